"""Score with both heads, combine to hazard, and report all metrics of all models in one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import is_missing
from ..models.heads import Head
from ..operators import metrics as E
from ..operators import scoring as H
from ..session import stage

P_METRICS = ["roc_auc", "average_precision"]
DECISIONS = ["brier_score", "accuracy", "precision", "recall", "f1_score"]
ERRORS = ["rmse", "mae", "r2"]


def score_model(
    df: DataFrame, p: Head, a: Head | None, keys: Sequence[str], cap: float | None, model: str
) -> DataFrame:
    """The prediction table of one model: key, predictions, actual values.

    Without an area head (there was nothing to train it on) area and hazard are NULL, and only the
    metrics of the ignition head are defined.
    """
    scored = p.score(df, "_p")
    scored = scored.withColumn("_log", F.lit(None).cast("double")) if a is None else a.score(scored, "_log")
    table = H.prediction_table(scored, list(keys), "_p", "_log", cap)
    return table.withColumn("model", F.lit(model))


def metric_report(predictions: DataFrame) -> DataFrame:
    """Long ``(model, head, subset, metric, value)`` rows for any number of models.

    ``predictions`` should be a stored or staged table: each family of metrics reads its few
    columns of it once, for all models and subsets together.
    """
    by = ["model"]
    p = predictions.select("model", "actual_ignition", "p_ignition")
    ranked = E.unpivot_metrics(
        E.ranking_metrics(p, "actual_ignition", "p_ignition", by), by, P_METRICS
    )
    decided = E.unpivot_metrics(
        E.classification_metrics(p, "actual_ignition", "p_ignition", by), by, DECISIONS
    )
    p_rows = _tag(ranked.unionByName(decided), "ignition", "all")

    keys = ["model", "subset"]
    area = E.positive_subsets(predictions, "actual_burned_area")
    # Log and original scale of all models and subsets in one aggregation.
    scales = F.array(
        *[
            F.struct(F.lit(s).alias("scale"), F.col(f"actual_{c}").alias("a"), F.col(c).alias("p"))
            for s, c in (("", "log_burned_area"), ("_original", "burned_area"))
        ]
    )
    scaled = area.select(*keys, F.explode(scales).alias("s")).select(*keys, "s.*")
    errors = E.unpivot_metrics(
        E.regression_metrics(scaled, "a", "p", [*keys, "scale"]), [*keys, "scale"], ERRORS
    )
    errors = errors.where((F.col("scale") == "") | (F.col("metric") != "r2")).select(
        *keys, F.concat("metric", "scale").alias("metric"), "value"
    )
    # Area and hazard of all models and subsets are ranked in one ordering pass.
    actual = predictions.withColumn(
        "_actual", H.actual_hazard("actual_ignition", "actual_burned_area")
    )
    paired = [
        (area, "burned_area", "actual_log_burned_area", "log_burned_area"),
        (E.positive_subsets(actual.where(~is_missing("_actual") & ~is_missing("hazard_score")), "_actual"), "hazard", "_actual", "hazard_score"),
    ]
    columns = [[*keys, F.lit(head).alias("head"), F.col(x).cast("double").alias("_a"), F.col(y).cast("double").alias("_b")] for _, head, x, y in paired]
    both = paired[0][0].select(*columns[0]).unionByName(paired[1][0].select(*columns[1]))
    rhos = stage(E.spearman(both, "_a", "_b", [*keys, "head"]).select(*keys, "head", "rho"))
    ranks = E.unpivot_metrics(rhos.where("head = 'burned_area'"), keys, ["rho"]).withColumn("metric", F.lit("spearman"))
    residuals = E.add_residual(
        predictions.where("actual_burned_area > 0"), "actual_log_burned_area", "log_burned_area"
    )
    profile = E.unpivot_metrics(
        E.error_profile(residuals, "residual", by),
        by,
        ["large_percent", "under_percent", "over_percent"],
    ).withColumn("subset", F.lit("positive"))
    a_rows = (
        errors.unionByName(ranks)
        .unionByName(profile)
        .withColumn("head", F.lit("burned_area"))
    )

    own = rhos.where("head = 'hazard'").drop("head")
    hazard = _tag(E.evaluate_hazard(actual, "_actual", "hazard_score", by, own), "hazard", "all")
    order = ["model", "head", "subset", "metric", "value"]
    return (
        p_rows.select(*order).unionByName(a_rows.select(*order)).unionByName(hazard.select(*order))
    )


def _tag(df: DataFrame, head: str, subset: str) -> DataFrame:
    return df.withColumn("head", F.lit(head)).withColumn("subset", F.lit(subset))


def compare_families(
    report: DataFrame, ours: str = "boosted", base: str = "linear"
) -> DataFrame:
    """Metric by metric comparison of two models of a report."""
    keys = ["head", "subset", "metric"]
    lower = ["rmse", "mae", "rmse_original", "mae_original", "brier_score"]
    lower += ["log1p_hazard_rmse", "log1p_hazard_mae"]
    report = stage(report)
    picked = [report.where(F.col("model") == m).select(*keys, "value") for m in (ours, base)]
    return E.compare_models(picked[0], picked[1], lower, keys)
