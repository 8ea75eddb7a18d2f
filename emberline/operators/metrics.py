"""Exact evaluation metrics as grouped aggregates.

Everything comes as long rows ``(by..., metric, value)`` or as curve points. ``by`` carries the
model and subset, so that all models and subsets of a report share one pass. Rank metrics first
reduce to distinct scores and then use prefix sums over range cells.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import count_if, is_missing
from ..session import stage
from .joins import hot_split_join, lookup_join
from .ordering import CELL, prefix_sums, range_cells, with_next


def _ratio(a: Column, b: Column) -> Column:
    """a / b, 0 on an empty denominator."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def unpivot_metrics(df: DataFrame, by: Sequence[str], names: Sequence[str]) -> DataFrame:
    """One row per metric from one column per metric."""
    pairs = F.array(
        *[
            F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value"))
            for n in names
        ]
    )
    return df.select(*by, F.explode(pairs).alias("m")).select(*by, "m.metric", "m.value")


# --- ranking of scores --------------------------------------------------------------------------


def score_counts(
    df: DataFrame, label: str, score: str, by: Sequence[str] = ()
) -> DataFrame:
    """Positives and negatives per distinct score; rows with a missing part are left out."""
    kept = df.where(~is_missing(F.col(label).cast("double")) & ~is_missing(F.col(score).cast("double")))
    return kept.groupBy(*by, F.col(score).cast("double").alias("score")).agg(
        F.sum((F.col(label) == 1).cast("bigint")).alias("pos"),
        F.sum((F.col(label) != 1).cast("bigint")).alias("neg"),
    )


def score_curve(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Per distinct score, true and false positives when everything at or above it is called."""
    return _curve(score_counts(df, label, score, by), by, stored=False)


def _curve(counts: DataFrame, by: Sequence[str], stored: bool) -> DataFrame:
    return prefix_sums(counts, ["score"], ["pos", "neg"], by=by, descending=True, stored=stored)


def _curve_and_totals(
    df: DataFrame, label: str, score: str, by: Sequence[str], ahead: bool = False
) -> tuple[DataFrame, DataFrame]:
    """The curve with its totals, and the totals; ``ahead`` adds the counts of the next lower score."""
    counts = range_cells(score_counts(df, label, score, by), ["score"], by)
    totals = counts.groupBy(*by).agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    if ahead:
        counts = with_next(counts, ["score"], ["pos", "neg"], by, descending=True)
    return _with_totals(_curve(counts, by, stored=True).drop(CELL), totals, by), totals


def ranking_metrics(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """``roc_auc`` (ties count half) and ``average_precision`` (step sum), one row per group.

    Both are undefined, and NULL, where a class is absent.
    """
    tp, fp = F.col("upto_pos"), F.col("upto_neg")
    pos, neg = F.col("pos"), F.col("neg")
    summed = score_curve(df, label, score, by).groupBy(*by).agg(
        F.sum(pos).cast("double").alias("_p"),
        F.sum(neg).cast("double").alias("_n"),
        # negatives below a score are all minus those at or above it
        F.sum(neg.cast("double") * (tp - pos) + pos.cast("double") * neg / 2).alias("_wins"),
        F.sum(pos * (tp / (tp + fp))).alias("_steps"),
    )
    return summed.select(
        *by,
        F.try_divide("_wins", F.col("_p") * F.col("_n")).alias("roc_auc"),
        F.try_divide("_steps", "_p").alias("average_precision"),
    )


def roc_points(df: DataFrame, label: str, score: str, by: Sequence[str] = (), corners: bool = False) -> DataFrame:
    """ROC points for every distinct score, with the origin (threshold +infinity).

    With ``corners`` a point is left out if the curve goes on after it by the same step as before
    it, so that long straight runs are only their ends; the first and last score stay.
    """
    curve, totals = _curve_and_totals(df, label, score, by, corners)
    if corners:
        start = (F.col("upto_pos") == F.col("pos")) & (F.col("upto_neg") == F.col("neg"))
        goes_on = (F.col("next_pos") == F.col("pos")) & (F.col("next_neg") == F.col("neg"))
        curve = curve.where(start | ~F.coalesce(goes_on, F.lit(False)))
    points = curve.select(
        *by,
        F.col("score").alias("threshold"),
        F.try_divide("upto_neg", "_n").alias("fpr"),
        F.try_divide("upto_pos", "_p").alias("tpr"),
    )
    origin = totals.select(
        *by,
        F.lit(float("inf")).alias("threshold"),
        F.lit(0.0).alias("fpr"),
        F.lit(0.0).alias("tpr"),
    )
    return points.unionByName(origin)


def pr_points(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Precision and recall for every distinct score, the end point (1, 0) and the prevalence."""
    curve = score_curve(df, label, score, by)
    totals = curve.groupBy(*by).agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    prevalence = F.try_divide(F.col("_p"), F.col("_p") + F.col("_n"))
    points = _with_totals(curve, totals, by).select(
        *by,
        F.col("score").alias("threshold"),
        F.try_divide(F.col("upto_pos"), F.col("upto_pos") + F.col("upto_neg")).alias("precision"),
        F.try_divide("upto_pos", "_p").alias("recall"),
        prevalence.alias("prevalence"),
    )
    end = totals.select(
        *by,
        F.lit(float("inf")).alias("threshold"),
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
        prevalence.alias("prevalence"),
    )
    return points.unionByName(end)


def _with_totals(curve: DataFrame, totals: DataFrame, by: Sequence[str]) -> DataFrame:
    if by:
        # `by` names models and subsets; their totals are broadcast after a look at how many there are.
        return lookup_join(curve, totals, list(by), ["score"])
    pair = totals.select(F.struct("_p", "_n")).scalar()
    return curve.withColumn("_both", pair).select("*", "_both._p", "_both._n").drop("_both")


def _average_ranks(pairs: DataFrame, by: Sequence[str]) -> DataFrame:
    """Stored (by, _side, _value, _pairs, _rank) of both columns of the pairs, from one ordering pass."""
    sides = F.array(*[F.struct(F.lit(s).alias("_side"), F.col(f"_{s}").alias("_value")) for s in "xy"])
    each = pairs.select(*by, "_c", F.explode(sides).alias("_s")).select(*by, "_c", "_s.*")
    counted = each.groupBy(*by, "_side", "_value").agg(F.sum("_c").alias("_rows"), F.count(F.lit(1)).alias("_pairs"))
    ranked = prefix_sums(counted, ["_value"], ["_rows"], by=[*by, "_side"])
    rank = F.col("upto__rows") - F.col("_rows") + (F.col("_rows") + 1) / 2
    return stage(ranked.select(*by, "_side", "_value", "_pairs", rank.alias("_rank")))


def spearman(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Spearman's rho with average ranks for ties, ``n``, and the t value of the test on it.

    Equal (x, y) rows collapse first. Ranks are looked up with hot values split off, so zeros
    filling a third of the table do not meet in one task. Constant input gives NULL.
    """
    pairs = stage(
        df.select(*by, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
        .where(~is_missing("_x") & ~is_missing("_y"))
        .groupBy(*by, "_x", "_y")
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    ranks = _average_ranks(pairs, by)
    ranked = pairs
    for side, other in ("xy", "yx"):
        own = ranks.where(F.col("_side") == side).withColumnsRenamed({"_value": f"_{side}", "_rank": f"_r{side}"}).drop("_side")
        ranked = hot_split_join(ranked, own, [*by, f"_{side}"], "_pairs", [f"_r{side}"], [f"_{other}"], stored=True)
    # Ranks average (n+1)/2 exactly, so the moments are taken around it for accuracy.
    sizes = pairs.groupBy(*by).agg(F.sum("_c").alias("_n"))
    centred = _with_count(ranked, sizes, by, ["_x", "_y"])
    middle = (F.col("_n") + 1) / 2
    dx, dy = F.col("_rx") - middle, F.col("_ry") - middle
    sums = centred.groupBy(*by).agg(
        F.max("_n").alias("n"),
        F.sum(F.col("_c") * dx * dy).alias("_xy"),
        F.sum(F.col("_c") * dx * dx).alias("_xx"),
        F.sum(F.col("_c") * dy * dy).alias("_yy"),
    )
    rho = F.try_divide(F.col("_xy"), F.sqrt("_xx") * F.sqrt("_yy"))
    with_rho = sums.select(*by, F.coalesce("n", F.lit(0)).alias("n"), rho.alias("rho"))
    inside = F.try_divide(F.col("n") - 2, 1 - F.col("rho") * F.col("rho"))
    return with_rho.withColumn("t", F.when(inside >= 0, F.col("rho") * F.sqrt(inside)))


def _with_count(df: DataFrame, sizes: DataFrame, by: Sequence[str], spread: Sequence[str]) -> DataFrame:
    if by:
        # Few values of `by` hold all rows: the sizes are broadcast after a look at how many there are.
        return lookup_join(df, sizes, list(by), list(spread))
    return df.withColumn("_n", sizes.scalar())


# --- decisions ----------------------------------------------------------------------------------


def decision(score: Column | str, threshold: float = 0.5) -> Column:
    """Strictly above the threshold counts as ignition."""
    score = F.col(score) if isinstance(score, str) else score
    return (score > threshold).cast("int")


def _judged(df: DataFrame, label: str, score: str) -> DataFrame:
    return df.where(~is_missing(F.col(label).cast("double")) & ~is_missing(F.col(score).cast("double")))


def classification_metrics(
    df: DataFrame, label: str, score: str, by: Sequence[str] = (), threshold: float = 0.5
) -> DataFrame:
    """Brier score, accuracy, precision, recall and F1, one row per group.

    Rows without a label or without a score count nowhere, as in the ranking metrics.
    """
    kept = _judged(df, label, score)
    y, p = F.col(label).cast("int"), F.col(score).cast("double")
    called = decision(p, threshold)
    counted = kept.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        count_if((y == 1) & (called == 1)).alias("tp"),
        count_if((y == 0) & (called == 1)).alias("fp"),
        count_if((y == 1) & (called == 0)).alias("fn"),
        count_if((y == 0) & (called == 0)).alias("tn"),
        F.avg(F.pow(p - y, 2)).alias("brier_score"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counted.select(
        *by,
        "n",
        "brier_score",
        F.try_divide((tp + tn).cast("double"), F.col("n")).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
    )


def confusion_matrix(
    df: DataFrame, label: str, score: str, by: Sequence[str] = (), threshold: float = 0.5
) -> DataFrame:
    """All four cells per group with counts and percent of all rows with a label and a score,
    empty cells included."""
    kept = _judged(df, label, score)
    y, called = F.col(label).cast("int"), decision(F.col(score).cast("double"), threshold)
    grid = [(a, b) for a in (0, 1) for b in (0, 1)]
    counted = kept.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        *[count_if((y == a) & (called == b)).alias(f"c{a}{b}") for a, b in grid],
    )
    cells = F.array(
        *[
            F.struct(
                F.lit(a).alias("actual"), F.lit(b).alias("predicted"), F.col(f"c{a}{b}").alias("rows")
            )
            for a, b in grid
        ]
    )
    return counted.select(*by, "n", F.explode(cells).alias("c")).select(
        *by,
        "c.*",
        F.try_divide(F.lit(100.0) * F.col("c.rows"), F.col("n")).alias("percent"),
    )


# --- errors of a regression ---------------------------------------------------------------------


def regression_metrics(
    df: DataFrame, actual: Column | str, predicted: Column | str, by: Sequence[str] = ()
) -> DataFrame:
    """``n``, MSE, RMSE, MAE and R2, one row per group; a constant target has R2 1 or 0."""
    a = F.col(actual) if isinstance(actual, str) else actual
    p = F.col(predicted) if isinstance(predicted, str) else predicted
    pairs = df.select(*by, a.cast("double").alias("_a"), p.cast("double").alias("_p")).where(
        ~is_missing("_a") & ~is_missing("_p")
    )
    e = F.col("_a") - F.col("_p")
    summed = pairs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(e * e).alias("mse"),
        F.avg(F.abs(e)).alias("mae"),
        F.var_pop("_a").alias("_var"),
    )
    r2 = F.when(F.col("_var") > 0, 1 - F.col("mse") / F.col("_var")).when(
        F.col("_var") == 0, (F.col("mse") == 0).cast("double")
    )
    return summed.select(*by, "n", "mse", F.sqrt("mse").alias("rmse"), "mae", r2.alias("r2"))


def add_residual(
    df: DataFrame, actual: str = "actual", predicted: str = "predicted", name: str = "residual"
) -> DataFrame:
    return df.withColumn(name, F.col(actual) - F.col(predicted))


def error_profile(df: DataFrame, residual: str, by: Sequence[str] = ()) -> DataFrame:
    """Large errors (beyond two sample deviations) and the balance of under- and overestimates."""
    kept = df.where(~is_missing(residual))
    r = F.col(residual)
    sizes = kept.groupBy(*by).agg(F.stddev_samp(r).alias("_n"))
    marked = _with_count(kept, sizes, by, [residual])
    n = F.count(F.lit(1))
    large, under, over = count_if(F.abs(r) > 2 * F.col("_n")), count_if(r > 0), count_if(r < 0)
    return marked.groupBy(*by).agg(
        n.alias("n"),
        large.alias("large_errors"),
        F.try_divide(large * 100.0, n).alias("large_percent"),
        under.alias("underestimates"),
        F.try_divide(under * 100.0, n).alias("under_percent"),
        over.alias("overestimates"),
        F.try_divide(over * 100.0, n).alias("over_percent"),
    )


def positive_subsets(df: DataFrame, value: str) -> DataFrame:
    """Rows tagged for subset ``all`` and, where ``value`` > 0, a second time for ``positive``."""
    tags = F.when(F.col(value) > 0, F.array(F.lit("all"), F.lit("positive"))).otherwise(
        F.array(F.lit("all"))
    )
    return df.withColumn("subset", F.explode(tags))


def evaluate_hazard(
    df: DataFrame, actual: str, predicted: str, by: Sequence[str] = (), ranks: DataFrame | None = None
) -> DataFrame:
    """Hazard metrics in long form: original scale on all rows, log scale where hazard is real.

    The log metrics use rows with actual hazard above 0 whatever was predicted. ``ranks`` has the
    (by, subset, rho) of the same rows where the caller has ordered them already.
    """
    tagged = positive_subsets(
        df.select(*by, F.col(actual).alias("_y"), F.col(predicted).alias("_h")).where(
            ~is_missing("_y") & ~is_missing("_h")
        ),
        "_y",
    )
    keys = [*by, "subset"]
    log = F.col("subset") == "positive"
    errors = regression_metrics(
        tagged.withColumns(
            {
                "_t": F.when(log, F.log1p("_y")).otherwise(F.col("_y")),
                "_q": F.when(log, F.log1p("_h")).otherwise(F.col("_h")),
            }
        ),
        "_t",
        "_q",
        keys,
    )
    if ranks is None:
        ranks = spearman(tagged, "_y", "_h", keys).select(*keys, "rho")
    on_all, on_pos = F.col("subset") == "all", F.col("subset") == "positive"

    def value(where: Column, column: str) -> Column:
        return F.max(F.when(where, F.col(column)))

    wide = (
        errors.join(ranks, keys, "left")
        .groupBy(*by)
        .agg(
            value(on_all, "rmse").alias("rmse"),
            value(on_all, "mae").alias("mae"),
            value(on_all, "r2").alias("r2"),
            value(on_all, "rho").alias("spearman"),
            value(on_pos, "rho").alias("spearman_positive"),
            value(on_pos, "rmse").alias("log1p_hazard_rmse"),
            value(on_pos, "mae").alias("log1p_hazard_mae"),
            F.coalesce(value(on_pos, "n"), F.lit(0)).alias("log1p_hazard_n"),
        )
    )
    return unpivot_metrics(wide, by, [c for c in wide.columns if c not in by])


# --- comparisons and descriptions ---------------------------------------------------------------


def compare_models(
    ours: DataFrame,
    base: DataFrame,
    lower_is_better: Sequence[str] = ("rmse", "mae", "mse", "brier_score"),
    keys: Sequence[str] = ("subset", "metric"),
) -> DataFrame:
    """Difference, ratio in percent, and the improvement where a lower value is better."""
    joined = ours.join(base.withColumnRenamed("value", "base_value"), list(keys))
    v, b = F.col("value"), F.col("base_value")
    lower = F.col("metric").isin(list(lower_is_better))
    return joined.select(
        *keys,
        v,
        b,
        (v - b).alias("difference"),
        ((F.try_divide(v, b) - 1) * 100).alias("ratio_percent"),
        F.when(lower & (b > 0), (1 - v / b) * 100)
        .when(lower, F.lit(float("nan")))
        .alias("improvement_percent"),
    )


def value_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    wide = df.agg(
        *[F.min(c).alias(f"lo_{i}") for i, c in enumerate(columns)],
        *[F.max(c).alias(f"hi_{i}") for i, c in enumerate(columns)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"lo_{i}").cast("double").alias("minimum"),
                F.col(f"hi_{i}").cast("double").alias("maximum"),
            )
            for i, c in enumerate(columns)
        ]
    )
    return wide.select(F.explode(rows).alias("r")).select("r.*")
