"""Checks of scoring and evaluation metrics on deterministic pseudo-predictions with many ties."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics as E
from ..operators import scoring as H
from .registry import check
from .views import Tables

KEY = ["year", "fire", "img"]


def _cap(t: Tables):
    return H.log_area_cap(t.stored_pred)


def _hazard(t: Tables):
    """Result table of the heads: predictions, actuals and hazard."""
    table = H.prediction_table(t.stored_pred, KEY, "p_ignition", "log_pred", _cap(t))
    return table.withColumn(
        "actual_hazard", H.actual_hazard("actual_ignition", "actual_burned_area")
    )


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


# --- scoring ------------------------------------------------------------------------------------


@check("h2_clip_log_area", "SELECT img, round(log_clip, 6) AS log_clip FROM scored")
def clip_log_area(t: Tables):
    clipped = H.clip_log_area("log_pred", _cap(t))
    return t.stored_pred.select("img", F.round(clipped, 6).alias("log_clip"))


@check(
    "h2_clip_without_train",
    "SELECT img, round(greatest(log_pred, 0), 6) AS log_clip FROM pred",
)
def clip_without_train(t: Tables):
    cap = H.log_area_cap(t.stored_pred.where("burned_area < 0"))
    return t.stored_pred.select("img", F.round(H.clip_log_area("log_pred", cap), 6).alias("log_clip"))


@check("h3_hazard", "SELECT img, round(hazard, 6) AS hazard_score FROM haz")
def hazard(t: Tables):
    clipped = H.clip_log_area("log_pred", _cap(t))
    return t.stored_pred.select("img", F.round(H.hazard("p_ignition", clipped), 6).alias("hazard_score"))


@check(
    "h4_actual_hazard",
    "SELECT img, CAST(ignition AS DOUBLE) * burned_area AS actual_hazard FROM pred",
)
def actual_hazard(t: Tables):
    return t.stored_pred.select(
        "img", H.actual_hazard("ignition", "burned_area").alias("actual_hazard")
    )


@check(
    "h5_prediction_table",
    """
SELECT year, fire, img, p_ignition, round(log_clip, 6) AS log_burned_area,
       round(area_pred, 6) AS burned_area, round(hazard, 6) AS hazard_score,
       CAST(ignition AS DOUBLE) AS actual_ignition, CAST(burned_area AS DOUBLE) AS actual_burned_area,
       round(log_burned_area, 6) AS actual_log_burned_area
FROM haz""",
)
def prediction_table(t: Tables):
    table = H.prediction_table(t.stored_pred, KEY, "p_ignition", "log_pred", _cap(t))
    return _rounded(
        table, "log_burned_area", "burned_area", "hazard_score", "actual_log_burned_area"
    )


@check(
    "h6_risk_tiers",
    """
SELECT img, CASE WHEN p_ignition > 0.7 THEN 'HIGH' WHEN p_ignition > 0.3 THEN 'MODERATE' ELSE 'LOW' END AS risk,
       CASE WHEN 40 * hazard > 1000 THEN 'MAJOR' WHEN 40 * hazard > 100 THEN 'SIGNIFICANT' ELSE 'MODERATE' END AS impact
FROM haz""",
)
def risk_tiers(t: Tables):
    scaled = _hazard(t).withColumn("hazard_score", 40 * F.col("hazard_score"))
    return H.add_tiers(scaled).select("img", "risk", "impact")


_COMPARED = """
SELECT {columns}, CASE WHEN p_ignition > 0.5 THEN 'YES' ELSE 'NO' END AS predicted,
       CASE WHEN ignition = 1 THEN 'YES' ELSE 'NO' END AS actual,
       (p_ignition > 0.5) = (ignition = 1) AS correct,
       round(CASE WHEN burned_area > 0 THEN abs(area_pred - burned_area) END, 6) AS area_error,
       round(CASE WHEN burned_area > 0 THEN abs(area_pred - burned_area) / burned_area * 100 END, 6)
         AS area_error_percent
FROM haz"""


@check("h7_row_comparison", _COMPARED.format(columns="img"))
def row_comparison(t: Tables):
    compared = H.compare_rows(_hazard(t))
    return _rounded(compared, "area_error", "area_error_percent").select(
        "img", "predicted", "actual", "correct", "area_error", "area_error_percent"
    )


@check(
    "h8_random_sample",
    """
SELECT img, round(hazard, 6) AS hazard_score FROM haz
ORDER BY md5(concat('42|', CAST(year AS VARCHAR), '|', CAST(fire AS VARCHAR), '|', CAST(img AS VARCHAR)))
LIMIT 1""",
)
def random_sample(t: Tables):
    picked = H.random_sample(t.stored_pred, KEY, 42)
    table = H.prediction_table(picked, KEY, "p_ignition", "log_pred", _cap(t))
    return table.select("img", F.round("hazard_score", 6).alias("hazard_score"))


@check(
    "h8_chosen_sample",
    """
SELECT img, sample_number, round(hazard, 6) AS hazard_score FROM (
  SELECT h.*, CAST(row_number() OVER (ORDER BY h.year, h.fire, s.in_fire_index) - 1 AS BIGINT) AS sample_number
  FROM haz h JOIN smp s USING (img)) t WHERE sample_number = 123""",
)
def chosen_sample(t: Tables):
    from ..operators import samples as S

    numbers = S.find_samples(S.number_samples(t.smp), 123).select("img", "sample_number")
    table = _hazard(t).join(numbers, "img")
    return table.select("img", "sample_number", F.round("hazard_score", 6).alias("hazard_score"))


# --- ranking metrics ----------------------------------------------------------------------------

_CURVE = """
d AS (SELECT p_ignition AS s, sum(ignition) AS pos, sum(1 - ignition) AS neg FROM pred GROUP BY 1),
cum AS (SELECT s, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
               sum(pos) OVER () AS p, sum(neg) OVER () AS n
        FROM d WINDOW w AS (ORDER BY s DESC))"""


@check(
    "e1_roc_auc",
    f"""
WITH {_CURVE}
SELECT round(sum(neg * (tp - pos) + pos * neg / 2.0::DOUBLE) / (max(p) * max(n)), 6) AS roc_auc FROM cum""",
)
def roc_auc(t: Tables):
    return E.ranking_metrics(t.stored_pred, "ignition", "p_ignition").select(
        F.round("roc_auc", 6).alias("roc_auc")
    )


@check(
    "e2_average_precision",
    f"""
WITH {_CURVE}
SELECT round(sum(pos * (CAST(tp AS DOUBLE) / (tp + fp))) / max(p), 6) AS average_precision FROM cum""",
)
def average_precision(t: Tables):
    return E.ranking_metrics(t.stored_pred, "ignition", "p_ignition").select(
        F.round("average_precision", 6).alias("average_precision")
    )


@check(
    "e3_brier_score",
    "SELECT round(avg((p_ignition - ignition) * (p_ignition - ignition)), 6) AS brier_score FROM pred",
)
def brier_score(t: Tables):
    return E.classification_metrics(t.stored_pred, "ignition", "p_ignition").select(
        F.round("brier_score", 6).alias("brier_score")
    )


@check(
    "e4_decision_metrics",
    """
WITH c AS (SELECT CAST(count(*) AS DOUBLE) AS n,
  CAST(sum(CASE WHEN ignition = 1 AND p_ignition > 0.5 THEN 1 ELSE 0 END) AS DOUBLE) AS tp,
  CAST(sum(CASE WHEN ignition = 0 AND p_ignition > 0.5 THEN 1 ELSE 0 END) AS DOUBLE) AS fp,
  CAST(sum(CASE WHEN ignition = 1 AND p_ignition <= 0.5 THEN 1 ELSE 0 END) AS DOUBLE) AS fn FROM pred)
SELECT round((n - fp - fn) / n, 6) AS accuracy, round(tp / (tp + fp), 6) AS precision,
       round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1_score FROM c""",
)
def decision_metrics(t: Tables):
    metrics = E.classification_metrics(t.stored_pred, "ignition", "p_ignition")
    names = ("accuracy", "precision", "recall", "f1_score")
    return metrics.select(*[F.round(n, 6).alias(n) for n in names])


@check(
    "e4_empty_denominator",
    """
SELECT CAST(0 AS DOUBLE) AS precision, CAST(0 AS DOUBLE) AS recall, CAST(0 AS DOUBLE) AS f1_score""",
)
def empty_denominator(t: Tables):
    metrics = E.classification_metrics(t.stored_pred, "ignition", "p_ignition", threshold=2.0)
    return metrics.select("precision", "recall", "f1_score")


@check(
    "e5_confusion_matrix",
    """
SELECT a AS actual, b AS predicted,
       count(CASE WHEN ignition = a AND (CASE WHEN p_ignition > 0.5 THEN 1 ELSE 0 END) = b THEN 1 END) AS "rows",
       round(100.0 * count(CASE WHEN ignition = a AND (CASE WHEN p_ignition > 0.5 THEN 1 ELSE 0 END) = b
                           THEN 1 END) / count(*), 6) AS percent
FROM pred, (VALUES (0), (1)) x(a), (VALUES (0), (1)) y(b) GROUP BY a, b""",
)
def confusion_matrix(t: Tables):
    return _rounded(E.confusion_matrix(t.stored_pred, "ignition", "p_ignition"), "percent")


@check(
    "e6_ignition_accuracy",
    """
SELECT year, count(*) AS n,
       round(avg(CASE WHEN (p_ignition > 0.5) = (ignition = 1) THEN 1.0 ELSE 0.0 END), 6) AS accuracy
FROM pred GROUP BY year""",
)
def ignition_accuracy(t: Tables):
    metrics = E.classification_metrics(t.stored_pred, "ignition", "p_ignition", by=["year"])
    return metrics.select("year", "n", F.round("accuracy", 6).alias("accuracy"))


@check(
    "e7_roc_points",
    f"""
WITH {_CURVE}
SELECT s AS threshold, round(CAST(fp AS DOUBLE) / n, 6) AS fpr, round(CAST(tp AS DOUBLE) / p, 6) AS tpr FROM cum
UNION ALL SELECT CAST('infinity' AS DOUBLE), 0, 0""",
)
def roc_points(t: Tables):
    return _rounded(E.roc_points(t.stored_pred, "ignition", "p_ignition"), "fpr", "tpr")


@check(
    "e7_roc_corners",
    f"""
WITH {_CURVE},
steps AS (SELECT *, tp - lag(tp, 1, 0) OVER o AS dt, fp - lag(fp, 1, 0) OVER o AS df FROM cum WINDOW o AS (ORDER BY s DESC)),
near AS (SELECT *, lead(dt) OVER o AS nt, lead(df) OVER o AS nf, lag(s) OVER o AS higher FROM steps WINDOW o AS (ORDER BY s DESC))
SELECT s AS threshold, round(CAST(fp AS DOUBLE) / n, 6) AS fpr, round(CAST(tp AS DOUBLE) / p, 6) AS tpr FROM near
WHERE higher IS NULL OR nt IS NULL OR nt <> dt OR nf <> df
UNION ALL SELECT CAST('infinity' AS DOUBLE), 0, 0""",
)
def roc_corners(t: Tables):
    return _rounded(E.roc_points(t.stored_pred, "ignition", "p_ignition", corners=True), "fpr", "tpr")


@check(
    "e8_pr_points",
    f"""
WITH {_CURVE}
SELECT s AS threshold, round(CAST(tp AS DOUBLE) / (tp + fp), 6) AS precision,
       round(CAST(tp AS DOUBLE) / p, 6) AS recall, round(CAST(p AS DOUBLE) / (p + n), 6) AS prevalence FROM cum
UNION ALL SELECT CAST('infinity' AS DOUBLE), 1, 0, (SELECT round(avg(ignition), 6) FROM pred)""",
)
def pr_points(t: Tables):
    points = E.pr_points(t.stored_pred, "ignition", "p_ignition")
    return _rounded(points, "precision", "recall", "prevalence")


# --- regression metrics -------------------------------------------------------------------------

@check(
    "e9_rmse",
    """
SELECT count(*) AS n, round(avg((log_burned_area - log_clip) ** 2), 6) AS mse,
       round(sqrt(avg((log_burned_area - log_clip) ** 2)), 6) AS rmse FROM haz""",
)
def rmse(t: Tables):
    errors = E.regression_metrics(_hazard(t), "actual_log_burned_area", "log_burned_area")
    return _rounded(errors, "mse", "rmse").select("n", "mse", "rmse")


@check("e10_mae", "SELECT round(avg(abs(log_burned_area - log_clip)), 6) AS mae FROM haz")
def mae(t: Tables):
    errors = E.regression_metrics(_hazard(t), "actual_log_burned_area", "log_burned_area")
    return errors.select(F.round("mae", 6).alias("mae"))


@check(
    "e11_r2",
    """
SELECT year, round(1 - avg((log_burned_area - log_clip) ** 2) / var_pop(log_burned_area), 6) AS r2
FROM haz GROUP BY year""",
)
def r2(t: Tables):
    errors = E.regression_metrics(
        _hazard(t), "actual_log_burned_area", "log_burned_area", by=["year"]
    )
    return errors.select("year", F.round("r2", 6).alias("r2"))


_RANKS = """
ranks AS (SELECT count(*) OVER () AS n,
  rank() OVER (ORDER BY {x}) + (count(*) OVER (PARTITION BY {x}) - 1) / 2.0::DOUBLE AS rx,
  rank() OVER (ORDER BY {y}) + (count(*) OVER (PARTITION BY {y}) - 1) / 2.0::DOUBLE AS ry FROM {source})"""


@check(
    "e12_spearman",
    "WITH "
    + _RANKS.format(x="log_burned_area", y="log_clip", source="haz")
    + " SELECT max(n) AS n, round(corr(rx, ry), 6) AS rho FROM ranks",
)
def spearman(t: Tables):
    ranks = E.spearman(_hazard(t), "actual_log_burned_area", "log_burned_area")
    return ranks.select("n", F.round("rho", 6).alias("rho"))


@check(
    "e13_spearman_t",
    "WITH "
    + _RANKS.format(x="log_burned_area", y="log_pred", source="pred")
    + """, r AS (SELECT max(n) AS n, corr(rx, ry) AS rho FROM ranks)
SELECT n, round(rho, 6) AS rho, round(rho * sqrt((n - 2) / (1 - rho * rho)), 4) AS t FROM r""",
)
def spearman_t(t: Tables):
    ranks = E.spearman(t.stored_pred, "log_burned_area", "log_pred")
    return ranks.select("n", F.round("rho", 6).alias("rho"), F.round("t", 4).alias("t"))


@check(
    "e14_original_scale",
    """
SELECT count(*) AS n, round(sqrt(avg((burned_area - area_pred) ** 2)), 6) AS rmse,
       round(avg(abs(burned_area - area_pred)), 6) AS mae FROM haz WHERE burned_area > 0""",
)
def original_scale(t: Tables):
    burnt = _hazard(t).where("actual_burned_area > 0")
    errors = E.regression_metrics(burnt, "actual_burned_area", H.area_from_log("log_burned_area"))
    return _rounded(errors, "rmse", "mae").select("n", "rmse", "mae")


_POSITIVE = "(SELECT * FROM haz WHERE actual > 0) q"


@check(
    "e15_evaluate_hazard",
    "WITH "
    + _RANKS.format(x="actual", y="hazard", source="haz")
    + ", p"
    + _RANKS.format(x="actual", y="hazard", source=_POSITIVE).strip()
    + """
SELECT 'rmse' AS metric, round(sqrt(avg((actual - hazard) ** 2)), 6) AS value FROM haz
UNION ALL SELECT 'mae', round(avg(abs(actual - hazard)), 6) FROM haz
UNION ALL SELECT 'r2', round(1 - avg((actual - hazard) ** 2) / var_pop(actual), 6) FROM haz
UNION ALL SELECT 'spearman', round(corr(rx, ry), 6) FROM ranks
UNION ALL SELECT 'spearman_positive', round(corr(rx, ry), 6) FROM pranks
UNION ALL SELECT 'log1p_hazard_rmse', round(sqrt(avg((ln(1 + actual) - ln(1 + hazard)) ** 2)), 6) FROM haz WHERE actual > 0
UNION ALL SELECT 'log1p_hazard_mae', round(avg(abs(ln(1 + actual) - ln(1 + hazard))), 6) FROM haz WHERE actual > 0
UNION ALL SELECT 'log1p_hazard_n', CAST(count(*) AS DOUBLE) FROM haz WHERE actual > 0""",
)
def evaluate_hazard(t: Tables):
    return _rounded(E.evaluate_hazard(_hazard(t), "actual_hazard", "hazard_score"), "value")


@check(
    "e16_masked_log_errors",
    """
SELECT count(*) AS n, round(avg(abs(log_clip - log_burned_area)), 6) AS mae,
       round(sqrt(avg((log_clip - log_burned_area) ** 2)), 6) AS rmse FROM haz WHERE burned_area > 0""",
)
def masked_log_errors(t: Tables):
    burnt = _hazard(t).where("actual_burned_area > 0")
    errors = E.regression_metrics(burnt, "actual_log_burned_area", "log_burned_area")
    return _rounded(errors, "mae", "rmse").select("n", "mae", "rmse")


def _residuals(t: Tables):
    burnt = _hazard(t).where("actual_burned_area > 0")
    return E.add_residual(burnt, "actual_log_burned_area", "log_burned_area")


@check(
    "e17_residuals",
    "SELECT img, round(log_burned_area - log_clip, 6) + 0 AS residual FROM haz WHERE burned_area > 0",
)
def residuals(t: Tables):
    return _residuals(t).select("img", F.round("residual", 6).alias("residual"))


_RES = "(SELECT log_burned_area - log_clip AS e FROM haz WHERE burned_area > 0) r"


@check(
    "e18_large_errors",
    f"""
SELECT count(*) AS n, count(CASE WHEN abs(e) > 2 * s THEN 1 END) AS large_errors,
       round(100.0 * count(CASE WHEN abs(e) > 2 * s THEN 1 END) / count(*), 6) AS large_percent
FROM {_RES}, (SELECT stddev_samp(e) AS s FROM {_RES}) d""",
)
def large_errors(t: Tables):
    profile = E.error_profile(_residuals(t), "residual")
    return _rounded(profile, "large_percent").select("n", "large_errors", "large_percent")


@check(
    "e19_under_over",
    f"""
SELECT count(CASE WHEN e > 0 THEN 1 END) AS underestimates,
       round(100.0 * count(CASE WHEN e > 0 THEN 1 END) / count(*), 6) AS under_percent,
       count(CASE WHEN e < 0 THEN 1 END) AS overestimates,
       round(100.0 * count(CASE WHEN e < 0 THEN 1 END) / count(*), 6) AS over_percent
FROM {_RES}""",
)
def under_over(t: Tables):
    profile = E.error_profile(_residuals(t), "residual")
    names = ("underestimates", "under_percent", "overestimates", "over_percent")
    return _rounded(profile, "under_percent", "over_percent").select(*names)


def _model_rows(t: Tables, shrink: float):
    burnt = _hazard(t).where("actual_burned_area > 0")
    errors = E.regression_metrics(
        burnt, "actual_log_burned_area", F.col("log_burned_area") * shrink
    )
    long = E.unpivot_metrics(errors, [], ["rmse", "mae", "r2"])
    return long.withColumn("subset", F.lit("positive"))


def _model_sql(shrink: str) -> str:
    e = f"(log_burned_area - log_clip * {shrink}::DOUBLE)"
    source = "FROM haz WHERE burned_area > 0"
    return f"""
SELECT 'rmse' AS metric, sqrt(avg({e} ** 2)) AS value {source}
UNION ALL SELECT 'mae', avg(abs({e})) {source}
UNION ALL SELECT 'r2', 1 - avg({e} ** 2) / var_pop(log_burned_area) {source}"""


@check(
    "e20_compare_models",
    f"""
SELECT 'positive' AS subset, metric, round(a.value, 6) AS value, round(b.value, 6) AS base_value,
       round(a.value - b.value, 6) AS difference, round((a.value / b.value - 1) * 100, 4) AS ratio_percent,
       round(CASE WHEN metric IN ('rmse', 'mae') THEN (1 - a.value / b.value) * 100 END, 4) AS improvement_percent
FROM ({_model_sql('1.0')}) a JOIN ({_model_sql('0.5')}) b USING (metric)""",
)
def compare_models(t: Tables):
    compared = E.compare_models(_model_rows(t, 1.0), _model_rows(t, 0.5))
    rounded = _rounded(compared, "value", "base_value", "difference")
    return rounded.withColumns(
        {c: F.round(c, 4) for c in ("ratio_percent", "improvement_percent")}
    )


@check(
    "e22_prediction_ranges",
    """
SELECT 'p_ignition' AS "column", min(p_ignition) AS minimum, max(p_ignition) AS maximum FROM haz
UNION ALL SELECT 'log_burned_area', round(min(log_clip), 6), round(max(log_clip), 6) FROM haz
UNION ALL SELECT 'hazard_score', round(min(hazard), 6), round(max(hazard), 6) FROM haz""",
)
def prediction_ranges(t: Tables):
    ranges = E.value_ranges(_hazard(t), ["p_ignition", "log_burned_area", "hazard_score"])
    return _rounded(ranges, "minimum", "maximum")


def _describe_sql(column: str, value: str) -> str:
    return f"""
SELECT '{column}' AS "column", count({value}) AS count, round(avg({value}), 6) AS mean,
       round(stddev_samp({value}), 6) AS std, round(min({value}), 6) AS min, round(max({value}), 6) AS max,
       round(quantile_cont({value}, 0.25), 6) AS q25, round(quantile_cont({value}, 0.5), 6) AS q50,
       round(quantile_cont({value}, 0.75), 6) AS q75 FROM haz"""


@check(
    "e23_describe",
    _describe_sql("p_ignition", "p_ignition")
    + " UNION ALL "
    + _describe_sql("log_burned_area", "log_clip")
    + " UNION ALL "
    + _describe_sql("hazard_score", "hazard"),
)
def describe(t: Tables):
    from ..operators import explore as X

    described = X.describe(_hazard(t), ["p_ignition", "log_burned_area", "hazard_score"])
    return _rounded(described, "mean", "std", "min", "max", "q25", "q50", "q75")
