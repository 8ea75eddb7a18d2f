"""Checks of the heads: trained on the published settings, compared by rows only."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..models import heads as M
from ..operators import features as X
from ..operators import metrics as E
from ..operators import scoring as H
from ..operators.prepare import name_features
from ..operators.splits import random_split_exact
from ..plans import evaluation, training
from ..session import stage, staging_root
from .registry import check
from .views import Tables

NAMES = ["avg_cont", "avg_static", "n_px", "label"]
KEY = ["year", "fire", "img"]


def _table(t: Tables):
    packed = F.array(*[F.col(n).cast("double") for n in NAMES])
    targets = name_features(X.add_targets(t.feat).withColumn("features", packed), NAMES)
    split = random_split_exact(targets, KEY)
    return stage(split.select(*KEY, *training.COLUMNS))


def _parts(t: Tables):
    table = _table(t)
    return [table.where(F.col("split") == s) for s in ("train", "val", "test")]


def _metrics(head, val):
    return M.validation_metrics(head, val).withColumn("value", F.round("value", 6))


@check("m1_boosted_classifier")
def boosted_classifier(t: Tables):
    train, val, _ = _parts(t)
    medians = training.feature_medians(train)
    return _metrics(M.boosted_classifier(train, val, NAMES, medians, M.Boosting()), val)


@check("m2_boosted_regressor")
def boosted_regressor(t: Tables):
    train, val, _ = _parts(t)
    medians = training.feature_medians(train)
    return _metrics(M.boosted_regressor(train, val, NAMES, medians, M.Boosting()), val)


@check("m3_early_stopping")
def early_stopping(t: Tables):
    train, val, _ = _parts(t)
    medians = training.feature_medians(train)
    settings = M.Boosting()
    head = M.boosted_regressor(train, val, NAMES, medians, settings)
    kept = F.lit(head.model.getNumTrees).cast("int").alias("trees")
    return _metrics(head, val).select("metric", "value", kept)


@check("m4_logistic_baseline")
def logistic_baseline(t: Tables):
    train, val, _ = _parts(t)
    medians = training.feature_medians(train)
    return _metrics(M.logistic_baseline(train, NAMES, medians), val)


@check("m5_linear_baseline")
def linear_baseline(t: Tables):
    train, val, _ = _parts(t)
    medians = training.feature_medians(train)
    head = M.linear_baseline(train, NAMES, medians)
    return _metrics(head, val.where("burned_area > 0"))


@check("m6_train_heads")
def train_heads(t: Tables):
    table = _table(t)
    heads = training.train_heads(table, NAMES, M.Boosting())
    return training.validation_report(heads, table.where("split = 'val'"))


@check("h1_ignition_probability")
def ignition_probability(t: Tables):
    train, _, test = _parts(t)
    head = M.logistic_baseline(train, NAMES, training.feature_medians(train))
    return head.score(test, "p_ignition").select(*KEY, "ignition", "p_ignition")


_SHRINK = {"boosted": "1.0", "linear": "0.5"}


def _report_sql() -> str:
    """Every metric of the report, from two models that differ by a factor."""
    models = "\nUNION ALL ".join(
        f"SELECT '{m}' AS model, ignition, burned_area, log_burned_area, actual, p_ignition * {s}::DOUBLE AS p, log_clip * {s}::DOUBLE AS lg FROM haz"
        for m, s in _SHRINK.items()
    )
    rows = []

    def add(head: str, subset: str, metric: str, value: str, source: str = "two", where: str = "true") -> None:
        rows.append(
            f"SELECT model, '{head}' AS head, '{subset}' AS subset, '{metric}' AS metric, round(CAST({value} AS DOUBLE), 6) AS value"
            f" FROM {source} WHERE {where} GROUP BY model"
        )

    called, hit = "(p > 0.5)", "(p > 0.5 AND ignition = 1)"
    pos = "sum(ignition)::DOUBLE"
    add("ignition", "all", "roc_auc", f"(sum(rp * ignition) - {pos} * ({pos} + 1) / 2) / ({pos} * (count(*) - {pos}))", "ranked")
    add("ignition", "all", "average_precision", "sum(pos * tp / (tp + fp)) / sum(pos)", "curve")
    add("ignition", "all", "brier_score", "avg((p - ignition) ** 2)")
    add("ignition", "all", "accuracy", f"avg(CASE WHEN {called} = (ignition = 1) THEN 1.0 ELSE 0.0 END)")
    add("ignition", "all", "precision", f"coalesce(count_if({hit}) / nullif(count_if({called}), 0), 0)")
    add("ignition", "all", "recall", f"coalesce(count_if({hit}) / nullif({pos}, 0), 0)")
    add("ignition", "all", "f1_score", f"coalesce(2.0 * count_if({hit}) / nullif(count_if({called}) + {pos}, 0), 0)")
    e, area, hazard = "(log_burned_area - lg)", "(exp(lg) - 1)", "(p * (exp(lg) - 1))"
    for subset, where in (("all", "true"), ("positive", "burned_area > 0")):
        add("burned_area", subset, "rmse", f"sqrt(avg({e} ** 2))", where=where)
        add("burned_area", subset, "mae", f"avg(abs({e}))", where=where)
        add("burned_area", subset, "r2", f"1 - avg({e} ** 2) / var_pop(log_burned_area)", where=where)
        add("burned_area", subset, "rmse_original", f"sqrt(avg((burned_area - {area}) ** 2))", where=where)
        add("burned_area", subset, "mae_original", f"avg(abs(burned_area - {area}))", where=where)
        add("burned_area", subset, "spearman", "corr(ra, rl)", f"ranked_{subset}")
    burnt = "burned_area > 0"
    add("burned_area", "positive", "large_percent", "100 * avg(CASE WHEN abs(e) > 2 * sd THEN 1.0 ELSE 0.0 END)", "spread")
    add("burned_area", "positive", "under_percent", f"100 * avg(CASE WHEN {e} > 0 THEN 1.0 ELSE 0.0 END)", where=burnt)
    add("burned_area", "positive", "over_percent", f"100 * avg(CASE WHEN {e} < 0 THEN 1.0 ELSE 0.0 END)", where=burnt)
    add("hazard", "all", "rmse", f"sqrt(avg((actual - {hazard}) ** 2))")
    add("hazard", "all", "mae", f"avg(abs(actual - {hazard}))")
    add("hazard", "all", "r2", f"1 - avg((actual - {hazard}) ** 2) / var_pop(actual)")
    add("hazard", "all", "spearman", "corr(rt, rh)", "ranked")
    add("hazard", "all", "spearman_positive", "corr(rt, rh)", "ranked_hazard")
    logs = f"(ln(1 + actual) - ln(1 + {hazard}))"
    add("hazard", "all", "log1p_hazard_rmse", f"sqrt(avg({logs} ** 2))", where="actual > 0")
    add("hazard", "all", "log1p_hazard_mae", f"avg(abs({logs}))", where="actual > 0")
    add("hazard", "all", "log1p_hazard_n", "count(*)", where="actual > 0")

    def rank(x: str, name: str) -> str:
        return f"rank() OVER (PARTITION BY model ORDER BY {x}) + (count(*) OVER (PARTITION BY model, {x}) - 1) / 2.0 AS {name}"

    ranks = ", ".join(rank(x, n) for x, n in (("p", "rp"), ("log_burned_area", "ra"), ("lg", "rl"), ("actual", "rt"), (hazard, "rh")))
    return f"""WITH two AS ({models}),
ranked AS (SELECT *, {ranks} FROM two),
ranked_all AS (SELECT * FROM ranked),
ranked_positive AS (SELECT model, {rank("log_burned_area", "ra")}, {rank("lg", "rl")} FROM two WHERE burned_area > 0),
ranked_hazard AS (SELECT model, {rank("actual", "rt")}, {rank(hazard, "rh")} FROM two WHERE actual > 0),
counts AS (SELECT model, p, sum(ignition) AS pos, count(*) - sum(ignition) AS neg FROM two GROUP BY model, p),
curve AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM counts WINDOW w AS (PARTITION BY model ORDER BY p DESC)),
spread AS (SELECT model, {e} AS e, stddev_samp({e}) OVER (PARTITION BY model) AS sd FROM two WHERE burned_area > 0)
""" + "\nUNION ALL ".join(rows)


def _two_models(t: Tables):
    cap = H.log_area_cap(t.stored_pred)
    parts = []
    for model, shrink in (("boosted", 1.0), ("linear", 0.5)):
        rows = t.stored_pred.withColumns(
            {
                "p_ignition": F.col("p_ignition") * shrink,
                "log_pred": H.clip_log_area("log_pred", cap) * shrink,
            }
        )
        table = H.prediction_table(rows, KEY, "p_ignition", "log_pred", None)
        parts.append(table.withColumn("model", F.lit(model)))
    return stage(parts[0].unionByName(parts[1]))


@check("e21_metric_report", _report_sql())
def metric_report(t: Tables):
    return evaluation.metric_report(_two_models(t)).withColumn("value", F.round("value", 6))


@check(
    "e18_e19_by_model",
    """
WITH two AS ("""
    + " UNION ALL ".join(
        f"SELECT '{m}' AS model, log_burned_area - log_clip * {s}::DOUBLE AS e FROM haz WHERE burned_area > 0" for m, s in _SHRINK.items()
    )
    + """),
d AS (SELECT model, e, stddev_samp(e) OVER (PARTITION BY model) AS sd FROM two)
SELECT model, count(*) AS n, count(CASE WHEN abs(e) > 2 * sd THEN 1 END) AS large_errors,
       count(CASE WHEN e > 0 THEN 1 END) AS underestimates, count(CASE WHEN e < 0 THEN 1 END) AS overestimates
FROM d GROUP BY model""",
)
def error_profile_by_model(t: Tables):
    burnt = _two_models(t).where("actual_burned_area > 0")
    residuals = E.add_residual(burnt, "actual_log_burned_area", "log_burned_area")
    profile = E.error_profile(residuals, "residual", ["model"])
    return profile.select("model", "n", "large_errors", "underestimates", "overestimates")


@check("e21_compare_families")
def compare_families(t: Tables):
    return evaluation.compare_families(evaluation.metric_report(_two_models(t)))


@check("e21_scored_heads")
def scored_heads(t: Tables):
    """Both families trained, scored on test rows, and reported together."""
    table = _table(t)
    heads = training.train_heads(table, NAMES, M.Boosting())
    test, train = table.where("split = 'test'"), table.where("split = 'train'")
    cap = H.log_area_cap(train)
    parts = [
        evaluation.score_model(test, pair["p"], pair["a"], KEY, cap, family)
        for family, pair in heads.items()
    ]
    return evaluation.metric_report(stage(parts[0].unionByName(parts[1])))




# --- heads on data where their values are known -------------------------------------------------

_ONE = M.Boosting(rounds=1, depth=1, rate=1.0, row_share=1.0, column_share=1.0, patience=None, l2=0.0, least_hessian=0.0)
_THREE = M.Boosting(rounds=3, depth=2, rate=0.3, row_share=1.0, column_share=1.0, patience=None)
_FEW = ["x0", "x1", "x2"]


def _binary(t: Tables):
    """Rows with one feature that is 0 or 1: whether an image has more than three pixels."""
    x = F.array((F.col("n_px") > 3).cast("double"))
    rows = X.add_targets(t.feat.select(*KEY, "n_px", "burned_area")).withColumn("features", x)
    return stage(name_features(rows, ["many"]))


def _three_rounds_sql(logistic: bool) -> str:
    """Three second-order trees of depth 2 with the published penalties, split by split."""
    gradient = "w * (1 / (1 + exp(-m)) - y), w / (1 + exp(-m)) * (1 - 1 / (1 + exp(-m)))" if logistic else "m - y, 1.0::DOUBLE"
    weight = "CASE WHEN burned_area > 0 THEN (SELECT count(CASE WHEN burned_area = 0 THEN 1 END)::DOUBLE / count(CASE WHEN burned_area > 0 THEN 1 END) FROM feat) ELSE 1 END"
    label = "CASE WHEN burned_area > 0 THEN 1.0::DOUBLE ELSE 0 END" if logistic else "ln(1 + burned_area::DOUBLE)"
    base = "4 * (sum(w * y) OVER () / sum(w) OVER () - 0.5)" if logistic else "avg(y) OVER ()"
    ctes = [
        f"d AS (SELECT img, n_px::DOUBLE AS x0, least(n_px % 4, 2)::DOUBLE AS x1, (img % 12)::DOUBLE AS x2, {label} AS y, {weight} AS w FROM feat)",
        f"m0 AS (SELECT *, {base} AS m FROM d)",
    ]
    for r in range(3):
        ctes.append(f"a{r}_0 AS (SELECT *, 1 AS node, false AS done FROM (SELECT *, {gradient.split(', ')[0]} AS g, {gradient.split(', ')[1]} AS h FROM m{r}))")
        for level in range(2):
            here = f"a{r}_{level}"
            long = " UNION ALL ".join(f"SELECT node, '{f}' AS f, {f} AS x, g, h FROM {here} WHERE NOT done" for f in ("x0", "x1", "x2"))
            ctes += [
                f"h{r}_{level} AS (SELECT node, f, x, sum(g) AS g, sum(h) AS h FROM ({long}) GROUP BY node, f, x)",
                f"c{r}_{level} AS (SELECT node, f, x, sum(g) OVER o AS gl, sum(h) OVER o AS hl, sum(g) OVER p AS gt, sum(h) OVER p AS ht FROM h{r}_{level}"
                " WINDOW o AS (PARTITION BY node, f ORDER BY x), p AS (PARTITION BY node, f))",
                f"s{r}_{level} AS (SELECT * FROM (SELECT *, gl * gl / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt * gt / (ht + 1) AS gain FROM c{r}_{level}"
                " WHERE hl >= 1 AND ht - hl >= 1) WHERE gain > 1e-9 QUALIFY row_number() OVER (PARTITION BY node ORDER BY round(gain, 7) DESC, f, x) = 1)",
                f"a{r}_{level + 1} AS (SELECT a.* EXCLUDE (node, done), CASE WHEN s.f IS NULL OR a.done THEN a.node ELSE 2 * a.node +"
                " CASE WHEN CASE s.f WHEN 'x0' THEN x0 WHEN 'x1' THEN x1 ELSE x2 END <= s.x THEN 0 ELSE 1 END END AS node, a.done OR s.f IS NULL AS done"
                f" FROM {here} a LEFT JOIN s{r}_{level} s ON s.node = a.node AND NOT a.done)",
            ]
        ctes.append(f"m{r + 1} AS (SELECT img, x0, x1, x2, y, w, m - 0.3 * sum(g) OVER (PARTITION BY node) / (sum(h) OVER (PARTITION BY node) + 1) AS m FROM a{r}_2)")
    value = "1 / (1 + exp(-m))" if logistic else "m"
    return "WITH " + ",\n".join(ctes) + f"\nSELECT img, round({value}, 5) AS predicted FROM m3"


def _few(t: Tables):
    """Rows with three features of few values, each of which has a bin."""
    x = [F.col("n_px"), F.least(F.col("n_px") % 4, F.lit(2)), F.col("img") % 12]
    rows = X.add_targets(t.feat.select(*KEY, "n_px", "burned_area")).withColumn("features", F.array(*[c.cast("double") for c in x]))
    return stage(name_features(rows, _FEW))


@check("m1_three_rounds", _three_rounds_sql(True))
def three_rounds_classifier(t: Tables):
    rows = _few(t)
    head = M.boosted_classifier(rows, None, _FEW, [None] * 3, _THREE)
    return head.score(rows, "predicted").select("img", F.round("predicted", 5).alias("predicted"))


@check("m2_three_rounds", _three_rounds_sql(False))
def three_rounds_regressor(t: Tables):
    rows = _few(t)
    head = M.boosted_regressor(rows, None, _FEW, [None] * 3, _THREE)
    return head.score(rows, "predicted").select("img", F.round("predicted", 5).alias("predicted"))


@check(
    "m2_one_split_means",
    """
SELECT img, round(avg(ln(1 + burned_area::DOUBLE)) OVER (PARTITION BY n_px > 3), 6) AS predicted FROM feat""",
)
def one_split_means(t: Tables):
    """One tree of one split gives the mean label of each side."""
    rows = _binary(t)
    head = M.boosted_regressor(rows, None, ["many"], [None], _ONE)
    return head.score(rows, "predicted").select("img", F.round("predicted", 6).alias("predicted"))


@check(
    "m1_one_split_probability",
    """
WITH w AS (SELECT count(CASE WHEN burned_area = 0 THEN 1 END)::DOUBLE / count(CASE WHEN burned_area > 0 THEN 1 END) AS w FROM feat),
g AS (SELECT img, CASE WHEN burned_area > 0 THEN w ELSE -1 END AS v, CASE WHEN burned_area > 0 THEN w ELSE 1 END AS u, n_px > 3 AS side FROM feat, w),
f AS (SELECT img, sum(v) OVER (PARTITION BY side) / sum(u) OVER (PARTITION BY side) AS f FROM g)
SELECT img, round(1 / (1 + exp(-2 * f)), 6) AS probability FROM f""",
)
def one_split_probability(t: Tables):
    """One tree of one split gives each side the margin of its weighted labels +1 and -1."""
    rows = _binary(t)
    head = M.boosted_classifier(rows, None, ["many"], [None], _ONE)
    return head.score(rows, "probability").select("img", F.round("probability", 6).alias("probability"))


@check(
    "m5_least_squares",
    """
SELECT round(regr_slope(ln(1 + burned_area::DOUBLE), n_px), 5) AS slope, round(regr_intercept(ln(1 + burned_area::DOUBLE), n_px), 5) AS intercept
FROM feat WHERE burned_area > 0""",
)
def least_squares(t: Tables):
    rows = X.add_targets(t.feat.select(*KEY, "n_px", "burned_area")).withColumn("features", F.array(F.col("n_px").cast("double")))
    model = M.linear_baseline(stage(name_features(rows, ["n_px"])), ["n_px"], [None]).model
    found = [(round(float(model.coefficients[0]), 5), round(float(model.intercept), 5))]
    return t.spark.createDataFrame(found, "slope double, intercept double")


@check("m4_h1_mean_probability", "SELECT round(avg(CASE WHEN burned_area > 0 THEN 1.0 ELSE 0.0 END), 3) AS probability FROM feat")
def mean_probability(t: Tables):
    """The intercept is free, so the mean probability on the training rows is the share of ignitions."""
    rows = X.add_targets(t.feat.select(*KEY, "n_px", "avg_static", "burned_area"))
    packed = F.array(F.col("n_px").cast("double"), F.col("avg_static"))
    rows = stage(name_features(rows.withColumn("features", packed), ["n_px", "avg_static"]))
    head = M.logistic_baseline(rows, ["n_px", "avg_static"], [None, None])
    return head.score(rows, "p").agg(F.round(F.avg("p"), 3).alias("probability"))


@check("s7_stored_head", "SELECT count(*) AS scored, count(*) AS equal FROM feat")
def stored_head(t: Tables):
    """A head that was stored and loaded scores every row as before."""
    rows = _binary(t)
    head = M.boosted_regressor(rows, None, ["many"], [None], _ONE)
    path = f"{staging_root(t.spark).rstrip('/')}/head-{uuid.uuid4().hex}"
    M.save_head(head, path, t.spark)
    both = M.load_head(path, t.spark).score(head.score(rows, "before"), "after")
    equal = F.sum((F.col("before") == F.col("after")).cast("bigint")).alias("equal")
    return both.agg(F.count(F.lit(1)).alias("scored"), equal)
