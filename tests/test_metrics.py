from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from emberline.operators import explore as X
from emberline.operators import metrics as E


def scores(spark, y, s):
    return spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, s double")


def auc(y, s):
    y, s = np.asarray(y), np.asarray(s)
    pos, neg = s[y == 1], s[y == 0]
    if not len(pos) or not len(neg):
        return None
    return float(((pos[:, None] > neg) + 0.5 * (pos[:, None] == neg)).mean())


def average_precision(y, s):
    y, s = np.asarray(y), np.asarray(s)
    if not y.sum():
        return None
    total = last = 0.0
    for cut in sorted(set(s), reverse=True):
        called = s >= cut
        recall, precision = y[called].sum() / y.sum(), y[called].mean()
        total, last = total + (recall - last) * precision, recall
    return float(total)


def close(a, b):
    return (a is None and b is None) or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12)


CASES = {
    "ties": ([0, 1, 1, 0, 1, 0, 0, 1], [0.1, 0.4, 0.4, 0.4, 0.9, 0.9, 0.2, 0.1]),
    "equal": ([0, 1, 1], [0.5, 0.5, 0.5]),
    "distinct": ([0, 0, 1, 1, 0], [-3.0, 1.0, 0.5, 8.0, 9.0]),
    "one class": ([1, 1], [0.3, 0.2]),
    "other class": ([0, 0], [0.3, 0.2]),
}


@pytest.mark.parametrize("case", CASES)
def test_ranking_cases(spark, case):
    y, s = CASES[case]
    got = E.ranking_metrics(scores(spark, y, s), "y", "s").first()
    assert close(got["roc_auc"], auc(y, s))
    assert close(got["average_precision"], average_precision(y, s))


def test_empty_input(spark):
    got = E.ranking_metrics(scores(spark, [], []), "y", "s").collect()
    assert [tuple(r) for r in got] == [(None, None)]
    assert E.spearman(scores(spark, [], []), "y", "s").first()["rho"] is None


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(-20, 20)), min_size=2, max_size=60))
def test_auc_of_the_complement(spark, rows):
    y, s = zip(*rows)
    df = scores(spark, y, s)
    a = E.ranking_metrics(df, "y", "s").first()["roc_auc"]
    b = E.ranking_metrics(df.withColumn("s", -F.col("s")), "y", "s").first()["roc_auc"]
    assert close(a, auc(y, s))
    assert a is None or math.isclose(a + b, 1.0)


def skewed(n=4000, seed=2):
    rng = np.random.default_rng(seed)
    x = np.where(rng.random(n) < 0.35, 0.0, np.round(rng.normal(size=n), 3))
    y = np.round(x * 2 + rng.normal(size=n), 2)
    return pd.DataFrame({"x": x, "y": y, "g": rng.integers(0, 3, n)})


def rank_corr(p):
    return p["x"].rank().corr(p["y"].rank())


def test_spearman_with_a_third_of_zeros(spark):
    pdf = skewed()
    df = spark.createDataFrame(pdf)
    got = E.spearman(df, "x", "y").first()
    rho = rank_corr(pdf)
    assert got["n"] == len(pdf) and math.isclose(got["rho"], rho, rel_tol=1e-9)
    assert math.isclose(got["t"], rho * math.sqrt((len(pdf) - 2) / (1 - rho**2)), rel_tol=1e-9)
    by = {r["g"]: r["rho"] for r in E.spearman(df, "x", "y", ["g"]).collect()}
    for g, part in pdf.groupby("g"):
        assert math.isclose(by[g], rank_corr(part), rel_tol=1e-9)


def test_spearman_by_shuffle(spark, monkeypatch):
    """The path for rank tables that are too large to broadcast."""
    import emberline.operators.joins as J

    monkeypatch.setattr(J.hot_split_join, "__defaults__", (0.01, 0))
    pdf = skewed()
    got = E.spearman(spark.createDataFrame(pdf), "x", "y").first()
    assert math.isclose(got["rho"], rank_corr(pdf), rel_tol=1e-9)


def test_spearman_is_invariant_and_undefined_for_constants(spark):
    df = spark.createDataFrame(skewed())
    a = E.spearman(df, "x", "y").first()["rho"]
    b = E.spearman(df.withColumn("x", F.exp("x") * 3), "x", "y").first()["rho"]
    assert math.isclose(a, b, rel_tol=1e-9)
    assert E.spearman(df.withColumn("x", F.lit(1.0)), "x", "y").first()["rho"] is None
    perfect = E.spearman(df.withColumn("y", F.col("x")), "x", "y").first()
    assert math.isclose(perfect["rho"], 1.0, rel_tol=1e-12)


def test_regression_and_constant_targets(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 1.0), (None, 1.0)], "a double, p double")
    got = E.regression_metrics(df, "a", "p").first()
    assert got["n"] == 3 and math.isclose(got["mse"], 17 / 3) and math.isclose(got["mae"], 5 / 3)
    assert math.isclose(got["r2"], 1 - 17 / 8)
    same = df.where("a IS NOT NULL").withColumn("a", F.lit(4.0))
    assert E.regression_metrics(same, "a", "p").first()["r2"] == 0.0
    assert E.regression_metrics(same, "a", "a").first()["r2"] == 1.0


def test_hazard_without_positives(spark):
    df = spark.createDataFrame([(0.0, 1.0), (0.0, 2.0)], "y double, h double")
    got = {r["metric"]: r["value"] for r in E.evaluate_hazard(df, "y", "h").collect()}
    assert got["log1p_hazard_rmse"] is None and got["log1p_hazard_n"] == 0
    assert got["spearman_positive"] is None and math.isclose(got["mae"], 1.5)


def test_confusion_has_all_cells(spark):
    got = E.confusion_matrix(scores(spark, [1, 1], [0.5, 0.9]), "y", "s").collect()
    assert {(r["actual"], r["predicted"]): r["rows"] for r in got} == {
        (0, 0): 0, (0, 1): 0, (1, 0): 1, (1, 1): 1,
    }


def test_comparison_with_a_zero_base(spark):
    rows = [("all", "rmse", 1.0), ("all", "r2", 0.5)]
    base = [("all", "rmse", 0.0), ("all", "r2", 0.25)]
    schema = "subset string, metric string, value double"
    got = {
        r["metric"]: r
        for r in E.compare_models(spark.createDataFrame(rows, schema), spark.createDataFrame(base, schema)).collect()
    }
    assert math.isnan(got["rmse"]["improvement_percent"]) and got["rmse"]["ratio_percent"] is None
    assert got["r2"]["ratio_percent"] == 100.0 and got["r2"]["improvement_percent"] is None


def test_histogram_is_numpys(spark):
    v = np.round(np.random.default_rng(0).normal(size=500), 2)
    got = X.histogram(spark.createDataFrame([(float(x),) for x in v], "v double"), "v", 30)
    rows = got.orderBy("bin").collect()
    want, edges = np.histogram(v, bins=30)
    assert [r["rows"] for r in rows] == list(want)
    np.testing.assert_allclose([r["left"] for r in rows], edges[:-1], atol=1e-12)
    flat = X.histogram(spark.createDataFrame([(3.0,), (3.0,)], "v double"), "v", 4).orderBy("bin").collect()
    assert [r["rows"] for r in flat] == list(np.histogram([3.0, 3.0], bins=4)[0])


def test_infinite_and_missing(spark):
    df = spark.createDataFrame(
        [([float("inf"), 1.0], float("-inf")), ([0.0, float("nan")], None), (None, float("nan"))],
        "e array<double>, v double",
    )
    assert {r["column"]: r["infinite"] for r in X.infinite_counts(df, ["e", "v"]).collect()} == {"e": 1, "v": 1}
    assert {r["column"]: r["missing"] for r in X.missing_counts(df).collect()} == {"e": 1, "v": 2}
    total = X.missing_totals(df).first()
    assert (total["columns_with_missing"], total["missing_values"]) == (2, 3)


def test_box_of_nothing(spark):
    got = X.box_stats(spark.createDataFrame([(None,)], "v double"), "v").first()
    assert math.isnan(got["q1"]) and got["outliers"] == 0


def test_rows_without_a_score_count_nowhere(make):
    nan = float("nan")
    df = make([(1, 0.9), (0, 0.1), (1, None), (0, nan)], "y int, p double")
    m = E.classification_metrics(df, "y", "p").first()
    assert (m["n"], m["accuracy"], m["precision"], m["recall"], m["f1_score"]) == (2, 1.0, 1.0, 1.0, 1.0)
    cells = {(r["actual"], r["predicted"]): r["rows"] for r in E.confusion_matrix(df, "y", "p").collect()}
    assert cells == {(0, 0): 1, (1, 1): 1, (0, 1): 0, (1, 0): 0}
