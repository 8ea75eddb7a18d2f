from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from emberline.operators import joins as J
from emberline.operators import quantiles as Q

PROBS = [0.0, 0.001, 0.25, 0.5, 0.75, 0.999, 1.0]


def data(n=6000, seed=5):
    rng = np.random.default_rng(seed)
    value = np.where(rng.random(n) < 0.35, 0.0, rng.normal(0, 100, n))
    value[rng.random(n) < 0.05] = np.nan
    return pd.DataFrame({"g": rng.integers(0, 4, n), "v": value})


def check(spark, pdf, by):
    got = Q.exact_quantiles(spark.createDataFrame(pdf), "v", PROBS, by=by).toPandas()
    groups = pdf.dropna().groupby(by)["v"] if by else [((), pdf["v"].dropna())]
    for key, values in groups:
        row = got.set_index(by).loc[list(key)].iloc[0] if by else got.iloc[0]
        assert row["n"] == len(values)
        np.testing.assert_allclose(row["quantiles"], np.quantile(values, PROBS), rtol=1e-12)


@pytest.mark.parametrize("by", [[], ["g"]])
@pytest.mark.parametrize("accuracy", [Q.ACCURACY, 50])
def test_equal_to_numpy(spark, monkeypatch, by, accuracy):
    """Accuracy 50 puts the brackets to work on few rows."""
    monkeypatch.setattr(Q, "ACCURACY", accuracy)
    check(spark, data(), by)


@pytest.mark.parametrize("broadcast", [400_000, 0])
def test_brackets_joined_by_shuffle_give_the_same(spark, monkeypatch, broadcast):
    monkeypatch.setattr(Q, "lookup_join", lambda *args, **kw: J.lookup_join(*args, **kw, broadcast_rows=broadcast))
    monkeypatch.setattr(Q, "ACCURACY", 50)
    check(spark, data(), ["g"])


def test_fifty_thousand_groups_one_of_them_hot(spark):
    """Group 0 has a third of all rows; the others have four each."""
    rows = spark.range(300_000).selectExpr("IF(id % 3 = 0, 0, 1 + id % 50000) AS g", "CAST(pmod(hash(id), 1000) AS DOUBLE) AS v")
    got = Q.exact_quantiles(rows, "v", [0.5, 0.9], by=["g"]).toPandas().set_index("g").sort_index()
    want = rows.toPandas().groupby("g")["v"]
    assert len(got) > 33_000 and got.loc[0, "n"] >= 100_000
    np.testing.assert_array_equal(got["n"], want.size())
    np.testing.assert_allclose(np.stack(got["quantiles"]), np.stack([want.quantile(0.5), want.quantile(0.9)], axis=1), rtol=1e-12)


def test_no_values(spark):
    empty = spark.createDataFrame([(None,), (float("nan"),)], "v double")
    assert Q.quantile_list(empty, "v", [0.5]) == [None]


def test_brackets_at_full_accuracy(spark):
    """More rows than the sketch keeps exactly, and a third of them equal."""
    df = spark.range(120_000).selectExpr("CASE WHEN id % 3 = 0 THEN 7.5D ELSE CAST(hash(id) AS DOUBLE) END v")
    got = Q.quantile_list(df, "v", PROBS)
    np.testing.assert_allclose(got, np.quantile(df.toPandas()["v"], PROBS), rtol=1e-12)
