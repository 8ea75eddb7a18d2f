from __future__ import annotations

import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from emberline.operators import ordering as O
from emberline.operators.joins import hot_split_join, lookup_join


def hot_rows(n=3000, seed=1):
    """A third of all rows share one group and one day."""
    rng = np.random.default_rng(seed)
    group = np.where(rng.random(n) < 0.34, 0, rng.integers(1, 40, n))
    day = np.where(group == 0, 7, rng.integers(0, 30, n))
    return pd.DataFrame({"g": group, "day": day, "k": rng.permutation(n), "m": rng.integers(0, 9, n)})


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("by", [[], ["g"]])
def test_prefix_sums_equal_cumulative_sums(spark, by, descending):
    pdf = hot_rows()
    got = (
        O.prefix_sums(spark.createDataFrame(pdf), ["k"], ["m"], by=by, descending=descending, cells=7)
        .toPandas()
        .set_index("k")["upto_m"]
        .sort_index()
    )
    ordered = pdf.sort_values("k", ascending=not descending)
    want = ordered.groupby(by)["m"].cumsum() if by else ordered["m"].cumsum()
    want = pd.Series(want.to_numpy(), index=ordered["k"]).sort_index()
    assert (got == want).all()


def test_prefix_sums_over_text_and_two_columns(spark):
    rows = [(y, f"fire_{i:03d}'\\", 1 + i % 3) for y in (2018, 2019) for i in range(60)]
    df = spark.createDataFrame(rows, "year int, fire string, n int")
    got = {
        (r["year"], r["fire"]): r["upto_n"]
        for r in O.prefix_sums(df, ["year", "fire"], ["n"], cells=9).collect()
    }
    running = 0
    for year, fire, n in sorted(rows):
        running += n
        assert got[(year, fire)] == running


def test_cells_follow_the_order_of_every_key_type(spark):
    day = datetime.date(2020, 1, 1)
    rows = [(i, float(i), f"{i:04d}", day + datetime.timedelta(days=i)) for i in range(300)]
    df = spark.createDataFrame(rows, "i bigint, d double, s string, t date")
    for name in ("i", "d", "s", "t"):
        cells = [r[O.CELL] for r in O.range_cells(df, [name], cells=5).orderBy("i").collect()]
        assert cells == sorted(cells) and len(set(cells)) == 5


def test_number_of_cells_follows_the_rows(spark, monkeypatch):
    monkeypatch.setattr(O, "CELL_ROWS", 1000)
    df = spark.range(12_000).select(F.col("id").cast("double").alias("v"))
    sizes = O.range_cells(df, ["v"]).groupBy(O.CELL).count().toPandas()["count"]
    assert len(sizes) == 12 and sizes.max() < 3000
    assert O.range_cells(df.limit(900), ["v"]).select(O.CELL).distinct().count() == 1


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("cells", [1, 9, 40])
def test_next_rows_across_cells(spark, descending, cells):
    pdf = hot_rows(400)
    celled = O.range_cells(spark.createDataFrame(pdf), ["k"], ["g"], cells)
    got = O.with_next(celled, ["k"], ["k", "m"], ["g"], descending).toPandas().set_index("k").sort_index()
    ordered = pdf.sort_values("k", ascending=not descending)
    ordered["want"] = ordered.groupby("g")["k"].shift(-1)
    ordered["want_m"] = ordered.groupby("g")["m"].shift(-1)
    want = ordered.set_index("k").sort_index()
    assert got["next_k"].fillna(-1).eq(want["want"].fillna(-1)).all()
    assert got["next_m"].fillna(-1).eq(want["want_m"].fillna(-1)).all()


def test_group_ordinal_and_lead_with_small_chunks(spark):
    pdf = hot_rows()
    df = spark.createDataFrame(pdf)
    indexed = O.group_ordinal(df, ["g"], ["day", "k"], F.col("day"), "at")
    spread, window = O.ordinal_chunks(indexed, ["g"], "at", 2, chunk=5)
    led = spread.select("*", F.lead("k", 2).over(window).alias("later")).where("not _lent").toPandas()
    want = pdf.sort_values(["g", "day", "k"]).reset_index(drop=True)
    want["at"] = want.groupby("g").cumcount()
    want["later"] = want.groupby("g")["k"].shift(-2)
    merged = led.merge(want, on="k", suffixes=("", "_want"))
    assert len(led) == len(want) == len(merged)
    assert (merged["at"] == merged["at_want"]).all()
    assert merged["later"].fillna(-1).eq(merged["later_want"].fillna(-1)).all()


def test_lookup_join_both_ways(spark):
    big = spark.createDataFrame(hot_rows())
    small = spark.createDataFrame([(g, g * 10) for g in range(30)], "g bigint, v bigint")
    for how in ("inner", "left"):
        frames = [
            lookup_join(big, small, ["g"], ["k"], how=how, broadcast_rows=limit)
            .select("g", "k", "v")
            .orderBy("k")
            .collect()
            for limit in (0, 1000)
        ]
        assert frames[0] == frames[1]
    with pytest.raises(ValueError):
        lookup_join(big, small, ["g"], ["k"], how="right")


def test_hot_split_join_agrees_with_a_plain_join(spark):
    pdf = hot_rows()
    rows = spark.createDataFrame(pdf)
    table = rows.groupBy("g").agg(F.count("*").alias("n"), F.sum("m").alias("v"))
    for limit, share in ((0, 0.2), (0, 0.01), (10**6, 0.1)):
        got = hot_split_join(rows, table, ["g"], "n", ["v"], ["k"], share, limit).toPandas()
        want = pdf.groupby("g")["m"].sum()
        assert len(got) == len(pdf)
        assert (got["v"] == got["g"].map(want)).all()


def test_tables_too_large_to_broadcast_are_not_broadcast(spark):
    """Their files are small, which alone would have Spark broadcast them, repeated per salt."""
    big = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") % 700).alias("g"))
    small = spark.range(700).select(F.col("id").alias("g"), (F.col("id") * 2).alias("v"), F.lit(5).cast("bigint").alias("n"))
    shuffled = [lookup_join(big, small, ["g"], ["k"], how=how, broadcast_rows=600) for how in ("inner", "left")]
    for joined in [*shuffled, hot_split_join(big, small, ["g"], "n", ["v"], ["k"], 0.5, 600)]:
        plan = joined._jdf.queryExecution().sparkPlan().toString()
        assert "SortMergeJoin" in plan and plan.count("BroadcastHashJoin") == (0 if any(joined is s for s in shuffled) else 1)
        assert joined.where("v = g * 2").count() == 3000


def test_weighed_lookups_are_shuffled_as_they_are(spark):
    """Only hot keys are spread: the looked-up table is not repeated per salt."""
    big = spark.createDataFrame(hot_rows()).select("g", "k", "m")
    big = big.union(spark.createDataFrame([(None, -1, 0), (77, -2, 0)], "g bigint, k bigint, m bigint"))
    small = spark.createDataFrame([(g, g * 10, 1000 if g == 0 else g) for g in range(30)], "g bigint, v bigint, n bigint")
    for how in ("inner", "left"):
        frames = [lookup_join(big, small, ["g"], ["k"], how=how, broadcast_rows=limit, weight="n") for limit in (0, 1000)]
        assert frames[0].columns == frames[1].columns == ["g", *[c for c in big.columns if c != "g"], "v"]
        got, want = (f.select("g", "k", "v").orderBy("k").collect() for f in frames)
        assert got == want
        plan = frames[0]._jdf.queryExecution().sparkPlan().toString()
        assert "SortMergeJoin" in plan and "explode" not in plan


def test_rows_of_keys_without_a_weight_are_found(spark):
    big = spark.createDataFrame([(g, g) for g in range(10)], "g bigint, k bigint")
    small = spark.createDataFrame([(g, g * 10, None if g == 4 else 1) for g in range(10)], "g bigint, v bigint, n bigint")
    got = lookup_join(big, small, ["g"], ["k"], broadcast_rows=0, weight="n")
    assert got.where("v = g * 10").count() == 10
