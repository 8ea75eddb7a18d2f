"""Steps whose looked-up table is too large to broadcast: same rows, and no table repeated per salt."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import emberline.operators.joins as J
from emberline.checks.views import SCHEMAS, Tables
from emberline.operators import features as X
from emberline.operators import geometry as G
from emberline.operators import samples as S
from emberline.sources import rasters as R

PIXELS = "img bigint, r int, c int, x double, y double, z double"


@pytest.fixture
def both(monkeypatch):
    """What a step gives with a broadcast and without, and the plan without."""

    def run(step):
        want = sorted(map(tuple, step().collect()))
        monkeypatch.setattr(J.lookup_join, "__defaults__", (*J.lookup_join.__defaults__[:-1], 0))
        shuffled = step()
        return want, sorted(map(tuple, shuffled.collect())), shuffled._jdf.queryExecution().sparkPlan().toString()

    return run


def check(got):
    want, rows, plan = got
    assert rows == want and rows
    assert "SortMergeJoin" in plan and "explode" not in plan


def pixels(spark):
    rows = [(i % 9 if i % 3 else 0, i % 7, i % 5 + i // 40, float(i), float(i % 4), 1.0) for i in range(300)]
    return spark.createDataFrame(rows, PIXELS)


def test_image_sizes(spark, both):
    check(both(lambda: G.with_image_size(pixels(spark), ["img"])))


def test_pixel_view_does_not_broadcast_many_orders(spark, tmp_path, monkeypatch):
    """The files of the orders are far below Spark's limit, their rows are not below the library's."""
    day = "TIMESTAMP_NTZ '1995-01-02 00:00:00'"
    line = f"id % 7, id, id % 5, 1, double(id), 10.0D, 0.05D, 0.0D, 'R', 'O', {day}"
    orders = f"id, id * 3, 'O', 1.0D, {day}, '1'"
    for name, row, n in (("lineitem", line, 40), ("orders", orders, 6)):
        names = [c.split()[0] for c in SCHEMAS[name].split(", ")]
        rows = spark.range(n).selectExpr(f"struct({row}) AS s").select("s.*").toDF(*names)
        rows.write.parquet(str(tmp_path / f"{name}.parquet"))
    want = sorted(map(str, Tables(spark, str(tmp_path)).px.collect()))
    monkeypatch.setattr(J, "BROADCAST_ROWS", 5)
    px = Tables(spark, str(tmp_path)).px
    assert sorted(map(str, px.collect())) == want and len(want) == 35
    plan = px._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_rgb_planes(spark, both):
    check(both(lambda: X.rgb_prepare(pixels(spark), ["img"], ["x", "y", "z"])))


def test_best_crops(spark, both):
    fires = pixels(spark).select(
        "img", "r", "c", (F.col("x") % 5).alias("fire_hour"), (F.col("x") % 11 == 0).cast("int").alias("label"),
        F.lit(16).alias("height"), F.lit(16).alias("width"),
    )
    check(both(lambda: G.best_crop(fires, ["img"], 8, seed=3)))


def test_sample_numbers(spark, both):
    rows = [(1995 + f % 2, f, i) for f in range(12) for i in range(f + 1)]
    samples = spark.createDataFrame(rows, "year int, fire bigint, in_fire_index bigint")
    check(both(lambda: S.find_samples(S.number_samples(samples), 0, 41, -1, -7)))


def test_image_positions(spark, both):
    rows = [(1995, str(f), i) for f in range(6) for i in range(f + 1)]
    images = spark.createDataFrame(rows, "year int, fire string, day int")
    images = images.select("year", "fire", F.date_add(F.lit("2018-01-01").cast("date"), F.col("day")).alias("obs_date"))
    check(both(lambda: R.image_positions(images)))
