from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from emberline.operators import explore as E
from emberline.operators import features as X
from emberline.operators import prepare as R
from emberline.operators import scoring as H


def test_feature_columns(spark):
    df = spark.createDataFrame(
        [(1, 2, 0.5, 0.5, 0.5, 1, "train")],
        "year int, day_of_month int, embedding_2 double, embedding_10 double, tif_feature_0 double, ignition int, split string",
    )
    assert R.feature_columns(df) == ["day_of_month", "embedding_10", "embedding_2", "tif_feature_0"]
    assert R.feature_columns(df, ordered=False)[1] == "embedding_2"
    assert "ignition" in R.feature_columns(df, exclude=["year"])


def test_contract():
    assert R.align_to_model(["a", "b", "x"], ["b", "a", "c"]) == ["b", "a", "x"]
    assert R.align_to_model(None, ["b"]) == ["b"] and R.align_to_model(["a"], None) == ["a"]
    with pytest.raises(ValueError):
        R.align_to_model(None, None)
    assert R.common_features(["a", "b"], ["b", "a"]) == (["a", "b"], ["b", "a"])
    assert R.common_features(["a", "b", "p"], ["q", "b", "a"]) == (["a", "b"], ["b", "a"])


def test_order_features(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "a double, b double, c double")
    packed = R.assemble_features(df, ["a", "b", "c"])
    assert R.order_features(packed, "features", ["c", "a"]).first()["features"] == [3.0, 1.0]
    with pytest.raises(ValueError, match="missing"):
        R.order_features(packed, "features", ["z"])
    with pytest.raises(ValueError, match="not found"):
        R.assemble_features(df, ["a", "z"])


def arrays(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "features array<double>")


def values(df):
    return [r["features"] for r in df.collect()]


def test_median_policies(spark):
    nan = float("nan")
    train = arrays(spark, [[1.0, None, None], [3.0, 5.0, nan], [8.0, 7.0, None]])
    other = arrays(spark, [[None, nan, None], [10.0, 1.0, None]])
    assert R.feature_medians(train) == [3.0, 6.0]
    assert values(R.impute(other, train, "train")) == [[3.0, 6.0, None], [10.0, 1.0, None]]
    assert values(R.impute(other, None, "own")) == [[10.0, 1.0, None], [10.0, 1.0, None]]
    assert values(R.impute(other, train, "train_then_zero")) == [[3.0, 6.0, 0.0], [10.0, 1.0, 0.0]]
    assert values(R.impute(other, None, "train_then_zero"))[0] == [0.0, 0.0, 0.0]
    with pytest.raises(ValueError):
        R.impute(other, train, "mode")


@pytest.mark.parametrize("positives,verdict", [(1, "imbalanced"), (10, "moderate"), (30, "balanced")])
def test_class_balance(spark, positives, verdict):
    df = spark.range(100).select((F.col("id") < positives).cast("int").alias("ignition"))
    row = R.class_balance(df).first()
    assert row["verdict"] == verdict
    assert math.isclose(row["scale_pos_weight"], (100 - positives) / positives)


def test_one_class_has_no_weight(spark):
    df = spark.range(5).select(F.lit(0).alias("ignition"))
    assert R.class_balance(df).first()["scale_pos_weight"] is None


def test_profile_counts_nan_as_missing(spark):
    df = spark.createDataFrame(
        [(float("nan"), 1), (2.0, 1), (None, None)], "embedding_0 double, year int"
    )
    rows = {r["column"]: (r["category"], r["missing"], r["distinct_values"]) for r in R.column_profile(df).collect()}
    assert rows == {"embedding_0": ("embedding", 2, 1), "year": ("temporal", 1, 1)}


def test_clip_and_hazard(spark):
    train = spark.createDataFrame([(1.0, float(i)) for i in range(1001)], "burned_area double, log_burned_area double")
    cap = H.log_area_cap(train)
    assert math.isclose(cap, 999.0)
    df = spark.createDataFrame([(0.5, -3.0), (0.5, 2.0), (1.0, 5000.0)], "p double, x double")
    got = df.select(H.clip_log_area("x", 4.0).alias("c")).collect()
    assert [r["c"] for r in got] == [0.0, 2.0, 4.0]
    assert H.log_area_cap(None) is None and H.log_area_cap(train.where("burned_area < 0")) is None
    assert [r[0] for r in df.select(H.clip_log_area("x", None)).collect()] == [0.0, 2.0, 5000.0]
    hazard = [r[0] for r in df.limit(2).select(H.hazard("p", "x")).collect()]
    assert hazard[0] == 0.0 and math.isclose(hazard[1], 0.5 * math.expm1(2.0))


def test_hazard_is_monotone_in_p(spark):
    df = spark.range(101).select((F.col("id") / 100).alias("p"), F.lit(1.5).alias("x"))
    h = [r[0] for r in df.orderBy("p").select(H.hazard("p", "x")).collect()]
    assert h == sorted(h) and min(h) >= 0


def test_tiers_and_comparison(spark):
    rows = [(0.7, 100.0, 1.0, 5.0, 4.0), (0.71, 1000.1, 0.0, 2.0, 0.0), (0.3, 100.1, 0.0, 0.0, 0.0)]
    df = spark.createDataFrame(
        rows, "p_ignition double, hazard_score double, actual_ignition double, burned_area double, actual_burned_area double"
    )
    got = H.compare_rows(H.add_tiers(df)).collect()
    assert [(r["risk"], r["impact"]) for r in got] == [
        ("MODERATE", "MODERATE"), ("HIGH", "MAJOR"), ("LOW", "SIGNIFICANT"),
    ]
    assert [r["correct"] for r in got] == [True, False, True]
    assert [r["area_error_percent"] for r in got] == [25.0, None, None]


def test_one_row_scores_as_in_a_batch(spark):
    rows = [(i, i / 10, float(i) - 3, 1) for i in range(10)]
    df = spark.createDataFrame(rows, "id int, p double, x double, ignition int")
    batch = {r["id"]: r for r in H.prediction_table(df, ["id"], "p", "x", 4.0).collect()}
    one = H.prediction_table(H.random_sample(df, ["id"], 5), ["id"], "p", "x", 4.0).first()
    assert one == batch[one["id"]]
    assert H.random_sample(df.repartition(3), ["id"], 5).first()["id"] == one["id"]


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, 2)], "id int, x int")
    b = spark.createDataFrame([(3,)], "id int")
    rows = {r["id"]: (r["x"], r["split"]) for r in X.union_splits({"train": a, "test": b}).collect()}
    assert rows == {1: (2, "train"), 3: (None, "test")}


def test_constant_image_and_two_bands(spark):
    df = spark.createDataFrame(
        [("a", 0, c, 5.0, 5.0) for c in range(3)] + [("b", 0, 0, 0.0, 10.0)],
        "img string, r int, c int, u double, v double",
    )
    got = X.rgb_prepare(df, ["img"], ["u", "v"], means=(0.0, 0.0, 0.0), stds=(1.0, 1.0, 1.0))
    rows = {(r["img"], r["c"]): (r["red"], r["green"], r["blue"]) for r in got.collect()}
    assert rows[("a", 0)] == (1.0, 1.0, 0.0)  # the filled-up third plane is the minimum
    assert rows[("b", 0)] == (0.0, 1.0, 0.0)
    flat = X.rgb_prepare(df.withColumn("w", F.lit(5.0)).where("img = 'a'"), ["img"], ["u", "v", "w"],
                         means=(0.0,) * 3, stds=(1.0,) * 3)
    assert {(r["red"], r["green"], r["blue"]) for r in flat.collect()} == {(0.0, 0.0, 0.0)}


def test_too_large_an_image_fails(spark):
    planes = spark.range(20).selectExpr("1 AS img", "0 AS r", "CAST(id AS INT) AS c", "0D AS red", "0D AS green", "0D AS blue")
    with pytest.raises(Exception, match="too large"):
        X.embed_images(planes, ["img"], lambda: lambda grid: [0.0], max_pixels=10).collect()


def test_digests_tell_values_missing_ones_and_positions_apart(spark):
    rows = [(1, None, [1.0, None], "a"), (None, 1, [None, 1.0], "a"), (1, None, [1.0], None), (1, None, [1.0, None], "a"), (None, None, None, "")]
    df = spark.createDataFrame(rows, "x long, y long, v array<double>, s string")
    got = {r["column"]: r["distinct_values"] for r in E.distinct_counts(df, df.columns).collect()}
    assert got == {"x": 1, "y": 1, "v": 3, "s": 2}
    assert E.duplicate_rows(df, df.columns).first().asDict() == {"rows": 5, "duplicates": 1}
    assert E.duplicate_rows(df, ["x", "y"]).first().asDict() == {"rows": 5, "duplicates": 2}
    profile = {r["column"]: (r["missing"], r["distinct_values"]) for r in R.column_profile(df).collect()}
    assert profile == {"x": (2, 1), "y": (4, 1), "v": (1, 3), "s": (1, 2)}


def test_column_without_values_has_none(spark):
    df = spark.createDataFrame([(None, float("nan")), (None, None)], "a int, b double")
    assert {r["column"]: r["distinct_values"] for r in E.distinct_counts(df, ["a", "b"]).collect()} == {"a": 0, "b": 0}


def test_large_images_are_embedded_from_strips(spark):
    """One image of 1,500 x 900 pixels and one of 3 x 2 with a gap."""
    big = spark.range(1500 * 900).selectExpr("'big' AS image", "CAST(id DIV 900 AS INT) AS r", "CAST(id % 900 AS INT) AS c", "CAST(id AS DOUBLE) AS red", "1.0D AS green", "CAST(id % 7 AS DOUBLE) AS blue")
    small = spark.createDataFrame([("small", r, c, float(r), float(c), 2.0) for r in range(3) for c in range(2) if (r, c) != (1, 1)], big.schema)

    def load():
        return lambda grid: [*grid.shape, grid[0, -1, -1], grid[1].sum(), grid[2, 1, 1]]

    got = {r["image"]: r["embedding"] for r in X.embed_images(big.union(small), ["image"], load).collect()}
    assert got == {"big": [3, 1500, 900, 1349999, 1350000, 901 % 7], "small": [3, 3, 2, 2, 2, 0]}


def test_runs_of_keys_leave_whole():
    """Runs that cross batches are put together, many short ones leave in one batch."""
    import pyarrow as pa

    keys = [1, 1, 2, None, None, None, None, 3, 4, 4, 5]
    table = pa.table({"k": pa.array(keys, pa.int64()), "v": pa.array(range(len(keys)))})
    for size in (1, 2, 3, 20):
        got = list(X.whole_runs(iter(table.to_batches(max_chunksize=size)), ["k"]))
        runs = [batch.slice(lo, hi - lo).to_pydict() for batch, cuts in got for lo, hi in zip(cuts[:-1], cuts[1:])]
        assert [run["k"][0] for run in runs] == [1, 2, None, 3, 4, 5]
        assert [v for run in runs for v in run["v"]] == list(range(len(keys)))
    assert len(got) == 2


def test_many_sparse_images_are_embedded(spark):
    """Three pixels an image, some of them in different strips; an empty value is passed on."""
    rows = [(i, r, c, float(i), None if i == 7 else 1.0, 2.0) for i in range(500) for r, c in ((0, 3), (i % 90, 1), (i % 90 + 1, 0))]
    planes = spark.createDataFrame(rows, "img bigint, r int, c int, red double, green double, blue double")

    def load():
        return lambda grid: [*grid.shape, grid[0].sum(), grid[1, 0, 3], (grid[2] != 0).sum()]

    got = {r["img"]: r["embedding"] for r in X.embed_images(planes, ["img"], load).collect()}
    assert len(got) == 500
    for i, vector in got.items():
        assert vector[:4] == [3, i % 90 + 2, 4, 3 * i] and vector[5] == 3
        assert vector[4] == 1 or i == 7 and vector[4] != vector[4]
    for bad in ([(1, None, 0)], [(1, 0, -1)], [(1, 0, 0), (1, 0, 0)]):
        frame = spark.createDataFrame([(*b, 1.0, 1.0, 1.0) for b in bad], planes.schema)
        with pytest.raises(Exception, match="place"):
            X.embed_images(frame, ["img"], load).collect()
