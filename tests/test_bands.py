from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberline import schema
from emberline.functions import columns as C
from emberline.operators import bands as B

GAPS = [None, float("nan"), float("inf"), float("-inf"), 0.0, 59.0, 130.0, 2359.0]


def column(spark, values):
    rows = [(i, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "i int, v double")


def apply(spark, values, expression):
    return [r["x"] for r in column(spark, values).select("i", expression.alias("x")).orderBy("i").collect()]


def test_gap_cases(spark):
    big = C.FLOAT32_MAX
    assert apply(spark, GAPS, C.finite_or("v")) == [0, 0, big, -big, 0, 59, 130, 2359]
    assert apply(spark, GAPS, C.zero_if_missing("v"))[:2] == [0, 0]
    some = [None, float("nan"), 0.0, 59.0, 130.0, 2359.0]
    # A detection within hour 0 is in the label but not in the input mask.
    assert apply(spark, some, C.detection_hour("v")) == [0, 0, 0, 0, 1, 23]
    assert apply(spark, some, C.fire_label("v")) == [0, 0, 0, 1, 1, 1]
    assert apply(spark, [None, float("nan"), 0.0, 1.0, 17.0], C.land_cover_index("v")) == [16, 16, 16, 0, 16]


def test_dates(spark):
    df = spark.createDataFrame([("a/2018/f/2020-02-29_x.tif",), ("2021-12-31.tif",)], "p string")
    got = df.select(C.image_date("p").cast("string"), C.day_of_year(F.regexp_extract("p", r"\d{4}-\d\d-\d\d", 0)))
    assert [tuple(r) for r in got.collect()] == [("2020-02-29", 60), ("2021-12-31", 365)]
    month, day = C.month_day("d")
    days = spark.createDataFrame([(1,), (30,), (31,), (360,), (366,)], "d int")
    assert [tuple(r) for r in days.select(month, day).collect()] == [(1, 1), (1, 30), (2, 1), (12, 30), (12, 6)]


def test_channel_dictionary(spark):
    names = schema.channel_names()
    assert len(names) == 40 and len(schema.channel_names(True)) == 23
    assert names[15].startswith("Palmer") and names[16].endswith("Needleleaf Forests")
    assert names[32].endswith("Water Bodies") and names[38:] == ["Active fire", "Active fire (binary)"]
    table = B.channel_table(spark).collect()
    assert [r["channel"] for r in table if r["static"]] == sorted(schema.STATIC_CHANNELS)
    assert sorted([*schema.STATIC_CHANNELS, *schema.DYNAMIC_CHANNELS]) == list(range(40))


def test_band_stats_equal_numpy(spark, pixels, images):
    stats = B.band_stats(pixels, B.prepared_bands(F.col("bands")), [f[:2] for f in schema.FOLD_YEARS])
    rows = {(tuple(r["train_years"]), r["band"]): r for r in stats.collect()}
    assert len(rows) == 6 * 23
    for years in ((2018, 2019), (2020, 2021)):
        stack = np.concatenate(
            [b.reshape(23, -1).astype(float) for (y, _, _), b in images.items() if y in years], axis=1
        )
        for i in (0, 7, 12, 16, 22):
            v = stack[i]
            v = np.floor(v / 100) if i == 22 else np.sin(np.radians(v)) if i == 7 else v
            row, present = rows[(years, schema.BASE_BANDS[i])], v[~np.isnan(v)]
            np.testing.assert_allclose(row["mean"], present.mean(), rtol=1e-9, atol=1e-12)
            np.testing.assert_allclose(row["std"], present.std(ddof=1), rtol=1e-9)
            np.testing.assert_allclose(row["missing"], np.isnan(v).mean(), atol=1e-12)


def expand(bands, scaler):
    """Plain numpy statement of the channel chain, shape (40, n)."""
    out = []
    hour = np.floor(np.nan_to_num(bands[22], nan=0) / 100)
    for i in range(23):
        v = bands[i].astype(float)
        if i == 16:
            code = np.nan_to_num(v, nan=0).astype(int) - 1
            out += [np.where(code % 17 == k, 1.0, 0.0) for k in range(17)]
            continue
        if i in (7, 13, 19):
            v = np.sin(np.radians(v))
        else:
            v = hour if i == 22 else v
            mean, std = scaler.get(schema.BASE_BANDS[i], (0.0, 1.0))
            v = (v - mean) / std
        out.append(np.nan_to_num(v, nan=0.0))
    return np.stack([*out, (hour > 0).astype(float)])


def test_expand_channels(spark, pixels, images):
    key = next(iter(images))
    scaler = {n: (10.0, 3.0) for i, n in enumerate(schema.BASE_BANDS) if i not in (7, 13, 16, 19)}
    one = pixels.where((F.col("year") == key[0]) & (F.col("fire") == key[1]) & (F.col("obs_date") == key[2]))
    got = one.orderBy("r", "c").select(F.array(*B.expand_channels(F.col("bands"), scaler)).alias("x"))
    got = np.array([r["x"] for r in got.collect()]).T
    want = expand(images[key].reshape(23, -1), scaler)
    np.testing.assert_allclose(got, want, rtol=1e-6, atol=1e-6)
    np.testing.assert_array_equal(got[16:33].sum(axis=0), 1.0)


def test_standardize_and_back(spark):
    df = spark.createDataFrame([(float(i), float(i * i)) for i in range(9)], "a double, b double")
    stats = {"a": (3.0, 2.0), "b": (-1.0, 0.5)}
    back = B.destandardize(B.standardize(df, stats), stats)
    assert [tuple(map(round, r)) for r in back.collect()] == [(i, i * i) for i in range(9)]


@pytest.mark.parametrize("keep", [None, [0, 13, 16, 20, 35, 38]])
@pytest.mark.parametrize("n", [1, 3])
def test_dedupe_static_width_and_order(spark, keep, n):
    days = [[float(100 * d + c) for c in range(40)] for d in range(n)]
    df = spark.createDataFrame([(days,)], "days array<array<double>>")
    got = df.select(B.dedupe_static("days", n, keep).alias("x")).first()["x"]
    static, dynamic = B.kept_channels(keep)
    want = [100 * d + c for d in range(n - 1) for c in dynamic]
    want += [100 * (n - 1) + c for c in (keep or range(40))]
    assert got == want
    assert len(got) == B.expected_width(n, keep, dedupe=n > 1)


def test_keep_features(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],)], "x array<double>")
    assert df.select(B.keep_features("x", [2, 0]).alias("k")).first()["k"] == [3.0, 1.0]


def test_missing_share(spark):
    df = column(spark, GAPS)
    assert math.isclose(B.missing_share(df, ["v"]).first()["v"], 2 / 8)


def test_a_constant_band_becomes_zero(make):
    stats = make([("flat", 5.0, 0.0, [2018, 2019]), ("wide", 1.0, 2.0, [2018, 2019]), ("empty", None, None, [2018, 2019])], "band string, mean double, std double, train_years array<int>")
    scaler = B.fit_scaler(stats, [2018, 2019])
    assert scaler == {"flat": (5.0, 1.0), "wide": (1.0, 2.0)}
    got = B.standardize(make([(5.0, 3.0)], "flat double, wide double"), scaler).first()
    assert tuple(got) == (0.0, 1.0)
