from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberline.operators import geometry as G

SCHEMA = "sample string, height int, width int, r int, c int, angle double, fire_hour double, label int"


def grid(spark, shapes, seed=0):
    rng = np.random.default_rng(seed)
    rows, arrays = [], {}
    for name, (h, w) in shapes.items():
        angle = rng.uniform(0, 360, (h, w))
        hour = np.where(rng.random((h, w)) < 0.1, rng.integers(1, 24, (h, w)), 0)
        label = (rng.random((h, w)) < 0.1).astype(int)
        arrays[name] = (angle, hour, label)
        for r in range(h):
            for c in range(w):
                rows.append((name, h, w, r, c, float(angle[r, c]), float(hour[r, c]), int(label[r, c])))
    return spark.createDataFrame(rows, SCHEMA), arrays


def back(df, name, column):
    pdf = df.where(F.col("sample") == name).toPandas()
    out = np.full((pdf["height"].iloc[0], pdf["width"].iloc[0]), np.nan)
    assert not pdf.duplicated(["r", "c"]).any()
    out[pdf["r"], pdf["c"]] = pdf[column]
    assert not np.isnan(out).any()
    return out


@pytest.mark.parametrize("size", [6, 9, 12])
def test_reflect_pad_is_numpys(spark, size):
    shapes = {"a": (5, 7), "b": (8, 8), "tall": (12, 7)}
    df, arrays = grid(spark, shapes)
    padded = G.reflect_pad(df, size)
    for name, (h, w) in shapes.items():
        ph, pw = max(0, size - h), max(0, size - w)
        pads = ((ph // 2, ph - ph // 2), (pw // 2, pw - pw // 2))
        want = np.pad(arrays[name][0], pads, mode="reflect")
        np.testing.assert_array_equal(back(padded, name, "angle"), want)


def test_padding_far_beyond_the_image_and_of_one_line(spark):
    df, arrays = grid(spark, {"a": (2, 3), "line": (1, 4)})
    padded = G.reflect_pad(df, 11)
    for name in ("a", "line"):
        h, w = arrays[name][0].shape
        pads = (((11 - h) // 2, 11 - h - (11 - h) // 2), ((11 - w) // 2, 11 - w - (11 - w) // 2))
        want = np.pad(arrays[name][0], pads, mode="reflect" if h > 1 else "edge")
        if h == 1:
            want = np.pad(np.repeat(arrays[name][0], 11, axis=0), ((0, 0), pads[1]), mode="reflect")
        np.testing.assert_array_equal(back(padded, name, "angle"), want)


@pytest.mark.parametrize("turns", [0, 1, 2, 3])
def test_rotation_is_counter_clockwise(spark, turns):
    df, arrays = grid(spark, {"b": (8, 8)})
    got = G.rotate(df, ["angle"], turns)
    want = np.rot90(arrays["b"][0], turns)
    want = want if turns == 0 else (want - 90 * turns) % 360
    np.testing.assert_allclose(back(got, "b", "angle"), want)
    np.testing.assert_array_equal(back(got, "b", "label"), np.rot90(arrays["b"][2], turns))


def test_four_turns_and_two_flips_are_identities(spark):
    df, arrays = grid(spark, {"b": (8, 8)})
    turned = df
    for _ in range(4):
        turned = G.rotate(turned, ["angle"], 1)
    np.testing.assert_allclose(back(turned, "b", "angle"), arrays["b"][0])
    twice = G.flip(G.flip(df, ["angle"], True, False), ["angle"], True, False)
    np.testing.assert_allclose(back(twice, "b", "angle"), arrays["b"][0])
    twice = G.flip(G.flip(df, ["angle"], False, True), ["angle"], False, True)
    np.testing.assert_allclose(back(twice, "b", "angle"), arrays["b"][0])


def test_flips(spark):
    df, arrays = grid(spark, {"a": (5, 7)})
    angle = arrays["a"][0]
    np.testing.assert_allclose(
        back(G.flip(df, ["angle"], True), "a", "angle"), 360 - np.fliplr(angle)
    )
    np.testing.assert_allclose(
        back(G.flip(df, ["angle"], False, True), "a", "angle"), (180 - np.flipud(angle)) % 360
    )
    both = G.flip(df, ["angle"], F.lit(True), F.lit(True))
    np.testing.assert_allclose(
        back(both, "a", "angle"), (180 - (360 - np.flipud(np.fliplr(angle)))) % 360
    )


@pytest.mark.parametrize("shape", [(40, 70), (33, 65), (64, 32), (31, 90)])
def test_center_crop(spark, shape):
    df, arrays = grid(spark, {"x": shape})
    cropped = G.center_crop_32(df)
    h, w = (s // 32 * 32 for s in shape)
    if h == 0 or w == 0:
        assert cropped.isEmpty()
        return
    top, left = round((shape[0] - h) / 2), round((shape[1] - w) / 2)
    want = arrays["x"][0][top : top + h, left : left + w]
    np.testing.assert_array_equal(back(cropped, "x", "angle"), want)


def test_best_crop_is_the_first_best_candidate(spark):
    shapes = {"a": (20, 30), "b": (16, 16), "c": (24, 18), "none": (20, 20)}
    df, arrays = grid(spark, shapes)
    df = df.where("sample <> 'none'").unionByName(
        df.where("sample = 'none'").withColumns({"fire_hour": F.lit(0.0), "label": F.lit(0)})
    )
    got = G.best_crop(df, ["sample"], 12, seed=4, tries=10)
    for name, (h, w) in shapes.items():
        angle, hour, label = arrays[name]
        if name == "none":
            hour, label = hour * 0, label * 0
        key = spark.createDataFrame([(name,)], "sample string")
        offsets = [
            key.select(
                G.crop_offset(["sample"], 4, i, "top", F.lit(h - 12)),
                G.crop_offset(["sample"], 4, i, "left", F.lit(w - 12)),
            ).first()
            for i in range(10)
        ]
        best, pick = -1.0, None
        for top, left in offsets:
            cut = np.s_[top : top + 12, left : left + 12]
            score = round(hour[cut].mean() + 1000 * label[cut].mean(), 9)
            if score > best:
                best, pick = score, cut
        np.testing.assert_array_equal(back(got, name, "angle"), angle[pick])


def test_augmentation_depends_on_the_key_alone(spark):
    df, _ = grid(spark, {"a": (20, 30), "b": (10, 9)})
    one = G.augment(df, ["sample"], 12, 9, ["angle"]).orderBy("sample", "r", "c").collect()
    two = G.augment(df.repartition(3), ["sample"], 12, 9, ["angle"]).orderBy("sample", "r", "c").collect()
    assert one == two and len(one) == 2 * 144
    other = G.augment(df, ["sample"], 12, 10, ["angle"]).orderBy("sample", "r", "c").collect()
    assert one != other
