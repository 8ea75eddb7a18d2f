"""The whole feature job against a plain numpy statement of it."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_bands import expand

from emberline import schema
from emberline.plans import feature_build as P

KEY = schema.SAMPLE_KEY


def by_key(df):
    return {tuple(r[k] for k in KEY): r for r in df.collect()}


def fires(images):
    out = {}
    for (year, fire, date), bands in sorted(images.items()):
        out.setdefault((year, fire), []).append((date, bands))
    return out


def crop32(a):
    h, w = a.shape[-2:]
    nh, nw = h // 32 * 32, w // 32 * 32
    top, left = round((h - nh) / 2), round((w - nw) / 2)
    return a[..., top : top + nh, left : left + nw]


@pytest.mark.parametrize("n,adjust,kind", [(1, None, "mean"), (2, 3, "max")])
def test_centre_cropped_features(pixels, images, n, adjust, kind):
    settings = P.BuildSettings(n_days=n, adjust_to=adjust, aggregation=kind)
    got = by_key(P.feature_table(pixels, settings, augmented=False))
    scaler = P.fold_scaler(pixels, settings)
    split = {2018: "train", 2019: "train", 2020: "val", 2021: "test"}
    reduce = {"mean": np.mean, "max": np.max}[kind]
    seen = 0
    for (year, fire), days in fires(images).items():
        skip = adjust - n if adjust and split[year] == "test" else 0
        for i in range(skip, len(days) - n):
            row = got[(year, fire, i - skip)]
            want = []
            for _, bands in days[i : i + n]:
                cut = crop32(bands)
                channels = expand(cut.reshape(23, -1), scaler)[:-1]
                want += list(reduce(channels, axis=1))
            np.testing.assert_allclose(row["tif"], want, rtol=1e-5, atol=1e-5)
            burnt = int((np.nan_to_num(crop32(days[i + n][1])[22], nan=0) > 0).sum())
            assert row["burned_area"] == burnt and row["ignition"] == int(burnt > 0)
            assert np.isclose(row["log_burned_area"], np.log1p(burnt))
            assert row["split"] == split[year]
            seen += 1
    assert seen == len(got)


def test_augmented_features_match_the_chosen_crops(pixels, images):
    """Rebuild the features of training samples from the augmented pixels themselves."""
    settings = P.BuildSettings(crop_side=36, crop_tries=4)
    table = P.feature_table(pixels, settings)
    got = by_key(table)
    assert {r["split"] for r in got.values()} == {"train", "val", "test"}
    assert all(len(r["tif"]) == 39 for r in got.values())
    assert len(got) == 4 * 2 * 3

    key = (2018, "fire_1", 1)
    crops = P.sample_pixels(pixels.where("year = 2018"), settings)
    one = crops.where((F.col("fire") == key[1]) & (F.col("in_fire_index") == key[2])).toPandas()
    x, y = one[one["is_input"]], one[~one["is_input"]]
    assert len(x) == len(y) == 36 * 36
    bands = np.array(x["bands"].tolist(), dtype=float).T
    for i, name in zip(schema.DEGREE_BANDS, P.ANGLES):
        bands[i] = x[name]
    scaler = P.fold_scaler(pixels, settings)
    np.testing.assert_allclose(
        got[key]["tif"], expand(bands, scaler)[:-1].mean(axis=1), rtol=1e-5, atol=1e-5
    )
    assert got[key]["burned_area"] == y["label"].sum()

    # The pixels are a window of the right images: non-angle values occur there equally often.
    (_, before), (_, after) = fires(images)[(2018, "fire_1")][1:3]
    padded = np.pad(before[12], ((1, 2), (0, 0)), mode="reflect")
    assert set(bands[12].astype(np.float32)) <= set(padded.ravel())
    assert y["label"].sum() <= (np.nan_to_num(np.pad(after[22], ((1, 2), (0, 0)), mode="reflect")) > 0).sum()


def test_hot_fire_gives_the_same_rows(pixels):
    """Joining by shuffle and salt instead of broadcast changes nothing."""
    import emberline.operators.joins as J

    settings = P.BuildSettings(crop_side=36, crop_tries=2)
    want = by_key(P.feature_table(pixels, settings))
    defaults = J.lookup_join.__defaults__
    J.lookup_join.__defaults__ = (*defaults[:-1], 0)
    try:
        got = by_key(P.feature_table(pixels, settings))
    finally:
        J.lookup_join.__defaults__ = defaults
    assert got.keys() == want.keys()
    for k in want:
        np.testing.assert_allclose(got[k]["tif"], want[k]["tif"], rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("n", [1, 2])
def test_stored_stacks_give_the_same_samples_without_a_join(spark, pixels, tmp_path, n):
    from emberline.sources import rasters as R

    centred = pixels.withColumns({"lng": F.lit(1.0), "lat": F.lit(2.0)})
    R.write_fire_stacks(centred, f"{tmp_path}/stacks")
    stacks = R.read_fire_stacks(spark, f"{tmp_path}/stacks")
    settings = P.BuildSettings(n_days=n, crop_side=36, crop_tries=2)
    got = by_key(P.feature_table(stacks, settings))
    joined = by_key(P.feature_table(stacks.drop("day_index", "fire_days"), settings))
    assert got.keys() == joined.keys() and len(got) == 4 * 2 * (4 - n)
    for k in joined:
        np.testing.assert_allclose(got[k]["tif"], joined[k]["tif"], rtol=1e-9, atol=1e-9)
        assert got[k]["burned_area"] == joined[k]["burned_area"]
    # The stored table says itself that its fire band holds hours: the channel is not empty.
    assert any(r["tif"][38] != 0 for r in got.values())
    plan = P.sample_pixels(stacks, settings)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan


def test_drop_active_fire_and_embeddings(spark, pixels):
    settings = P.BuildSettings(drop_active_fire=True)
    vectors = spark.createDataFrame(
        [(2018, "fire_0", 0, [1.0, 2.0])], "year int, fire string, in_fire_index bigint, embedding array<float>"
    )
    got = by_key(P.feature_table(pixels, settings, vectors, augmented=False))
    assert len(got[(2018, "fire_0", 0)]["tif"]) == 38
    assert got[(2018, "fire_0", 0)]["embedding"] == [1.0, 2.0]
    assert got[(2018, "fire_0", 1)]["embedding"] is None


def test_embeddings_use_the_same_samples(pixels):
    settings = P.BuildSettings(crop_side=36, crop_tries=2)

    def load():
        return lambda grid: [grid.shape[1], grid.shape[2], grid[0].mean()]

    vectors = by_key(P.embedding_table(pixels, load, settings))
    table = by_key(P.feature_table(pixels, settings))
    assert vectors.keys() == table.keys()
    sides = {k: tuple(int(v) for v in r["embedding"][:2]) for k, r in vectors.items()}
    assert {s for k, s in sides.items() if k[0] != 2021} == {(36, 36)}
    assert {s for k, s in sides.items() if k[0] == 2021} == {(32, 32)}


def test_dates_travel_to_the_feature_table(pixels, images):
    from emberline.operators.features import add_month_day

    for n in (1, 2):
        table = P.feature_table(pixels, P.BuildSettings(n_days=n), augmented=False)
        rows = by_key(add_month_day(table))
        for (year, fire, index), r in rows.items():
            days = sorted(k[2] for k in images if k[:2] == (year, fire))
            assert r["obs_date"] == days[index + n - 1]
            assert r["gap_days"] == (days[index + n] - days[index + n - 1]).days
            assert r["day_of_year"] == r["obs_date"].timetuple().tm_yday
            # The calendar of that operator has months of 30 days.
            assert (r["month"], r["day_of_month"]) == ((r["day_of_year"] - 1) // 30 + 1, (r["day_of_year"] - 1) % 30 + 1)


def test_bad_settings(pixels):
    with pytest.raises(ValueError):
        P.feature_table(pixels, P.BuildSettings(n_days=0))
    with pytest.raises(ValueError):
        P.feature_table(pixels, P.BuildSettings(n_days=3, adjust_to=2))
    with pytest.raises(ValueError):
        P.feature_table(pixels, P.BuildSettings(aggregation="median"))


