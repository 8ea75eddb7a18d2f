from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from emberline.operators import samples as S
from emberline.operators import splits as P

DAY = datetime.date(2020, 8, 1)


@pytest.fixture(scope="module")
def images(spark):
    """Fire b has a gap of three days, fire c is too short for any sample."""
    rows = [(2018, "a", DAY + datetime.timedelta(days=d), d % 3) for d in range(6)]
    rows += [(2018, "b", DAY + datetime.timedelta(days=d), d) for d in (0, 1, 4, 5)]
    rows += [(2019, "c", DAY, 9), (2021, "d", DAY, 0), (2021, "d", DAY + datetime.timedelta(days=1), 2)]
    rows += [(2021, "d", DAY + datetime.timedelta(days=2), 5)]
    df = spark.createDataFrame(rows, "year int, fire string, obs_date date, n_fire int")
    return S.index_images(df)


def test_next_file_is_not_next_day(images):
    led = S.next_label(images, dates="obs_date").where("fire = 'b'").orderBy("in_fire_index")
    assert [(r["burned_area"], r["gap_days"]) for r in led.collect()] == [(1, 1), (4, 3), (5, 1)]


@pytest.mark.parametrize("n", [1, 2, 3, 6])
def test_windows_per_fire(images, n):
    built = S.leading_windows(images, n, ["n_fire"], "n_fire").collect()
    points = {(r["year"], r["fire"]): r for r in S.datapoints_per_fire(images, n).collect()}
    for key, row in points.items():
        mine = [r for r in built if (r["year"], r["fire"]) == key]
        assert len(mine) == row["datapoints"] == max(0, row["images"] - n)
        assert row["contributes"] == (len(mine) > 0)
        assert all(len(r["days"]) == n for r in mine)


def test_skip_makes_test_sets_agree(images):
    def labels(n):
        rows = S.next_label(images, n).where("fire = 'a'")
        kept = S.skip_initial(rows, n, 3)
        return [r["burned_area"] for r in kept.orderBy("in_fire_index").collect()]

    assert labels(1) == labels(2) == labels(3) == [0, 1, 2]


def test_settings_are_validated():
    for n, adjust in ((0, None), (2, 1), (1, 0)):
        with pytest.raises(ValueError):
            S.check_days(n, adjust)
    assert S.check_days(2, 5) == 3


def test_numbers_and_lookup(images):
    numbered = S.number_samples(S.next_label(images))
    rows = numbered.orderBy("sample_number").collect()
    assert [r["sample_number"] for r in rows] == list(range(10))
    assert [(r["fire"], r["in_fire_index"]) for r in rows] == sorted(
        (r["fire"], r["in_fire_index"]) for r in rows
    )
    last = S.find_samples(numbered, -1).first()
    assert (last["fire"], last["in_fire_index"]) == ("d", 1)
    for wrong in (10, -11):
        with pytest.raises(Exception, match="out of range"):
            S.find_samples(numbered, wrong).collect()


def test_folds(spark, images):
    assert S.fold_years(0) == {"train": [2018, 2019], "val": [2020], "test": [2021]}
    folds = S.all_folds(spark)
    assert folds.count() == 48
    assert folds.groupBy("fold_id").agg(F.countDistinct("year").alias("y")).where("y <> 4").isEmpty()
    split = {r["fire"]: r["split"] for r in S.fold_split(images, 11).collect()}
    assert split == {"a": "test", "b": "test", "c": "val", "d": "train"}


def test_views(images):
    views = S.split_views(S.next_label(images), 0, 1, 2)
    assert {n: v.count() for n, v in views.items()} == {"train": 8, "val": 0, "test": 1}
    test = views["test"].first()
    assert test["in_fire_index"] == 0 and test["burned_area"] == 5
    assert test["stats_years"] == [2018, 2019] and test["augmented"] is False


def test_overview(images):
    rows = {r["year"]: (r["fires"], r["images"], r["samples"]) for r in S.dataset_overview(images, 1).collect()}
    assert rows == {2018: (2, 10, 8), 2019: (1, 1, 0), 2021: (1, 3, 2), None: (4, 14, 10)}


@pytest.mark.parametrize("n", [1, 2, 7, 1000, 5001])
def test_exact_sizes(spark, n):
    df = spark.range(n).withColumn("year", F.lit(2018))
    split = P.random_split_exact(df, ["id"], 0.7, 0.15, 0.15, seed=3)
    sizes = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    a, b = int(n * 0.7), int(n * 0.15)
    want = {"train": a, "val": b, "test": n - a - b}
    assert sizes == {k: v for k, v in want.items() if v}
    assert split.count() == n


def test_whole_table_into_one_split(spark):
    df = spark.range(50)
    only = P.random_split_exact(df, ["id"], 1.0, 0.0, 0.0)
    assert only.where("split = 'train'").count() == 50
    only = P.random_split_exact(df, ["id"], 0.0, 0.0, 1.0)
    assert only.where("split = 'test'").count() == 50


def test_hash_split_is_stable_under_appends(spark):
    small = P.random_split_hash(spark.range(500), ["id"]).collect()
    large = {r["id"]: r["split"] for r in P.random_split_hash(spark.range(3000), ["id"]).collect()}
    assert all(large[r["id"]] == r["split"] for r in small)
    share = sum(s == "train" for s in large.values()) / 3000
    assert abs(share - 0.7) < 0.03


def test_ratios_must_sum_to_one(spark):
    for split in (P.random_split_exact, P.random_split_hash):
        with pytest.raises(ValueError):
            split(spark.range(5), ["id"], 0.7, 0.2, 0.2)


def test_split_checks_find_leaks(spark):
    rows = [(1, "a", "train"), (1, "a", "test"), (2, "a", "train"), (3, "b", "train")]
    df = spark.createDataFrame(rows, "id int, fire string, split string")
    got = P.split_checks(df, ["id"], ["fire"], 5).first()
    assert got.asDict() == {
        "samples": 4, "empty_splits": 1, "shared_keys": 1, "shared_fires": 1, "complete": False,
    }
