"""Checks of sample construction: windows, labels, numbering, folds, splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import samples as S
from ..operators import splits as P
from .registry import check
from .views import FOLDS, Tables

KEY = ["year", "fire", "img"]


@check(
    "w1_leading_windows",
    """
SELECT year, fire, CAST(i AS BIGINT) AS in_fire_index, a0, a1, a2, label FROM (
  SELECT year, fire, row_number() OVER w - 1 AS i, img AS a0, lead(img, 1) OVER w AS a1,
         lead(img, 2) OVER w AS a2, lead(n_fire, 3) OVER w AS label
  FROM imgs WINDOW w AS (PARTITION BY year, fire ORDER BY obs_ts, img)) t
WHERE label IS NOT NULL""",
)
def leading_windows(t: Tables):
    built = S.leading_windows(t.indexed, 3, ["img"], "n_fire")
    days = [F.col("days")[i]["img"].alias(f"a{i}") for i in range(3)]
    return built.select("year", "fire", "in_fire_index", *days, "label")


@check(
    "w2_next_label",
    """
SELECT year, fire, img, CAST(i AS BIGINT) AS in_fire_index, burned_area,
       CAST(date_diff('day', CAST(obs_ts AS DATE), CAST(nxt AS DATE)) AS INT) AS gap_days FROM (
  SELECT year, fire, img, obs_ts, row_number() OVER w - 1 AS i,
         lead(n_fire) OVER w AS burned_area, lead(obs_ts) OVER w AS nxt
  FROM imgs WINDOW w AS (PARTITION BY year, fire ORDER BY obs_ts, img)) t
WHERE burned_area IS NOT NULL""",
)
def next_label(t: Tables):
    led = S.next_label(t.indexed, dates="obs_ts")
    return led.select("year", "fire", "img", "in_fire_index", "burned_area", "gap_days")


@check(
    "w3_datapoints_per_fire",
    """
SELECT year, fire, count(*) AS images, CAST(greatest(count(*) - 1 - 2, 0) AS BIGINT) AS datapoints,
       count(*) > 3 AS contributes
FROM imgs GROUP BY year, fire""",
)
def datapoints_per_fire(t: Tables):
    return S.datapoints_per_fire(t.img, n=2, adjust_to=3)


@check(
    "w4_skip_initial",
    """
SELECT year, fire, img, CAST(in_fire_index - 2 AS BIGINT) AS in_fire_index, burned_area
FROM smp WHERE in_fire_index >= 2""",
)
def skip_initial(t: Tables):
    kept = S.skip_initial(t.smp, n=1, adjust_to=3)
    return kept.select("year", "fire", "img", "in_fire_index", "burned_area")


@check(
    "w5_sample_number",
    """
SELECT year, fire, CAST(in_fire_index AS BIGINT) AS in_fire_index,
       CAST(row_number() OVER (ORDER BY year, fire, in_fire_index) - 1 AS BIGINT) AS sample_number,
       count(*) OVER () AS n_samples
FROM smp""",
)
def sample_number(t: Tables):
    numbered = S.number_samples(t.stored_smp)
    return numbered.select("year", "fire", "in_fire_index", "sample_number", "n_samples")


@check(
    "w5_find_samples",
    """
WITH numbered AS (
  SELECT year, fire, img, CAST(row_number() OVER (ORDER BY year, fire, in_fire_index) - 1 AS BIGINT)
           AS sample_number, count(*) OVER () AS n
  FROM smp)
SELECT year, fire, img, sample_number FROM numbered WHERE sample_number IN (0, 41, n - 1, n - 7)""",
)
def find_samples(t: Tables):
    found = S.find_samples(S.number_samples(t.stored_smp), 0, 41, -1, -7)
    return found.select("year", "fire", "img", "sample_number")


@check("w6_fold_split", "SELECT year, fire, img, split FROM tagged")
def fold_split(t: Tables):
    return t.fold(0).select("year", "fire", "img", "split")


@check(
    "w6_all_folds",
    "WITH folds AS (SELECT * FROM (VALUES "
    + ", ".join(
        f"({i}, {y}, '{s}')"
        for i, f in enumerate(FOLDS)
        for y, s in zip(f, ("train", "train", "val", "test"))
    )
    + """) v(fold_id, year, split))
SELECT fold_id, split, count(*) AS samples, CAST(sum(burned_area) AS BIGINT) AS burned
FROM smp JOIN folds USING (year) GROUP BY fold_id, split""",
)
def all_folds(t: Tables):
    per_year = t.stored_smp.groupBy("year").agg(
        F.count(F.lit(1)).alias("n"), F.sum("burned_area").alias("b")
    )
    folds = S.all_folds(t.spark, FOLDS)
    return (
        per_year.join(F.broadcast(folds), "year")
        .groupBy("fold_id", "split")
        .agg(F.sum("n").alias("samples"), F.sum("b").alias("burned"))
    )


@check(
    "w7_split_views",
    """
SELECT split, count(*) AS samples, CAST(sum(CASE WHEN split = 'test' THEN in_fire_index - 2
       ELSE in_fire_index END) AS BIGINT) AS index_sum, split <> 'test' AS augmented,
       '1995,1996' AS stats_years
FROM tagged WHERE split <> 'test' OR in_fire_index >= 2 GROUP BY split""",
)
def split_views(t: Tables):
    views = S.split_views(t.stored_smp, 0, n=1, adjust_to=3, folds=FOLDS)
    parts = [
        v.groupBy("split", "augmented", "stats_years").agg(
            F.count(F.lit(1)).alias("samples"), F.sum("in_fire_index").alias("index_sum")
        )
        for v in views.values()
    ]
    union = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return union.withColumn("stats_years", F.array_join("stats_years", ","))


@check(
    "w8_dataset_overview",
    """
SELECT year, count(*) AS fires, CAST(sum(n) AS BIGINT) AS images,
       CAST(sum(greatest(n - 1, 0)) AS BIGINT) AS samples
FROM (SELECT year, fire, count(*) AS n FROM imgs GROUP BY year, fire) f GROUP BY ROLLUP (year)""",
)
def dataset_overview(t: Tables):
    return S.dataset_overview(t.img, n=1)


_MD5 = "md5(concat('42|', CAST(year AS VARCHAR), '|', CAST(fire AS VARCHAR), '|', CAST(img AS VARCHAR)))"
_EXACT = f"""
SELECT year, fire, img, CASE
    WHEN k < floor(n * CAST(0.7 AS DOUBLE)) THEN 'train'
    WHEN k < floor(n * CAST(0.7 AS DOUBLE)) + floor(n * CAST(0.15 AS DOUBLE)) THEN 'val'
    ELSE 'test' END AS split
FROM (SELECT year, fire, img, row_number() OVER (ORDER BY {_MD5}) - 1 AS k, count(*) OVER () AS n
      FROM smp) t"""


@check("sp1_random_split_exact", _EXACT)
def random_split_exact(t: Tables):
    return P.random_split_exact(t.stored_smp, KEY).select(*KEY, "split")


@check(
    "sp2_random_split_hash",
    f"""
SELECT year, fire, img, CASE WHEN u < CAST(0.7 AS DOUBLE) THEN 'train'
    WHEN u < CAST(0.7 AS DOUBLE) + CAST(0.15 AS DOUBLE) THEN 'val' ELSE 'test' END AS split
FROM (SELECT year, fire, img,
             CAST(CAST(('0x' || substr({_MD5}, 1, 8)) AS BIGINT) AS DOUBLE) / 4294967296.0 AS u
      FROM smp) t""",
)
def random_split_hash(t: Tables):
    return P.random_split_hash(t.smp, KEY).select(*KEY, "split")


@check(
    "sp3_split_report",
    f"""
WITH s AS ({_EXACT})
SELECT split, count(*) AS samples,
       round(100.0 * count(*) / (SELECT count(*) FROM s), 6) AS percent,
       string_agg(DISTINCT CAST(year AS VARCHAR), ',' ORDER BY CAST(year AS VARCHAR)) AS years,
       count(DISTINCT year) AS n_years
FROM s GROUP BY split""",
)
def split_report(t: Tables):
    report = P.split_report(P.random_split_exact(t.stored_smp, KEY))
    return report.withColumns(
        {"percent": F.round("percent", 6), "years": F.array_join("years", ",")}
    )


@check(
    "sp4_split_checks",
    f"""
WITH s AS ({_EXACT})
SELECT (SELECT count(*) FROM s) AS samples,
       (SELECT 3 - count(DISTINCT split) FROM s) AS empty_splits,
       (SELECT count(*) FROM (SELECT img FROM s GROUP BY year, fire, img
                              HAVING count(DISTINCT split) > 1) a) AS shared_keys,
       (SELECT count(*) FROM (SELECT fire FROM s GROUP BY year, fire
                              HAVING count(DISTINCT split) > 1) b) AS shared_fires,
       (SELECT count(*) FROM s) = (SELECT count(*) FROM smp) AS complete""",
)
def split_checks(t: Tables):
    split = P.random_split_exact(t.stored_smp, KEY)
    expected = t.stored_smp.agg(F.count(F.lit(1))).scalar()
    return P.split_checks(split, KEY, ["year", "fire"], expected)


