"""Checks of features, targets, joins, preparation."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import fire_label
from ..operators import features as X
from ..operators import prepare as R
from ..operators import samples as S
from ..schema import RGB_MEAN, RGB_STD
from ..session import stage, staging_root
from ..sources.tables import read_feature_list, write_feature_list
from .registry import check
from .views import Tables


@check(
    "f2_flatten_days",
    """
WITH w AS (SELECT year, fire, row_number() OVER o - 1 AS i, n_px AS p0, avg_static AS s0,
                  lead(n_px) OVER o AS p1, lead(avg_static) OVER o AS s1, lead(n_fire, 2) OVER o AS label
           FROM imgs WINDOW o AS (PARTITION BY year, fire ORDER BY obs_ts, img))
SELECT year, fire, CAST(i AS BIGINT) AS in_fire_index, position, round(value, 6) AS value
FROM (SELECT year, fire, i, label, 0 AS position, CAST(p0 AS DOUBLE) AS value FROM w
      UNION ALL SELECT year, fire, i, label, 1, s0 FROM w
      UNION ALL SELECT year, fire, i, label, 2, CAST(p1 AS DOUBLE) FROM w
      UNION ALL SELECT year, fire, i, label, 3, s1 FROM w) u
WHERE label IS NOT NULL""",
)
def flatten_days(t: Tables):
    daily = t.indexed.withColumn("tif", F.array(F.col("n_px").cast("double"), "avg_static"))
    windows = S.leading_windows(daily, 2, ["tif"], "n_fire")
    flat = X.flatten_days(F.transform("days", lambda d: d["tif"]))
    long = X.to_long(windows, ["year", "fire", "in_fire_index"], flat)
    return long.withColumn("value", F.round("value", 6))


@check(
    "f3_f4_image_targets",
    """
SELECT img, CAST(sum(y) AS BIGINT) AS burned_pixels, max(y) AS ignition
FROM (SELECT img, CASE WHEN coalesce(b_fire, 0) > 0 THEN 1 ELSE 0 END AS y FROM px) t GROUP BY img""",
)
def image_targets(t: Tables):
    return X.image_targets(t.px, ["img"], fire_label("b_fire"))


@check(
    "f5_log_burned_area",
    """
SELECT img, burned_area, CASE WHEN burned_area > 0 THEN 1 ELSE 0 END AS ignition,
       round(ln(1 + CAST(burned_area AS DOUBLE)), 6) AS log_burned_area FROM smp""",
)
def log_burned_area(t: Tables):
    targets = X.add_targets(t.smp.select("img", "burned_area"))
    return targets.withColumn("log_burned_area", F.round("log_burned_area", 6))


def _vectors(t: Tables):
    return t.read("embeddings").select(F.col("vec_id").alias("img"), "embedding")


@check(
    "f6_join_embeddings",
    """
SELECT s.img, s.burned_area, CAST(len(e.embedding) AS INT) AS width,
       round(CAST(e.embedding[1] AS DOUBLE), 6) AS first_value
FROM smp s LEFT JOIN embeddings e ON e.vec_id = s.img""",
)
def join_embeddings(t: Tables):
    joined = X.join_embeddings(t.smp.select("img", "burned_area"), _vectors(t), ["img"])
    width = F.when(F.col("embedding").isNotNull(), F.size("embedding"))
    return joined.select(
        "img",
        "burned_area",
        width.alias("width"),
        F.round(F.get("embedding", 0).cast("double"), 6).alias("first_value"),
    )


@check(
    "f6_match_coverage",
    """
SELECT count(*) AS samples, count(e.embedding) AS matched, count(*) = count(e.embedding) AS complete
FROM smp s LEFT JOIN embeddings e ON e.vec_id = s.img""",
)
def match_coverage(t: Tables):
    return X.match_coverage(X.join_embeddings(t.smp.select("img"), _vectors(t), ["img"]))


@check(
    "f7_join_by_position",
    """
SELECT a.img, b.other, true AS lengths_agree
FROM (SELECT img, row_number() OVER (ORDER BY year, fire, img) AS k FROM smp) a
JOIN (SELECT img AS other, row_number() OVER (ORDER BY img) AS k FROM smp) b USING (k)""",
)
def join_by_position(t: Tables):
    right = t.stored_smp.select(F.col("img").alias("other"))
    left = t.stored_smp.select("year", "fire", "img")
    joined = X.join_by_position(left, ["year", "fire", "img"], right, ["other"], ["other"])
    return joined.select("img", "other", "lengths_agree")


@check(
    "f7_lengths_differ",
    "SELECT img, CAST(NULL AS BIGINT) AS vec_id, false AS lengths_agree FROM smp",
)
def lengths_differ(t: Tables):
    right = t.read("embeddings").select("vec_id")
    left = t.stored_smp.select("img")
    return X.join_by_position(left, ["img"], right, ["vec_id"], ["vec_id"])


@check(
    "f8_union_splits",
    """
SELECT img, n_px, CASE WHEN split = 'test' THEN NULL ELSE burned_area END AS burned_area, split
FROM tagged""",
)
def union_splits(t: Tables):
    fold = t.stored_fold(0).select("img", "n_px", "burned_area", "split")
    parts = {n: fold.where(F.col("split") == n).drop("split") for n in ("train", "val", "test")}
    parts["test"] = parts["test"].drop("burned_area")
    return X.union_splits(parts)


@check(
    "f9_month_day",
    """
SELECT event_id, day_of_year,
       CAST(least(greatest(floor((day_of_year - 1) / 30) + 1, 1), 12) AS INT) AS month,
       CAST((day_of_year - 1) % 30 + 1 AS INT) AS day_of_month FROM cal""",
)
def month_day(t: Tables):
    return X.add_month_day(t.cal.select("event_id", "day_of_year"))


@check(
    "f10_split_summary",
    """
SELECT split, count(*) AS samples,
       round(avg(CASE WHEN burned_area > 0 THEN 1.0 ELSE 0.0 END), 6) AS ignition_rate,
       round(avg(burned_area), 6) AS mean_burned_area, 2 AS features
FROM tagged GROUP BY split""",
)
def split_summary(t: Tables):
    summary = X.split_summary(X.add_targets(t.fold(0)), 2)
    return summary.withColumns(
        {c: F.round(c, 6) for c in ("ignition_rate", "mean_burned_area")}
    )


@check(
    "f11_rgb_prepare",
    f"""
WITH p AS (SELECT img, r, c, b_deg AS a, coalesce(b_cont, 0) AS b, b_static AS d FROM px),
e AS (SELECT img, least(min(a), min(b), min(d)) AS lo, greatest(max(a), max(b), max(d)) AS hi
      FROM p GROUP BY img)
SELECT img, r, c,
       round((CASE WHEN hi > lo THEN (a - lo) / (hi - lo) ELSE 0 END - {RGB_MEAN[0]}::DOUBLE) / {RGB_STD[0]}::DOUBLE, 6) AS red,
       round((CASE WHEN hi > lo THEN (b - lo) / (hi - lo) ELSE 0 END - {RGB_MEAN[1]}::DOUBLE) / {RGB_STD[1]}::DOUBLE, 6) AS green,
       round((CASE WHEN hi > lo THEN (d - lo) / (hi - lo) ELSE 0 END - {RGB_MEAN[2]}::DOUBLE) / {RGB_STD[2]}::DOUBLE, 6) AS blue
FROM p JOIN e USING (img)""",
)
def rgb_prepare(t: Tables):
    pixels = t.px.select(
        "img", "r", "c", "b_deg", F.coalesce("b_cont", F.lit(0.0)).alias("b_cont"), "b_static"
    )
    planes = X.rgb_prepare(pixels, ["img"], ["b_deg", "b_cont", "b_static"])
    return planes.withColumns({n: F.round(n, 6) for n in ("red", "green", "blue")})


_PLANE = "round(CAST(CAST((CASE WHEN hi > lo THEN ({v} - lo) / (hi - lo) ELSE 0 END - {mean}::DOUBLE) / {std}::DOUBLE AS FLOAT) AS DOUBLE), 6)"


@check(
    "f12_embed_images",
    """
WITH places AS (
  SELECT img, r, c, max(b_deg) AS a, max(coalesce(b_cont, 0)) AS b, max(CAST(b_static AS DOUBLE)) AS d FROM px GROUP BY img, r, c),
ends AS (
  SELECT img, max(a) AS ah, min(a) AS al, max(b) AS bh, min(b) AS bl, max(d) AS dh, min(d) AS dl, count(*) AS pixels,
         greatest(max(a), max(b), max(d)) AS hi, least(min(a), min(b), min(d)) AS lo FROM places GROUP BY img)
SELECT img, pixels, """
    + ", ".join(
        f"{_PLANE.format(v=v, mean=RGB_MEAN[i % 3], std=RGB_STD[i % 3])} AS {v}"
        for i, v in enumerate(("ah", "bh", "dh", "al", "bl", "dl"))
    )
    + " FROM ends",
)
def embed_images(t: Tables):
    """The function stands for a network: it gives the largest and the least value of each plane."""
    value = {"b_deg": F.col("b_deg"), "b_cont": F.coalesce("b_cont", F.lit(0.0)), "b_static": F.col("b_static").cast("double")}
    pixels = t.px.groupBy("img", "r", "c").agg(*[F.max(v).alias(n) for n, v in value.items()])
    planes = X.rgb_prepare(pixels, ["img"], list(value))

    def load():
        import numpy as np

        def run(grid):
            # Places without a pixel are 0 in the grid; only real ones are looked at.
            real = (grid != 0).any(axis=0)
            planes = grid[:, real]
            return np.concatenate([planes.max(axis=1), planes.min(axis=1), [real.sum()]])

        return run

    found = X.embed_images(planes, ["img"], load)
    at = F.col("embedding")
    names = ["ah", "bh", "dh", "al", "bl", "dl"]
    ends = [F.round(at[i].cast("double"), 6).alias(n) for i, n in enumerate(names)]
    return found.select("img", at[6].cast("bigint").alias("pixels"), *ends)


@check(
    "s4_embedding_table",
    "SELECT vec_id AS img, 'train' AS split, CAST(len(embedding) AS INT) AS width, round(CAST(list_sum(embedding) AS DOUBLE), 4) AS total FROM embeddings",
)
def embedding_table(t: Tables):
    """Stored by split and read back."""
    vectors = _vectors(t).withColumn("split", F.lit("train"))
    read = stage(vectors, "split")
    total = F.aggregate("embedding", F.lit(0.0), lambda s, v: s + v.cast("double"))
    return read.select("img", "split", F.size("embedding").alias("width"), F.round(total, 4).alias("total"))


# --- preparation --------------------------------------------------------------------------------

_FEATURES = ["avg_cont", "avg_static", "n_px"]


@check(
    "t1_assemble_features",
    """
SELECT img, round(avg_cont, 6) AS f0, round(avg_static, 6) AS f1, CAST(n_px AS DOUBLE) AS f2,
       'avg_cont,avg_static,n_px' AS names
FROM feat""",
)
def assemble_features(t: Tables):
    table = t.feat.select("year", "img", "n_px", "avg_static", "avg_cont", "burned_area")
    names = R.feature_columns(table.drop("img"))
    packed = R.assemble_features(table, names)
    columns = [F.round(F.col("features")[i], 6).alias(f"f{i}") for i in range(3)]
    kept = packed.schema["features"].metadata["names"]
    return packed.select("img", *columns, F.lit(",".join(kept)).alias("names"))


@check(
    "t2_column_profile",
    """
SELECT 'avg_cont' AS "column", count(*) - count(avg_cont) AS missing,
       count(DISTINCT round(avg_cont, 6)) AS distinct_values, 'other' AS category FROM feat
UNION ALL SELECT 'n_px', count(*) - count(n_px), count(DISTINCT n_px), 'other' FROM feat
UNION ALL SELECT 'year', count(*) - count(year), count(DISTINCT year), 'temporal' FROM feat
UNION ALL SELECT 'label', count(*) - count(label), count(DISTINCT label), 'other' FROM feat
UNION ALL SELECT 'burned_area', count(*) - count(burned_area), count(DISTINCT burned_area), 'target' FROM feat
UNION ALL SELECT 'embedding', count(*) - count(embedding), count(DISTINCT embedding), 'embedding' FROM feat""",
)
def column_profile(t: Tables):
    table = t.feat.withColumn("avg_cont", F.round("avg_cont", 6))
    names = ["avg_cont", "n_px", "year", "label", "burned_area", "embedding"]
    return R.column_profile(table, names)


def _features(t: Tables):
    packed = F.array(
        *[F.col(c).cast("double") for c in ("avg_cont", "label", "n_px")],
        F.get("embedding", 0).cast("double"),
    )
    return stage(t.feat.select("year", "img", packed.alias("features")))


_COLUMNS = ["avg_cont", "label", "n_px", "embedding[1]"]


def _imputed_sql(train: str, last: str = "NULL") -> str:
    medians = ", ".join(
        f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS m{i}" for i, c in enumerate(_COLUMNS)
    )
    filled = ", ".join(
        f"round(coalesce(CAST({c} AS DOUBLE), m{i}, {last}), 6) AS f{i}" for i, c in enumerate(_COLUMNS)
    )
    return f"WITH m AS (SELECT {medians} FROM feat WHERE {train}) SELECT img, {filled} FROM feat, m"


def _imputed(df):
    return df.select("img", *[F.round(F.col("features")[i], 6).alias(f"f{i}") for i in range(4)])


@check("t4_impute_train", _imputed_sql("year <= 1996"))
def impute_train(t: Tables):
    table = _features(t)
    return _imputed(R.impute(table, table.where("year <= 1996"), "train"))


@check("t4_impute_own", _imputed_sql("true"))
def impute_own(t: Tables):
    return _imputed(R.impute(_features(t), None, "own"))


@check(
    "t4_impute_train_then_zero",
    _imputed_sql("year <= 1993", last="0").replace(
        "quantile_cont(CAST(label AS DOUBLE), 0.5) AS m1", "CAST(NULL AS DOUBLE) AS m1"
    ),
)
def impute_train_then_zero(t: Tables):
    table = _features(t)
    # The training part has no label at all, so its missing labels fall through to 0.
    blank = F.transform(
        "features", lambda v, i: F.when(i == 1, F.lit(None).cast("double")).otherwise(v)
    )
    train = table.where("year <= 1993").withColumn("features", blank)
    return _imputed(R.impute(table, train, "train_then_zero"))


_CONTRACT = ["n_px", "avg_cont", "avg_static", "label"]


@check(
    "t3_feature_contract",
    """
SELECT img, n_px::DOUBLE AS p_0, round(avg_static, 6) AS p_1, round(avg_static, 6) AS a_0, n_px::DOUBLE AS a_1, 'gone,later' AS missing,
       'n_px,avg_static,label,gone,later' AS aligned FROM feat""",
)
def feature_contract(t: Tables):
    """Stored lists are put into the models' order; heads that disagree share what both know; names that
    the table lacks are told."""
    table = t.feat.withColumn("features", F.array(*[F.col(n).cast("double") for n in _CONTRACT]))
    table = R.name_features(table, _CONTRACT)
    folder = f"{staging_root(t.spark).rstrip('/')}/contract-{uuid.uuid4().hex}"
    write_feature_list(t.spark, ["avg_static", "gone", "label", "n_px", "later"], f"{folder}/p")
    write_feature_list(t.spark, ["avg_static", "other", "n_px", "avg_cont"], f"{folder}/a")
    p_head = R.align_to_model(read_feature_list(t.spark, f"{folder}/p"), ["n_px", "avg_static", "label"])
    p_names, a_names = R.common_features(p_head, read_feature_list(t.spark, f"{folder}/a"))
    for head, names in (("p", p_names), ("a", a_names)):
        own = R.name_features(table.withColumn(f"for_{head}", F.col("features")), _CONTRACT, f"for_{head}")
        table = R.order_features(own, f"for_{head}", names)
    told = ",".join(R.missing_features(_CONTRACT, p_head))
    values = [F.round(F.get(F.col(f"for_{head}"), i), 6).alias(f"{head}_{i}") for head in "pa" for i in range(2)]
    return table.select("img", *values, F.lit(told).alias("missing"), F.lit(",".join(p_head)).alias("aligned"))


@check("t5_drop_missing_label", "SELECT img, label FROM feat WHERE label IS NOT NULL")
def drop_missing_label(t: Tables):
    return R.drop_missing_label(t.feat, "label").select("img", "label")


def _balance_sql(low: int, high: int) -> str:
    return f"""
SELECT positive, negative, round(100.0 * positive / (positive + negative), 6) AS positive_percent,
       round(CAST(negative AS DOUBLE) / positive, 6) AS scale_pos_weight,
       CASE WHEN 100.0 * positive / (positive + negative) < {low} THEN 'imbalanced'
            WHEN 100.0 * positive / (positive + negative) < {high} THEN 'moderate'
            ELSE 'balanced' END AS verdict
FROM (SELECT count(CASE WHEN burned_area > 0 THEN 1 END) AS positive,
             count(CASE WHEN burned_area = 0 THEN 1 END) AS negative FROM smp) t"""


def _rounded_balance(df):
    return df.withColumns(
        {c: F.round(c, 6) for c in ("positive_percent", "scale_pos_weight")}
    )


@check("t6_class_balance", _balance_sql(5, 20))
def class_balance(t: Tables):
    return _rounded_balance(R.class_balance(X.add_targets(t.smp)))


@check("t6_class_balance_exploration", _balance_sql(1, 5))
def class_balance_exploration(t: Tables):
    return _rounded_balance(R.class_balance(X.add_targets(t.smp), purpose="exploration"))


@check(
    "t7_positives",
    "SELECT img, burned_area, label FROM feat WHERE burned_area > 0 AND label IS NOT NULL",
)
def positives(t: Tables):
    return R.positives(t.feat, label="label").select("img", "burned_area", "label")
