"""Derived inputs of the checks: an order stands for an image, ten customers for a fire, a line
item for a pixel. Spark builds them with the library's own operators; the SQL text is independent.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import count_if, detection_hour, zero_if_missing
from ..operators import samples as S
from ..operators.joins import unless_large
from ..schema import FOLD_YEARS
from ..session import stage

#: Years of the check tables standing for 2018..2021 in the fold table.
YEARS = (1995, 1996, 1997, 1998)
FOLDS = [
    tuple(YEARS[y - 2018] for y in fold)
    for fold in FOLD_YEARS
]
ORDER = ("obs_ts", "img")


#: Known schemas save the job that would infer them from the files.
SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "labels": "doc_id bigint, quality int, toxic int",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


class Tables:
    """The driver's tables and the views derived from them, built lazily for one query."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def read(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(
            f"{self.sf_dir.rstrip('/')}/{name}.parquet"
        )

    @cached_property
    def px(self) -> DataFrame:
        line, orders = self.read("lineitem"), unless_large(self.read("orders"))
        hhmm = (F.col("l_partkey") % 24) * 100 + F.col("l_suppkey") % 60
        seen = (F.col("l_returnflag") == "R") & (F.col("l_quantity") > 30)
        return line.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.year("o_orderdate").cast("int").alias("year"),
            F.floor(F.col("o_custkey") / 10).cast("bigint").alias("fire"),
            F.col("o_orderdate").alias("obs_ts"),
            F.col("o_orderkey").alias("img"),
            (F.col("l_partkey") % 64).cast("int").alias("r"),
            (F.col("l_suppkey") % 48).cast("int").alias("c"),
            F.when(seen, hhmm.cast("double")).alias("b_fire"),
            (F.col("l_quantity") * 7.2).alias("b_deg"),
            F.when(F.col("l_tax") == 0, None)
            .otherwise((F.col("l_partkey") % 17 + 1).cast("int"))
            .alias("b_lc"),
            F.when(F.col("l_discount") > 0.095, None)
            .otherwise(F.col("l_extendedprice"))
            .alias("b_cont"),
            F.col("l_discount").alias("b_static"),
        )

    @cached_property
    def img(self) -> DataFrame:
        return self.px.groupBy("year", "fire", "obs_ts", "img").agg(
            F.count(F.lit(1)).alias("n_px"),
            count_if(zero_if_missing("b_fire") > 0).alias("n_fire"),
            count_if(detection_hour("b_fire") > 0).alias("n_mask"),
            F.avg("b_cont").alias("avg_cont"),
            F.avg("b_static").alias("avg_static"),
        )

    @cached_property
    def indexed(self) -> DataFrame:
        # Pixels are reduced once and stored; numbering and windows read the image rows.
        return S.index_images(stage(self.img), ORDER)

    @cached_property
    def smp(self) -> DataFrame:
        return S.next_label(self.indexed)

    @cached_property
    def pred(self) -> DataFrame:
        p = 1 / (1 + F.exp(-(F.lit(0.4) * F.col("n_px") - 2 + F.col("n_mask"))))
        area = F.col("burned_area")
        return self.smp.select(
            "year",
            "fire",
            "img",
            (area > 0).cast("int").alias("ignition"),
            area,
            F.log1p(area.cast("double")).alias("log_burned_area"),
            F.round(p, 2).alias("p_ignition"),
            F.round(F.lit(0.25) * F.col("n_px") + 4 * F.col("avg_static") - 0.8, 3).alias("log_pred"),
        )

    # Tables that several passes read are stored first, as the hand-over between stages is.

    @cached_property
    def stored_smp(self) -> DataFrame:
        return stage(self.smp)

    @cached_property
    def stored_pred(self) -> DataFrame:
        return stage(self.pred)

    @cached_property
    def feat(self) -> DataFrame:
        labels = self.read("labels").select(F.col("doc_id").alias("img"), F.col("quality").alias("label"))
        vectors = self.read("embeddings").select(F.col("vec_id").alias("img"), "embedding")
        base = self.smp.select(
            "year", "fire", "img", "n_px", "avg_cont", "avg_static", "burned_area"
        )
        return base.join(labels, "img", "left").join(vectors, "img", "left")

    @cached_property
    def files(self) -> DataFrame:
        ending = F.when(F.col("img") % 50 == 0, ".hdf5").otherwise(".tif")
        return self.img.select(
            F.concat(
                F.lit("raw/"),
                F.col("year").cast("string"),
                F.lit("/fire_"),
                F.col("fire").cast("string"),
                F.lit("/"),
                F.date_format("obs_ts", "yyyy-MM-dd"),
                F.lit("_"),
                F.col("img").cast("string"),
                ending,
            ).alias("path"),
            (F.col("n_px") * 1024).alias("size"),
        )

    @cached_property
    def cal(self) -> DataFrame:
        return self.read("events").select(
            "event_id",
            F.col("user_id").alias("burn_id"),
            F.col("event_type").alias("split"),
            F.year("ts").alias("year"),
            F.month("ts").alias("month"),
            F.dayofyear("ts").alias("day_of_year"),
            "value",
            "ts",
        )

    def stored_fold(self, fold_id: int = 0) -> DataFrame:
        return S.fold_split(self.stored_smp, fold_id, FOLDS)

    def fold(self, fold_id: int = 0) -> DataFrame:
        return S.fold_split(self.smp, fold_id, FOLDS)


SQL_VIEWS = {
    "px": """
SELECT CAST(year(o_orderdate) AS INT) AS year, CAST(floor(o_custkey / 10) AS BIGINT) AS fire,
       o_orderdate AS obs_ts, o_orderkey AS img,
       CAST(l_partkey % 64 AS INT) AS r, CAST(l_suppkey % 48 AS INT) AS c,
       CASE WHEN l_returnflag = 'R' AND l_quantity > 30
            THEN CAST((l_partkey % 24) * 100 + l_suppkey % 60 AS DOUBLE) END AS b_fire,
       l_quantity * CAST(7.2 AS DOUBLE) AS b_deg,
       CASE WHEN l_tax = 0 THEN NULL ELSE CAST(l_partkey % 17 + 1 AS INT) END AS b_lc,
       CASE WHEN l_discount > 0.095 THEN NULL ELSE l_extendedprice END AS b_cont,
       l_discount AS b_static
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "imgs": """
SELECT year, fire, obs_ts, img, count(*) AS n_px,
       CAST(sum(CASE WHEN coalesce(b_fire, 0) > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_fire,
       CAST(sum(CASE WHEN floor(coalesce(b_fire, 0) / 100) > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_mask,
       avg(b_cont) AS avg_cont, avg(b_static) AS avg_static
FROM px GROUP BY year, fire, obs_ts, img""",
    "smp": """
SELECT * FROM (
  SELECT i.*, lead(n_fire) OVER (PARTITION BY year, fire ORDER BY obs_ts, img) AS burned_area,
         row_number() OVER (PARTITION BY year, fire ORDER BY obs_ts, img) - 1 AS in_fire_index
  FROM imgs i) t
WHERE burned_area IS NOT NULL""",
    "pred": """
SELECT year, fire, img, CASE WHEN burned_area > 0 THEN 1 ELSE 0 END AS ignition, burned_area,
       ln(1 + CAST(burned_area AS DOUBLE)) AS log_burned_area,
       round(1 / (1 + exp(-(CAST(0.4 AS DOUBLE) * n_px - 2 + n_mask))), 2) AS p_ignition,
       round(CAST(0.25 AS DOUBLE) * n_px + 4 * avg_static - CAST(0.8 AS DOUBLE), 3) AS log_pred
FROM smp""",
    "feat": """
SELECT s.year, s.fire, s.img, s.n_px, s.avg_cont, s.avg_static, s.burned_area,
       l.quality AS label, e.embedding
FROM smp s LEFT JOIN labels l ON l.doc_id = s.img LEFT JOIN embeddings e ON e.vec_id = s.img""",
    "files": """
SELECT concat('raw/', CAST(year AS VARCHAR), '/fire_', CAST(fire AS VARCHAR), '/',
              substr(CAST(obs_ts AS VARCHAR), 1, 10), '_', CAST(img AS VARCHAR),
              CASE WHEN img % 50 = 0 THEN '.hdf5' ELSE '.tif' END) AS path,
       n_px * 1024 AS size
FROM imgs""",
    "cal": """
SELECT event_id, user_id AS burn_id, event_type AS split, CAST(year(ts) AS INT) AS year,
       CAST(month(ts) AS INT) AS month, CAST(dayofyear(ts) AS INT) AS day_of_year, value, ts
FROM events""",
    "tagged": """
SELECT *, CASE WHEN year IN (1995, 1996) THEN 'train' WHEN year = 1997 THEN 'val'
               WHEN year = 1998 THEN 'test' END AS split
FROM smp WHERE year BETWEEN 1995 AND 1998""",
    "scored": """
SELECT year, fire, img, ignition, burned_area, log_burned_area, p_ignition,
       least(greatest(log_pred, 0),
             (SELECT quantile_cont(log_burned_area, CAST(0.999 AS DOUBLE)) FROM pred WHERE burned_area > 0)) AS log_clip
FROM pred""",
    "haz": """
SELECT year, fire, img, ignition, burned_area, log_burned_area, p_ignition, log_clip,
       greatest(exp(log_clip) - 1, 0) AS area_pred,
       p_ignition * greatest(exp(log_clip) - 1, 0) AS hazard,
       CAST(ignition AS DOUBLE) * burned_area AS actual
FROM scored""",
}
