"""Exact deduplication by skew-safe combining: DataFrame functions only.

Rows meet three times, and whole contents are compared each time: inside their task (the partial
aggregate), per digest and salt, and, for salted digests, once more among the salt winners. Only
digests that hold at least ``hot_share`` of all rows are salted, so the list of them has at most
``1 / hot_share`` entries and is broadcast; all other rows cross the network once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, query, sized_join, stage, table


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = lambda content: F.sha2(content, 256),
    hot_share: float = 0.001,
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z. The largest id of a group stays.
    Null text counts as empty; rows with a null id count in ``group_size`` and are never kept
    unless the whole group has no id (keep_id null, kept false). Rows that repeat the kept id are
    all marked kept. Other columns, whatever their names, are ignored. An empty table gives an
    empty result. ``digest`` may be weak: groups are told apart by content, never by digest alone.
    """
    rows = docs.select(F.col(id_col).alias("id"), lower_ascii(F.coalesce(F.col(text_col), F.lit(""))).alias("content"))
    keyed = rows.select("id", "content", digest(F.col("content")).alias("digest"))
    ids = stage(keyed.select("id", "digest", F.sha2("content", 256).alias("sha")))
    total = ids.count()
    least = max(2, int(total * hot_share))
    hot = stage(
        ids.groupBy("digest").count().where(F.col("count") >= least)
        .select("digest", F.ceil(F.col("count") / least).alias("salts"))
    )
    salt = F.when(F.col("salts").isNull(), F.lit(-1)).otherwise(F.pmod(F.xxhash64("id"), "salts")).alias("salt")
    salted = keyed.join(F.broadcast(hot), "digest", "left").select("id", "content", "digest", salt)
    winners = stage(
        salted.groupBy("digest", "salt", "content")
        .agg(F.max("id").alias("keep_id"), F.count("*").alias("size"))
        .select("digest", "salt", "keep_id", "size", F.when(F.col("salt") >= 0, F.col("content")).alias("content"))
    )
    merged = (
        winners.where("salt >= 0").groupBy("digest", "content")
        .agg(F.max("keep_id").alias("keep_id"), F.sum("size").alias("size"))
        .select("digest", "keep_id", "size", F.lit(True).alias("hot"))
    )
    classes = stage(merged.union(winners.where("salt < 0").select("digest", "keep_id", "size", F.lit(False))))
    clashing = stage(classes.groupBy("digest").count().where("count > 1").select("digest"))
    plain = classes
    if not clashing.isEmpty():
        plain = classes.join(clashing, "digest", "left_anti")
    heavy = plain.where("hot").select("digest", F.col("keep_id").alias("hot_id"), F.col("size").alias("hot_size"))
    light = plain.where("NOT hot").select("digest", "keep_id", "size")
    # Hot rows are served by the broadcast and leave their key, so that they do not meet in the shuffle.
    first = ids.join(F.broadcast(heavy), "digest", "left")
    first = first.withColumn("key", F.when(F.col("hot_size").isNull(), F.col("digest")).otherwise(F.concat(F.lit("#"), F.xxhash64("id"))))
    found = first.join(light.withColumnRenamed("digest", "key"), "key", "left").select(
        "id", "sha", F.coalesce("hot_id", "keep_id").alias("keep_id"), F.coalesce("hot_size", "size").alias("size")
    )
    if not clashing.isEmpty():
        found = found.where("size IS NOT NULL").union(_by_content(keyed, clashing))
    return found.select(
        F.col("id").alias("doc_id"),
        "keep_id",
        F.col("size").alias("group_size"),
        F.coalesce(F.col("id") == F.col("keep_id"), F.lit(False)).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def _by_content(keyed: DataFrame, clashing: DataFrame) -> DataFrame:
    """Rows of digests that stand for several contents, matched with their class by content."""
    rows = keyed.join(clashing, "digest", "left_semi")
    classes = rows.groupBy("digest", "content").agg(F.max("id").alias("keep_id"), F.count("*").alias("size"))
    return rows.join(classes, ["digest", "content"]).select("id", F.sha2("content", 256).alias("sha"), "keep_id", "size")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of equal texts, that of the largest id, with all its columns.

    Rows go by id and text, so a row stays whose id another text has too. Rows without an id give
    way to equal texts that have one. Of rows equal in both, and of equal texts that all have no id,
    any one stays. An empty table stays empty.
    """
    marks = exact_dedup(docs, id_col, text_col)
    key = _content_key(F.col("doc_id"), F.col("text_sha256")).alias("key")
    stays = F.col("kept") | F.col("keep_id").isNull()
    marks = stage(marks.select(key, stays.alias("stays")))
    gone = stage(marks.where("NOT stays").select("key").distinct())
    twice = stage(marks.where("stays").groupBy("key").count().where("count > 1").select("key"))
    name = "content_key"
    while name in docs.columns:
        name += "_"
    sha = F.sha2(lower_ascii(F.coalesce(F.col(text_col), F.lit(""))), 256)
    rows = docs.withColumn(name, _content_key(F.col(id_col), sha))
    rows = sized_join(rows, gone.withColumnRenamed("key", name), [name], "left_anti")
    if not twice.isEmpty():
        again = twice.withColumnRenamed("key", name)
        several = sized_join(rows, again, [name], "left_semi")
        one = several.groupBy(name).agg(*[F.first(F.struct(F.col(c))).alias(c) for c in docs.columns])
        one = one.select(name, *[F.col(f"`{c}`.`{c}`").alias(c) for c in docs.columns])
        rows = sized_join(rows, again, [name], "left_anti").unionByName(one)
    return rows.select(*docs.columns)


def _content_key(id_: Column, sha: Column) -> Column:
    return F.concat(F.coalesce(F.concat(F.lit("="), id_.cast("string")), F.lit("-")), F.lit(":"), sha)


SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS content
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY content) AS keep_id,
       count(*) OVER (PARTITION BY content) AS group_size,
       coalesce(doc_id = max(doc_id) OVER (PARTITION BY content), false) AS kept,
       sha256(content) AS text_sha256
FROM d
"""


@query("op10_exact_dedup", SQL)
def op10_exact_dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"))
