"""Feature, split, embedding and prediction tables. Parquet is the stored form, CSV the exchange form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.prepare import expand_arrays

ARRAYS = {"tif": "tif_feature", "embedding": "embedding"}


def write_table(df: DataFrame, path: str, *partition_by: str) -> None:
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def write_feature_csv(df: DataFrame, path: str, widths: dict[str, int]) -> None:
    """Arrays become numbered columns only here, at the edge."""
    arrays = {a: (ARRAYS[a], w) for a, w in widths.items()}
    expand_arrays(df, arrays).write.option("header", True).mode("errorifexists").csv(path)


def feature_csv_schema(keys: T.StructType, widths: dict[str, int]) -> T.StructType:
    wide = [
        T.StructField(f"{ARRAYS[a]}_{i}", T.DoubleType()) for a, w in widths.items() for i in range(w)
    ]
    return T.StructType([*keys.fields, *wide])


def read_feature_csv(
    spark: SparkSession, path: str, keys: T.StructType, widths: dict[str, int]
) -> DataFrame:
    """Read with a fixed schema (never inferred) and pack numbered columns back into arrays."""
    schema = feature_csv_schema(keys, widths)
    wide = spark.read.option("header", True).option("enforceSchema", False).schema(schema).csv(path)
    packed = [
        F.array(*[F.col(f"{ARRAYS[a]}_{i}") for i in range(w)]).alias(a) for a, w in widths.items()
    ]
    return wide.select(*keys.names, *packed)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).mode("errorifexists").csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.option("header", True).option("enforceSchema", False).schema(schema).csv(path)


def write_feature_list(spark: SparkSession, names: Sequence[str], path: str) -> None:
    """One name per line, in order: a few thousand names at most, so a single file."""
    rows = spark.createDataFrame([(n,) for n in names], "value string")
    rows.coalesce(1).write.mode("errorifexists").text(path)


def read_feature_list(spark: SparkSession, path: str) -> list[str]:
    lines = spark.read.text(path, wholetext=True).collect()
    return [line.strip() for row in lines for line in row["value"].split("\n") if line.strip()]
