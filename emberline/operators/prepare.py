"""Feature preparation: choosing columns, contracts between heads, medians, class balance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import count_if, is_missing, null_if_nan
from ..schema import METADATA_COLUMNS, NON_FEATURES, TARGET_COLUMNS, TEMPORAL_COLUMNS
from .quantiles import exact_quantiles


def feature_columns(
    df: DataFrame, exclude: Sequence[str] | None = None, ordered: bool = True
) -> list[str]:
    """Every column that is not excluded, lexicographically or in table order."""
    skip = set(NON_FEATURES if exclude is None else exclude)
    names = [c for c in df.columns if c not in skip]
    return sorted(names) if ordered else names


def expand_arrays(df: DataFrame, arrays: dict[str, tuple[str, int]]) -> DataFrame:
    """Arrays to numbered columns, the form of the CSV files: ``{array: (prefix, width)}``."""
    flat = [c for c in df.columns if c not in arrays]
    wide = [
        F.get(F.col(a), i).alias(f"{prefix}_{i}")
        for a, (prefix, width) in arrays.items()
        for i in range(width)
    ]
    return df.select(*flat, *wide)


def assemble_features(df: DataFrame, names: Sequence[str], name: str = "features") -> DataFrame:
    """The named columns as one array in that order; the names stay in the column's metadata."""
    missing = missing_features(df.columns, names)
    if missing:
        raise ValueError(f"features not found: {missing[:10]}")
    packed = F.array(*[null_if_nan(F.col(n).cast("double")) for n in names])
    return df.withColumn(name, packed).withMetadata(name, {"names": list(names)})


def missing_features(available: Sequence[str], wanted: Sequence[str]) -> list[str]:
    have = set(available)
    return [w for w in wanted if w not in have]


def column_category(name: str) -> str:
    if name.startswith("embedding"):
        return "embedding"
    for category, names in (
        ("target", TARGET_COLUMNS),
        ("metadata", METADATA_COLUMNS),
        ("temporal", TEMPORAL_COLUMNS),
    ):
        if name in names:
            return category
    return "other"


def digests(df: DataFrame, names: Sequence[str]) -> list[Column]:
    """Two independent 64-bit hashes ``_h1``, ``_h2`` of some columns' values, told apart from missing ones.

    Together 128 bits: what a value is compared by, whatever its length.
    """
    parts = []
    for name in names:
        parts += [_text(df, name) if _nested(df, name) else F.col(name), F.col(name).isNull()]
    return [F.xxhash64(F.lit(seed), *parts).alias(f"_h{seed}") for seed in (1, 2)]


def column_digests(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct (column, _h1, _h2) of all values that are there.

    Each row is unpivoted and made distinct within its task; a distinct value travels as 24 bytes,
    also a whole embedding, and a value that fills a third of the table as one row per task.
    """
    pairs = [
        F.when(~_missing_of(df, n), F.struct(F.lit(i).alias("column"), *digests(df, [n])))
        for i, n in enumerate(columns)
    ]
    each = df.select(F.explode(F.array_compact(F.array(*pairs))).alias("p"))
    return each.select("p.*").distinct()


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, distinct_values)`` of non-missing values; columns without any are not listed."""
    names = F.array(*[F.lit(n) for n in columns])
    counts = column_digests(df, columns).groupBy("column").agg(F.count(F.lit(1)).alias("distinct_values"))
    return counts.select(F.element_at(names, F.col("column") + 1).alias("column"), "distinct_values")


def missing_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, missing)`` of every column; only counts are shuffled."""
    flags = F.array(*[F.struct(F.lit(n).alias("column"), _missing_of(df, n).alias("gone")) for n in columns])
    each = df.select(F.explode(flags).alias("p"))
    return each.groupBy("p.column").agg(count_if(F.col("p.gone")).alias("missing"))


def _nested(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.ArrayType, T.StructType, T.MapType))


def _missing_of(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return is_missing(name)
    return F.col(name).isNull()


def _text(df: DataFrame, name: str) -> Column:
    if _nested(df, name):
        return F.to_json(F.struct(name))
    return F.col(name).cast("string")


def column_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing and distinct counts of each column with its category."""
    names = list(columns or df.columns)
    category = F.lit("other")
    for wanted in ("embedding", "target", "metadata", "temporal"):
        members = [n for n in names if column_category(n) == wanted]
        if members:
            category = F.when(F.col("column").isin(members), wanted).otherwise(category)
    found = missing_values(df, names).join(F.broadcast(distinct_values(df, names)), "column", "left")
    return found.select("column", "missing", F.coalesce("distinct_values", F.lit(0)).alias("distinct_values"), category.alias("category"))


# --- feature contract ---------------------------------------------------------------------------


def align_to_model(saved: Sequence[str] | None, model: Sequence[str] | None) -> list[str]:
    """The saved list in the model's order; names unknown to the model follow at the end."""
    if saved is None and model is None:
        raise ValueError("neither a saved feature list nor the model's own names are known")
    if saved is None:
        return list(model)
    if model is None:
        return list(saved)
    wanted, known = set(saved), set(model)
    return [m for m in model if m in wanted] + [s for s in saved if s not in known]


def common_features(p_head: Sequence[str], a_head: Sequence[str]) -> tuple[list[str], list[str]]:
    """What each head is given: its own list if both agree, else the shared names in its order."""
    if set(p_head) == set(a_head):
        return list(p_head), list(a_head)
    shared = set(p_head) & set(a_head)
    return [f for f in p_head if f in shared], [f for f in a_head if f in shared]


def name_features(df: DataFrame, names: Sequence[str], features: str = "features") -> DataFrame:
    """Let a feature array carry the names of its entries."""
    return df.withMetadata(features, {**df.schema[features].metadata, "names": list(names)})


def order_features(df: DataFrame, features: str, names: Sequence[str]) -> DataFrame:
    """Re-order a named feature array to ``names``; fails with the names that are missing."""
    have = df.schema[features].metadata.get("names")
    if have is None:
        raise ValueError(f"column {features} carries no feature names")
    missing = missing_features(have, names)
    if missing:
        raise ValueError(f"model expects {len(names)} features, missing: {missing[:10]}")
    if list(have) == list(names):
        return df
    place = {n: i for i, n in enumerate(have)}
    reordered = F.array(*[F.get(F.col(features), place[n]) for n in names])
    return df.withColumn(features, reordered).withMetadata(features, {"names": list(names)})


# --- medians ------------------------------------------------------------------------------------


def feature_medians(df: DataFrame, features: str = "features") -> list[float | None]:
    """Exact median of every array position over non-missing values.

    The result has as many numbers as the array has positions, however many rows there are.
    """
    long = df.select(F.posexplode(features).alias("position", "value"))
    found = {
        r["position"]: r["quantiles"][0]
        for r in exact_quantiles(long, "value", [0.5], by=["position"]).collect()
    }
    return [found.get(i) for i in range(max(found) + 1)] if found else []


def fill_with(
    df: DataFrame, medians: Sequence[float | None], features: str = "features", zero: bool = False
) -> DataFrame:
    """Replace missing entries by position; ``zero`` also fills what has no median."""
    metadata = df.schema[features].metadata
    fills = F.array(*[F.lit(m) for m in medians]).cast("array<double>")
    last = [F.lit(0.0)] if zero else []
    filled = F.zip_with(features, fills, lambda v, m: F.coalesce(null_if_nan(v.cast("double")), m, *last))
    return df.withColumn(features, filled).withMetadata(features, metadata)


def impute(
    df: DataFrame, train: DataFrame | None, policy: str = "train", features: str = "features"
) -> DataFrame:
    """Median imputation: ``train`` medians, the table's ``own``, or ``train_then_zero``."""
    if policy == "own":
        return fill_with(df, feature_medians(df, features), features)
    if policy == "train":
        return fill_with(df, feature_medians(train, features), features)
    if policy == "train_then_zero":
        medians = feature_medians(train, features) if train is not None else []
        return fill_with(df, medians, features, zero=True)
    raise ValueError(f"unknown imputation policy {policy!r}")


def drop_missing_label(df: DataFrame, label: str) -> DataFrame:
    return df.where(~_missing_of(df, label))


def positives(df: DataFrame, label: str = "log_burned_area", area: str = "burned_area") -> DataFrame:
    """Rows with burned area and a label."""
    return drop_missing_label(df.where(F.col(area) > 0), label)


def class_balance(df: DataFrame, label: str = "ignition", purpose: str = "training") -> DataFrame:
    """Class counts, positive percentage, ``neg/pos`` weight and a verdict.

    Verdict limits are 5 and 20 percent for training, 1 and 5 for exploration.
    """
    low, high = {"training": (5, 20), "exploration": (1, 5)}[purpose]
    counted = df.agg(
        count_if(F.col(label) == 1).alias("positive"),
        count_if(F.col(label) == 0).alias("negative"),
        F.count(label).alias("labelled"),
    )
    percent = F.try_divide(F.lit(100.0) * F.col("positive"), F.col("labelled"))
    both = (F.col("positive") > 0) & (F.col("negative") > 0)
    return counted.select(
        "positive",
        "negative",
        percent.alias("positive_percent"),
        F.when(both, F.col("negative") / F.col("positive")).alias("scale_pos_weight"),
        F.when(percent < low, "imbalanced")
        .when(percent < high, "moderate")
        .otherwise("balanced")
        .alias("verdict"),
    )
