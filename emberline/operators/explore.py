"""Exploration and data quality: listings, band and embedding statistics, distributions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import count_if, is_missing, null_if_nan
from ..schema import DOC_KEYWORDS, FILE_TYPES
from .joins import lookup_join
from .prepare import digests, distinct_values
from .quantiles import exact_quantiles, quantile_list

# --- files --------------------------------------------------------------------------------------


def file_extension(path: Column | str = "path") -> Column:
    """Lower-case ending with its dot, of the last path component only."""
    name = F.element_at(F.split(path, "/"), -1)
    ending = F.lower(F.regexp_extract(name, r".(\.[^.]+)$", 1))
    return F.when(ending == "", "(no extension)").otherwise(ending)


def files_by_extension(files: DataFrame) -> DataFrame:
    """Count and size per extension, and the grand total (extension ``TOTAL``)."""
    tagged = files.select(file_extension().alias("extension"), "size")
    rolled = tagged.rollup("extension").agg(
        F.grouping("extension").alias("_all"),
        F.count(F.lit(1)).alias("files"),
        F.sum("size").alias("bytes"),
    )
    return rolled.select(
        F.when(F.col("_all") == 1, "TOTAL").otherwise(F.col("extension")).alias("extension"),
        "files",
        "bytes",
        (F.col("bytes") / F.lit(1024.0 * 1024.0)).alias("megabytes"),
    )


def directory_counts(files: DataFrame, root: str = "", depth: int = 3) -> DataFrame:
    """Files directly inside each directory down to ``depth`` levels below ``root``.

    Directories that only hold directories are listed with 0 files.
    """
    relative = F.col("path") if not root else F.replace("path", F.lit(root.rstrip("/") + "/"), F.lit(""))
    parts = F.split(relative, "/")
    folders = F.slice(parts, 1, F.size(parts) - 1)
    levels = files.select(folders.alias("f")).where(F.size("f") > 0)
    # First per full folder, then each folder counts once for itself and names its parents.
    per_folder = levels.groupBy("f").agg(F.count(F.lit(1)).alias("n"))
    spread = per_folder.select(
        "n",
        "f",
        F.explode(F.sequence(F.lit(1), F.least(F.size("f"), F.lit(depth)))).alias("depth"),
    )
    return (
        spread.groupBy(F.array_join(F.slice("f", F.lit(1), F.col("depth")), "/").alias("directory"), "depth")
        .agg(F.sum(F.when(F.size("f") == F.col("depth"), F.col("n")).otherwise(0)).alias("files"))
    )


def top_level_files(files: DataFrame, root: str = "") -> DataFrame:
    """Files directly under ``root`` with a description of their type."""
    relative = F.col("path") if not root else F.replace("path", F.lit(root.rstrip("/") + "/"), F.lit(""))
    ending = file_extension(relative)
    known = F.create_map(*[F.lit(x) for pair in FILE_TYPES.items() for x in pair])
    shown = F.when(ending == "(no extension)", "").otherwise(ending)
    return (
        files.where(~F.contains(relative, F.lit("/")))
        .select(
            relative.alias("filename"),
            "size",
            F.coalesce(known[shown], F.concat(F.lit("Unknown format ("), shown, F.lit(")"))).alias(
                "type"
            ),
        )
    )


def documentation_files(files: DataFrame) -> DataFrame:
    name = F.lower(F.element_at(F.split("path", "/"), -1))
    return files.where(name.rlike("|".join(DOC_KEYWORDS)))


def sample_files(
    images: DataFrame, order: Sequence[str], year: str = "year", years: int = 3
) -> DataFrame:
    """The first file of each of the first ``years`` years that have any."""
    firsts = images.groupBy(year).agg(F.min(F.struct(*order)).alias("_first"))
    # One row per year is left: the top-k below is over years.
    return firsts.orderBy(year).limit(years).select(year, "_first.*")


# --- bands --------------------------------------------------------------------------------------


def band_profile(
    pixels: DataFrame, bands: dict[str, Column], image: Sequence[str] = ()
) -> DataFrame:
    """Minimum, maximum, mean, population std and non-missing count per band, and its kind.

    Kinds: binary or normalised within [-0.1, 1.1], continuous below 1000, raw from 1000 on.
    """
    values = F.array(*[null_if_nan(v.cast("double")) for v in bands.values()])
    x = F.col("x")
    stats = (
        pixels.select(*image, F.posexplode(values).alias("band_at", "x"))
        .groupBy(*image, "band_at")
        .agg(
            F.min(x).alias("minimum"),
            F.max(x).alias("maximum"),
            F.avg(x).alias("mean"),
            F.stddev_pop(x).alias("std"),
            F.count(x).alias("non_missing"),
            F.coalesce(F.bool_and(x.isin(0.0, 1.0)), F.lit(True)).alias("_binary"),
        )
    )
    names = F.array(*[F.lit(n) for n in bands])
    long = stats.withColumn("band", F.get(names, "band_at")).drop("band_at")
    low, high = F.col("minimum"), F.col("maximum")
    kind = (
        F.when((high <= 1.1) & (low >= -0.1) & F.col("_binary"), "binary")
        .when((high <= 1.1) & (low >= -0.1), "normalized")
        .when((high > 1) & (high < 1000), "continuous")
        .when(high >= 1000, "raw")
        .otherwise("unknown")
    )
    return long.withColumn("kind", kind).drop("_binary")


def band_count_summary(per_file: DataFrame, count: str = "bands") -> DataFrame:
    return per_file.agg(
        F.count(F.lit(1)).alias("files"),
        F.avg(count).alias("mean_bands"),
        F.min(count).alias("min_bands"),
        F.max(count).alias("max_bands"),
    )


# --- embeddings ---------------------------------------------------------------------------------


def embedding_summary(df: DataFrame, column: str = "embedding") -> DataFrame:
    """Shape and minimum, maximum, mean and population std over the whole matrix."""
    rows = df.where(F.col(column).isNotNull())
    values = rows.select(F.explode(column).alias("v"))
    v = null_if_nan(F.col("v").cast("double"))
    shape = rows.agg(F.struct(F.count(F.lit(1)).alias("rows"), F.max(F.size(column)).alias("width"))).scalar()
    stats = values.agg(
        F.min(v).alias("minimum"),
        F.max(v).alias("maximum"),
        F.avg(v).alias("mean"),
        F.stddev_pop(v).alias("std"),
    )
    return stats.withColumn("_s", shape).select("_s.*", "minimum", "maximum", "mean", "std")


def dimension_stats(df: DataFrame, column: str = "embedding") -> DataFrame:
    """Mean and sample std of each array position."""
    long = df.select(F.posexplode(column).alias("position", "v"))
    v = null_if_nan(F.col("v").cast("double"))
    return long.groupBy("position").agg(F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"))


def add_norm(df: DataFrame, column: str = "embedding", name: str = "norm") -> DataFrame:
    squared = F.aggregate(
        column, F.lit(0.0), lambda acc, v: acc + v.cast("double") * v.cast("double")
    )
    return df.withColumn(name, F.sqrt(squared))


def norm_summary(df: DataFrame, norm: str = "norm", by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(
        F.count(norm).alias("rows"),
        F.avg(norm).alias("mean"),
        F.stddev_pop(norm).alias("std"),
        F.min(norm).alias("minimum"),
        F.max(norm).alias("maximum"),
    )


# --- quality ------------------------------------------------------------------------------------


def _is_float(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType))


def missing_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing values per column: one pass, one row per column."""
    names = list(columns or df.columns)
    missing = [is_missing(n) if _is_float(df, n) else F.col(n).isNull() for n in names]
    return _per_column(df, names, [count_if(m) for m in missing], "missing")


def missing_totals(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    per_column = missing_counts(df, columns)
    return per_column.agg(
        count_if(F.col("missing") > 0).alias("columns_with_missing"),
        F.sum("missing").alias("missing_values"),
    )


def infinite_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Infinite values per column; arrays count all their elements."""
    counts = []
    for n in columns:
        if isinstance(df.schema[n].dataType, T.ArrayType):
            inf = F.size(F.filter(n, lambda v: F.abs(v) == float("inf")))
            counts.append(F.coalesce(F.sum(F.when(F.col(n).isNotNull(), inf)), F.lit(0)))
        else:
            counts.append(count_if(F.abs(F.col(n).cast("double")) == float("inf")))
    return _per_column(df, list(columns), counts, "infinite")


def _per_column(df: DataFrame, names: list[str], aggs: list[Column], name: str) -> DataFrame:
    wide = df.agg(*[a.cast("bigint").alias(f"a{i}") for i, a in enumerate(aggs)])
    rows = F.array(
        *[
            F.struct(F.lit(n).alias("column"), F.col(f"a{i}").alias(name))
            for i, n in enumerate(names)
        ]
    )
    return wide.select(F.explode(rows).alias("r")).select("r.*")


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows"))


def duplicate_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows beyond the first of each group of equal rows; copies collapse before the shuffle, and a
    row travels as its 128-bit digest."""
    groups = df.select(*digests(df, columns)).groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
    )


def matched_share(df: DataFrame, condition: Column) -> DataFrame:
    matched = count_if(condition)
    n = F.count(F.lit(1))
    return df.agg(
        matched.alias("matched"),
        (n - matched).alias("unmatched"),
        F.try_divide(matched * 100.0, n).alias("matched_percent"),
        F.try_divide((n - matched) * 100.0, n).alias("unmatched_percent"),
    )


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-missing values of each column."""
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    found = names.join(F.broadcast(distinct_values(df, columns)), "column", "left")
    return found.select("column", F.coalesce("distinct_values", F.lit(0)).alias("distinct_values"))


def coverage(df: DataFrame, date: str, year: str) -> DataFrame:
    """Date range, number of years and of dates. Reduced to one row per date first."""
    dates = df.groupBy(F.col(date).alias("d"), F.col(year).alias("y")).agg(F.count(F.lit(1)))
    return dates.agg(
        F.min("d").alias("first_date"),
        F.max("d").alias("last_date"),
        F.countDistinct("y").alias("years"),
        F.countDistinct("d").alias("dates"),
    )


def events_coverage(df: DataFrame, event: str) -> DataFrame:
    per_event = df.where(F.col(event).isNotNull()).groupBy(event).agg(F.count(F.lit(1)).alias("n"))
    return per_event.agg(F.count(F.lit(1)).alias("events"), F.avg("n").alias("mean_images"))


def first_per_class(
    df: DataFrame, label: str, order: Sequence[str], k: int = 5, classes: Sequence[int] = (0, 1)
) -> DataFrame:
    """The first ``k`` samples of each class by key: a bounded top-k per task for each class."""
    parts = [df.where(F.col(label) == c).orderBy(*order).limit(k) for c in classes]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return union


# --- distributions ------------------------------------------------------------------------------


def target_summary(
    df: DataFrame, ignition: str = "ignition", log_area: str = "log_burned_area",
    area: str = "burned_area",
) -> DataFrame:
    """One row: class rates, log area statistics with quartiles, area statistics."""
    q = quantile_list(df, log_area, [0.25, 0.5, 0.75])
    n = F.count(F.lit(1))
    burning = F.sum(F.col(ignition).cast("bigint"))
    zero = count_if(F.col(log_area) == 0)
    return df.agg(
        n.alias("samples"),
        burning.alias("ignitions"),
        (F.avg(F.col(ignition).cast("double")) * 100).alias("ignition_percent"),
        F.try_divide(count_if(F.col(ignition) == 0).cast("double"), burning).alias("imbalance"),
        F.avg(log_area).alias("log_mean"),
        F.stddev_samp(log_area).alias("log_std"),
        F.min(log_area).alias("log_min"),
        F.max(log_area).alias("log_max"),
        *[F.lit(v).alias(f"log_q{p}") for v, p in zip(q, (25, 50, 75))],
        zero.alias("log_zeros"),
        F.try_divide(zero * 100.0, n).alias("log_zero_percent"),
        F.avg(F.col(area).cast("double")).alias("area_mean"),
        F.stddev_samp(F.col(area).cast("double")).alias("area_std"),
        F.min(area).cast("double").alias("area_min"),
        F.max(area).cast("double").alias("area_max"),
        count_if(F.col(area) > 0).alias("area_nonzero"),
    )


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample std, minimum, exact quartiles and maximum of each column."""
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column"), null_if_nan(F.col(c).cast("double")).alias("v"))
            for c in columns
        ]
    )
    long = df.select(F.explode(pairs).alias("p")).select("p.*")
    stats = long.groupBy("column").agg(
        F.count("v").alias("count"),
        F.avg("v").alias("mean"),
        F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
    )
    quartiles = exact_quantiles(long, "v", [0.25, 0.5, 0.75], by=["column"]).select(
        "column",
        *[F.col("quantiles")[i].alias(n) for i, n in enumerate(("q25", "q50", "q75"))],
    )
    return stats.join(quartiles, "column", "left")


def histogram(
    df: DataFrame, value: str, bins: int = 50, by: str | None = None
) -> DataFrame:
    """Equal-width bins between minimum and maximum, the last bin closed, empty bins included.

    With ``by`` each class has its own range, as when every class is drawn on its own.
    """
    keys = [by] if by else []
    clean = df.select(*keys, null_if_nan(F.col(value).cast("double")).alias("v")).where(
        F.col("v").isNotNull()
    )
    ends = clean.groupBy(*keys).agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    # A constant column is given a range of one around its value.
    ends = ends.where(F.col("lo").isNotNull()).select(
        *keys,
        F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    width = (F.col("hi") - F.col("lo")) / bins
    if by:
        # Classes are few and may be large: rows of one class are spread over tasks.
        ranged = lookup_join(clean, ends, keys, ["v"])
    else:
        pair = ends.select(F.struct("lo", "hi")).scalar()
        ranged = clean.withColumn("_e", pair).select("v", "_e.*")
    place = F.least(F.floor((F.col("v") - F.col("lo")) / width), F.lit(bins - 1)).cast("int")
    counted = ranged.groupBy(*keys, place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = ends.select(*keys, "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return grid.join(counted, [*keys, "bin"], "left").select(
        *keys,
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("left"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("right"),
        F.coalesce("n", F.lit(0)).alias("rows"),
    )


def rates_by_period(df: DataFrame, period: str, flag: Column, log_area: Column) -> DataFrame:
    """Ignition rate in percent, count and mean log area per year or month."""
    return df.groupBy(period).agg(
        (F.avg(flag.cast("double")) * 100).alias("ignition_percent"),
        F.count(F.lit(1)).alias("samples"),
        F.avg(log_area).alias("mean_log_area"),
    )


def box_stats(df: DataFrame, value: str) -> DataFrame:
    """Quartiles, whiskers (the furthest values within 1.5 IQR) and the number of outliers."""
    q1, q2, q3 = quantile_list(df, value, [0.25, 0.5, 0.75])
    if q1 is None:
        q1 = q2 = q3 = float("nan")
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    v = null_if_nan(F.col(value).cast("double"))
    inside = F.when((v >= low) & (v <= high), v)
    return df.agg(
        F.lit(q1).alias("q1"),
        F.lit(q2).alias("median"),
        F.lit(q3).alias("q3"),
        F.min(inside).alias("whisker_low"),
        F.max(inside).alias("whisker_high"),
        count_if((v < low) | (v > high)).alias("outliers"),
    )
