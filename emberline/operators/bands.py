"""Pixel preprocessing: projections over band columns, and the statistics they need."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    detection_hour,
    finite_or,
    fire_label,
    is_missing,
    land_cover_one_hot,
    null_if_nan,
    sin_degrees,
    zero_if_missing,
)
from ..schema import (
    BASE_BANDS,
    DEGREE_BANDS,
    DYNAMIC_CHANNELS,
    FIRE_BAND,
    LAND_COVER_BAND,
    N_BASE,
    STATIC_CHANNELS,
    channel_names,
)

Stats = dict[str, tuple[float, float]]


# --- single steps on named band columns --------------------------------------------------------


def clean_fire_band(df: DataFrame, fire: str) -> DataFrame:
    """No detection is a value of 0, not a missing measurement."""
    return df.withColumn(fire, zero_if_missing(fire))


def fire_to_hours(df: DataFrame, fire: str, name: str) -> DataFrame:
    return df.withColumn(name, detection_hour(fire))


def add_label_mask(df: DataFrame, fire: str, name: str = "label") -> DataFrame:
    return df.withColumn(name, fire_label(fire))


def add_input_mask(df: DataFrame, hour: str, name: str = "fire_mask") -> DataFrame:
    """Binary mask of the input day, taken from full hours (a detection in hour 0 is not seen)."""
    return df.withColumn(name, (F.col(hour) > 0).cast("double"))


def degrees_to_sine(df: DataFrame, bands: Sequence[str]) -> DataFrame:
    return df.withColumns({b: sin_degrees(b) for b in bands})


def standardize(df: DataFrame, stats: Stats) -> DataFrame:
    """``(x - mean) / std`` for the bands in ``stats``; degree and class bands are left out of it."""
    return df.withColumns(
        {b: (F.col(b) - F.lit(mean)) / F.lit(std) for b, (mean, std) in stats.items()}
    )


def destandardize(df: DataFrame, stats: Stats) -> DataFrame:
    return df.withColumns(
        {b: F.col(b) * F.lit(std) + F.lit(mean) for b, (mean, std) in stats.items()}
    )


def fill_missing(df: DataFrame, bands: Sequence[str]) -> DataFrame:
    """Missing after standardisation becomes 0, the band mean; infinities become finite."""
    return df.withColumns({b: finite_or(b) for b in bands})


def one_hot_land_cover(df: DataFrame, code: str, prefix: str = "lc_") -> DataFrame:
    columns = {f"{prefix}{k + 1}": c for k, c in enumerate(land_cover_one_hot(code))}
    return df.withColumns(columns).drop(code)


# --- statistics --------------------------------------------------------------------------------


def band_stats(
    pixels: DataFrame,
    bands: dict[str, Column],
    year_groups: Sequence[Sequence[int]],
    year: str = "year",
) -> DataFrame:
    """Mean, sample std and missing share of each band for each group of training years.

    ``bands`` maps a name to the prepared value (fire in hours, degrees after sine). Pixels are
    read once and reduced to one row per year on the map side; a fold is then put together from
    its years' rows, so a pixel is never repeated per fold.
    """
    wanted = sorted({y for group in year_groups for y in group})
    values = F.array(*[null_if_nan(value.cast("double")) for value in bands.values()])
    # One row per pixel and band with a handful of buffers stays in generated code, which an
    # aggregate over all bands side by side is too wide for.
    narrow = pixels.where(F.col(year).isin(wanted)).select(
        F.col(year).alias("year"), F.posexplode(values).alias("band_at", "x")
    )
    per_year = narrow.groupBy("year", "band_at").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("x").alias("n"),
        F.avg("x").alias("m"),
        (F.var_pop("x") * F.count("x")).alias("ss"),
    )
    names = F.array(*[F.lit(n) for n in bands])
    long = per_year.select("year", "rows", F.get(names, "band_at").alias("band"), "n", "m", "ss")
    groups = pixels.sparkSession.createDataFrame(
        [([int(y) for y in g], int(y)) for g in map(list, dict.fromkeys(map(tuple, year_groups))) for y in g],
        "train_years array<int>, year int",
    )
    # A group has a handful of years, so its list of moments is a handful of entries.
    grouped = (
        long.join(F.broadcast(groups), "year")
        .groupBy("train_years", "band")
        .agg(
            F.sum("rows").alias("rows"),
            F.sum("n").alias("n"),
            (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("mean"),
            F.collect_list(F.struct("n", "m", "ss")).alias("parts"),
        )
    )
    spread = F.aggregate(
        "parts",
        F.lit(0.0),
        lambda acc, p: acc
        + F.when(p["n"] > 0, p["ss"] + p["n"] * F.pow(p["m"] - F.col("mean"), 2)).otherwise(0.0),
    )
    return grouped.select(
        "train_years",
        "band",
        "mean",
        F.sqrt(spread / F.nullif(F.col("n") - 1, F.lit(0))).alias("std"),
        (1 - F.col("n") / F.col("rows")).alias("missing"),
    )


def fire_hour_of(fire: Column, in_hours: bool = False) -> Column:
    """Hour of detection, 0 for none, from hhmm or from a stored stack's hours."""
    return zero_if_missing(fire) if in_hours else detection_hour(fire)


def prepared_bands(bands: Column, fire_in_hours: bool = False) -> dict[str, Column]:
    """The 23 source bands as ``band_stats`` wants them: hours where detected, sine of degrees.

    Stored stacks have 0 for no detection, so there 0 is what counts as missing.
    """
    out = {}
    for i, name in enumerate(BASE_BANDS):
        value = null_if_nan(bands[i].cast("double"))
        if i == FIRE_BAND:
            hours = F.nullif(value, F.lit(0.0)) if fire_in_hours else F.floor(value / 100)
            value = hours.cast("double")
        elif i in DEGREE_BANDS:
            value = sin_degrees(value)
        out[name] = value
    return out


def fit_scaler(stats: DataFrame, train_years: Sequence[int], untouched: Sequence[str] = ()) -> Stats:
    """The statistics of one fold as numbers: one row per band.

    A constant band is only moved to 0 (its scale stays 1); a band without values has no entry.
    """
    rows = (
        stats.where(F.col("train_years") == F.array(*[F.lit(int(y)) for y in train_years]))
        .where(~F.col("band").isin(list(untouched)) if untouched else F.lit(True))
        .collect()
    )
    return {r["band"]: (r["mean"], r["std"] or 1.0) for r in rows if r["mean"] is not None}


UNSCALED = [BASE_BANDS[i] for i in (*DEGREE_BANDS, LAND_COVER_BAND)]


# --- the whole chain on 23-band arrays ----------------------------------------------------------


def expand_channels(bands: Column, scaler: Stats, fire_in_hours: bool = False) -> list[Column]:
    """The 40 channel expressions of one pixel, every one inside generated code.

    Order: fire hour, sine of degrees, mask from the unscaled hour, standardise, missing to 0,
    land cover to 17 indicators.
    """
    hour = fire_hour_of(bands[FIRE_BAND], fire_in_hours)

    def scaled(i: int, value: Column) -> Column:
        mean, std = scaler.get(BASE_BANDS[i], (0.0, 1.0))
        return finite_or((value - F.lit(mean)) / F.lit(std))

    channels: list[Column] = []
    for i in range(N_BASE):
        if i == LAND_COVER_BAND:
            channels += land_cover_one_hot(bands[i])
        elif i == FIRE_BAND:
            channels += [scaled(i, hour)]
        elif i in DEGREE_BANDS:
            channels += [finite_or(sin_degrees(bands[i]))]
        else:
            channels += [scaled(i, bands[i].cast("double"))]
    return [*channels, (hour > 0).cast("double")]


# --- channel selection --------------------------------------------------------------------------


def channel_table(spark, only_base: bool = False) -> DataFrame:
    """Channel dimension: position, name, kind and whether it is constant over a fire."""
    rows = []
    for i, name in enumerate(channel_names(only_base)):
        if name.startswith("Land"):
            kind = "land cover"
        elif name.startswith("Active fire"):
            kind = "fire"
        elif name.startswith("Forecast"):
            kind = "forecast"
        else:
            kind = "observed"
        static = name in ("Slope", "Aspect", "Elevation") or kind == "land cover"
        rows.append((i, name, kind, static))
    return spark.createDataFrame(rows, "channel int, name string, kind string, static boolean")


def name_channels(long: DataFrame, channel: str = "channel", only_base: bool = False) -> DataFrame:
    """Attach name and kind to one-row-per-channel data (a 23- or 40-row dimension)."""
    names = channel_table(long.sparkSession, only_base).withColumnRenamed("channel", channel)
    return long.join(F.broadcast(names), channel, "left")


def keep_features(features: Column | str, ids: Sequence[int]) -> Column:
    """The chosen channels, in the order given."""
    source = F.col(features) if isinstance(features, str) else features
    return F.array(*[F.get(source, i) for i in ids])


def kept_channels(
    keep: Sequence[int] | None,
    static: Sequence[int] = STATIC_CHANNELS,
    dynamic: Sequence[int] = DYNAMIC_CHANNELS,
) -> tuple[list[int], list[int]]:
    """Static and dynamic channels that remain under a keep-list, ascending."""
    if keep is None:
        return list(static), list(dynamic)
    wanted = set(keep)
    return sorted(wanted & set(static)), sorted(wanted & set(dynamic))


def dedupe_static(
    days: Column | str,
    n: int,
    keep: Sequence[int] | None = None,
    static: Sequence[int] = STATIC_CHANNELS,
    dynamic: Sequence[int] = DYNAMIC_CHANNELS,
) -> Column:
    """One flat array: dynamic channels of the earlier days, then every kept channel of the last.

    With a single day there is nothing to repeat, so only the keep-list applies.
    """
    source = F.col(days) if isinstance(days, str) else days
    _, dyn = kept_channels(keep, static, dynamic)
    full = list(keep) if keep is not None else sorted([*static, *dynamic])
    last = keep_features(F.element_at(source, -1), full)
    if n < 2:
        return last
    earlier = F.transform(F.slice(source, 1, n - 1), lambda day: keep_features(day, dyn))
    return F.concat(F.flatten(earlier), last)


def expected_width(
    n: int,
    keep: Sequence[int] | None,
    dedupe: bool,
    static: Sequence[int] = STATIC_CHANNELS,
    dynamic: Sequence[int] = DYNAMIC_CHANNELS,
) -> int:
    s, d = kept_channels(keep, static, dynamic)
    return int(dedupe) * len(d) * (n - 1) + len(s) + len(d)


def width_audit(df: DataFrame, features: str, expected: int) -> DataFrame:
    """How many samples have which feature-array width, and whether it is the expected one."""
    return (
        df.groupBy(F.size(features).alias("width"))
        .agg(F.count(F.lit(1)).alias("samples"))
        .withColumn("as_expected", F.col("width") == expected)
    )


def missing_share(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.avg(is_missing(c).cast("double")).alias(c) for c in columns])


