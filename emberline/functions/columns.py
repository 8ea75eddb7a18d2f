"""Scalar expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import N_CLASSES

FLOAT32_MAX = 3.4028234663852886e38


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def null_if_nan(value: Column | str) -> Column:
    """NaN becomes NULL: Spark's avg, max and count skip only NULL."""
    return F.nanvl(_col(value), F.lit(None).cast("double"))


def is_missing(value: Column | str) -> Column:
    return _col(value).isNull() | F.coalesce(F.isnan(_col(value)), F.lit(False))


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def zero_if_missing(value: Column | str) -> Column:
    return F.coalesce(null_if_nan(_col(value).cast("double")), F.lit(0.0))


def finite_or(value: Column | str, missing: float = 0.0) -> Column:
    """Missing becomes ``missing`` and infinities become the largest float32 of their sign."""
    v = null_if_nan(_col(value).cast("double"))
    return (
        F.when(v == float("inf"), F.lit(FLOAT32_MAX))
        .when(v == float("-inf"), F.lit(-FLOAT32_MAX))
        .otherwise(F.coalesce(v, F.lit(float(missing))))
    )


def detection_hour(hhmm: Column | str) -> Column:
    """Detection time hhmm to full hours; no detection is hour 0."""
    return F.floor(zero_if_missing(hhmm) / 100).cast("double")


def fire_label(hhmm: Column | str) -> Column:
    """1 where the label day has a detection at any minute of the day, else 0."""
    return (zero_if_missing(hhmm) > 0).cast("int")


def sin_degrees(angle: Column | str) -> Column:
    return F.sin(F.radians(_col(angle)))


def cycle_degrees(angle: Column | str) -> Column:
    """Angle folded into [0, 360)."""
    return F.pmod(_col(angle), F.lit(360.0))


def land_cover_index(code: Column | str) -> Column:
    """Zero-based class position; a missing code wraps to the last class."""
    whole = F.coalesce(null_if_nan(_col(code).cast("double")), F.lit(0.0)).cast("int")
    return F.pmod(whole - 1, F.lit(N_CLASSES))


def land_cover_one_hot(code: Column | str) -> list[Column]:
    position = land_cover_index(code)
    return [(position == k).cast("double") for k in range(N_CLASSES)]


def image_date(path: Column | str) -> Column:
    """Acquisition date from the last path component: text before ``_`` without ``.tif``."""
    name = F.element_at(F.split(_col(path), "/"), -1)
    return F.to_date(F.replace(F.split_part(name, F.lit("_"), F.lit(1)), F.lit(".tif"), F.lit("")))


def day_of_year(date_text: Column | str) -> Column:
    """Day of the year of ``yyyy-MM-dd``, which older files give with a ``.tif`` ending."""
    return F.dayofyear(F.to_date(F.replace(_col(date_text), F.lit(".tif"), F.lit("")), "yyyy-MM-dd"))


def month_day(doy: Column | str) -> tuple[Column, Column]:
    """Month and day of month on the 30-day calendar, months clipped to 1..12."""
    zero_based = _col(doy) - 1
    month = F.greatest(F.lit(1), F.least(F.lit(12), F.floor(zero_based / 30).cast("int") + 1))
    return month, F.pmod(zero_based, F.lit(30)) + 1


def seeded_md5(seed: int, *keys: Column | str) -> Column:
    """Hex digest of ``seed|key|key...``: a reproducible, evenly spread shuffle key."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[_col(k).cast("string") for k in keys]))


def hash_unit(digest: Column) -> Column:
    """First 32 bits of a hex digest as a number in [0, 1)."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(2**32))
