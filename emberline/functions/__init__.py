"""Column functions: plain JVM expressions, no Python in the row path."""

from .columns import (  # noqa: F401
    count_if,
    cycle_degrees,
    day_of_year,
    detection_hour,
    finite_or,
    fire_label,
    hash_unit,
    image_date,
    is_missing,
    land_cover_index,
    land_cover_one_hot,
    month_day,
    null_if_nan,
    seeded_md5,
    sin_degrees,
    zero_if_missing,
)
