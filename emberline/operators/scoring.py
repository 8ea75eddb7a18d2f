"""From head outputs to hazard scores, tiers and comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import seeded_md5
from .quantiles import quantile_list

CAP_QUANTILE = 0.999


def log_area_cap(
    train: DataFrame | None, log_area: str = "log_burned_area", area: str = "burned_area"
) -> float | None:
    """The 0.999 quantile of log area over training rows with area; NULL without any."""
    if train is None:
        return None
    return quantile_list(train.where(F.col(area) > 0), log_area, [CAP_QUANTILE])[0]


def clip_log_area(value: Column | str, cap: float | None) -> Column:
    """Clip to [0, cap]; without a cap only negative values are raised to 0. Missing stays missing."""
    v = F.col(value) if isinstance(value, str) else value
    clipped = F.greatest(v, F.lit(0.0))
    if cap is not None:
        clipped = F.least(clipped, F.lit(cap))
    return F.when(v.isNotNull(), clipped)


def area_from_log(value: Column | str) -> Column:
    area = F.expm1(value)
    return F.when(area.isNotNull(), F.greatest(area, F.lit(0.0)))


def hazard(p: Column | str, log_area: Column | str) -> Column:
    """Probability of ignition times the area expected from it."""
    p = F.col(p) if isinstance(p, str) else p
    return p * area_from_log(log_area)


def actual_hazard(ignition: Column | str, area: Column | str) -> Column:
    a = F.col(ignition) if isinstance(ignition, str) else ignition
    b = F.col(area) if isinstance(area, str) else area
    return a.cast("double") * b.cast("double")


def prediction_table(
    df: DataFrame,
    keys: list[str],
    p: str,
    log_pred: str,
    cap: float | None,
    actuals: dict[str, str] | None = None,
) -> DataFrame:
    """Predictions with the key kept, and the actual values where the table has them."""
    actuals = actuals or {
        "actual_ignition": "ignition",
        "actual_burned_area": "burned_area",
        "actual_log_burned_area": "log_burned_area",
    }
    clipped = clip_log_area(F.col(log_pred).cast("double"), cap)
    return df.select(
        *keys,
        F.col(p).cast("double").alias("p_ignition"),
        clipped.alias("log_burned_area"),
        area_from_log(clipped).alias("burned_area"),
        hazard(F.col(p).cast("double"), clipped).alias("hazard_score"),
        *[
            F.col(source).cast("double").alias(name)
            for name, source in actuals.items()
            if source in df.columns
        ],
    )


def add_tiers(df: DataFrame) -> DataFrame:
    p, h = F.col("p_ignition"), F.col("hazard_score")
    return df.withColumns(
        {
            "risk": F.when(p > 0.7, "HIGH").when(p > 0.3, "MODERATE").otherwise("LOW"),
            "impact": F.when(h > 1000, "MAJOR").when(h > 100, "SIGNIFICANT").otherwise("MODERATE"),
        }
    )


def compare_rows(df: DataFrame) -> DataFrame:
    """Predicted and actual yes/no, whether they agree, and the area error where there was area."""
    said = F.when(F.col("p_ignition") > 0.5, "YES").otherwise("NO")
    was = F.when(F.col("actual_ignition") == 1, "YES").otherwise("NO")
    burnt = F.col("actual_burned_area") > 0
    error = F.abs(F.col("burned_area") - F.col("actual_burned_area"))
    return df.withColumns(
        {
            "predicted": said,
            "actual": was,
            "correct": said == was,
            "area_error": F.when(burnt, error),
            "area_error_percent": F.when(burnt, error / F.col("actual_burned_area") * 100),
        }
    )


def random_sample(df: DataFrame, keys: list[str], seed: int) -> DataFrame:
    """One seeded random row: the smallest digest, kept as a top-1 per task."""
    return df.orderBy(seeded_md5(seed, *keys)).limit(1)
