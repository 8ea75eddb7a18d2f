"""Train both heads, boosted and linear, on one prepared feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..models.heads import (
    Boosting,
    Head,
    boosted_classifier,
    boosted_regressor,
    linear_baseline,
    logistic_baseline,
    validation_metrics,
)
from ..operators.prepare import feature_medians, name_features, order_features
from ..session import stage

COLUMNS = ["split", "ignition", "burned_area", "log_burned_area", "features"]


def pack_features(df: DataFrame, arrays: dict[str, Sequence[str]], scalars: Sequence[str] = ()) -> DataFrame:
    """All scalar features and feature arrays as one array ``features`` that carries its names.

    ``arrays`` has the names of each array's entries; an array of another length fails the job.
    """
    parts = [F.array(*[F.col(s).cast("double") for s in scalars])] if scalars else []
    for a, own in arrays.items():
        width = F.size(a) != len(own)
        told = F.concat(F.lit(f"array {a} should have {len(own)} entries, it has "), F.size(a))
        parts.append(F.when(width, F.raise_error(told)).otherwise(F.col(a).cast("array<double>")))
    packed = df.withColumn("features", parts[0] if len(parts) == 1 else F.concat(*parts))
    return name_features(packed, [*scalars, *[n for own in arrays.values() for n in own]])


def train_heads(
    table: DataFrame,
    names: Sequence[str],
    boosting: Boosting | None = None,
    families: Sequence[str] = ("boosted", "linear"),
) -> dict[str, dict[str, Head | None]]:
    """``{family: {"p": head, "a": head}}`` from a table with ``split`` and ``features``.

    The table is staged once: every tree level and solver step reads it again. Its features must
    carry their names and are put into the order of ``names``. Medians come from the training rows
    and travel with the heads.
    """
    ready = stage(order_features(table.select(*COLUMNS), "features", names))
    train, val = (ready.where(F.col("split") == s).drop("split") for s in ("train", "val"))
    medians = feature_medians(train)
    medians += [None] * (len(names) - len(medians))
    heads: dict[str, dict[str, Head | None]] = {}
    if "boosted" in families:
        heads["boosted"] = {
            "p": boosted_classifier(train, val, names, medians, boosting),
            "a": boosted_regressor(train, val, names, medians, boosting),
        }
    if "linear" in families:
        heads["linear"] = {
            "p": logistic_baseline(train, names, medians),
            "a": linear_baseline(train, names, medians),
        }
    return heads


def validation_report(heads: dict[str, dict[str, Head | None]], val: DataFrame) -> DataFrame:
    """Long ``(model, head, metric, value)`` rows on validation data."""
    parts = []
    for family, pair in heads.items():
        for name, head in pair.items():
            if head is None:
                continue
            rows = val if family == "boosted" or name == "p" else val.where("burned_area > 0")
            parts.append(
                validation_metrics(head, rows).select(
                    F.lit(family).alias("model"), F.lit(name).alias("head"), "metric", "value"
                )
            )
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report
