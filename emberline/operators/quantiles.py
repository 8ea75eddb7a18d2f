"""Exact quantiles with linear interpolation, without gathering a group in one task.

A first pass brackets each wanted rank with a bounded sketch; a second pass counts the values
inside the bracket exactly and everything below it as one number. Only the bracket's values are
shuffled and ordered, in the cells the sketch already gave. Brackets are a stored table with a row
per group, so there may be any number of groups; nothing is listed on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import null_if_nan
from ..session import stage
from .joins import lookup_join
from .ordering import prefix_sums

ACCURACY = 5000
_STEPS = (-4, -2, -1, 0, 1, 2, 4)


def exact_quantiles(
    df: DataFrame, value: Column | str, probs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """One row per group with ``n`` and ``quantiles`` (array aligned with ``probs``).

    Missing values are skipped; a group without values gives no row. The input is read twice:
    pass a stored table, or one that is cheap to compute.
    """
    by, probs = list(by), [float(p) for p in probs]
    value = F.col(value) if isinstance(value, str) else value
    values = df.select(*by, null_if_nan(value.cast("double")).alias("_v")).where(
        F.col("_v").isNotNull()
    )

    wanted = [min(1.0, max(0.0, p + s / ACCURACY)) for p in probs for s in _STEPS]
    sketch = values.groupBy(*by).agg(
        F.count("_v").alias("_n"),
        F.min("_v").alias("_lo"),
        F.max("_v").alias("_hi"),
        F.percentile_approx("_v", wanted, ACCURACY).alias("_cuts"),
    )
    targets = F.array(*[_target(j, p) for j, p in enumerate(probs)])
    # Stored, so that both readers below see the same brackets, whatever executors are lost.
    lists = stage(sketch.where("_n > 0").select(*by, targets.alias("_targets")))
    if by:
        matched = lookup_join(values, lists, by, ["_v"], stored=True)
    else:
        matched = values.withColumn("_targets", lists.select("_targets").scalar())
    spread = matched.select(*by, "_v", F.explode("_targets").alias("_t")).where(
        F.col("_v") <= F.element_at("_t._cuts", -1)
    )
    below = F.col("_v") < F.element_at("_t._cuts", 1)
    keyed = spread.select(
        *by,
        F.col("_t._j").alias("_j"),
        F.when(below, F.lit(float("-inf"))).otherwise(F.col("_v")).alias("_key"),
        F.when(below, F.lit(0))
        .otherwise(F.size(F.filter("_t._cuts", lambda c: c <= F.col("_v"))))
        .alias("_at"),
    )
    # Everything below the bracket collapses to one counted row per task before the shuffle.
    # What is left is a thin slice of the distinct values, stored as it is read twice below.
    counted = stage(keyed.groupBy(*by, "_j", "_key", "_at").agg(F.count(F.lit(1)).alias("_c")))
    ranked = prefix_sums(counted, ["_key"], ["_c"], by=[*by, "_j"], cell=F.col("_at"))
    wanted_ranks = lists.select(*by, F.explode("_targets").alias("_t")).select(
        *by, *[F.col(f"_t.{c}").alias(c) for c in ("_j", "_n", "_k0", "_k1", "_frac")]
    )
    placed = lookup_join(ranked, wanted_ranks, [*by, "_j"], ["_key"], stored=True)
    return _pick(placed, by, len(probs))


def _target(j: int, prob: float) -> Column:
    """The wanted ranks of one probability and the ascending cuts around them."""
    n = F.col("_n")
    place = F.lit(prob) * (n - 1)
    own = F.slice("_cuts", j * len(_STEPS) + 1, len(_STEPS))
    # The sketch is off by n/ACCURACY ranks at most; close to an end, or for few values, the end
    # itself is the safe bracket.
    slack = 4 / ACCURACY
    few = n <= 8 * ACCURACY
    none = F.array().cast("array<double>")
    low = F.when(few | F.lit(prob <= slack), F.array("_lo")).otherwise(none)
    high = F.when(few | F.lit(prob >= 1 - slack), F.array("_hi")).otherwise(none)
    return F.struct(
        F.lit(j).alias("_j"),
        n.alias("_n"),
        F.array_sort(F.array_distinct(F.concat(own, low, high))).alias("_cuts"),
        F.floor(place).cast("bigint").alias("_k0"),
        F.ceil(place).cast("bigint").alias("_k1"),
        (place - F.floor(place)).alias("_frac"),
    )


def _pick(placed: DataFrame, by: list[str], n_probs: int) -> DataFrame:
    before, upto = F.col("upto__c") - F.col("_c"), F.col("upto__c")

    def at(rank: str) -> Column:
        inside = (before <= F.col(rank)) & (F.col(rank) < upto)
        return F.max(F.when(inside, F.col("_key")))

    per_target = placed.groupBy(*by, "_j").agg(
        F.first("_n").alias("_n"),
        F.first("_frac").alias("_frac"),
        at("_k0").alias("_a"),
        at("_k1").alias("_b"),
    )
    missed = F.col("_a").isNull() | F.col("_b").isNull()
    per_target = per_target.withColumn(
        "_q",
        F.when(missed, F.raise_error(F.lit("a quantile fell outside its bracket")).cast("double"))
        .when(F.col("_a") == F.col("_b"), F.col("_a"))
        .otherwise(F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_frac")),
    )
    return per_target.groupBy(*by).agg(
        F.max("_n").alias("n"),
        *_aligned(n_probs),
    )


def _aligned(n_probs: int) -> list[Column]:
    return [
        F.array(*[F.max(F.when(F.col("_j") == j, F.col("_q"))) for j in range(n_probs)]).alias(
            "quantiles"
        )
    ]


def quantile_list(df: DataFrame, value: Column | str, probs: Sequence[float]) -> list[float | None]:
    """The quantiles of one column as plain numbers."""
    row = exact_quantiles(df, value, probs).first()
    return list(row["quantiles"]) if row else [None] * len(probs)
