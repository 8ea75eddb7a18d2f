"""Equi-joins that stay even when one key holds a large share of the rows.

The smaller side is stored first. Its row count is then known from the file footers, so whether it
may be broadcast is decided on its real size, and it is not computed a second time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage, stored_bytes

DEFAULT_SALTS = 16
#: A key with this share of all rows is hot; there are at most 500 of them.
HOT_SHARE = 0.002
#: A stored table of at most so many rows and bytes on disk is fit to broadcast.
BROADCAST_ROWS, BROADCAST_BYTES = 400_000, 16 << 20


def _is_small(stored: DataFrame, rows: int) -> bool:
    return stored.count() <= rows and stored_bytes(stored) <= BROADCAST_BYTES


def unless_large(table: DataFrame) -> DataFrame:
    """A table read from files for an equi-join: past ``BROADCAST_ROWS`` rows it is kept from being broadcast.

    Spark plans with the bytes of the files, of which a few columns of many short rows have hardly any,
    while the driver has to hold the unpacked rows and their hash table.
    """
    return table if _is_small(table, BROADCAST_ROWS) else table.hint("merge")


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    spread: Sequence[Column | str],
    salts: int = DEFAULT_SALTS,
    how: str = "inner",
    broadcast_rows: int = BROADCAST_ROWS,
    *,
    stored: bool = False,
    weight: str | None = None,
) -> DataFrame:
    """Join many rows per key to few rows per key.

    A small table of at most ``broadcast_rows`` rows (and 16 MB) is broadcast and the big side stays
    where it is (``stored``: it reads a stored table and is not stored again). A larger one is
    shuffled. With ``weight``, a column of ``small`` that tells how many big rows (or a like measure)
    each of its keys has and is left out of the result, ``small`` has one row per key and is shuffled
    as it is: only hot keys are spread (see ``hot_split_join``). Without it the big side spreads each key over ``salts`` partitions by
    hashing ``spread`` (columns that vary within the key, so a retried task salts alike), and the
    small side is repeated per salt. The hint keeps Spark, which plans with the bytes of the files
    before they are unpacked and repeated, from broadcasting what was found too large for that.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"the big side must be kept: {how}")
    small = small if stored else stage(small)
    if _is_small(small, broadcast_rows):
        return big.join(F.broadcast(small if weight is None else small.drop(weight)), list(keys), how)
    if weight is not None:
        values = [c for c in small.columns if c not in (*keys, weight)]
        found = _split_join(big, small.withColumn("_found", F.lit(True)), list(keys), weight, [*values, "_found"], spread, HOT_SHARE)
        found = found.where("_found") if how == "inner" else found
        return found.select(*keys, *[c for c in big.columns if c not in keys], *values)
    salt = F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")
    left = big.withColumn("_salt", salt)
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right.hint("merge"), [*keys, "_salt"], how).drop("_salt")


def hot_split_join(
    rows: DataFrame,
    table: DataFrame,
    key: Sequence[str],
    weight: str,
    values: Sequence[str],
    spread: Sequence[Column | str],
    share: float = HOT_SHARE,
    broadcast_rows: int = BROADCAST_ROWS,
    *,
    stored: bool = False,
) -> DataFrame:
    """Look ``values`` up in ``table`` (one row per key, ``weight`` = its number of ``rows``; ``stored``:
    it reads a stored table and is not stored again).

    Beyond ``broadcast_rows``, keys with at least ``share`` of all rows are broadcast: there can be
    no more than ``1/share`` of them, whatever the size of the table. All other keys take the
    shuffle join, in which the rows already served are spread by hash instead of meeting on their
    hot key; the hint keeps Spark from broadcasting a table whose files are small.
    """
    key, values = list(key), list(values)
    table = table.select(*key, weight, *values)
    table = table if stored else stage(table)
    if _is_small(table, broadcast_rows):
        return rows.join(F.broadcast(table.drop(weight)), key, "left")
    return _split_join(rows, table, key, weight, values, spread, share)


def _split_join(
    rows: DataFrame, table: DataFrame, key: list[str], weight: str, values: list[str], spread: Sequence[Column | str], share: float
) -> DataFrame:
    """``hot_split_join`` with a stored table that is too large to broadcast."""
    total = table.agg(F.sum(weight)).scalar()
    is_hot = F.coalesce(F.col(weight) >= total * F.lit(share), F.lit(False))
    hot = table.where(is_hot).select(*key, *[F.col(v).alias(f"_hot_{v}") for v in values])
    hot = hot.withColumn("_is_hot", F.lit(True))
    cold = table.where(~is_hot).select(*key, *values).withColumn("_side", F.lit(0).cast("bigint"))
    first = rows.join(F.broadcast(hot), key, "left")
    side = F.when(F.col("_is_hot"), F.pmod(F.xxhash64(*spread), F.lit(1 << 20)) + 1).otherwise(
        F.lit(0).cast("bigint")
    )
    joined = first.withColumn("_side", side).join(cold.hint("merge"), [*key, "_side"], "left")
    return joined.select(
        *rows.columns, *[F.coalesce(F.col(f"_hot_{v}"), F.col(v)).alias(v) for v in values]
    )
