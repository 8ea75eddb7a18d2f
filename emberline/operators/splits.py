"""Random train/validation/test splits by seeded hash, and the checks on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import hash_unit, seeded_md5

_DIGITS = 3  # 4,096 prefixes: the size of the count table the driver sees


def _check_ratios(train: float, val: float, test: float) -> None:
    if abs(train + val + test - 1.0) > 1e-6:
        raise ValueError(f"ratios must sum to 1, got {train + val + test}")


def prefix_counts(df: DataFrame, digest: Column) -> list[tuple[str, int]]:
    """Rows per digest prefix in order: at most 4,096 entries, whatever the table."""
    prefix = F.substring(digest, 1, _DIGITS)
    counted = df.groupBy(prefix.alias("p")).agg(F.count(F.lit(1)).alias("n"))
    return sorted((r["p"], r["n"]) for r in counted.collect())


def rank_thresholds(
    df: DataFrame, digest: Column, counts: Sequence[tuple[str, int]], ranks: Sequence[int]
) -> list[str | None]:
    """The digests at the given zero-based ranks, found without sorting the table.

    The prefix counts say in which of the even cells a rank lies; only those cells' digests are
    then ordered. A rank at or past the end has no threshold.
    """
    places: dict[int, tuple[str, int]] = {}
    before = 0
    for p, n in counts:
        for rank in ranks:
            if before <= rank < before + n:
                places[rank] = (p, rank - before)
        before += n
    if not places:
        return [None] * len(ranks)
    wanted = sorted(set(places.values()))
    keyed = df.select(digest.alias("h")).withColumn("p", F.substring("h", 1, _DIGITS))
    within = keyed.where(F.col("p").isin([p for p, _ in wanted]))
    place = F.row_number().over(Window.partitionBy("p").orderBy("h")) - 1
    hit = F.lit(False)
    for p, k in wanted:
        hit = hit | ((F.col("p") == p) & (F.col("k") == k))
    found = {
        (r["p"], r["k"]): r["h"] for r in within.withColumn("k", place).where(hit).collect()
    }
    return [found[places[r]] if r in places else None for r in ranks]


def random_split_exact(
    df: DataFrame,
    key: Sequence[str],
    train: float = 0.7,
    val: float = 0.15,
    test: float = 0.15,
    seed: int = 42,
) -> DataFrame:
    """Seeded shuffle cut at ``int(n * ratio)``: exact sizes, the rest going to test.

    ``key`` identifies a row. Each row is compared with two threshold digests, so the table itself
    is neither sorted nor shuffled.
    """
    _check_ratios(train, val, test)
    digest = seeded_md5(seed, *key)
    counts = prefix_counts(df, digest)
    n = sum(size for _, size in counts)
    n_train, n_val = int(n * train), int(n * val)
    cut_val, cut_test = rank_thresholds(df, digest, counts, [n_train, n_train + n_val])
    split = F.lit("train") if cut_val is None else F.when(digest < cut_val, "train")
    if cut_val is not None:
        split = split.otherwise("val") if cut_test is None else split.when(
            digest < cut_test, "val"
        ).otherwise("test")
    return df.withColumn("split", split)


def random_split_hash(
    df: DataFrame,
    key: Sequence[str],
    train: float = 0.7,
    val: float = 0.15,
    test: float = 0.15,
    seed: int = 42,
) -> DataFrame:
    """Split by hash threshold: sizes are approximate, but a row never changes sides when rows
    are appended, and one projection is all it takes."""
    _check_ratios(train, val, test)
    u = hash_unit(seeded_md5(seed, *key))
    split = F.when(u < train, "train").when(u < F.lit(train + val), "val").otherwise("test")
    return df.withColumn("split", split)


def split_report(df: DataFrame, year: str = "year") -> DataFrame:
    """Rows, percent and the years of each split."""
    # Reduced to (split, year) first: the collected years are distinct by then.
    by_year = df.groupBy("split", year).agg(F.count(F.lit(1)).alias("n"))
    total = by_year.agg(F.sum("n")).scalar()
    return by_year.groupBy("split").agg(
        F.sum("n").alias("samples"),
        (F.lit(100.0) * F.sum("n") / total).alias("percent"),
        F.sort_array(F.collect_list(year)).alias("years"),
        F.count(F.lit(1)).alias("n_years"),
    )


def split_checks(
    df: DataFrame, key: Sequence[str], fire: Sequence[str], expected_rows: int | Column
) -> DataFrame:
    """One row: rows, empty splits, keys and fires found in more than one split, completeness."""

    def shared(columns: Sequence[str]) -> Column:
        pairs = df.groupBy(*columns, "split").agg(F.count(F.lit(1)).alias("n"))
        per_key = pairs.groupBy(*columns).agg(F.count(F.lit(1)).alias("splits"))
        return per_key.agg(F.count(F.when(F.col("splits") > 1, 1))).scalar()

    expected = F.lit(expected_rows) if isinstance(expected_rows, int) else expected_rows
    sizes = df.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
    seen = [F.max(F.when(F.col("split") == s, 1)) for s in ("train", "val", "test")]
    empty = sum((F.coalesce(1 - s, F.lit(1)) for s in seen[1:]), F.coalesce(1 - seen[0], F.lit(1)))
    return sizes.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("samples"), empty.cast("bigint").alias("empty_splits")
    ).select(
        "samples",
        "empty_splits",
        shared(key).alias("shared_keys"),
        shared(fire).alias("shared_fires"),
        (F.col("samples") == expected).alias("complete"),
    )
