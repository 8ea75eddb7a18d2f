"""Samples from image rows: windows of leading days, next-day labels, numbering, folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import FOLD_YEARS
from .joins import lookup_join
from .ordering import group_ordinal, lead_by_ordinal, ordinal_chunks, prefix_sums

FIRE = ("year", "fire")
INDEX = "in_fire_index"


def check_days(n: int, adjust_to: int | None = None) -> int:
    """Number of initial samples to skip; refuses impossible settings."""
    if n < 1:
        raise ValueError("at least one day of observations is needed")
    if adjust_to is None:
        return 0
    if adjust_to < n:
        raise ValueError("the test adjustment cannot be below the number of leading days")
    return adjust_to - n


def index_images(
    images: DataFrame,
    order: Sequence[str] = ("obs_date",),
    day: Column | None = None,
    fire: Sequence[str] = FIRE,
) -> DataFrame:
    """Number the images of each fire from 0 in file order.

    The next image is the next file, which need not be the next calendar day. ``images`` is read
    twice, so store it when it is the result of reducing pixels.
    """
    cell = F.to_date(F.col(order[0])) if day is None else day
    return group_ordinal(images, fire, order, cell, INDEX)


def leading_windows(
    indexed: DataFrame,
    n: int,
    columns: Sequence[str],
    label: str,
    fire: Sequence[str] = FIRE,
    days: str = "days",
) -> DataFrame:
    """Sample i: the structs of images i..i+n-1 with the label of image i+n."""
    check_days(n)
    chunks, window = ordinal_chunks(indexed, fire, INDEX, n)
    ahead = window.rowsBetween(Window.currentRow, n - 1)
    # The list holds n entries, n being the fixed number of leading days.
    built = chunks.select(
        *fire,
        INDEX,
        "_lent",
        F.collect_list(F.struct(*columns)).over(ahead).alias(days),
        F.lead(label, n).over(window).alias("label"),
    )
    return built.where(~F.col("_lent") & F.col("label").isNotNull()).drop("_lent")


def next_label(
    indexed: DataFrame,
    n: int = 1,
    label: str = "n_fire",
    name: str = "burned_area",
    fire: Sequence[str] = FIRE,
    dates: str | None = None,
) -> DataFrame:
    """Label of each image: the burning pixels of the image ``n`` files later; last images drop.

    With ``dates``, ``gap_days`` tells how far ahead that file really is.
    """
    check_days(n)
    columns = {name: label}
    if dates:
        columns["_next_date"] = dates
    led = lead_by_ordinal(indexed, fire, INDEX, n, columns).where(F.col(name).isNotNull())
    if dates:
        led = led.withColumn("gap_days", F.date_diff("_next_date", dates)).drop("_next_date")
    return led


def datapoints_per_fire(
    images: DataFrame, n: int, adjust_to: int | None = None, fire: Sequence[str] = FIRE
) -> DataFrame:
    """Images and usable samples of each fire; fires with too few images are flagged."""
    skip = check_days(n, adjust_to)
    counted = images.groupBy(*fire).agg(F.count(F.lit(1)).alias("images"))
    points = F.greatest(F.col("images") - skip - n, F.lit(0)).cast("bigint")
    return counted.withColumn("datapoints", points).withColumn(
        "contributes", F.col("datapoints") > 0
    )


def skip_initial(samples: DataFrame, n: int, adjust_to: int | None) -> DataFrame:
    """Drop the first samples of each fire so that test sets agree across numbers of days.

    The remaining samples are re-indexed from 0.
    """
    skip = check_days(n, adjust_to)
    if skip == 0:
        return samples
    return samples.where(F.col(INDEX) >= skip).withColumn(INDEX, F.col(INDEX) - skip)


def number_samples(samples: DataFrame, fire: Sequence[str] = FIRE) -> DataFrame:
    """Dense ``sample_number`` over fires in order, and ``n_samples`` of the whole set.

    Running totals go over fires, not samples; the start of a fire is joined back spread, as one
    fire may hold a large share of the samples.
    """
    sizes = samples.groupBy(*fire).agg(F.count(F.lit(1)).alias("size"))
    starts = prefix_sums(sizes, fire, ["size"]).select(
        *fire, "size", (F.col("upto_size") - F.col("size")).alias("_start")
    )
    total = sizes.agg(F.sum("size")).scalar()
    return (
        lookup_join(samples, starts, fire, [INDEX], weight="size")
        .withColumn("sample_number", (F.col("_start") + F.col(INDEX)).cast("bigint"))
        .withColumn("n_samples", total)
        .drop("_start")
    )


def find_samples(numbered: DataFrame, *targets: int) -> DataFrame:
    """Samples by dataset index; negative indices count from the end, out of range fails."""
    total, number = F.col("n_samples"), F.col("sample_number")
    chosen, in_range = F.lit(False), F.lit(True)
    for t in targets:
        at = F.lit(t) if t >= 0 else total + F.lit(t)
        chosen = chosen | (number == at)
        in_range = in_range & (at >= 0) & (at < total)
    failed = F.raise_error(F.lit("sample index out of range")).cast("boolean")
    return numbered.where(F.when(in_range, chosen).otherwise(failed))


def fold_years(fold_id: int, folds: Sequence[tuple] = FOLD_YEARS) -> dict[str, list[int]]:
    years = folds[fold_id]
    return {"train": list(years[:2]), "val": [years[2]], "test": [years[3]]}


def fold_split(df: DataFrame, fold_id: int, folds: Sequence[tuple] = FOLD_YEARS) -> DataFrame:
    """``split`` from the year; years outside the fold drop. No join: the fold is four literals."""
    split = None
    for name, years in fold_years(fold_id, folds).items():
        test = F.col("year").isin(years)
        split = F.when(test, name) if split is None else split.when(test, name)
    kept = df.where(F.col("year").isin(list(folds[fold_id])))
    return kept.withColumn("split", split)


def all_folds(spark, folds: Sequence[tuple] = FOLD_YEARS) -> DataFrame:
    """The fold table: twelve folds of four years."""
    rows = [
        (i, y, name)
        for i in range(len(folds))
        for name, years in fold_years(i, folds).items()
        for y in years
    ]
    return spark.createDataFrame(rows, "fold_id int, year int, split string")


def tag_samples(
    samples: DataFrame,
    fold_id: int,
    n: int,
    adjust_to: int | None,
    folds: Sequence[tuple] = FOLD_YEARS,
) -> DataFrame:
    """Samples of one fold with the treatment of each split, in one pass.

    Train and validation are cropped and augmented; test is centre-cropped and skip-adjusted. All
    three name the training years, whose statistics standardise them.
    """
    skip = check_days(n, adjust_to)
    tagged = fold_split(samples, fold_id, folds)
    is_test = F.col("split") == "test"
    if skip:
        shifted = F.when(is_test, F.col(INDEX) - skip).otherwise(F.col(INDEX))
        tagged = tagged.where(~is_test | (F.col(INDEX) >= skip)).withColumn(INDEX, shifted)
    stats = F.array(*[F.lit(y) for y in fold_years(fold_id, folds)["train"]])
    return tagged.withColumn("stats_years", stats).withColumn("augmented", ~is_test)


def split_views(
    samples: DataFrame,
    fold_id: int,
    n: int,
    adjust_to: int | None,
    folds: Sequence[tuple] = FOLD_YEARS,
) -> dict[str, DataFrame]:
    """The tagged samples of one fold as three tables."""
    tagged = tag_samples(samples, fold_id, n, adjust_to, folds)
    return {name: tagged.where(F.col("split") == name) for name in ("train", "val", "test")}


def dataset_overview(
    images: DataFrame, n: int, adjust_to: int | None = None, fire: Sequence[str] = FIRE
) -> DataFrame:
    """Fires, images and samples per year, with a total row whose year is NULL."""
    return (
        datapoints_per_fire(images, n, adjust_to, fire)
        .rollup(fire[0])
        .agg(
            F.count(F.lit(1)).alias("fires"),
            F.sum("images").alias("images"),
            F.sum("datapoints").alias("samples"),
        )
    )
