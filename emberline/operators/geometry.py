"""Crops, padding, flips and rotations as coordinate arithmetic on pixel rows.

The image sides ``height`` and ``width`` are columns of the pixel table, so most of these are
plain projections and filters. Angles turn with the image.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cycle_degrees, seeded_md5
from .joins import lookup_join

H, W = "height", "width"


def with_image_size(pixels: DataFrame, image: Sequence[str]) -> DataFrame:
    """Add ``height`` and ``width`` to a pixel table that lacks them (one aggregate, one join)."""
    sizes = pixels.groupBy(*image).agg(
        (F.max("r") + 1).alias(H),
        (F.max("c") + 1).alias(W),
        F.count(F.lit(1)).alias("_pixels"),
    )
    return lookup_join(pixels, sizes, image, ["r", "c"], weight="_pixels")


def _half_even(value: Column) -> Column:
    return F.bround(value).cast("int")


def center_crop_32(pixels: DataFrame) -> DataFrame:
    """Centre crop to sides that are multiples of 32; sides below 32 leave no pixel."""
    new_h = (F.floor(F.col(H) / 32) * 32).cast("int")
    new_w = (F.floor(F.col(W) / 32) * 32).cast("int")
    top = _half_even((F.col(H) - new_h) / F.lit(2.0))
    left = _half_even((F.col(W) - new_w) / F.lit(2.0))
    return _crop(pixels, top, left, new_h, new_w)


def _crop(pixels: DataFrame, top: Column, left: Column, new_h: Column, new_w: Column) -> DataFrame:
    inside = (
        (F.col("r") >= top)
        & (F.col("r") < top + new_h)
        & (F.col("c") >= left)
        & (F.col("c") < left + new_w)
    )
    return pixels.where(inside).withColumns(
        {
            "r": (F.col("r") - top).cast("int"),
            "c": (F.col("c") - left).cast("int"),
            H: new_h.cast("int"),
            W: new_w.cast("int"),
        }
    )


def _reflections(place: str, side: str, size: int) -> Column:
    """Target positions of a source line when its image is reflect-padded to ``size``.

    Mirroring without repeating the edge has period ``2 (side - 1)``: a source line shows at
    ``pad + place`` and ``pad - place`` modulo the period.
    """
    padded = F.greatest(F.lit(size), F.col(side))
    before = F.floor((padded - F.col(side)) / 2).cast("int")
    period = F.greatest(2 * (F.col(side) - 1), F.lit(1)).cast("int")
    last = (padded - 1).cast("int")

    def run(start: Column) -> Column:
        first = F.pmod(start, period)
        return F.when(first <= last, F.sequence(first, last, period)).otherwise(
            F.array().cast("array<int>")
        )

    return F.array_union(run(before + F.col(place)), run(before - F.col(place)))


def reflect_pad(pixels: DataFrame, size: int) -> DataFrame:
    """Pad images below ``size`` by reflection, the odd line going to the bottom and right.

    Each pixel says where it appears, so no coordinate grid is joined.
    """
    others = [c for c in pixels.columns if c not in ("r", "c", H, W)]
    rows = pixels.withColumn("_r", F.explode(_reflections("r", H, size)))
    both = rows.withColumn("_c", F.explode(_reflections("c", W, size)))
    return both.select(
        *others,
        F.greatest(F.lit(size), F.col(H)).cast("int").alias(H),
        F.greatest(F.lit(size), F.col(W)).cast("int").alias(W),
        F.col("_r").cast("int").alias("r"),
        F.col("_c").cast("int").alias("c"),
    ).select(*pixels.columns)


def crop_offset(
    keys: Sequence[str], seed: int, attempt: Column | int, axis: str, room: Column
) -> Column:
    """Deterministic offset in [0, room] for one attempt: both passes see the same crop."""
    attempt = F.lit(attempt) if isinstance(attempt, int) else attempt
    digest = F.conv(F.substring(seeded_md5(seed, *keys, attempt, F.lit(axis)), 1, 8), 16, 10).cast("bigint")
    return F.pmod(digest, (room + 1).cast("bigint")).cast("int")


def best_crop(
    pixels: DataFrame,
    keys: Sequence[str],
    size: int,
    seed: int,
    fire_hour: str = "fire_hour",
    label: str = "label",
    tries: int = 10,
    days: int = 1,
    burning: DataFrame | None = None,
) -> DataFrame:
    """Of ``tries`` hashed square crops keep the one with most fire in label, then in input.

    A crop's score is the mean fire hour over its ``days`` input days plus 1000 times the mean of
    the label; the first of equal scores wins. Images must be whole, and at least ``size`` on both
    sides (see ``reflect_pad``). ``fire_hour`` may be NULL on rows that only carry the label and
    the other way round, as when input and label pixels of a sample come as separate rows.

    Only burning pixels, some per mille of all, add to a score: they alone are scored and
    shuffled, and may be given as ``burning``. A sample without any keeps its first crop.
    """
    alight = pixels if burning is None else burning
    alight = alight.where((F.col(fire_hour) > 0) | (F.col(label) > 0))
    area = float(size * size)
    sums = []
    for i in range(tries):
        top = crop_offset(keys, seed, i, "top", F.col(H) - size)
        left = crop_offset(keys, seed, i, "left", F.col(W) - size)
        inside = F.col("r").between(top, top + (size - 1)) & F.col("c").between(
            left, left + (size - 1)
        )
        worth = F.coalesce(F.col(fire_hour) / (area * days), F.lit(0.0)) + F.coalesce(
            1000 * F.col(label) / area, F.lit(0.0)
        )
        sums.append(F.sum(F.when(inside, worth).otherwise(0.0)).alias(f"_s{i}"))
    # Equal crops must not differ by the order of addition.
    scored = alight.groupBy(*keys).agg(*sums, F.max(F.col(H).cast("bigint") * F.col(W)).alias("_area"))
    scores = [F.round(f"_s{i}", 9) for i in range(tries)]
    best = F.greatest(*scores) if tries > 1 else scores[0]
    pick = F.coalesce(*[F.when(s == best, F.lit(i)) for i, s in enumerate(scores)])
    chosen = scored.select(*keys, pick.alias("_try"), "_area").where("_try > 0")
    placed = lookup_join(pixels, chosen, keys, ["r", "c"], how="left", weight="_area")
    attempt = F.coalesce(F.col("_try"), F.lit(0))
    offsets = placed.withColumns(
        {
            "_top": crop_offset(keys, seed, attempt, "top", F.col(H) - size),
            "_left": crop_offset(keys, seed, attempt, "left", F.col(W) - size),
        }
    )
    cropped = _crop(offsets, F.col("_top"), F.col("_left"), F.lit(size), F.lit(size))
    return cropped.drop("_top", "_left", "_try")


def coin(keys: Sequence[str], seed: int, purpose: str, sides: int = 2) -> Column:
    """Deterministic draw in 0..sides-1 from the sample key."""
    return F.pmod(F.xxhash64(*keys, F.lit(seed), F.lit(purpose)), F.lit(sides)).cast("int")


def _when(condition: Column | bool, yes: Column, no: Column) -> Column:
    if isinstance(condition, bool):
        return yes if condition else no
    return F.when(condition, yes).otherwise(no)


def flip(
    pixels: DataFrame,
    angles: Sequence[str],
    horizontal: Column | bool = False,
    vertical: Column | bool = False,
) -> DataFrame:
    """Mirror left-right and top-bottom. Angles become ``360 - a``, then ``(180 - a) mod 360``."""
    turned = pixels.withColumns(
        {
            "c": _when(horizontal, F.col(W) - 1 - F.col("c"), F.col("c")).cast("int"),
            **{a: _when(horizontal, 360 - F.col(a), F.col(a)) for a in angles},
        }
    )
    return turned.withColumns(
        {
            "r": _when(vertical, F.col(H) - 1 - F.col("r"), F.col("r")).cast("int"),
            **{a: _when(vertical, cycle_degrees(180 - F.col(a)), F.col(a)) for a in angles},
        }
    )


def rotate(pixels: DataFrame, angles: Sequence[str], quarter_turns: Column | int) -> DataFrame:
    """Rotate square images counter-clockwise by quarter turns; angles fall by 90 per turn."""
    k = F.lit(quarter_turns) if isinstance(quarter_turns, int) else quarter_turns
    k = F.pmod(k, F.lit(4))
    r, c, last = F.col("r"), F.col("c"), F.col(W) - 1

    def place(zero: Column, one: Column, two: Column, three: Column) -> Column:
        return F.when(k == 0, zero).when(k == 1, one).when(k == 2, two).otherwise(three).cast("int")

    return pixels.withColumns(
        {
            "r": place(r, last - c, last - r, c),
            "c": place(c, r, last - c, last - r),
            **{
                a: F.when(k == 0, F.col(a)).otherwise(cycle_degrees(F.col(a) - 90 * k))
                for a in angles
            },
        }
    )


def augment(
    pixels: DataFrame,
    keys: Sequence[str],
    size: int,
    seed: int,
    angles: Sequence[str],
    fire_hour: str = "fire_hour",
    label: str = "label",
    tries: int = 10,
    days: int = 1,
    burning: DataFrame | None = None,
) -> DataFrame:
    """Training treatment: pad, best crop, flips, rotation, each drawn from the sample key."""
    padded = reflect_pad(pixels, size)
    alight = None if burning is None else reflect_pad(burning, size)
    cropped = best_crop(padded, keys, size, seed, fire_hour, label, tries, days, alight)
    flipped = flip(
        cropped, angles, coin(keys, seed, "hflip") == 1, coin(keys, seed, "vflip") == 1
    )
    return rotate(flipped, angles, coin(keys, seed, "turns", 4))
