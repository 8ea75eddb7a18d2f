"""From the pixel table to the feature table.

Pixels are reduced to images (or to samples, when each sample is cropped on its own) before any
window runs, so the label window works on image rows only. A sample is keyed by
``(year, fire, in_fire_index)``; the embedding pass uses the same key and the same hashed crops.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fire_label, zero_if_missing
from ..operators import bands as B
from ..operators import features as X
from ..operators import geometry as G
from ..operators import samples as S
from ..operators.joins import lookup_join
from ..schema import DEGREE_BANDS, FIRE_BAND, FOLD_YEARS, IMAGE_KEY, SAMPLE_KEY
from ..session import stage

ANGLES = [f"angle_{i}" for i in DEGREE_BANDS]
DAY, ROLE_X = "day", "is_input"


@dataclass(frozen=True)
class BuildSettings:
    fold_id: int = 0
    n_days: int = 1
    adjust_to: int | None = None
    crop_side: int = 256
    crop_tries: int = 10
    aggregation: str = "mean"
    drop_active_fire: bool = False
    seed: int = 42
    folds: tuple = tuple(FOLD_YEARS)

    @property
    def dropped(self) -> int:
        """Channels left out at the end: the binary mask, and today's fire hour on request."""
        return 2 if self.drop_active_fire else 1


def fire_in_hours(pixels: DataFrame) -> bool:
    """Whether the fire band holds hours (stored stacks say so themselves) or hhmm times.

    In hours a detection in hour 0 is no label.
    """
    return pixels.schema["bands"].metadata.get("fire") == "hours"


def fold_scaler(pixels: DataFrame, settings: BuildSettings) -> B.Stats:
    """Band statistics of the fold's training years on unaugmented pixels."""
    years = settings.folds[settings.fold_id][:2]
    stats = B.band_stats(pixels, B.prepared_bands(F.col("bands"), fire_in_hours(pixels)), [years])
    return B.fit_scaler(stats, years, untouched=B.UNSCALED)


def _image_rows(pixels: DataFrame, channels: Sequence[Column], settings: BuildSettings) -> DataFrame:
    """One row per image: channel aggregates and burning pixels."""
    label = fire_label(F.col("bands")[FIRE_BAND])
    return X.spatial_agg_array(
        pixels,
        IMAGE_KEY,
        channels,
        settings.aggregation,
        drop_last=settings.dropped,
        extra=[F.sum(label).cast("bigint").alias("burned_pixels")],
    )


def uncropped_samples(pixels: DataFrame, scaler: B.Stats, settings: BuildSettings) -> DataFrame:
    """Samples from whole (or centre-cropped) images: aggregate each image once, then window."""
    channels = B.expand_channels(F.col("bands"), scaler, fire_in_hours(pixels))
    images = S.index_images(stage(_image_rows(pixels, channels, settings)))
    windows = S.leading_windows(images, settings.n_days, ["tif"], "burned_pixels")
    tif = X.flatten_days(F.transform("days", lambda d: d["tif"]))
    return windows.select(*SAMPLE_KEY, tif.alias("tif"), F.col("label").alias("burned_area"))


def sample_roles(images: DataFrame, n_days: int) -> DataFrame:
    """Which images each sample needs: ``day`` 0..n-1 are inputs, ``day`` n is the label."""
    indexed = S.index_images(images)
    windows = S.leading_windows(
        indexed.withColumn("_label_date", F.col("obs_date")), n_days, ["obs_date"], "_label_date"
    )
    dates = F.concat(F.transform("days", lambda d: d["obs_date"]), F.array("label"))
    return windows.select(*SAMPLE_KEY, F.posexplode(dates).alias(DAY, "obs_date"))


def sample_dates(images: DataFrame, n_days: int) -> DataFrame:
    """Dates of each sample: ``obs_date`` of the last input image, its ``day_of_year``, and
    ``gap_days``, how far ahead the labelled image is."""
    days = stage(sample_roles(images, n_days))
    last = F.max(F.when(F.col(DAY) == n_days - 1, F.col("obs_date")))
    label = F.max(F.when(F.col(DAY) == n_days, F.col("obs_date")))
    return days.groupBy(*SAMPLE_KEY).agg(
        last.alias("obs_date"),
        F.dayofyear(last).alias("day_of_year"),
        F.date_diff(label, last).alias("gap_days"),
    )


def pixels_by_sample(pixels: DataFrame, n_days: int) -> Callable[[DataFrame], DataFrame]:
    """A function repeating pixel rows for the samples that use their image, with ``day``.

    Stored stacks carry the position of the image, so this is a projection; other tables look the
    samples of their image up.
    """
    if "day_index" in pixels.columns:
        # Position p serves samples p-n..p, as day n (the label) down to day 0.
        days = F.sequence(F.lit(0), F.lit(n_days))

        def spread(rows: DataFrame) -> DataFrame:
            first = F.col("day_index") - F.col(DAY)
            repeated = rows.withColumn(DAY, F.explode(days)).withColumn(SAMPLE_KEY[2], first)
            return repeated.where((first >= 0) & (first < F.col("fire_days") - n_days))

        return spread
    images = stage(pixels.groupBy(*IMAGE_KEY).agg(F.count(F.lit(1)).alias("n_px")))
    roles = stage(sample_roles(images, n_days))
    return lambda rows: lookup_join(rows, roles, IMAGE_KEY, ["r", "c"])


def sample_pixels(pixels: DataFrame, settings: BuildSettings) -> DataFrame:
    """Augmented pixels of every sample, inputs and label as separate rows.

    Each image is repeated for the few samples that use it; the crop is scored and chosen per
    sample, then flips and turns move coordinates and angles of all its days alike.
    """
    spread = pixels_by_sample(pixels, settings.n_days)
    is_input = F.col(DAY) < settings.n_days
    fire = F.col("bands")[FIRE_BAND]
    hour = B.fire_hour_of(fire, fire_in_hours(pixels))

    def by_sample(rows: DataFrame) -> DataFrame:
        return spread(rows).select(
            *SAMPLE_KEY,
            DAY,
            is_input.alias(ROLE_X),
            G.H,
            G.W,
            "r",
            "c",
            "bands",
            *[F.col("bands")[i].cast("double").alias(a) for i, a in zip(DEGREE_BANDS, ANGLES)],
            F.when(is_input, hour).alias("fire_hour"),
            F.when(~is_input, fire_label(fire)).alias("label"),
        )

    return G.augment(
        by_sample(pixels),
        SAMPLE_KEY,
        settings.crop_side,
        settings.seed,
        ANGLES,
        tries=settings.crop_tries,
        days=settings.n_days,
        # Detections are picked out of the pixel scan before they meet their samples.
        burning=by_sample(pixels.where(zero_if_missing(fire) > 0)),
    )


def _turned_bands() -> list[Column]:
    """Bands with the angles as they are after flips and turns."""
    place = dict(zip(DEGREE_BANDS, ANGLES))
    return [F.col(place[i]) if i in place else F.col("bands")[i] for i in range(FIRE_BAND + 1)]


def cropped_samples(augmented: DataFrame, scaler: B.Stats, settings: BuildSettings) -> DataFrame:
    """Samples from augmented pixels: one aggregate per (sample, day), then one per sample."""
    channels = B.expand_channels(_BandList(_turned_bands()), scaler, fire_in_hours(augmented))
    per_day = X.spatial_agg_array(
        augmented,
        [*SAMPLE_KEY, DAY],
        channels,
        settings.aggregation,
        drop_last=settings.dropped,
        extra=[F.sum("label").cast("bigint").alias("burning")],
    )
    is_input = F.col(DAY) < settings.n_days
    # n + 1 short rows meet per sample.
    days = F.array_sort(F.collect_list(F.when(is_input, F.struct(DAY, "tif"))))
    return per_day.groupBy(*SAMPLE_KEY).agg(
        X.flatten_days(F.transform(days, lambda d: d["tif"])).alias("tif"),
        F.max(F.when(~is_input, F.col("burning"))).alias("burned_area"),
    )


class _BandList:
    """Indexes like a bands column, over given expressions."""

    def __init__(self, columns: list[Column]) -> None:
        self._columns = columns

    def __getitem__(self, i: int) -> Column:
        return self._columns[i]


def feature_table(
    pixels: DataFrame,
    settings: BuildSettings = BuildSettings(),
    embeddings: DataFrame | None = None,
    augmented: bool = True,
) -> DataFrame:
    """Feature rows of one fold: key, split, dates, targets, ``tif`` array and, if given, embeddings.

    Training and validation samples come from augmented crops, test samples from centre crops.
    With ``augmented=False`` all three come from centre crops.
    """
    S.check_days(settings.n_days, settings.adjust_to)
    scaler = fold_scaler(pixels, settings)
    years = S.fold_years(settings.fold_id, settings.folds)

    def of(*splits: str) -> DataFrame:
        return pixels.where(F.col("year").isin([y for s in splits for y in years[s]]))

    if augmented:
        crops = sample_pixels(of("train", "val"), settings)
        parts = [cropped_samples(crops, scaler, settings)]
        plain = of("test")
    else:
        parts, plain = [], of("train", "val", "test")
    parts.append(uncropped_samples(G.center_crop_32(plain), scaler, settings))
    samples = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    # One narrow row per image; the keys of both sides are unique.
    images = stage(of("train", "val", "test").select(*IMAGE_KEY).distinct())
    samples = samples.join(sample_dates(images, settings.n_days), SAMPLE_KEY, "left")
    tagged = S.tag_samples(
        samples, settings.fold_id, settings.n_days, settings.adjust_to, settings.folds
    )
    table = X.add_targets(tagged.drop("stats_years", "augmented"))
    return table if embeddings is None else X.join_embeddings(table, embeddings, SAMPLE_KEY)


def embedding_table(
    pixels: DataFrame,
    load: Callable[[], Callable],
    settings: BuildSettings = BuildSettings(),
) -> DataFrame:
    """Embeddings of the last input day of every sample, from the very crops of the features."""
    scaler = fold_scaler(pixels, settings)
    years = S.fold_years(settings.fold_id, settings.folds)
    last = settings.n_days - 1
    crops = sample_pixels(
        pixels.where(F.col("year").isin([*years["train"], *years["val"]])), settings
    ).where(F.col(DAY) == last)
    turned = B.expand_channels(_BandList(_turned_bands()), scaler, fire_in_hours(pixels))
    planes = [crops.select(*SAMPLE_KEY, "r", "c", *_rgb(turned))]
    test = G.center_crop_32(pixels.where(F.col("year").isin(years["test"])))
    placed = pixels_by_sample(test, settings.n_days)(test).where(F.col(DAY) == last)
    placed = S.skip_initial(placed, settings.n_days, settings.adjust_to)
    plain = B.expand_channels(F.col("bands"), scaler, fire_in_hours(pixels))
    planes.append(placed.select(*SAMPLE_KEY, "r", "c", *_rgb(plain)))
    ready = X.rgb_prepare(planes[0].unionByName(planes[1]), SAMPLE_KEY, ["b0", "b1", "b2"])
    return X.embed_images(ready, SAMPLE_KEY, load)


def _rgb(channels: Sequence[Column]) -> list[Column]:
    return [channels[i].alias(f"b{i}") for i in range(3)]
