"""From raster files to pixel rows, with the file format left to a decoder function."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import image_date, null_if_nan
from ..operators.joins import lookup_join
from ..operators.samples import INDEX, index_images
from ..schema import FIRE_BAND, IMAGE_KEY, PIXELS, STACK_PIXELS
from ..session import stage
from .inventory import image_inventory

#: Pixel rows plus the centre of the image, which decoders may know, and the image's position.
CENTRE = [T.StructField("lng", T.DoubleType()), T.StructField("lat", T.DoubleType())]
POSITION = STACK_PIXELS.fields[len(PIXELS.fields) :]
RASTER_PIXELS = T.StructType([*PIXELS.fields, *CENTRE, *POSITION])
_BATCH = 65_536
#: Bytes of a file that one task reads where the format can be read in strips.
STRIP_BYTES = 64 << 20
_IMAGE_PATH = r"/(\d{4})/([^/]+)/[^/]+$"


def ingest_rasters(
    spark: SparkSession,
    root: str,
    years: Sequence[int],
    decoder: Callable[[bytes], object],
    suffix: str = ".tif",
) -> DataFrame:
    """Decode every image of the wanted years into pixel rows with the image's position in its fire.

    Only the folders of those years are listed and read. Positions come from the listing, before
    anything is decoded.

    ``decoder(content)`` returns an array of shape (bands, height, width), or a pair of it and
    ``(lng, lat)``. Files are decoded one by one where Spark placed them; pixels leave a task in
    small batches, so memory is bounded by the largest single image. How many files share an Arrow
    batch follows ``spark.sql.execution.arrow.maxBytesPerBatch``.
    """
    folders = [f"{root.rstrip('/')}/{int(y)}" for y in sorted(set(years))]
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*{suffix}")
    )
    present = [f for f in folders if _exists(spark, f)]
    if not present:
        return spark.createDataFrame([], RASTER_PIXELS)
    keyed = files.load(present).select(
        F.regexp_extract("path", _IMAGE_PATH, 1).try_cast("int").alias("year"),
        F.regexp_extract("path", _IMAGE_PATH, 2).alias("fire"),
        image_date(F.replace("path", F.lit(suffix), F.lit(""))).alias("obs_date"),
        "content",
    )
    keyed = keyed.where(F.col("year").isin([int(y) for y in years]))
    # Without the content column only file names are read.
    placed = image_positions(keyed.select(*IMAGE_KEY).distinct())
    return decode_rows(lookup_join(keyed, placed, IMAGE_KEY, ["obs_date"]), decoder)


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def _pixel_batches(raster, first: int, height: int, centre: tuple, batch, i: int) -> Iterator:
    """Pixel rows of the image rows from ``first`` on; the key and position come from row i of ``batch``."""
    import numpy as np
    import pyarrow as pa

    bands, rows, width = raster.shape
    flat = raster.reshape(bands, rows * width).T
    year, fire, date, index, days = (batch.column(n)[i] for n in [*IMAGE_KEY, *[f.name for f in POSITION]])
    for start in range(0, rows * width, _BATCH):
        part = np.ascontiguousarray(flat[start : start + _BATCH])
        n = len(part)
        place = np.arange(start, start + n, dtype=np.int32)
        offsets = np.arange(0, (n + 1) * bands, bands, dtype=np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                pa.repeat(year, n),
                pa.repeat(fire, n),
                pa.repeat(date, n),
                pa.array(np.full(n, height, dtype=np.int32)),
                pa.array(np.full(n, width, dtype=np.int32)),
                pa.array(place // width + np.int32(first)),
                pa.array(place % width),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(part.ravel(), pa.float32())),
                pa.repeat(pa.scalar(centre[0], pa.float64()), n),
                pa.repeat(pa.scalar(centre[1], pa.float64()), n),
                pa.repeat(index, n),
                pa.repeat(days, n),
            ],
            names=RASTER_PIXELS.names,
        )


def _packed_images(images: list, batch):
    """Pixel rows of several whole images in one batch; ``images`` has the row of ``batch``, raster and centre of each."""
    import numpy as np
    import pyarrow as pa

    rows, rasters, centres = zip(*images, strict=True)
    bands = rasters[0].shape[0]
    height, width = (np.array([x.shape[k] for x in rasters], dtype=np.int32) for k in (1, 2))
    sizes = height.astype(np.int64) * width
    total, ends = int(sizes.sum()), np.cumsum(sizes)
    of = np.repeat(np.arange(len(images)), sizes)
    place, wide = np.arange(total) - (ends - sizes)[of], width[of]
    values = np.concatenate([x.reshape(bands, -1).T for x in rasters]).ravel()
    offsets = np.arange(0, (total + 1) * bands, bands, dtype=np.int32)
    whose = pa.array(np.array(rows)[of])
    year, fire, date, index, days = (batch.column(n).take(whose) for n in [*IMAGE_KEY, *[f.name for f in POSITION]])
    lng, lat = (pa.array([c[k] for c in centres], pa.float64()).take(pa.array(of)) for k in (0, 1))
    return pa.RecordBatch.from_arrays(
        [
            year,
            fire,
            date,
            pa.array(height[of]),
            pa.array(wide),
            pa.array((place // wide).astype(np.int32)),
            pa.array((place % wide).astype(np.int32)),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.float32())),
            lng,
            lat,
            index,
            days,
        ],
        names=RASTER_PIXELS.names,
    )


def decode_rows(files: DataFrame, decoder: Callable[[bytes], object]) -> DataFrame:
    """``(year, fire, obs_date, day_index, fire_days, content)`` to pixel rows, each file decoded once.

    Small images leave a task together, since a batch of few rows costs as much as one of many.
    """

    def run(batches: Iterator) -> Iterator:
        import numpy as np

        for batch in batches:
            few, pixels = [], 0
            for i in range(batch.num_rows):
                raster = decoder(batch.column("content")[i].as_py())
                centre = (None, None)
                if isinstance(raster, tuple):
                    raster, centre = raster
                raster = np.asarray(raster, dtype=np.float32)
                size = raster.shape[1] * raster.shape[2]
                if few and (pixels + size > _BATCH // 4 or few[0][1].shape[0] != raster.shape[0]):
                    yield _packed_images(few, batch)
                    few, pixels = [], 0
                if size > _BATCH // 4:
                    yield from _pixel_batches(raster, 0, raster.shape[1], centre, batch, i)
                elif size:
                    few.append((i, raster, centre))
                    pixels += size
            if few:
                yield _packed_images(few, batch)

    return files.mapInArrow(run, RASTER_PIXELS)


def plan_strips(files: DataFrame, strip_bytes: int = STRIP_BYTES) -> DataFrame:
    """One row per strip ``part`` of ``parts``: a file of ``size`` bytes has one per ``strip_bytes``, at least one."""
    parts = F.greatest(F.lit(1), F.ceil(F.col("size") / strip_bytes)).cast("int")
    return files.withColumn("parts", parts).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))


def ingest_strips(
    spark: SparkSession,
    root: str,
    years: Sequence[int],
    reader: Callable,
    strip_bytes: int = STRIP_BYTES,
) -> DataFrame:
    """As ``ingest_rasters``, for formats that can be read in strips of rows: the result is the same.

    Strips are planned from the sizes in the listing and dealt out as tasks of their own, so a very
    large file is read by many tasks, and memory is bounded by a strip. ``reader(stream, part,
    parts)`` gets the open file, seeks as it likes and returns the rows of that part as an array
    (bands, rows, width), the number of the first of them, the image's height, and its centre or
    None; a part without rows gives an empty array. Files must be on a store that Arrow can open.
    """
    listed = stage(image_inventory(spark, root, years))
    placed = lookup_join(listed, image_positions(listed.select(*IMAGE_KEY).distinct()), IMAGE_KEY, ["path"])
    strips = stage(plan_strips(placed, strip_bytes))
    # A task per strip, whatever adaptive execution makes of a short list.
    dealt = strips.repartition(max(1, strips.count()))

    def run(batches: Iterator) -> Iterator:
        import re

        import numpy as np
        from pyarrow import fs

        for batch in batches:
            for i in range(batch.num_rows):
                path, part, parts = (batch.column(n)[i].as_py() for n in ("path", "part", "parts"))
                store, place = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
                with store.open_input_file(place) as stream:
                    raster, first, height, centre = reader(stream, part, parts)
                raster = np.asarray(raster, dtype=np.float32)
                if raster.size:
                    yield from _pixel_batches(raster, first, height, centre or (None, None), batch, i)

    return dealt.mapInArrow(run, RASTER_PIXELS)


def consolidate(pixels: DataFrame) -> DataFrame:
    """The fire band as hours with 0 for no detection, as stored in consolidated tables."""
    hour = F.floor(F.coalesce(null_if_nan(F.col("bands")[FIRE_BAND].cast("double")), F.lit(0.0)) / 100)
    bands = F.concat(F.slice("bands", 1, FIRE_BAND), F.array(hour.cast("float")))
    return pixels.withColumn("bands", bands)


def image_positions(images: DataFrame) -> DataFrame:
    """``day_index`` and ``fire_days`` of distinct images: position in the fire, images of the fire."""
    images = stage(images)
    days = F.count(F.lit(1))
    sizes = images.groupBy("year", "fire").agg(days.alias("fire_days"), days.alias("_images"))
    placed = index_images(images).withColumnRenamed(INDEX, "day_index")
    return lookup_join(placed, sizes, ["year", "fire"], ["obs_date"], weight="_images")


def add_positions(pixels: DataFrame) -> DataFrame:
    """Add positions to pixels that were not ingested with them; reads the pixels twice."""
    placed = image_positions(pixels.select(*IMAGE_KEY).distinct())
    return lookup_join(pixels, placed, IMAGE_KEY, ["r", "c"])


#: Images and rows of pixels that go to one partition of stored stacks together.
_STACK_DAYS, _STACK_ROWS = 8, 64
#: Images that a task decodes on average where images are dealt out, and years whose files it writes at once.
_TASK_IMAGES, _OPEN_YEARS = 16_384, 16


def deal_images(files: DataFrame, images: int) -> DataFrame:
    """The ``images`` files of ``decode_rows`` dealt out as ``write_fire_stacks`` deals out pixels, in order.

    For images of at most 64 rows, whose pixels stay together there: a file is far smaller than its pixels.
    """
    tasks = max(files.sparkSession.sparkContext.defaultParallelism, -(-images // _TASK_IMAGES))
    few = F.expr(f"day_index div {_STACK_DAYS}")
    return files.repartition(tasks, "year", "fire", few).sortWithinPartitions(*IMAGE_KEY)


def write_fire_stacks(pixels: DataFrame, path: str, fires_path: str | None = None, dealt: bool = False) -> None:
    """Write consolidated pixels, clustered by fire, day and place, partitioned by year.

    Partitions hold a few images of a fire, and of large images a band of rows, so a very large
    fire, or even a single very large image, becomes several files, and readers prune by fire and
    day. Ingested pixels carry their positions, so each is decoded and shuffled once; the centres
    of the fires for ``fires_path`` come from what was written. ``dealt`` pixels, decoded from what
    ``deal_images`` gave, are clustered and in order already and are written where they are.
    """
    order = ["year", "fire", "obs_date", "r", "c"]
    placed = pixels if "day_index" in pixels.columns else add_positions(pixels)
    centre = [f.name for f in CENTRE if f.name in pixels.columns]
    together = [F.expr(f"day_index div {_STACK_DAYS}"), F.expr(f"r div {_STACK_ROWS}")]
    stacks = consolidate(placed).select(*STACK_PIXELS.names, *centre)
    if not dealt:
        stacks = stacks.repartition("year", "fire", *together).sortWithinPartitions(*order)
    conf, name = pixels.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(name)
    try:
        if dealt:  # else Spark sorts all pixels by year once more
            conf.set(name, _OPEN_YEARS)
        stacks.write.partitionBy("year").mode("errorifexists").parquet(path)
    finally:
        conf.set(name, before)
    if fires_path:
        fire_centres(pixels.sparkSession.read.parquet(path)).write.mode("errorifexists").parquet(fires_path)


def fire_centres(stacks: DataFrame) -> DataFrame:
    """Centre of each fire from its first image, with its number of days; reads first pixels only."""
    first = stacks.where("r = 0 AND c = 0 AND day_index = 0")
    return first.select("year", "fire", "lng", "lat", F.col("fire_days").alias("days"))


def read_fire_stacks(spark: SparkSession, path: str) -> DataFrame:
    """Consolidated pixels; filters on year, fire and day reach the files.

    The fire band is in hours there; the column ``bands`` says so to the feature build.
    """
    fields = STACK_PIXELS.fields
    columns = [f for f in fields if f.name != "year"] + [STACK_PIXELS["year"]]
    stacks = spark.read.schema(T.StructType(columns)).parquet(path).select(*STACK_PIXELS.names)
    return stacks.withMetadata("bands", {"fire": "hours"})
