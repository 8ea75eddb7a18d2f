"""Checks of sources: files written from the tables are listed, decoded, stacked and read back."""

from __future__ import annotations

import struct
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import FIRE_BAND, IMAGE_KEY, N_BASE
from ..session import stage, staging_root
from ..sources import inventory as I
from ..sources import rasters as R
from ..sources import tables as A
from .registry import check
from .views import Tables

BAND = 5
#: Images that are files at a time: each takes a block of the disk, and the driver has the list of them.
FILES = 200_000
#: Shares of a part's folders, each written by one task.
TASKS = 32
#: Ending of the folder beside the raw files that holds what the next part may take.
SPARE = "-spare"
#: Rows and columns of the images; the places of the pixel view are folded into them.
SIDE = 8


def _folder(t: Tables, name: str) -> str:
    return f"{staging_root(t.spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _contents(t: Tables):
    """One row per image of the pixel view: key, position, and its rows, columns, values and detections
    as little-endian bytes, repeated places reduced to the largest value."""
    r, c = (F.col(x) % SIDE for x in ("r", "c"))
    places = t.px.groupBy("year", "fire", "img", r.alias("r"), c.alias("c")).agg(F.max("b_deg").alias("v"), F.max("b_fire").alias("f"))
    numbers = F.to_json(F.array_sort(F.collect_list(F.struct("r", "c", "v", F.coalesce("f", F.lit(-1.0)).alias("f")))))
    images = places.groupBy("year", "fire", "img").agg(numbers.alias("content"))
    # An image number stands for the date: days since a fixed one.
    return images.select(
        "year", F.col("fire").cast("string").alias("fire"), F.date_add(F.lit("1970-01-01").cast("date"), F.col("img").cast("int")).alias("obs_date"),
        F.encode("content", "UTF-8").alias("content"),
    )


def _decoder():
    bands, side, value, fire = N_BASE, SIDE, BAND, FIRE_BAND

    def decode(content):
        import json

        import numpy as np

        cells = json.loads(content)
        grid = np.full((bands, side, side), np.nan, np.float32)
        for cell in cells:
            grid[value, cell["r"], cell["c"]] = cell["v"]
            if cell["f"] >= 0:
                grid[fire, cell["r"], cell["c"]] = cell["f"]
        return grid, (float(len(cells)), 0.0)

    return decode


_PLACES = f"(SELECT year, fire, img, r % {SIDE} AS r, c % {SIDE} AS c, max(b_deg) AS v, max(b_fire) AS f FROM px GROUP BY year, fire, img, r % {SIDE}, c % {SIDE})"


@check(
    "s2_decode_rasters",
    f"""
SELECT CAST(fire AS VARCHAR) AS fire, count(DISTINCT img) * {SIDE * SIDE} AS pixels, count(v) AS seen,
       count(f) AS detections, round(sum(CAST(CAST(v AS FLOAT) AS DOUBLE)), 3) AS total
FROM {_PLACES} GROUP BY fire""",
)
def decode_rasters(t: Tables):
    images = stage(_contents(t))
    placed = R.image_positions(images.select(*IMAGE_KEY))
    pixels = R.decode_rows(images.join(placed, IMAGE_KEY), _decoder())
    value, fire = (F.nullif(F.col("bands")[i].cast("double"), F.lit(float("nan"))) for i in (BAND, FIRE_BAND))
    return pixels.groupBy("fire").agg(
        F.count(F.lit(1)).alias("pixels"), F.count(value).alias("seen"), F.count(fire).alias("detections"), F.round(F.sum(value), 3).alias("total")
    )


@check(
    "s3_fire_stacks",
    f"""
WITH images AS (SELECT year, fire, img, count(*) AS cells FROM {_PLACES} GROUP BY year, fire, img),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY year, fire ORDER BY img) - 1 AS day_index,
         count(*) OVER (PARTITION BY year, fire) AS fire_days FROM images),
hours AS (SELECT year, fire, img, sum(CASE WHEN f IS NULL THEN 0 ELSE floor(f / 100) END) AS hours FROM {_PLACES} GROUP BY year, fire, img)
SELECT CAST(p.year AS INT) AS year, CAST(p.fire AS VARCHAR) AS fire, day_index, fire_days, CAST(hours AS DOUBLE) AS hours,
       first_value(CAST(cells AS DOUBLE)) OVER (PARTITION BY p.year, p.fire ORDER BY p.img) AS lng
FROM placed p JOIN hours h ON p.year = h.year AND p.fire = h.fire AND p.img = h.img""",
)
def fire_stacks(t: Tables):
    """Stored stacks hold hours; the centre of a fire is that of its first image."""
    images = stage(_contents(t))
    placed = R.image_positions(images.select(*IMAGE_KEY))
    folder = _folder(t, "stacks")
    files = R.deal_images(images.join(placed, IMAGE_KEY), images.count())
    R.write_fire_stacks(R.decode_rows(files, _decoder()), f"{folder}/pixels", f"{folder}/fires", dealt=True)
    stacks = R.read_fire_stacks(t.spark, f"{folder}/pixels")
    fires = t.spark.read.parquet(f"{folder}/fires").select("year", "fire", "lng")
    hours = F.sum(F.col("bands")[FIRE_BAND].cast("double")).alias("hours")
    per_image = stacks.groupBy("year", "fire", "day_index", "fire_days").agg(hours)
    return per_image.join(fires, ["year", "fire"])


@check(
    "s1_inventory",
    """
SELECT CAST(year AS INT) AS year, 'fire_' || CAST(fire AS VARCHAR) AS fire, CAST(obs_ts AS DATE) AS obs_date, count(*) AS files
FROM imgs WHERE year IN (1995, 1996) GROUP BY ALL""",
)
def inventory(t: Tables):
    """Files are written below year and fire folders, one per image, and those of two years are listed.

    The fires are dealt out to parts of about ``FILES`` images. A part's files are gone when its inventory
    is stored, so neither the disk nor the driver's listing holds the files of all fires. A fire's days are in one part.
    """
    names = t.img.select(
        F.concat_ws("/", F.col("year").cast("string"), F.concat(F.lit("fire_"), F.col("fire").cast("string")),
                    F.concat(F.date_format("obs_ts", "yyyy-MM-dd"), F.lit("_"), F.col("img").cast("string"), F.lit(".tif"))).alias("name")
    )
    names, stored = stage(names), _folder(t, "listed")
    parts = max(1, -(-names.count() // FILES))
    folder = F.xxhash64(F.substring_index("name", "/", 2))
    names = names.withColumn("part", F.pmod(folder, F.lit(parts)).cast("int"))
    # A folder is one task's: stored by part, so that a part reads its own names only.
    dealt = names.repartition("part", F.pmod(F.shiftright(folder, 32), F.lit(TASKS)))
    names = stage(dealt.sortWithinPartitions("part", "name"), "part")
    root = _folder(t, "raw")
    path, spare = (t.spark._jvm.org.apache.hadoop.fs.Path(p) for p in (root, root + SPARE))
    store = path.getFileSystem(t.spark.sparkContext._jsc.hadoopConfiguration())
    for k in range(parts):
        store.mkdirs(path)
        part = names.where(F.col("part") == k).select("name")
        _touch(part, root)
        listed = I.image_inventory(t.spark, root, [1995, 1996])
        counted = listed.groupBy("year", "fire", "obs_date").agg(F.count(F.lit(1)).alias("files"))
        counted.write.mode("append").parquet(stored)
        _clear(part, root)
        store.delete(path, True)
    _empty(t.spark, root)
    store.delete(spare, True)
    return t.spark.read.schema(counted.schema).parquet(stored)


def _uri(root: str) -> str:
    return root if "://" in root or root.startswith("file:") else f"file://{root}"


def _touch(names, root: str) -> None:
    """Write one small file per name, each from the task that has the name; folders are made when their first name comes.

    Disks take long to make files where many were deleted a moment before. So on a mounted disk the folders and
    files that ``_clear`` has put beside ``root`` are taken, by whichever task is first, before new ones are made.
    """
    uri, beside = _uri(root), SPARE

    def write(batches):
        import os
        import random

        from pyarrow import fs
        from pyspark import TaskContext

        store, place = fs.FileSystem.from_uri(uri)
        mounted = isinstance(store, fs.LocalFileSystem)
        unused = sorted(os.listdir(place + beside)) if mounted and os.path.isdir(place + beside) else []
        random.Random(TaskContext.get().taskAttemptId()).shuffle(unused)
        unused.sort(key=lambda name: name.startswith("left-"))  # taken first: they have the most files
        made, files = None, []

        def enter(folder: str) -> None:
            store.create_dir(os.path.dirname(folder), recursive=True)
            while unused and not os.path.exists(folder):
                try:
                    os.rename(f"{place}{beside}/{unused.pop()}", folder)
                except FileNotFoundError:  # another task has taken it
                    continue
                files.extend(f"{folder}/{name}" for name in os.listdir(folder))
                return
            store.create_dir(folder, recursive=True)

        for batch in batches:
            for name in batch.column("name").to_pylist():
                folder, content = name.rpartition("/")[0], struct.pack("<i", len(name))
                if folder != made:
                    enter(f"{place}/{folder}")
                    made = folder
                if not files:
                    with store.open_output_stream(f"{place}/{name}") as out:
                        out.write(content)
                    continue
                os.rename(files.pop(), f"{place}/{name}")
                with open(f"{place}/{name}", "r+b") as out:
                    out.write(content)
                    out.truncate()
            yield batch
        if files:
            os.makedirs(left := f"{place}{beside}/left-{TaskContext.get().taskAttemptId()}")
            for i, name in enumerate(files):
                os.rename(name, f"{left}/{i}")

    names.mapInArrow(write, "name string").write.format("noop").mode("overwrite").save()


def _clear(names, root: str) -> None:
    """Take the fire folders of the names away, each by a task that has it: beside ``root`` on a mounted disk, elsewhere for good."""
    uri, beside = _uri(root), SPARE

    def clear(batches):
        import os
        import uuid

        from pyarrow import fs

        store, place = fs.FileSystem.from_uri(uri)
        mounted = isinstance(store, fs.LocalFileSystem)
        if mounted:
            store.create_dir(place + beside)
        for batch in batches:
            for folder in {name.rpartition("/")[0] for name in batch.column("name").to_pylist()}:
                there = f"{place}/{folder}"
                if "/" not in folder or store.get_file_info(there).type != fs.FileType.Directory:
                    continue
                if not mounted:
                    store.delete_dir(there)
                    continue
                for i, name in enumerate(os.listdir(there)):
                    os.rename(f"{there}/{name}", f"{there}/{i}")
                os.rename(there, f"{place}{beside}/{uuid.uuid4().hex}")
            yield batch

    names.mapInArrow(clear, "name string").write.format("noop").mode("overwrite").save()


def _empty(spark, root: str) -> None:
    """Delete the folders beside ``root`` that no part has taken, by many tasks."""
    uri, beside, tasks = _uri(root), SPARE, TASKS

    def empty(batches):
        import os
        import shutil
        import zlib

        from pyarrow import fs

        store, place = fs.FileSystem.from_uri(uri)
        for batch in batches:
            if isinstance(store, fs.LocalFileSystem) and os.path.isdir(place + beside):
                for share in batch.column("id").to_pylist():
                    for name in os.listdir(place + beside):
                        if zlib.crc32(name.encode()) % tasks == share:
                            shutil.rmtree(f"{place}{beside}/{name}", ignore_errors=True)
            yield batch

    spark.range(0, tasks, 1, tasks).mapInArrow(empty, "id bigint").write.format("noop").mode("overwrite").save()


@check("s5_csv_round_trip", "SELECT img, ignition, p_ignition, log_pred FROM pred")
def csv_round_trip(t: Tables):
    path = _folder(t, "csv")
    A.write_csv(t.pred.select("img", "ignition", "p_ignition", "log_pred"), path)
    return A.read_csv(t.spark, path, T.StructType.fromDDL("img bigint, ignition int, p_ignition double, log_pred double"))
