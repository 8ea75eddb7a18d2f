"""The image inventory: which files a dataset holds, read from listings alone."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import image_date
from ..session import stage

LAYOUTS = {
    # year / fire / date.tif
    "images": r"/(\d{4})/([^/]+)/[^/]+\.tif$",
    # year / fire.hdf5
    "stacks": r"/(\d{4})/([^/]+)\.hdf5$",
}


#: Entries that a task lists before it hands the folders it has not seen to the next round, and folders of a task there.
_TASK_ENTRIES, _TASK_FOLDERS = 50_000, 500


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Path and size of every file below ``root``; no content is read.

    Spark lists and scans with a task for every folder and few files, which takes longer than the
    listing where there are many small ones. Folders that every machine can open by their path are
    listed by a few tasks instead, in rounds: what a task leaves is dealt out to more of them.
    What Spark leaves out, hidden names and empty files, is left out here as well.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = (store.globStatus(path) or []) if store.getUri().getScheme() == "file" else []
    if not len(found):
        listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
        return listing.select("path", F.col("length").alias("size"))
    start = [(s.getPath().toUri().getPath(), None if s.isDirectory() else s.getLen()) for s in found]
    rounds = [spark.createDataFrame(start, "path string, size bigint")]
    while folders := rounds[-1].where("size IS NULL").count():
        tasks = min(folders, max(spark.sparkContext.defaultParallelism, -(-folders // _TASK_FOLDERS)))
        dealt = rounds[-1].where("size IS NULL").select("path").repartition(tasks)
        rounds.append(stage(dealt.mapInArrow(_lister(), "path string, size bigint")))
    files = reduce(DataFrame.unionAll, [r.where("size > 0") for r in rounds])
    return files.select(F.concat(F.lit("file:"), "path").alias("path"), "size")


def _lister():
    """Folders to the files below them; folders beyond the entries of a task come back with a NULL size."""
    most = _TASK_ENTRIES

    def hidden(name: str, folder: bool) -> bool:
        if folder and name.startswith(("_metadata", "_common_metadata")):
            return False
        return name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)

    def run(batches: Iterator) -> Iterator:
        import os

        import pyarrow as pa

        def packed(rows: list):
            columns = zip(*rows, strict=True) if rows else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64()), strict=True)], ["path", "size"])

        seen, rows = 0, []
        for batch in batches:
            left = batch.column("path").to_pylist()
            while left and seen < most:
                with os.scandir(left.pop()) as entries:
                    for entry in entries:
                        seen += 1
                        if hidden(entry.name, folder := entry.is_dir()):
                            continue
                        if folder:
                            left.append(entry.path)
                        elif size := entry.stat().st_size:
                            rows.append((entry.path, size))
                        if len(rows) >= 10_000:
                            yield packed(rows)
                            rows = []
            rows.extend((folder, None) for folder in left)
            yield packed(rows)
            rows = []

    return run


def image_inventory(
    spark: SparkSession, root: str, years: Sequence[int], layout: str = "images"
) -> DataFrame:
    """One row per image file (or per fire stack) of the wanted years."""
    return inventory_of(list_files(spark, root), years, layout)


def inventory_of(files: DataFrame, years: Sequence[int], layout: str = "images") -> DataFrame:
    pattern = LAYOUTS[layout]
    year = F.regexp_extract("path", pattern, 1)
    dated = image_date("path") if layout == "images" else F.lit(None).cast("date")
    return (
        files.where(year != "")
        .select(
            year.cast("int").alias("year"),
            F.regexp_extract("path", pattern, 2).alias("fire"),
            dated.alias("obs_date"),
            "path",
            "size",
        )
        .where(F.col("year").isin([int(y) for y in years]))
    )


def fire_directories(spark: SparkSession, root: str, years: Sequence[int]) -> DataFrame:
    """Directories ``root/year/fire`` by name, also those without files (names only)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    rows = []
    for year in years:
        pattern = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{int(year)}/*")
        for status in pattern.getFileSystem(conf).globStatus(pattern) or []:
            if status.isDirectory():
                rows.append((int(year), status.getPath().getName()))
    return spark.createDataFrame(rows, "year int, fire string")


def inventory_report(
    inventory: DataFrame, years: Sequence[int], fires: DataFrame | None = None
) -> DataFrame:
    """What the inventory lacks: wanted years without images, and known fires without images."""
    spark = inventory.sparkSession
    wanted = spark.createDataFrame([(int(y),) for y in years], "year int")
    seen = inventory.groupBy("year", "fire").agg(F.count(F.lit(1)).alias("images"))
    missing = wanted.join(seen, "year", "left_anti").select(
        "year", F.lit(None).cast("string").alias("fire"), F.lit("year not found").alias("problem")
    )
    if fires is None:
        return missing
    empty = fires.join(seen, ["year", "fire"], "left_anti").select(
        "year", "fire", F.lit("fire contains no images").alias("problem")
    )
    return missing.unionByName(empty)
