"""Small images leave a task together and are dealt out before they are decoded; the stacks are the same."""

from __future__ import annotations

import datetime

import numpy as np
from pyspark.sql import functions as F

from emberline.schema import IMAGE_KEY
from emberline.sources import rasters as R


def decoder():
    def decode(content):
        import io

        import numpy as np

        raster = np.load(io.BytesIO(content))
        return (raster, (float(raster[0, 0, 0]), None)) if raster.size else raster

    return decode


def stored(spark, images):
    import io

    rows = []
    for (year, fire, day), raster in images.items():
        buffer = io.BytesIO()
        np.save(buffer, raster)
        rows.append((year, fire, datetime.date(2000, 1, 1) + datetime.timedelta(days=day), bytearray(buffer.getvalue())))
    return spark.createDataFrame(rows, "year int, fire string, obs_date date, content binary")


def made(shapes):
    rng = np.random.default_rng(5)
    return {k: rng.integers(0, 2400, size=(23, *shape)).astype(np.float32) for k, shape in shapes.items()}


def test_images_of_all_sizes_keep_their_pixels(spark):
    shapes = {(2000 + i % 3, f"f{i % 5}", i): (1 + i % 7, 1 + i % 11) for i in range(300)}
    shapes |= {(2000, "large", 1): (300, 100), (2000, "large", 2): (130, 127), (2001, "empty", 1): (0, 4)}
    images = made(shapes)
    files = stored(spark, images).coalesce(1)
    files = files.withColumn("day_index", F.col("year").cast("bigint")).withColumn("fire_days", F.lit(None).cast("bigint"))
    batches = []
    pixels = R.decode_rows(files, decoder())
    for r in pixels.groupBy(*IMAGE_KEY).agg(F.array_sort(F.collect_list(F.struct("r", "c", "bands", "height", "width", "lng", "lat", "day_index", "fire_days"))).alias("px")).collect():
        raster = images.pop((r.year, r.fire, (r.obs_date - datetime.date(2000, 1, 1)).days))
        _, height, width = raster.shape
        assert [(p.r, p.c) for p in r.px] == [(i, j) for i in range(height) for j in range(width)]
        np.testing.assert_array_equal(np.array([p.bands for p in r.px], np.float32).T, raster.reshape(23, -1))
        assert {tuple(p)[3:] for p in r.px} == {(height, width, float(raster[0, 0, 0]), None, r.year, None)}
        batches.append(r)
    assert list(images) == [(2001, "empty", 1)] and len(batches) == 302


def test_dealt_stacks_are_those_of_shuffled_pixels(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(R, "_TASK_IMAGES", 20)
    files = stored(spark, made({(2000 + f % 3, f"f{f}", day): (3, 4) for f in range(6) for day in range(0, 50, 2)}))
    placed = files.join(R.image_positions(files.select(*IMAGE_KEY)), IMAGE_KEY)
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    dealt = R.decode_rows(R.deal_images(placed, 150), decoder())
    assert dealt.rdd.getNumPartitions() == 8
    R.write_fire_stacks(dealt, f"{tmp_path}/a", f"{tmp_path}/a_fires", dealt=True)
    R.write_fire_stacks(R.decode_rows(placed, decoder()), f"{tmp_path}/b", f"{tmp_path}/b_fires")
    assert spark.conf.get(name) == before
    for end in ("", "_fires"):
        a, b = (spark.read.parquet(f"{tmp_path}/{x}{end}") for x in "ab")
        assert sorted(map(str, a.collect())) == sorted(map(str, b.select(a.columns).collect())) and a.schema == b.schema
    # A file's rows are in order, and the images of a fire's few days are in one file.
    stacks = spark.read.parquet(f"{tmp_path}/a").withColumn("file", F.input_file_name())
    assert stacks.groupBy("year", "fire", F.expr("day_index div 8")).agg(F.count_distinct("file").alias("n")).where("n > 1").isEmpty()
    rows = stacks.select("file", "fire", "obs_date", "r", "c").collect()
    for file in {r.file for r in rows}:
        keys = [tuple(r)[1:] for r in rows if r.file == file]
        assert keys == sorted(keys)
