"""The inventory query keeps the files of some fires only on the disk."""

from __future__ import annotations

import os
from datetime import date
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from emberline.checks import source_checks as C
from emberline.sources import inventory as I


def images_in(folder) -> int:
    return sum(f.endswith(".tif") for _, _, files in os.walk(folder) for f in files)


def test_parts_give_the_whole_inventory_and_leave_no_files(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(C, "staging_root", lambda _: str(tmp_path))
    monkeypatch.setattr(C, "FILES", 10)
    written, touch = [], C._touch

    def counted(names, root):
        touch(names, root)
        written.append(images_in(tmp_path))

    monkeypatch.setattr(C, "_touch", counted)
    rows = [(1994 + i % 4, i % 9, i // 3, i) for i in range(90)]
    img = spark.createDataFrame(rows, "year int, fire bigint, day int, img bigint")
    img = img.withColumn("obs_ts", F.date_add(F.lit("1995-01-01").cast("date"), F.col("day")).cast("timestamp_ntz"))
    got = C.inventory(SimpleNamespace(spark=spark, img=img))
    want = {}
    for year, fire, day, _ in rows:
        if year in (1995, 1996):
            key = (year, f"fire_{fire}", day)
            want[key] = want.get(key, 0) + 1
    found = got.collect()
    assert {(r.year, r.fire, (r.obs_date - date(1995, 1, 1)).days): r.files for r in found} == want and len(found) == len(want)
    assert len(written) == 9 and sum(written) == 90 and max(written) < 45
    assert images_in(tmp_path) == 0


def test_parts_take_the_files_of_the_part_before(spark, tmp_path):
    """New files are made only where the part before has left too few; names and contents are those of the part."""
    root = f"{tmp_path}/raw"

    def part(day: int, images: int):
        rows = [(f"{1995 + f % 2}/fire_{f}/1995-01-{day:02d}_{f * 10 + i}.tif",) for f in range(6) for i in range(images)]
        return spark.createDataFrame(rows, "name string").coalesce(1), {r[0] for r in rows}

    def written():
        found = {}
        for folder, _, files in os.walk(root):
            for name in files:
                path = os.path.join(folder, name)
                with open(path, "rb") as f:
                    found[os.path.relpath(path, root)] = (os.stat(path).st_ino, f.read())
        return found

    numbers = set()
    for day, images, new in ((1, 4, 24), (2, 4, 0), (3, 2, 0), (4, 5, 8)):
        os.makedirs(root, exist_ok=True)
        names, want = part(day, images)
        C._touch(names, root)
        got = written()
        assert got.keys() == want and all(content == len(name).to_bytes(4, "little") for name, (_, content) in got.items())
        used = {number for number, _ in got.values()}
        assert len(used - numbers) == new
        numbers |= used
        C._clear(names, root)
        assert not written() and images_in(tmp_path) == 0
    C._empty(spark, root)
    assert not any(files for _, _, files in os.walk(tmp_path))


def test_listing_takes_few_tasks_and_all_files(spark, tmp_path, monkeypatch):
    root = tmp_path / "a root"
    want = {}
    for f in range(120):
        folder = root / str(1995 + f % 3) / f"fire_{f}" / "deep"
        folder.mkdir(parents=True)
        for name in ("1.tif", "_hidden", ".crc", "_a=b", "x._COPYING_", "_metadata"):
            (folder.parent / name).write_bytes(b"x" * (f % 4))
            if name in ("1.tif", "_a=b") and f % 4:
                want[f"file:{folder.parent}/{name}"] = f % 4
        (folder / "2.tif").write_bytes(b"22")
        want[f"file:{folder}/2.tif"] = 2
    for name in ("_temporary", "_metadata_of"):
        (root / name).mkdir()
        (root / name / "3.tif").write_bytes(b"1")
    want[f"file:{root}/_metadata_of/3.tif"] = 1
    spark.sparkContext.setJobGroup("listing", "listing")
    files = I.list_files(spark, str(root))
    got = {r.path: r.size for r in files.collect()}
    tracker = spark.sparkContext.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds}
    tasks = sum(tracker.getStageInfo(s).numTasks for s in stages if tracker.getStageInfo(s))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    old = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(root))
    assert got == want == {r.path: r.length for r in old.select("path", "length").collect()} and files.count() == len(want)
    assert tasks < 60
    monkeypatch.setattr(I, "_TASK_ENTRIES", 50)
    assert {r.path: r.size for r in I.list_files(spark, str(root)).collect()} == want
    assert {r.path for r in I.list_files(spark, f"{root}/199[5-6]").collect()} == {p for p in want if "/1995/" in p or "/1996/" in p}
    with pytest.raises(AnalysisException):
        I.list_files(spark, f"{root}/none")
