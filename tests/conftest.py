from __future__ import annotations

import datetime
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from emberline.session import local_session

    session = local_session(
        4,
        **{
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("stage")),
            "spark.sql.shuffle.partitions": "4",
        },
    )
    yield session


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def make(spark):
    return lambda rows, schema: frame(spark, rows, schema)


def rasters(years=(2018, 2019, 2020, 2021), fires=2, days=4, seed=3):
    """Small rasters of 23 bands by (year, fire, date): gaps, directions, classes, detections."""
    rng = np.random.default_rng(seed)
    out = {}
    for year in years:
        for f in range(fires):
            height, width = (40, 36) if f % 2 == 0 else (33, 45)
            for d in range(days):
                bands = rng.normal(50, 20, size=(23, height, width))
                for b in (7, 13, 19):
                    bands[b] = rng.uniform(0, 360, size=(height, width))
                bands[16] = rng.integers(1, 18, size=(height, width))
                for b in (0, 3, 9, 16):
                    bands[b][rng.random((height, width)) < 0.05] = np.nan
                fire = np.full((height, width), np.nan)
                hit = rng.random((height, width)) < 0.02
                fire[hit] = rng.integers(0, 24, hit.sum()) * 100 + rng.integers(1, 60, hit.sum())
                bands[22] = fire
                date = datetime.date(year, 7, 1) + datetime.timedelta(days=int(d * 2))
                out[(year, f"fire_{f}", date)] = bands.astype(np.float32)
    return out


def pixel_rows(images):
    for (year, fire, date), bands in images.items():
        _, height, width = bands.shape
        for r in range(height):
            for c in range(width):
                yield (year, fire, date, height, width, r, c, [float(v) for v in bands[:, r, c]])


@pytest.fixture(scope="session")
def images():
    return rasters()


@pytest.fixture(scope="session")
def pixels(spark, images):
    from emberline.schema import PIXELS
    from emberline.session import stage

    return stage(spark.createDataFrame(list(pixel_rows(images)), PIXELS))
