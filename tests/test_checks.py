"""Every registered check with an oracle must agree with DuckDB; the others must give rows."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from emberline.checks.compare import compare, duck

SF = "/root/testdata/sf0.001"
SLOW = ("m", "e21_scored", "h1")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_oracle(spark, con, name):
    assert compare(queries()[name](spark, SF), con, oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_rows(spark, name):
    assert queries()[name](spark, SF).collect()


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["split", "samples", "ignition_rate", "mean_burned_area", "features"]
    assert df.count() == 3


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())
