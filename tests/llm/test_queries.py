"""Registered queries against DuckDB, and the pipeline against its stages one by one."""

from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from emberline.checks.compare import compare, duck
from emberline.llm.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    assert compare(QUERIES[name](spark, SF), duck(SF), ORACLES[name]) is None


def test_every_operator_has_one_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows(spark, name):
    tables = {"op3_html_text": "pages", "op4_chat_format": "conversations"}
    rows = QUERIES[name](spark, SF).count()
    if name == "op7_decontamination":
        assert rows > 0
    elif name == "op9_best_fit_packing":
        assert rows >= 200
    else:
        assert rows == duckdb.sql(f"SELECT count(*) FROM '{SF}/{tables.get(name, 'documents')}.parquet'").fetchall()[0][0]


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "copies", "near_copies", "leaks", "packing"]
    before = {r.doc_id for r in docs.select("doc_id").collect()}
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stage(step(spark, docs, SF))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        after = {r.doc_id for r in docs.select("doc_id").collect()}
        assert after <= before, name
        before = after
    packed = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == before
