from __future__ import annotations

import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from emberline.llm.exact_dedup import deduplicated, exact_dedup

from .corpus import frame, lowered

TEXTS = ["Same Text", "same text", "SAME TEXT", "Ünder", "ünder", None, "", "other", "İstanbul", "x" * 200_000, "X" * 200_000, "K", "k"]
IDS = [5, 3, 9, 1, 2, 4, 6, 7, 8, 10, 11, 12, 13]


def expected(ids, texts):
    groups = defaultdict(list)
    for i, t in zip(ids, texts, strict=True):
        groups[lowered(t)].append(i)
    rows = []
    for i, t in zip(ids, texts, strict=True):
        known = [x for x in groups[lowered(t)] if x is not None]
        keep = max(known) if known else None
        rows.append((i, keep, len(groups[lowered(t)]), i is not None and i == keep, hashlib.sha256(lowered(t).encode()).hexdigest()))
    return sorted(rows, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_groups_nulls_and_long_texts(spark):
    assert got(exact_dedup(frame(spark, TEXTS, IDS))) == expected(IDS, TEXTS)


def test_null_ids_and_repeated_rows(spark):
    ids, texts = [None, 1, 1, None, 2], ["a", "A", "a", "z", "b"]
    assert got(exact_dedup(frame(spark, texts, ids))) == expected(ids, texts)


def test_a_weak_digest_never_joins_different_texts(spark):
    ids = list(range(60))
    texts = [f"t{i % 7}" if i % 2 else f"{i % 5}" * (1 + i % 3) for i in ids]
    weak = exact_dedup(frame(spark, texts, ids), digest=lambda c: F.length(c).cast("string"), hot_share=0.2)
    assert got(weak) == expected(ids, texts)


def test_hot_groups_take_the_salted_way(spark):
    ids = list(range(300))
    texts = ["hot" if i % 3 else f"cold {i // 6}" for i in ids]
    assert got(exact_dedup(frame(spark, texts, ids), hot_share=0.05)) == expected(ids, texts)


def test_empty_table(spark):
    assert exact_dedup(frame(spark, [])).collect() == []


def test_deduplicated_keeps_columns(spark):
    docs = frame(spark, TEXTS, IDS)
    kept = deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in expected(IDS, TEXTS) if r[3])


def test_rows_go_by_id_and_text(spark):
    rows = [(5, "alpha"), (5, "beta"), (9, "Beta"), (None, "ALPHA"), (None, "gamma"), (None, "gamma"), (7, "delta"), (7, "delta"), (2, None), (3, "")]
    docs = frame(spark, [t for _, t in rows], [i for i, _ in rows])
    kept = deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(5, "alpha"), (9, "Beta"), (None, "gamma"), (7, "delta"), (3, "")], key=str)
    assert deduplicated(frame(spark, [])).collect() == []
