from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from emberline.llm.substring_dedup import deep_nodes, without_repeats

from .corpus import frame, prose, words


def brute(texts, window):
    seen = Counter(tuple(ws[i : i + window]) for ws in map(words, texts) for i in range(len(ws) - window + 1))
    out = []
    for ws in map(words, texts):
        gone = set()
        for i in range(len(ws) - window + 1):
            if seen[tuple(ws[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = b" ".join(w for k, w in enumerate(ws) if k not in gone)
        out.append((len(ws), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def check(spark, texts, window, **more):
    rows = without_repeats(frame(spark, texts), window, **more).collect()
    assert [tuple(r)[1:] for r in sorted(rows, key=lambda r: r.doc_id)] == brute(texts, window)


def corpus(seed):
    rng = random.Random(seed)
    passages = [prose(rng, k) for k in (34, 35, 36, 60, 150)]
    texts = [None, "", " \t\n", "short", "a " * 200, "a b " * 90, "Case " * 40, "case " * 40]
    for _ in range(25):
        parts = [prose(rng, rng.randrange(60)) for _ in range(3)]
        for passage in rng.sample(passages, 2):
            parts.insert(rng.randrange(len(parts) + 1), passage)
        texts.append("\n".join(parts))
    return [*texts, texts[-1], texts[-2] + " x", prose(rng, 6000)]


@pytest.mark.parametrize("window", [35, 8, 3])
def test_against_counting_windows(spark, window):
    check(spark, corpus(window), window)


def test_prefixes_grow_where_groups_are_overfull(spark):
    check(spark, corpus(9), 35, memory=20)


def test_equal_rows_and_ids(spark):
    text = " ".join(f"u{i}" for i in range(50))
    rows = without_repeats(frame(spark, [text, text, "v"], [1, 1, None])).collect()
    assert sorted((r.n_words, r.n_removed) for r in rows) == [(1, 0), (50, 50), (50, 50)]


def test_kept_text_and_empty_table(spark):
    text = " ".join(f"u{i}" for i in range(40))
    rows = without_repeats(frame(spark, [text + " end", "begin " + text]), kept_text=True).collect()
    assert sorted(r.kept_text for r in rows) == ["begin", "end"]
    assert without_repeats(frame(spark, [])).collect() == []


def test_deep_nodes_are_labels_that_occur_twice():
    rng = np.random.default_rng(2)
    labels = rng.integers(0, 3, (200, 5)).astype(np.uint32)
    times = Counter(map(tuple, labels.tolist()))
    assert deep_nodes(labels).tolist() == [times[tuple(row)] > 1 for row in labels.tolist()]
