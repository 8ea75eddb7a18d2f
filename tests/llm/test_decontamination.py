from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from emberline.llm.decontamination import contaminated_pairs, decontaminated, tile, tokens

from .corpus import frame, prose

BENCH = "item_id long, text string, id long, seed string, item string"


def greedy(item, text, least):
    """Greedy string tiling by definition: the longest open common run, again and again."""
    in_item, in_text, covered = [False] * len(item), [False] * len(text), 0
    while True:
        best = (least - 1, 0, 0)
        for a in range(len(item)):
            for b in range(len(text)):
                k = 0
                while a + k < len(item) and b + k < len(text) and item[a + k] == text[b + k] and not in_item[a + k] and not in_text[b + k]:
                    k += 1
                if k > best[0]:
                    best = (k, a, b)
        k, a, b = best
        if k < least:
            return covered
        in_item[a : a + k] = [True] * k
        in_text[b : b + k] = [True] * k
        covered += k


def test_tiles_against_the_definition():
    rng = np.random.default_rng(4)
    for _ in range(150):
        item = rng.integers(0, 4, rng.integers(0, 25)).astype(np.uint64)
        text = rng.integers(0, 4, rng.integers(0, 40)).astype(np.uint64)
        tiles = tile(item, text, 3)
        for side in (0, 1):
            taken = [p for t in tiles for p in range(t[side], t[side] + t[2])]
            assert len(taken) == len(set(taken))
        assert all((item[a : a + n] == text[b : b + n]).all() and n >= 3 for a, b, n in tiles)
        lengths = [n for _, _, n in tiles]
        assert lengths == sorted(lengths, reverse=True) or sum(lengths) >= 3
        # Which of several equally long runs goes first may differ; the longest tile may not.
        longest = max((n for _, _, n in tiles), default=0)
        want = next((k for k in range(min(len(item), len(text)), 2, -1) if any((item[a : a + k] == text[b : b + k]).all() for a in range(len(item) - k + 1) for b in range(len(text) - k + 1))), 0)
        assert longest == want
        if len(set(item.tolist())) == len(item):
            assert sum(lengths) == greedy(item.tolist(), text.tolist(), 3)


def make(spark, items):
    return spark.createDataFrame([(i, t, 1, "s", "i") for i, t in items], BENCH)


def cover(item, text, least):
    a, b = (tokens(pa.array([t], pa.string())).hashes for t in (item, text))
    return sum(n for _, _, n in tile(a, b, least)), len(a)


def test_reordered_passages_and_clean_documents(spark):
    rng = random.Random(6)
    items = [(i, prose(rng, rng.randrange(15, 60), 5000)) for i in range(30)] + [(40, None), (41, ""), (42, "too short"), (None, "x y z u v w")]
    docs = [prose(rng, 300, 5000) for _ in range(40)]
    leaked = {}
    for k in range(0, 20):
        words = items[k][1].split()
        cut = len(words) // 2
        passage = [words, words[cut:] + ["and", "then"] + words[:cut], words[: len(words) // 4], [w.upper() + "," for w in words]][k % 4]
        docs[k] = docs[k] + "\n" + " ".join(passage) + "\n" + docs[k]
        if k % 4 != 2:
            leaked[k] = k
    docs += [None, "", " ".join(w for _, t in items[:3] for w in t.split())]
    frame_ = frame(spark, docs)
    found = contaminated_pairs(frame_, make(spark, items)).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    want = {
        (d, i) for d, text in enumerate(docs) for i, item in items if i is not None and item and text
        for covered, n in [cover(item, text, 5)] if covered and covered >= 0.5 * n
    }
    assert got == want >= {(d, i) for d, i in leaked.items()} | {(42, 0), (42, 1), (42, 2)}
    assert all(r.coverage == r.covered_tokens / r.item_tokens for r in found)
    kept = decontaminated(frame_, make(spark, items))
    assert kept.columns == frame_.columns
    assert {r.doc_id for r in kept.collect()} == set(range(len(docs))) - {d for d, _ in got}


def test_empty_tables_null_and_repeated_ids(spark):
    text = "one two three four five six seven"
    bench = make(spark, [(1, text), (1, text)])
    rows = contaminated_pairs(frame(spark, [text, text, text, "x " * 200_000 + text], [None, 3, 3, 4]), bench).collect()
    assert sorted((r.doc_id, r.item_id, r.coverage) for r in rows) == [(3, 1, 1.0), (4, 1, 1.0)]
    assert contaminated_pairs(frame(spark, []), bench).collect() == []
    assert contaminated_pairs(frame(spark, [text]), make(spark, [])).collect() == []


def test_decontaminated_goes_by_id_and_text(spark):
    import random

    from emberline.llm.decontamination import decontaminated

    from .corpus import frame, prose

    rng = random.Random(8)
    item = prose(rng, 40, 5000)
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(3, "clean words here"), (3, prose(rng, 60) + " " + item), (None, item), (None, None), (5, "")]
    kept = decontaminated(frame(spark, [t for _, t in rows], [i for i, _ in rows]), benchmark)
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(3, "clean words here"), (None, None), (5, "")], key=str)
    assert decontaminated(frame(spark, []), benchmark).collect() == []
