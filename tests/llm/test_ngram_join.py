from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from emberline.llm.components import components
from emberline.llm.ngram_join import apart, ngram_components, one_of_each, shingle_sets, similar

from .corpus import frame, lowered, prose, words


def brute(ids, texts, n, num, den):
    sets = []
    for text in texts:
        ws = words(lowered(text))
        sets.append({tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)} if len(ws) >= n else ({tuple(ws)} if ws else set()))
    label = list(range(len(ids)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and den * both >= num * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)), key=lambda k: ids[k])
                label[b] = a
    return sorted((ids[i], len(sets[i]), ids[root(i)]) for i in range(len(ids)))


def variants(rng, text, k, edits):
    out = []
    for _ in range(k):
        ws = text.split()
        for _ in range(rng.randrange(edits + 1)):
            ws[rng.randrange(len(ws))] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(ws))
    return out


@pytest.mark.parametrize(("n", "num"), [(4, 85), (5, 80), (2, 50)])
def test_against_all_pairs(spark, n, num):
    rng = random.Random(n)
    texts = [None, "", "   ", "one", "ONE", "one two", "Two one", "a b c d", "A  B\tC\nD", prose(rng, 3000)]
    for size in (12, 40, 80, 200):
        base = prose(rng, size)
        texts += variants(rng, base, 14, max(2, size // 16))
        texts += [base, base.upper(), base + " " + prose(rng, size // 8), " ".join(base.split()[: size - size // 10])]
    texts += [prose(rng, 60, vocabulary=6) for _ in range(10)]
    texts.append(texts[9] + " tail")
    common = prose(rng, 30)
    texts += [common + " " + prose(rng, 25) for _ in range(25)]
    ids = list(range(100, 100 + len(texts)))
    rng.shuffle(ids)
    got = ngram_components(frame(spark, texts, ids), n=n, num=num, den=100)
    assert sorted(tuple(r) for r in got.collect()) == brute(ids, texts, n, num, 100)


def test_edges_of_the_threshold():
    x = np.arange(100, dtype=np.uint64)
    for extra in range(30):
        y = np.concatenate([x, np.arange(1000, 1000 + extra, dtype=np.uint64)])
        assert similar(x, y, 85, 100) == (100 * 100 >= 85 * (100 + extra))


def test_suffix_filter_is_a_lower_bound():
    rng = np.random.default_rng(5)
    for _ in range(300):
        x, y = (np.unique(rng.integers(0, 60, rng.integers(0, 40))).astype(np.uint64) for _ in range(2))
        assert apart(x, y) <= len(np.setxor1d(x, y))


def test_null_and_repeated_ids(spark):
    text = "a b c d e f g h"
    rows = ngram_components(frame(spark, [text, text, text + " ", None, "q"], [None, 4, 4, 2, None])).collect()
    assert sorted(((r.doc_id, r.component_id) for r in rows), key=str) == sorted([(None, 4), (4, 4), (4, 4), (2, 2), (None, None)], key=str)


def test_empty_table(spark):
    assert ngram_components(frame(spark, [])).collect() == []


def test_one_of_each(spark):
    rng = random.Random(3)
    base = prose(rng, 100)
    docs = frame(spark, [base, base + " x", "alone", None], [9, 2, 5, 7])
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 5, 7]


def test_short_text_is_one_shingle_of_its_own_kind():
    sets = shingle_sets(pa.array(["a b", "a b c d", "", None, "A B"]), 4)
    assert [len(s) for s in sets] == [1, 1, 0, 0, 1]
    assert sets[0] == sets[4] and sets[0] != sets[1]


def test_components_of_chains_stars_and_rings(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200 + i, 200 + (i + 1) % 17) for i in range(17)] + [(5, 5), (None, 3)]
    links = [(b, a) if rng.random() < 0.5 else (a, b) for a, b in links]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}, **{200 + i: 200 for i in range(17)}}


def test_near_copies_with_more_shared_shingles_per_group_than_16_bits_hold(spark):
    ws = [f"w{i}" for i in range(600_000)]
    # Frames of their own: the texts stand in different tasks, so in different blocks.
    docs = frame(spark, [" ".join(ws)], [5]).union(frame(spark, [" ".join(ws[:-1]) + " other"], [3]))
    rows = ngram_components(docs.union(frame(spark, ["a b c d e f"], [1]))).collect()
    assert sorted((r.doc_id, r.component_id) for r in rows) == [(1, 1), (3, 3), (5, 3)]


def test_one_of_each_goes_by_id_and_text(spark):
    import random

    from emberline.llm.ngram_join import one_of_each

    from .corpus import frame, prose

    rng = random.Random(3)
    a, b, c = (prose(rng, 200) for _ in range(3))
    rows = [(4, a), (4, b), (2, a + " more"), (None, b + " more"), (None, c), (8, None), (8, ""), (6, c + " x")]
    docs = frame(spark, [t for _, t in rows], [i for i, _ in rows])
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    want = [(2, a + " more"), (4, b), (6, c + " x"), (8, None), (8, "")]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(want, key=str)
    assert one_of_each(frame(spark, [])).collect() == []
