from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from emberline.llm.vector_codes import coded_vectors, compress_vectors, decompressed, distances, nearest, reassign

SCHEMA = "vec_id long, embedding array<float>, label int, key string, codes int, n long, numbers string, distances double"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "k", 1, None, "x", 0.5) for i, v, label in rows], SCHEMA)


def brute(rows, parts, entries, rounds):
    """Plain Lloyd with a whole scan in every round."""
    kept = [(i, [int(np.floor(np.float64(x) * 256)) for x in np.array(v, np.float32)], label) for i, v, label in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    size = len(kept[0][1]) // parts
    seeds = sorted((i, v) for i, v, _ in kept if i is not None)[:entries]
    book = [[v[p * size : (p + 1) * size] for _, v in seeds] for p in range(parts)]

    def assign():
        out = []
        for _, v, _ in kept:
            row = []
            for p in range(parts):
                own = v[p * size : (p + 1) * size]
                row.append(min((sum((a - b) ** 2 for a, b in zip(own, e, strict=True)), k) for k, e in enumerate(book[p])))
            out.append(row)
        return out

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for k in range(len(seeds)):
                members = [v[p * size : (p + 1) * size] for (_, v, _), row in zip(kept, found, strict=True) if row[p][1] == k]
                if members:
                    book[p][k] = [sum(c) // len(members) for c in zip(*members, strict=True)]
    found = assign()
    errors = [sum(d for d, _ in row) for row in found]
    by_label = {}
    for (_, _, label), error in zip(kept, errors, strict=True):
        by_label[label] = by_label.get(label, 0) + error
    sha = hashlib.sha256(",".join(str(x) for part in book for e in part for x in e).encode()).hexdigest()
    return sorted(
        ((i if i is not None else -1, "".join(f"{k:02x}" for _, k in row), error, by_label[label], sha) for (i, _, label), row, error in zip(kept, found, errors, strict=True)),
    )


def collected(df):
    return sorted((r.vec_id if r.vec_id is not None else -1, r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect())


def rows_of(seed, n, width, grid):
    rng = random.Random(seed)
    return [(i, [rng.randrange(-grid, grid) / 64 for _ in range(width)], rng.choice([None, 0, 1, 1, 1])) for i in range(n)]


@pytest.mark.parametrize(("n", "rounds", "grid"), [(300, 2, 9), (40, 2, 200), (300, 5, 200), (300, 3, 2)])
def test_equals_plain_lloyd(spark, n, rounds, grid):
    rows = rows_of(n, n, 32, grid)
    rng = random.Random(1)
    rng.shuffle(rows)
    rows += [(1000, None, 1), (1001, [float("nan")] + [0.0] * 31, 1), (1002, [None] + [0.0] * 31, 0), (1003, [float("-inf")] + [0.0] * 31, 0)]
    rows += [(None, [0.5] * 32, None), (7, [1.0] * 32, 1), (7, [1.0] * 32, 1)]
    got = collected(coded_vectors(frame(spark, rows).repartition(7), rounds=rounds))
    assert got == brute(rows, 16, 64, rounds)


def test_empty_tables(spark):
    assert coded_vectors(frame(spark, [])).collect() == []
    assert coded_vectors(frame(spark, [(1, None, 1), (2, [None] * 32, 1)])).collect() == []


def test_one_label_and_one_vector_for_nearly_all(spark):
    rows = [(i, [0.25] * 16, 3) for i in range(500)] + rows_of(5, 30, 16, 9)
    rows = [(i, v, label) for i, (_, v, label) in enumerate(rows)]
    assert collected(coded_vectors(frame(spark, rows))) == brute(rows, 16, 64, 2)


def test_lengths_and_magnitudes_that_cannot_be_coded(spark):
    for rows in ([(1, [0.0] * 30, 1)], [(1, [0.0] * 32, 1), (2, [0.0] * 16, 1)], [(1, [3e30] * 32, 1)]):
        with pytest.raises(Exception):  # noqa: B017
            coded_vectors(frame(spark, rows)).collect()


def test_large_components_are_exact():
    rng = np.random.default_rng(3)
    rows, entries = rng.integers(-(1 << 28), 1 << 28, (50, 4)), rng.integers(-(1 << 28), 1 << 28, (20, 4))
    plain = [[sum((int(a) - int(b)) ** 2 for a, b in zip(r, e, strict=True)) for e in entries] for r in rows]
    assert distances(rows, entries).tolist() == plain


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 9), st.floats(0, 1))
def test_active_entries_give_the_whole_scan(seed, entries, share):
    rng = np.random.default_rng(seed)
    rows, old = rng.integers(-3, 3, (40, 2)), rng.integers(-3, 3, (entries, 2))
    at, d = nearest(rows, old)
    new = old.copy()
    for k in np.flatnonzero(rng.random(entries) < share):
        new[k] = rng.integers(-3, 3, 2)
    got = reassign(rows, new, (new != old).any(1), at, d)
    want = nearest(rows, new)
    assert got[0].tolist() == want[0].tolist() and got[1].tolist() == want[1].tolist()


def test_codes_stand_for_their_entries(spark):
    rows = rows_of(2, 64, 32, 50)
    coded, book = compress_vectors(frame(spark, rows), rounds=0)
    back = {r.vec_id: r.embedding for r in decompressed(coded, book).collect()}
    assert all(np.allclose(back[i], np.floor(np.array(v) * 256) / 256) for i, v, _ in rows)
