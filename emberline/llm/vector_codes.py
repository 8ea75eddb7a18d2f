"""Vector code compression: one codebook per part of the vector, trained by active-entry Lloyd.

Every pass stores, per row, the entry each part is assigned to and its exact squared distance. In the
next pass a part whose entry did not move keeps both and is compared with the moved entries only;
every other part is compared with the whole codebook. Rows stay where they are: a pass is one scan,
and only sums per (part, entry, position) are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import hot_split_join
from .common import map_batches, query, stage, table

#: Scaled components of larger magnitude are an error: their distances could leave 64 bits.
PEAK = 1 << 28
#: Rows compared with a codebook at once.
BLOCK_ROWS = 4096

CODED = "vec_id long, label_key string, numbers array<int>, codes binary, distances array<long>"


def usable(vectors: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is there and has finite components only."""

    def bad(x: F.Column) -> F.Column:
        return x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))

    return vectors.where(F.col(vector).isNotNull()).where(~F.coalesce(F.exists(vector, bad), F.lit(True)))


def scaled(vectors: DataFrame, id_col: str, vector: str, label: str, scale: int) -> DataFrame:
    """vec_id, label_key (null without a label) and floor(scale * x) of the usable vectors."""

    def whole(x: F.Column) -> F.Column:
        # Parquet has floats; their product with a power of two is exact in double.
        y = F.floor(x.cast("double") * float(scale))
        return F.when(F.abs(x.cast("double") * float(scale)) <= PEAK, y).otherwise(F.raise_error(F.lit(f"a component beyond {PEAK} / {scale}"))).cast("int")

    return usable(vectors, vector).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label_key"), F.transform(vector, whole).alias("numbers")
    )


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """The rows' numbers as a matrix of integers."""
    column = batch.column("numbers")
    numbers = column.flatten().to_numpy(zero_copy_only=False)
    if len(numbers) != len(column) * width or (len(column) and (np.diff(column.offsets.to_numpy()) != width).any()):
        raise ValueError(f"vectors of other lengths than {width}")
    return numbers.reshape(len(column), width)


def distances(rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of some integer rows to some entries."""
    peak = max(int(np.abs(rows).max(initial=0)), int(np.abs(entries).max(initial=0)))
    kind = np.float64 if 4 * max(1, rows.shape[1]) * peak * peak < 1 << 53 else np.int64
    r, e = rows.astype(kind), entries.astype(kind)
    return ((r * r).sum(1)[:, None] - 2 * (r @ e.T) + (e * e).sum(1)).astype(np.int64)


def nearest(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each row, the lowest index of equally near ones, and its squared distance."""
    d = distances(rows, entries)
    at = d.argmin(1)
    return at, d[np.arange(len(rows)), at]


def reassign(rows: np.ndarray, entries: np.ndarray, moved: np.ndarray, at: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``nearest`` for rows whose nearest entry and distance before the entries ``moved`` are known."""
    at, d = at.copy(), d.copy()
    active = np.flatnonzero(moved)
    lost = moved[at]
    if lost.any():
        at[lost], d[lost] = nearest(rows[lost], entries)
    kept = np.flatnonzero(~lost)
    if len(kept) and len(active):
        to, near = nearest(rows[kept], entries[active])
        to = active[to]
        better = (near < d[kept]) | ((near == d[kept]) & (to < at[kept]))
        at[kept[better]], d[kept[better]] = to[better], near[better]
    return at, d


def _pass(entries: np.ndarray, moved: np.ndarray | None):
    """Task of one pass; entries: part x entry x position, moved: part x entry, None in the first pass."""
    parts, _, size = entries.shape

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, len(whole), BLOCK_ROWS):
                batch = whole.slice(lo, BLOCK_ROWS)
                rows = _matrix(batch, parts * size).reshape(len(batch), parts, size)
                codes, far = np.empty((len(batch), parts), np.uint8), np.empty((len(batch), parts), np.int64)
                if moved is not None:
                    old = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(codes.shape).astype(np.int64)
                    known = batch.column("distances").flatten().to_numpy(zero_copy_only=False).reshape(far.shape)
                for p in range(parts):
                    if moved is None:
                        codes[:, p], far[:, p] = nearest(rows[:, p], entries[p])
                    else:
                        codes[:, p], far[:, p] = reassign(rows[:, p], entries[p], moved[p], old[:, p], known[:, p])
                offsets = pa.array(np.arange(0, far.size + 1, parts, dtype=np.int32))
                columns = [batch.column(c) for c in ("vec_id", "label_key", "numbers")]
                columns += [pa.array([row.tobytes() for row in codes], pa.binary()), pa.ListArray.from_arrays(offsets, pa.array(far.ravel()))]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label_key", "numbers", "codes", "distances"])

    return assign


def entry_sums(coded: DataFrame, parts: int, entries: int, size: int) -> dict[tuple[int, int], list[int]]:
    """(part, entry) -> its count and its sums by position; one partial row set per task."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts, entries, 1 + size), np.int64)
        for whole in batches:
            for lo in range(0, len(whole), BLOCK_ROWS):
                batch = whole.slice(lo, BLOCK_ROWS)
                rows = _matrix(batch, parts * size).reshape(len(batch), parts, size)
                codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(len(batch), parts)
                for p in range(parts):
                    sums[p, :, 0] += np.bincount(codes[:, p], minlength=entries)
                    for j in range(size):
                        # Sums of a block stay below 2**53, so those of doubles are exact.
                        sums[p, :, 1 + j] += np.bincount(codes[:, p], rows[:, p, j], entries).astype(np.int64)
        where = np.nonzero(sums[:, :, 0])
        found = sums[where]
        place = np.tile(np.arange(1 + size), len(found))
        columns = [np.repeat(where[0], 1 + size), np.repeat(where[1], 1 + size), place, found.ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["part", "entry", "place", "value"])

    partial = map_batches(coded.select("numbers", "codes"), add, "part long, entry long, place long, value long")
    total = partial.groupBy("part", "entry", "place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    out: dict[tuple[int, int], list[int]] = {}
    for r in total.collect():
        out.setdefault((r["part"], r["entry"]), [0] * (1 + size))[r["place"]] = int(r["value"])
    return out


def compress_vectors(
    vectors: DataFrame,
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> tuple[DataFrame, np.ndarray]:
    """Stored (vec_id, label_key, numbers, codes, distances) and the codebooks, part x entry x position.

    Rows without a vector, or with a null or non-finite component, are dropped; the others must have
    one length that ``parts`` divides, and components of at most 2**28 / ``scale``, or the job fails.
    The first entries are those of the smallest ids, rows of equal id in the order of their numbers;
    rows without an id are coded but found no entry. With fewer rows than ``entries`` there are as
    many entries as rows with an id; no such row at all gives an empty table and empty codebooks.
    Equal rows get equal codes; other columns are ignored. On the driver: one codebook set.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has one byte, so 1 to 256 entries")
    state = stage(scaled(vectors, id_col, vector_col, label_col, scale))
    first = state.where("vec_id IS NOT NULL").orderBy("vec_id", "numbers").select("numbers").limit(entries).collect()
    width = len(first[0]["numbers"]) if first else 0
    if width % parts:
        raise ValueError(f"{parts} parts do not divide a length of {width}")
    size = width // parts
    book = np.array([r["numbers"] for r in first], np.int64).reshape(len(first), parts, size).transpose(1, 0, 2)
    if not first:
        return stage(state.where("false").selectExpr("*", "CAST(NULL AS BINARY) AS codes", "CAST(NULL AS ARRAY<BIGINT>) AS distances")), book
    moved = None
    for _ in range(rounds):
        state = stage(map_batches(state, _pass(book, moved), CODED))
        new = book.copy()
        for (p, e), (n, *sums) in entry_sums(state, parts, len(first), size).items():
            new[p, e] = [s // n for s in sums]
        moved, book = (new != book).any(2), new
    return stage(map_batches(state, _pass(book, moved), CODED)), book


def decompressed(coded: DataFrame, book: np.ndarray, scale: int = 256) -> DataFrame:
    """vec_id and the vector its codes stand for (entries' lower corners over ``scale``)."""
    parts, _, size = book.shape

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(len(batch), parts)
            values = (book[np.arange(parts), codes] / scale).astype(np.float32).ravel()
            offsets = pa.array(np.arange(0, len(values) + 1, parts * size, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.ListArray.from_arrays(offsets, pa.array(values))], ["vec_id", "embedding"])

    return map_batches(coded.select("vec_id", "codes"), read, "vec_id long, embedding array<float>")


def book_sha256(book: np.ndarray) -> str:
    """Lowercase hex digest of all entries' components by part, entry and position."""
    import hashlib

    return hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()


def coded_vectors(vectors: DataFrame, **settings) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every row that ``compress_vectors`` keeps.

    ``label_error`` sums over rows of equal label, those without one together. Sums by label are
    combined before they are shuffled, and labels with a fixed share of the rows leave their key
    when the sums are looked up.
    """
    coded, book = compress_vectors(vectors, **settings)
    error = F.aggregate("distances", F.lit(0).cast("long"), lambda a, x: a + x)
    # Rows without a label have an empty key of their own.
    key = F.concat(F.when(F.col("label_key").isNull(), "").otherwise("="), F.coalesce("label_key", F.lit("")))
    rows = coded.select("vec_id", F.lower(F.hex("codes")).alias("code"), error.alias("error"), key.alias("key"))
    sums = rows.groupBy("key").agg(F.sum("error").alias("label_error"), F.count("*").alias("n"))
    found = hot_split_join(rows, sums, ["key"], "n", ["label_error"], ["vec_id", "code"])
    return found.select("vec_id", "code", "error", "label_error", F.lit(book_sha256(book)).alias("codebooks_sha256"))


def _sql(rounds: int = 2) -> str:
    ctes = [
        "v AS (SELECT vec_id, label, embedding FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        "c AS (SELECT vec_id, i // (len(embedding) // 16) AS p, i % (len(embedding) // 16) AS j, CAST(floor(256 * CAST(embedding[i + 1] AS DOUBLE)) AS BIGINT) AS x"
        " FROM (SELECT vec_id, embedding, unnest(range(len(embedding))) AS i FROM v))",
        "f AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS k FROM v QUALIFY k < 64)",
        "b0 AS (SELECT p, k, j, x FROM c JOIN f USING (vec_id))",
    ]
    for r in range(rounds + 1):
        ctes.append(
            f"d{r} AS (SELECT c.vec_id, c.p, b.k, sum((c.x - b.x) * (c.x - b.x)) AS d FROM c JOIN b{r} b ON b.p = c.p AND b.j = c.j GROUP BY ALL)"
        )
        ctes.append(f"a{r} AS (SELECT vec_id, p, k, d FROM d{r} QUALIFY row_number() OVER (PARTITION BY vec_id, p ORDER BY d, k) = 1)")
        if r < rounds:
            ctes.append(f"m{r} AS (SELECT a.p, a.k, c.j, CAST(sum(c.x) AS BIGINT) AS s, count(*) AS n FROM a{r} a JOIN c USING (vec_id, p) GROUP BY ALL)")
            ctes.append(
                f"b{r + 1} AS (SELECT p, k, j, CASE WHEN n IS NULL THEN x ELSE (s - ((s % n) + n) % n) // n END AS x FROM b{r} LEFT JOIN m{r} USING (p, k, j))"
            )
    return (
        "WITH "
        + ",\n".join(ctes)
        + f""",
e AS (SELECT vec_id, string_agg(printf('%02x', CAST(k AS INT)), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id),
h AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, k, j)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM e JOIN v USING (vec_id), h"""
    )


@query("op11_vector_codes", _sql())
def op11_vector_codes(spark, sf_dir):
    return coded_vectors(table(spark, sf_dir, "embeddings"))
