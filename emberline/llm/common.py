"""Helpers shared by the training-data operators: tables, size-checked joins, words and hashes of text batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import stage, stored_bytes

#: A stored table of at most so many bytes on disk may be broadcast; a larger one is shuffled.
BROADCAST_BYTES = 16 << 20
#: Text bytes handled at once inside a task.
CHUNK_BYTES = 4 << 20

#: Bytes of one batch of rows handed to a task's Python side.
BATCH_BYTES = 8 << 20

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``f(spark, sf_dir)`` under ``name`` with its DuckDB SQL, if it has one."""

    def register(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql.strip()
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sized_join(big: DataFrame, stored: DataFrame, on: list[str], how: str, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Join with a stored table: broadcast when its files are small, otherwise shuffled (AQE splits skew)."""
    return big.join(F.broadcast(stored) if stored_bytes(stored) <= limit else stored, on, how)


def with_row_key(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with a 64-bit key of each row's id and text, never null, and the key's name.

    Rows that share an id but not their text have keys of their own, rows equal in both share one.
    """
    name = "row_key"
    while name in docs.columns:
        name += "_"
    known = [F.col(c).isNull() for c in (id_col, text_col)]
    return docs.withColumn(name, F.xxhash64(F.col(id_col).cast("string"), F.col(text_col), *known)), name


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, every other character unchanged."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


# ---------------------------------------------------------------- words and hashes, vectorised over a batch

#: Separators for ``Words`` that leave letters, digits and all non-ASCII characters.
NOT_ALNUM = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])
_RNG = np.random.default_rng(20240611)
_SPACE = np.array([b == 0x20 or 0x09 <= b <= 0x0D for b in range(256)])
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if n <= 1 << 23:
            _powers[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of some texts: ``starts``/``ends`` are byte places in ``data``,
    ``hashes`` 64-bit hashes, and text i has the words ``first[i]:first[i + 1]``."""

    def __init__(self, texts: pa.Array, lower: bool, hashes: bool = True, separators: np.ndarray = _SPACE):
        texts = texts.fill_null("") if texts.null_count else texts
        if pa.types.is_large_string(texts.type):
            kind = np.int64
        else:
            texts, kind = texts.cast(pa.string()), np.int32
        offsets = np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        base, end = int(offsets[0]), int(offsets[-1])
        whole = texts.buffers()[2] if len(texts) else None
        self.data = np.frombuffer(whole, np.uint8)[base:end] if whole is not None and end > base else np.zeros(0, np.uint8)
        self.bounds = offsets.astype(np.int64) - base
        inside = ~separators[self.data]
        n = len(inside)
        begin, stop = inside.copy(), np.zeros(n + 1, bool)
        if n:
            begin[1:] &= ~inside[:-1]
            cuts = self.bounds[(self.bounds > 0) & (self.bounds < n)]
            begin[cuts] = inside[cuts]
            stop[1:n] = inside[:-1] & ~inside[1:]
            stop[n] = inside[-1]
            stop[cuts] = inside[cuts - 1]
        self.starts, self.ends = np.flatnonzero(begin), np.flatnonzero(stop)
        self.first = np.searchsorted(self.starts, self.bounds)
        self.hashes = self._hash(_BYTE_LOWER if lower else _BYTE) if hashes else None

    def _hash(self, values: np.ndarray) -> np.ndarray:
        out = np.empty(len(self.starts), np.uint64)
        at = 0
        while at < len(self.starts):
            lo = int(self.starts[at])
            upto = max(at + 1, int(np.searchsorted(self.ends, lo + (1 << 20), "right")))
            s, e = self.starts[at:upto] - lo, self.ends[at:upto] - lo
            n = int(e[-1])
            sums = np.empty(n + 1, np.uint64)
            sums[0] = 0
            np.cumsum(values[self.data[lo : lo + n]] * _power(_BASE, n), out=sums[1:])
            out[at:upto] = mix((sums[e] - sums[s]) * _power(_INVERSE, n)[s] + (e - s).astype(np.uint64))
            at = upto
        return out

    def __len__(self) -> int:
        return len(self.bounds) - 1


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words (also runs across texts; the caller leaves those out)."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    if n <= 8:
        out = np.zeros(len(hashes) - n + 1, np.uint64)
        for i in range(n):
            out = (out + hashes[i : i + len(out)]) * np.uint64(_BASE)
        return mix(out)
    out = np.empty(len(hashes) - n + 1, np.uint64)
    size = 1 << 18
    for lo in range(0, len(out), size):
        part = hashes[lo : lo + size + n - 1]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * _power(_BASE, len(part)), out=sums[1:])
        m = len(part) - n + 1
        out[lo : lo + m] = mix((sums[n:] - sums[:-n]) * _power(_INVERSE, m))
    return out


def map_batches(df: DataFrame, f, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with batches bounded in bytes, since rows may hold very long texts."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    df.sparkSession.conf.set(name, str(BATCH_BYTES))
    return df.mapInArrow(f, schema)


def text_chunks(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``CHUNK_BYTES`` of text (a longer text stands alone)."""
    for batch in batches:
        texts = batch.column(column)
        if not len(texts):
            continue
        sizes = np.nan_to_num(np.array(pc.binary_length(texts).to_numpy(zero_copy_only=False), float))
        parts = (np.cumsum(sizes) // CHUNK_BYTES).astype(np.int64)
        cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(texts)]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(lo, hi - lo)


def blob(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


__all__ = ["BROADCAST_BYTES", "Words", "blob", "lower_ascii", "map_batches", "mix", "query", "sized_join", "stage", "stored_bytes", "table", "text_chunks", "windows"]
