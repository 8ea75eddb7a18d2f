"""Benchmark decontamination by greedy string tiling.

Documents and items that share a seed (``least`` consecutive tokens) are joined. For each such pair
the longest common runs of tokens that no earlier tile covers are marked, longest first, found by
running Karp-Rabin over windows of falling length. The share of the item under tiles counts, not
their order, so a passage whose parts were moved is caught as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NOT_ALNUM, Words, map_batches, query, sized_join, stage, table, text_chunks, windows, with_row_key

#: Tokens of the shortest tile, and of a seed.
LEAST = 5
#: Share of an item's tokens under tiles from which a document counts as contaminated.
COVERAGE = 0.5
#: Places of the filter for seeds; at most so many integers reach the driver.
PLACES = 1 << 22


def tokens(texts: pa.Array) -> Words:
    """Tokens: runs of ASCII letters and digits and of other characters than ASCII, A-Z as a-z."""
    return Words(texts, lower=True, separators=NOT_ALNUM)


def _open_windows(marked: np.ndarray, n: int) -> np.ndarray:
    """Starts of the windows of ``n`` tokens without a marked one."""
    sums = np.concatenate([[0], np.cumsum(marked)])
    return np.flatnonzero(sums[n:] == sums[:-n])


def tile(item: np.ndarray, text: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """Tiles (start in item, start in text, length) of the greedy tiling of two token sequences.

    Longer matches are marked before shorter ones; of equal length, the one that starts first in
    the item, then in the text. Two tiles never overlap in either sequence.
    """
    tiles: list[tuple[int, int, int]] = []
    if len(item) < least or len(text) < least:
        return tiles
    in_item, in_text = np.zeros(len(item), bool), np.zeros(len(text), bool)
    size = 1 << (len(item).bit_length() - 1)
    while True:
        size = max(size, least)
        # Matches of at least ``size`` tokens, each extended to the right as far as both stay open.
        found: list[tuple[int, int, int]] = []
        for a, b in _seeds(item, text, in_item, in_text, size):
            if a and b and not in_item[a - 1] and not in_text[b - 1] and item[a - 1] == text[b - 1]:
                continue  # the match starts further left
            room = min(len(item) - a, len(text) - b)
            stop = (item[a : a + room] != text[b : b + room]) | in_item[a : a + room] | in_text[b : b + room]
            length = int(np.argmax(stop)) if stop.any() else room
            if length >= size:
                found.append((-length, a, b))
        queue = sorted(set(found), reverse=True)
        while queue:
            length, a, b = queue.pop()
            length = -length
            taken = in_item[a : a + length] | in_text[b : b + length]
            if taken.any():
                # What earlier tiles left of it waits for its turn, or for a smaller window.
                for lo, hi in _runs(~taken):
                    if hi - lo >= size:
                        _put(queue, (-(hi - lo), a + lo, b + lo))
                continue
            in_item[a : a + length] = in_text[b : b + length] = True
            tiles.append((a, b, length))
        if size == least:
            return tiles
        size //= 2


def _put(queue: list[tuple[int, int, int]], match: tuple[int, int, int]) -> None:
    """Insert into a list kept in falling order, so that the next to mark is at its end."""
    lo, hi = 0, len(queue)
    while lo < hi:
        mid = (lo + hi) // 2
        lo, hi = (mid + 1, hi) if queue[mid] > match else (lo, mid)
    queue.insert(lo, match)


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def _seeds(item: np.ndarray, text: np.ndarray, in_item: np.ndarray, in_text: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Pairs of equal open windows of ``size`` tokens, compared token by token."""
    if len(item) < size or len(text) < size:
        return
    ours, theirs = _open_windows(in_item, size), _open_windows(in_text, size)
    keys, hashes = windows(item, size)[ours], windows(text, size)[theirs]
    hit = np.isin(hashes, keys)
    at: dict[int, list[int]] = {}
    for key, a in zip(keys.tolist(), ours.tolist(), strict=True):
        at.setdefault(key, []).append(a)
    for key, b in zip(hashes[hit].tolist(), theirs[hit].tolist(), strict=True):
        for a in at[key]:
            if np.array_equal(item[a : a + size], text[b : b + size]):
                yield a, b


def _seed_rows(least: int, allowed: np.ndarray | None):
    """Distinct seed hashes per text, with the number of tokens; only places that ``allowed`` has."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            words = tokens(batch.column("text"))
            hashes = windows(words.hashes, least)
            owner = np.searchsorted(words.first, np.arange(len(hashes)), "right") - 1
            inside = np.arange(len(hashes)) + least <= words.first[owner + 1] if len(hashes) else np.zeros(0, bool)
            if allowed is not None:
                inside &= allowed[(hashes % np.uint64(PLACES)).astype(np.int64)]
            at = np.flatnonzero(inside)
            sizes = np.diff(words.first)
            found = np.unique(np.rec.fromarrays([owner[at], hashes[at].view(np.int64)], names="owner,seed")) if len(at) else None
            if found is not None:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(found.owner)), pa.array(found.seed), pa.array(sizes[found.owner])], ["id", "seed", "tokens"]
                )

    return rows


def contaminated_pairs(
    docs: DataFrame, benchmark: DataFrame, least: int = LEAST, coverage: float = COVERAGE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, item_id, item_tokens, covered_tokens, tiles, coverage of each contaminated document and item.

    A pair is contaminated when tiles of at least ``least`` tokens cover at least ``coverage`` of
    the item. Null and empty texts, and items shorter than ``least`` tokens, match nothing. Items
    and documents with null ids are left out; repeated rows of an id count once, with each of their
    texts tried and the best coverage kept. Other columns are ignored.
    """
    documents = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id IS NOT NULL AND text IS NOT NULL")
    items = stage(benchmark.select(F.col("item_id").cast("long").alias("id"), "text").where("id IS NOT NULL AND text IS NOT NULL").distinct())
    schema = "id long, seed long, tokens long"
    seeds = stage(map_batches(items, _seed_rows(least, None), schema).select("seed", F.col("id").alias("item_id"), F.col("tokens").alias("item_tokens")).distinct())
    allowed = np.zeros(PLACES, bool)
    # Unsigned remainder of a power of two: the low bits.
    used = seeds.select(F.col("seed").bitwiseAND(F.lit(PLACES - 1)).alias("place")).distinct().toArrow()
    allowed[used["place"].to_numpy()] = True
    found = map_batches(documents, _seed_rows(least, allowed), schema).select("id", "seed")
    pairs = sized_join(found, seeds, ["seed"], "inner").groupBy("id", "item_id").agg(F.countDistinct("seed").alias("shared"), F.max("item_tokens").alias("item_tokens"))
    # Each shared seed covers ``least`` tokens at most per place; a seed may stand at several places of the item.
    places = map_batches(items, _seed_places(least), "item_id long, most long").groupBy("item_id").agg(F.max("most").alias("most"))
    possible = sized_join(pairs, stage(places), ["item_id"], "inner").where(F.col("shared") * F.col("most") * least >= F.col("item_tokens") * coverage)
    named = sized_join(possible.select("id", "item_id"), items.select(F.col("id").alias("item_id"), F.col("text").alias("item")), ["item_id"], "inner")
    wanted = stage(named.groupBy("id").agg(F.collect_list(F.struct("item_id", "item")).alias("items")))

    def tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            words = tokens(batch.column("text"))
            for k, (doc, items) in enumerate(zip(batch.column("id").to_pylist(), batch.column("items").to_pylist(), strict=True)):
                text = words.hashes[words.first[k] : words.first[k + 1]]
                own = tokens(pa.array([entry["item"] for entry in items], pa.string()))
                for j, entry in enumerate(items):
                    item = own.hashes[own.first[j] : own.first[j + 1]]
                    tiles = tile(item, text, least)
                    covered = sum(length for _, _, length in tiles)
                    if covered and covered >= coverage * len(item):
                        out.append((doc, entry["item_id"], len(item), covered, len(tiles), covered / len(item)))
            if out:
                kinds = [pa.int64()] * 5 + [pa.float64()]
                names = ["doc_id", "item_id", "item_tokens", "covered_tokens", "tiles", "coverage"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)

    joined = sized_join(documents, wanted, ["id"], "inner").select("id", "text", "items")
    rows = map_batches(joined, tiled, "doc_id long, item_id long, item_tokens long, covered_tokens long, tiles long, coverage double")
    best = F.max(F.struct("coverage", "covered_tokens", "item_tokens", "tiles"))
    rows = rows.groupBy("doc_id", "item_id").agg(best.alias("best"))
    return rows.select("doc_id", "item_id", *[f"best.{c}" for c in ("item_tokens", "covered_tokens", "tiles", "coverage")])


def _seed_places(least: int):
    """Per item text, at how many places its most repeated seed stands."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = tokens(batch.column("text"))
            most = []
            for k in range(len(words)):
                hashes = windows(words.hashes[words.first[k] : words.first[k + 1]], least)
                most.append(int(np.unique(hashes, return_counts=True)[1].max()) if len(hashes) else 0)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(most, pa.int64())], ["item_id", "most"])

    return rows


def decontaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is not in a contaminated pair, all columns kept.

    Rows go by id and text: of rows that share an id only those with a contaminated text go, and rows
    without an id are judged like others. Null texts stay, and so does an empty table.
    """
    keyed, key = with_row_key(docs, id_col, text_col)
    pairs = contaminated_pairs(keyed.select(F.col(key), F.col(text_col).alias("text")), benchmark, id_col=key, text_col="text")
    gone = stage(pairs.select(F.col("doc_id").alias(key)).distinct())
    return sized_join(keyed, gone, [key], "left_anti").select(*docs.columns)


@query("op7_decontamination")
def op7_decontamination(spark, sf_dir):
    return contaminated_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
