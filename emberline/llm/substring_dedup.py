"""Removal of repeated passages with prefix-partitioned suffix trees over words.

1. Only suffixes that may have a deep branch are looked at: each window of ``window`` words has an
   anchor, the smallest of its word grams; equal windows have equal anchors, so a window whose anchor
   stands nowhere else in the corpus is unique. Anchors are counted as packed hashes.
2. The suffixes that are left are dealt out by prefix. A prefix is one part of the window (a fifth
   of its words); where more suffixes than ``memory`` start alike, it grows by another part, and so
   on, so each group fits a task. Equal suffixes of one block of texts are sent once.
3. Each group is a subtree: its suffixes are sorted, and the common prefixes of neighbours give the
   inner nodes. All leaves below a node of at least ``window`` words are repeats. Edge labels are
   hashes of the window's parts; words themselves would take ``window`` times the input.
4. Runs of such suffixes are the maximal repeats of a text; their words are removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, blob, map_batches, mix, query, sized_join, stage, stored_bytes, table, text_chunks, windows

WINDOW = 35
#: Parts of a window: the steps in which prefixes grow.
PARTS = 5
#: Suffixes of one group.
MEMORY = 2_000_000
BLOCK_BYTES = 5 << 20
GROUP_BYTES = 16 << 20
#: Bits of a place in a block: more words than a text can hold.
PLACE_BITS = 32


class Block:
    """Consecutive texts of a task, as word hashes, with the anchor of every window."""

    def __init__(self, number: int, ids: list[int], texts: list[np.ndarray], extra: list, window: int):
        self.number, self.ids, self.extra = number, ids, extra
        sizes = np.array([len(t) for t in texts], np.int64)
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        self.words = np.concatenate(texts) if texts else np.zeros(0, np.uint64)
        gram = max(1, min(8, window // 4))
        self.grams = windows(self.words, gram)
        span = window - gram + 1
        if len(self.grams) < span:
            self.starts = self.anchors = np.zeros(0, np.int64)
            return
        places = np.uint64((1 << PLACE_BITS) - 1) - np.arange(len(self.grams), dtype=np.uint64)
        least = (self.grams >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | places
        width = 1
        while width * 2 <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < span:
            least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
        owner = np.repeat(np.arange(len(texts)), sizes)[: len(least)]
        self.starts = np.flatnonzero(np.arange(len(least)) + window <= self.first[owner + 1])
        anchors = (1 << PLACE_BITS) - 1 - (least & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
        self.anchors = anchors[self.starts]
        self.owner = owner[self.starts]


def _blocks(batches: Iterator[pa.RecordBatch], window: int, extra: str | None = None) -> Iterator[Block]:
    task, number = TaskContext.get().partitionId(), 0
    ids: list[int] = []
    texts: list[np.ndarray] = []
    more: list = []
    size = 0
    for batch in text_chunks(batches):
        words = Words(batch.column("text"), lower=False)
        texts += [words.hashes[a:b] for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True)]
        ids += batch.column("rid").to_pylist()
        more += batch.column(extra).to_pylist() if extra else []
        size += batch.column("text").nbytes
        if size >= BLOCK_BYTES or len(ids) > 60_000:
            yield Block((task << 24) + number, ids, texts, more, window)
            ids, texts, more, size, number = [], [], [], 0, number + 1
    if ids:
        yield Block((task << 24) + number, ids, texts, more, window)


ROW = "group long, block long, n long, a binary, b binary, c binary"
NAMES = ["group", "block", "n", "a", "b", "c"]


def _packed(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    for lo in range(0, len(rows), 64):
        columns = list(zip(*rows[lo : lo + 64], strict=True))
        kinds = [pa.int64()] * 3 + [pa.binary()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], NAMES)


def _cuts(group: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Order by group, and (group, from, to) in that order."""
    order = np.argsort(group, kind="stable")
    ranked = group[order]
    if not len(ranked):
        return order, []
    at = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    return order, list(zip(ranked[at].tolist(), at.tolist(), [*at[1:].tolist(), len(ranked)], strict=True))


def repeated_anchors(rows: DataFrame, window: int) -> DataFrame:
    """Stored (rid, anchors): places of the anchors of each text that stand at several places."""
    groups = max(8, -(-stored_bytes(rows) // (4 * GROUP_BYTES)))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, window):
            fresh = np.flatnonzero(np.diff(block.anchors, prepend=-1))
            at, owner = block.anchors[fresh], block.owner[fresh] if len(fresh) else fresh
            hashes = block.grams[at] if len(at) else np.zeros(0, np.uint64)
            places = at - block.first[owner] if len(at) else at
            yield from _packed([(-1 - block.number, block.number, len(at), blob(np.array(block.ids, np.int64)), blob(hashes), blob(np.stack([owner, places]).astype(np.uint32)))])
            own = np.unique(hashes)
            order, cuts = _cuts((own >> np.uint64(32)) % np.uint64(groups))
            yield from _packed([(g, block.number, hi - lo, blob(own[order[lo:hi]]), b"", b"") for g, lo, hi in cuts])

    def count(part: pa.Table) -> pa.Table:
        if part["group"][0].as_py() < 0:
            return part.select(["block", "n", "a", "b", "c"])
        owns = [np.frombuffer(x, np.uint64) for x in part["a"].to_pylist()]
        found, times = np.unique(np.concatenate(owns), return_counts=True)
        found = found[times > 1]
        shared = [blob(own[np.isin(own, found, assume_unique=True)]) for own in owns]
        none = pa.array([b""] * len(owns), pa.binary())
        return pa.table({"block": part["block"].combine_chunks(), "n": pa.array([-1] * len(owns)), "a": pa.array(shared, pa.binary()), "b": none, "c": none})

    def gather(part: pa.Table) -> pa.Table:
        rows = part.to_pylist()
        info = next(r for r in rows if r["n"] >= 0)
        ids, hashes = np.frombuffer(info["a"], np.int64), np.frombuffer(info["b"], np.uint64)
        owner, places = np.frombuffer(info["c"], np.uint32).reshape(2, -1)
        shared = np.concatenate([np.zeros(0, np.uint64), *[np.frombuffer(r["a"], np.uint64) for r in rows if r["n"] < 0]])
        own, times = np.unique(hashes, return_counts=True)
        hit = np.isin(hashes, np.concatenate([shared, own[times > 1]]))
        owner, places = owner[hit], places[hit]
        _, cuts = _cuts(owner)
        return pa.table({"rid": pa.array([int(ids[g]) for g, _, _ in cuts], pa.int64()), "anchors": pa.array([blob(places[lo:hi]) for _, lo, hi in cuts], pa.binary())})

    posted = map_batches(rows, post, ROW)
    counted = posted.groupBy("group").applyInArrow(count, "block long, n long, a binary, b binary, c binary")
    found = counted.groupBy("block").applyInArrow(gather, "rid long, anchors binary")
    return stage(found.dropDuplicates(["rid"]))


def _suffixes(block: Block, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the block's windows with a repeated anchor, the texts they are in, and their labels:
    one hash for each part of the window."""
    wanted = np.zeros(len(block.grams) + 1, bool)
    for k, places in enumerate(block.extra):
        wanted[np.frombuffer(places, np.uint32).astype(np.int64) + block.first[k]] = True
    keep = wanted[block.anchors] if len(block.anchors) else np.zeros(0, bool)
    starts = block.starts[keep]
    steps = np.linspace(0, window, min(PARTS, window) + 1).astype(int)
    labels = np.empty((len(starts), len(steps) - 1), np.uint32)
    if len(starts):
        hashes: dict[int, np.ndarray] = {}
        for j, (lo, hi) in enumerate(zip(steps[:-1].tolist(), steps[1:].tolist(), strict=True)):
            if hi - lo not in hashes:
                hashes[hi - lo] = windows(block.words, hi - lo)
            labels[:, j] = hashes[hi - lo][starts + lo].astype(np.uint32)
    return starts, block.owner[keep] if len(starts) else starts, labels


def _prefix_groups(labels: np.ndarray, depth: int, groups: int) -> np.ndarray:
    """Group of each suffix among those of prefixes of ``depth`` parts."""
    key = np.zeros(len(labels), np.uint64)
    for j in range(depth):
        key = mix(key * np.uint64(31) + labels[:, j].astype(np.uint64) + np.uint64(1))
    return (key % np.uint64(groups)).astype(np.int64) + (depth << 40)


def _group_of(labels: np.ndarray, groups: int, full: list[set[int]]) -> np.ndarray:
    """Group under the shortest prefix that is not in ``full`` (overfull groups by depth)."""
    out = _prefix_groups(labels, 1, groups)
    for depth, over in enumerate(full, start=2):
        more = np.flatnonzero(np.isin(out, list(over)))
        if not len(more) or depth > labels.shape[1]:
            break
        out[more] = _prefix_groups(labels[more], depth, groups)
    return out


def _distinct(labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First row of each different label, the number of the label of each row, and how often each stands."""
    key = np.zeros(len(labels), np.uint64)
    for j in range(labels.shape[1]):
        key = mix(key * np.uint64(31) + labels[:, j].astype(np.uint64) + np.uint64(1))
    _, at, which, times = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    return at, which, times


def deep_nodes(labels: np.ndarray) -> np.ndarray:
    """Leaves below inner nodes of full depth in the tree of some suffixes (rows of part hashes).

    Suffixes are sorted; the common prefix of two neighbours is the depth of the node that parts
    them, and neighbours that agree in every part hang below one deep node.
    """
    order = np.lexsort(labels.T[::-1])
    ranked = labels[order]
    same = ranked[1:] == ranked[:-1]
    depth = np.where(same.all(axis=1), labels.shape[1], np.argmin(same, axis=1)) if len(same) else np.zeros(0, int)
    deep = depth >= labels.shape[1]
    below = np.zeros(len(labels), bool)
    below[order] = np.concatenate([deep, [False]]) | np.concatenate([[False], deep])
    return below


def repeated_spans(rows: DataFrame, window: int = WINDOW, memory: int = MEMORY) -> DataFrame:
    """Stored (rid, spans): the maximal runs of words under repeats, as pairs (start, end) of int64.

    rows: rid (the same for equal rows only) and text, not null. ``text`` may hold any words.
    """
    candidates = _anchored(rows, window)
    size = max(stored_bytes(rows), 1)
    groups = max(8, -(-size // GROUP_BYTES))
    full: list[set[int]] = []

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, window, "anchors"):
            _, _, labels = _suffixes(block, window)
            labels = labels[_distinct(labels)[0]]
            found, times = np.unique(_group_of(labels, groups, full), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(times, pa.int64())], ["group", "n"])

    for _ in range(min(PARTS, window) - 1):
        counts = map_batches(candidates, count, "group long, n long").groupBy("group").agg(F.sum("n").alias("n"))
        over = counts.where((F.col("n") > memory) & (F.shiftright("group", 40) == len(full) + 1))
        # At most (number of suffixes) / memory groups are overfull.
        found = {r.group for r in over.collect()}
        if not found:
            break
        full.append(found)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, window, "anchors"):
            starts, owner, labels = _suffixes(block, window)
            at, which, times = _distinct(labels)
            facts = np.stack([owner, starts - block.first[owner], which]).astype(np.uint32) if len(starts) else np.zeros((3, 0), np.uint32)
            yield from _packed([(-1 - block.number, block.number, len(at), blob(np.array(block.ids, np.int64)), blob(facts), blob((times > 1).astype(np.uint8)))])
            group = _group_of(labels[at], groups, full)
            order, cuts = _cuts(group)
            yield from _packed([(g, block.number, hi - lo, blob(order[lo:hi].astype(np.uint32)), blob(labels[at[order[lo:hi]]]), b"") for g, lo, hi in cuts])

    parts = min(PARTS, window)

    def subtree(part: pa.Table) -> pa.Table:
        if part["group"][0].as_py() < 0:
            return part.select(["block", "n", "a", "b", "c"])
        leaves = [np.frombuffer(x, np.uint32) for x in part["a"].to_pylist()]
        labels = np.concatenate([np.frombuffer(x, np.uint32).reshape(-1, parts) for x in part["b"].to_pylist()])
        below, shared, at = deep_nodes(labels), [], 0
        for own in leaves:
            shared.append(blob(own[below[at : at + len(own)]]))
            at += len(own)
        none = pa.array([b""] * len(leaves), pa.binary())
        return pa.table({"block": part["block"].combine_chunks(), "n": pa.array([-1] * len(leaves)), "a": pa.array(shared, pa.binary()), "b": none, "c": none})

    def gather(part: pa.Table) -> pa.Table:
        rows = part.to_pylist()
        info = next(r for r in rows if r["n"] >= 0)
        ids = np.frombuffer(info["a"], np.int64)
        owner, places, which = np.frombuffer(info["b"], np.uint32).reshape(3, -1).astype(np.int64)
        deep = np.frombuffer(info["c"], np.uint8) == 1
        for r in rows:
            if r["n"] < 0:
                deep[np.frombuffer(r["a"], np.uint32)] = True
        hit = deep[which] if len(which) else np.zeros(0, bool)
        owner, places = owner[hit], places[hit]
        order = np.lexsort((places, owner))
        owner, places = owner[order], places[order]
        _, cuts = _cuts(owner)
        spans = []
        for _, lo, hi in cuts:
            own = places[lo:hi]
            gap = np.flatnonzero(np.diff(own) > window) + 1
            begins = own[np.concatenate([[0], gap])]
            ends = own[np.concatenate([gap - 1, [len(own) - 1]])] + window
            spans.append(blob(np.stack([begins, ends], axis=1).astype(np.int64)))
        return pa.table({"rid": pa.array([int(ids[g]) for g, _, _ in cuts], pa.int64()), "spans": pa.array(spans, pa.binary())})

    posted = map_batches(candidates, post, ROW)
    marked = posted.groupBy("group").applyInArrow(subtree, "block long, n long, a binary, b binary, c binary")
    return stage(marked.groupBy("block").applyInArrow(gather, "rid long, spans binary").dropDuplicates(["rid"]))


def _anchored(rows: DataFrame, window: int) -> DataFrame:
    """The texts that have a repeated anchor, with the places of those anchors."""
    return sized_join(rows, repeated_anchors(rows, window), ["rid"], "inner").select("rid", "text", "anchors")


def without_repeats(
    docs: DataFrame, window: int = WINDOW, memory: int = MEMORY, id_col: str = "doc_id", text_col: str = "text", kept_text: bool = False
) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 per row, and on request kept_text.

    A word goes if a window of ``window`` words that covers it also starts anywhere else. Windows
    are judged on the input. Null and empty texts have no words; texts shorter than ``window`` lose
    nothing, and equal rows lose all words of their windows, as any copies do. Rows with null ids
    are treated like others. Other columns are ignored.
    """
    keyed = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)).alias("rid")
    )
    spans = repeated_spans(keyed.select("rid", "text"), window, memory)
    schema = f"doc_id {dict(keyed.dtypes)['doc_id']}, n_words long, n_removed long, kept_sha256 string" + (", kept_text string" if kept_text else "")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            counts, removed, digests, texts = [], [], [], []
            for text, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
                words = text.as_buffer().to_pybytes().split()
                kept, at, gone = [], 0, 0
                for lo, hi in np.frombuffer(spans.as_py() or b"", np.int64).reshape(-1, 2).tolist():
                    kept += words[at:lo]
                    at, gone = hi, gone + hi - lo
                kept += words[at:]
                whole = b" ".join(kept)
                counts.append(len(words))
                removed.append(gone)
                digests.append(hashlib.sha256(whole).hexdigest())
                if kept_text:
                    texts.append(whole.decode("utf-8", "surrogatepass"))
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests)]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(texts, pa.string())] * kept_text, names + ["kept_text"] * kept_text)

    return map_batches(sized_join(keyed, spans, ["rid"], "left").select("doc_id", "text", "spans"), keep, schema)


SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (
  SELECT doc_id, i, hash(array_to_string(ws[i:i + 34], ' ')) AS h
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM w WHERE len(ws) >= 35)),
rep AS (SELECT doc_id, list(i) AS places FROM win SEMI JOIN (SELECT h FROM win GROUP BY h HAVING count(*) > 1) USING (h) GROUP BY doc_id),
cov AS (
  SELECT doc_id, list(DISTINCT p) AS gone FROM (
    SELECT doc_id, unnest(range(i, i + 35)) AS p FROM (SELECT doc_id, unnest(places) AS i FROM rep)) GROUP BY doc_id),
out AS (
  SELECT w.doc_id, len(ws) AS n_words, coalesce(len(gone), 0) AS n_removed, ws, gone
  FROM w LEFT JOIN cov USING (doc_id)),
kept AS (
  SELECT o.doc_id, string_agg(o.word, ' ' ORDER BY o.p) AS t
  FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM out) o
  ANTI JOIN (SELECT doc_id, unnest(gone) AS p FROM cov) g ON g.doc_id = o.doc_id AND g.p = o.p
  GROUP BY o.doc_id)
SELECT out.doc_id, n_words, n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM out LEFT JOIN kept USING (doc_id)
"""


@query("op5_substring_dedup", SQL)
def op5_substring_dedup(spark, sf_dir):
    return without_repeats(table(spark, sf_dir, "documents"))
