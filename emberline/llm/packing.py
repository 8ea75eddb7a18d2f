"""Best-fit packing of tokenised documents by linear grouping.

Lengths of pieces have at most ``capacity`` values, so one histogram describes any corpus. The large
lengths are sorted into groups of equal cardinality and rounded up to the longest of their group; for
those few sizes a linear program over bin configurations is solved once, by generating columns, and
its solution is rounded. Spark numbers the pieces of every size; a piece's number tells which use of
which configuration it fills. What is left over, and all small pieces, are then added best-fit,
largest first, to the filled sequences, which are dealt into blocks of bounded size.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches, query, stage, table, text_chunks

CAPACITY = 2048
#: Pieces of one block: large enough that its last, half-empty sequences do not matter.
BLOCK_PIECES = 32_768
#: Sizes that large lengths are rounded up to, and pieces of one size that are worth a size of their own.
GROUPS, GROUP_PIECES = 240, 8
#: Lengths up to capacity / SMALL are left to best fit, so a configuration has at most three pieces.
SMALL = 4
#: The program is solved to within this share of its optimum.
GAP = 2e-4
#: Parts of words remembered by a worker's tokenizer, and the longest of them.
CACHE_PARTS, CACHE_CHARS = 340_000, 40


class WordEncoder:
    """Token ids of whole texts as little-endian bytes, remembering frequent parts of words.

    The tokenizer drops white space before it forms words, so a text's ids are those of its
    space-separated words in order. Stretches of plain Latin script are normalised together, split by
    the tokenizer's own pattern and given to its model part by part; all other words take the whole
    tokenizer.
    """

    def __init__(self, path: str):
        import json

        import regex
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        split = json.loads(self.tokenizer.to_str())["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        #: Signs of a word that is not plain; the tokenizer's special tokens hold the second.
        self.odd = re.compile("[^ !-~\u00a1-\u00ac\u00ae-\u024f]|<\\|")
        points = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x250)]
        # In plain stretches the normalizer only lowers letters, and the classes of the pattern are short
        # lists; where a tokenizer does more, its own normalizer is asked.
        own = self.tokenizer.normalizer
        lowers = own is not None and all(own.normalize_str(chr(p)) == chr(p).lower() for p in points) and own.normalize_str(" a ") == " a "
        self.normal = str.lower if lowers else own.normalize_str if own is not None else str
        chars = sorted({*" ", *map(chr, points), *"".join(chr(p).lower() for p in points)})
        for name in ("L", "N"):
            members = regex.compile(rf"\p{{{name}}}")
            split = split.replace(rf"\p{{{name}}}", "".join(filter(members.match, chars)))
        self.pattern = re.compile(split)
        coder = ByteLevel(add_prefix_space=False, use_regex=False)
        tokenize = self.tokenizer.model.tokenize

        class Coded(dict):
            """Visible characters that stand for a character's UTF-8 bytes."""

            def __missing__(self, point: int) -> str:
                self[point] = coder.pre_tokenize_str(chr(point))[0][0]
                return self[point]

        coded = Coded()

        class Parts(dict):
            """Ids of parts of words."""

            def __missing__(self, text: str) -> bytes:
                ids = array("I", [t.id for t in tokenize(text.translate(coded))]).tobytes()
                if len(text) <= CACHE_CHARS:
                    self[text] = ids
                return ids

        self.parts = Parts()

    def encode(self, word: str) -> bytes:
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def plain(self, text: str) -> bytes:
        return b"".join(map(self.parts.__getitem__, self.pattern.findall(self.normal(text))))

    def text(self, text: str) -> bytes:
        text = text.replace("\n", " ")
        out, at = [], 0
        for found in self.odd.finditer(text):
            if found.start() < at:
                continue
            start, end = text.rfind(" ", at, found.start()) + 1 or at, text.find(" ", found.end())
            end = len(text) if end < 0 else end
            out += [self.plain(text[at:start]), self.encode(text[start:end])]
            at = end
        out.append(self.plain(text[at:] if at else text))
        return b"".join(out)

    def __call__(self, texts: list[str]) -> list[bytes]:
        if len(self.parts) > CACHE_PARTS:
            self.parts.clear()
        return [self.text(text) for text in texts]


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """This process's encoder; a Python worker keeps it, and what it remembers, from task to task."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: each document's ids and a closing 0, cut at ``capacity``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in text_chunks(batches):
            rows: list[tuple] = []
            texts = [text or "" for text in batch.column("text").to_pylist()]
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encode(texts), strict=True):
                ids += b"\0\0\0\0"
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows, strict=True))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"]
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(rows, cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def size_classes(histogram: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of each length (-1: not large), and each class's size and number of pieces.

    histogram: number of pieces by length. Classes have about as many pieces each, in falling order
    of length; one length is never divided, a class's size is its longest length.
    """
    large = np.arange(capacity // SMALL + 1, capacity)[::-1]
    counts = histogram[large]
    large, counts = large[counts > 0], counts[counts > 0]
    classes = np.full(capacity + 1, -1)
    if not len(large):
        return classes, np.zeros(0, np.int64), np.zeros(0, np.int64)
    total = int(counts.sum())
    groups = max(1, min(GROUPS, total // GROUP_PIECES))
    middle = np.cumsum(counts) - (counts + 1) // 2
    _, of = np.unique(middle * groups // total, return_inverse=True)
    classes[large] = of
    sizes = np.zeros(of[-1] + 1, np.int64)
    np.maximum.at(sizes, of, large)
    return classes, sizes, np.bincount(of, counts).astype(np.int64)


def best_columns(values: np.ndarray, sizes: np.ndarray, left: np.ndarray, most: int = 32) -> list[np.ndarray]:
    """Configurations of large total value, best first: for a size, the best of up to three pieces
    with one of it. ``left`` has the room that two pieces leave, by the numbers of their sizes."""
    n = len(sizes)
    capacity = int(left[0, 0] + 2 * sizes[0])
    # The best single piece by room, and its size's number.
    order = np.lexsort((values, sizes))
    worth = np.maximum.accumulate(values[order])
    opens = np.concatenate([[True], worth[1:] > worth[:-1]])
    leader = order[np.maximum.accumulate(np.where(opens, np.arange(n), 0))]
    place = np.searchsorted(sizes[order], np.arange(capacity + 1), "right") - 1
    one = np.where(place >= 0, worth[place], 0.0)
    two = np.where(left >= 0, values + one[np.maximum(left, 0)], -1.0)
    second = two.argmax(1)
    best = np.maximum(two[np.arange(n), second], 0.0)
    out = []
    for first in np.argsort(-(values + best), kind="stable")[:most].tolist():
        column = np.zeros(n, np.int64)
        column[first] += 1
        if best[first] > 0:
            column[second[first]] += 1
            room = int(left[first, second[first]])
            if place[room] >= 0 and one[room] > 0:
                column[leader[place[room]]] += 1
        out.append(column)
    return out


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Bin configurations over a few sizes and how often each is used: the linear program's optimum
    (within ``GAP``), rounded. Every configuration fits ``capacity``; no size is used beyond its
    demand. Sizes are different, longer than capacity / SMALL and have a demand."""
    if not len(sizes):
        return []
    columns = np.diag(capacity // sizes).astype(float)
    left = capacity - sizes[:, None] - sizes
    inverse = np.diag(1 / columns.diagonal())
    amount = inverse @ demand
    for turn in range(40 * len(sizes) + 40):
        if turn % 64 == 63:
            inverse = np.linalg.inv(columns)
            amount = inverse @ demand
        value = inverse.sum(0)
        news = best_columns(np.maximum(value, 0), sizes, left)
        if value @ news[0] <= 1 + GAP:
            break
        for new in news:
            value = inverse.sum(0)
            if value @ new <= 1 + GAP / 2:
                continue
            step = inverse @ new
            with np.errstate(divide="ignore", invalid="ignore"):
                ratio = np.where(step > 1e-9, np.maximum(amount, 0) / step, np.inf)
            out = int(np.argmin(ratio))
            columns[:, out] = new
            inverse[out] /= step[out]
            others = step.copy()
            others[out] = 0
            inverse -= np.outer(others, inverse[out])
            amount = amount - others * ratio[out]
            amount[out] = ratio[out]
    whole = columns.astype(np.int64)
    uses = np.maximum(np.floor(amount + 1e-7), 0).astype(np.int64)
    spare = demand.astype(np.int64) - whole @ uses
    while (spare < 0).any():
        # Rounding errors of the solution, if any, are taken back.
        j = int(np.argmax((whole[spare < 0] > 0).any(0) & (uses > 0)))
        uses[j] -= 1
        spare += whole[:, j]
    # Pieces that rounding left over fill configurations once more, the most wanted ones first.
    for j in np.argsort(-(amount - np.floor(amount)), kind="stable").tolist():
        if (whole[:, j] <= spare).all():
            uses[j] += 1
            spare -= whole[:, j]
    return [(whole[:, j], int(uses[j])) for j in range(len(sizes)) if uses[j] > 0]


class Plan:
    """Where the pieces of each size go: number r of a size fills use t of a configuration."""

    def __init__(self, histogram: np.ndarray, capacity: int = CAPACITY):
        self.classes, sizes, counts = size_classes(histogram, capacity)
        found = configurations(sizes, counts.astype(float), capacity)
        self.sequences = sum(n for _, n in found)
        taken, first = np.zeros(len(sizes), np.int64), 0
        rules: list[list[tuple[int, int, int, int]]] = [[] for _ in sizes]
        for column, times in found:
            for c in np.flatnonzero(column).tolist():
                rules[c].append((int(taken[c]), int(taken[c] + column[c] * times), first, int(column[c])))
                taken[c] += column[c] * times
            first += times
        self.placed = int(taken.sum())
        self.rules = [np.array(r, np.int64).reshape(-1, 4) for r in rules]

    def sequence(self, size_class: int, numbers: np.ndarray) -> np.ndarray:
        """Sequence of the pieces of a class with some numbers, -1 for those left over."""
        rules = self.rules[size_class]
        if not len(rules):
            return np.full(len(numbers), -1)
        at = np.searchsorted(rules[:, 0], numbers, "right") - 1
        start, end, first, times = rules[at].T
        return np.where(numbers < end, first + (numbers - start) // times, -1)


def planned(plan: Plan, lengths: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sequences of some pieces, -1 for none; the pieces of class c are numbered from ``offsets[c]``."""
    classes = plan.classes[lengths]
    out = np.full(len(lengths), -1)
    order = np.argsort(classes, kind="stable")
    begin = np.searchsorted(classes[order], np.arange(len(plan.rules) + 1))
    for c in np.flatnonzero(np.diff(begin)).tolist():
        own = order[begin[c] : begin[c + 1]]
        out[own] = plan.sequence(c, offsets[c] + np.arange(len(own)))
    return out


def fill(lengths: np.ndarray, sequence: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Sequence (from 0) and offset of each piece; those without a sequence are placed best-fit,
    longest first. Sequences hold at most ``capacity`` without gaps."""
    if not len(lengths):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sequence = sequence.copy()
    have, sequence[sequence >= 0] = np.unique(sequence[sequence >= 0], return_inverse=True)
    used = np.bincount(sequence[sequence >= 0], lengths[sequence >= 0], len(have)).astype(np.int64)
    rooms = (capacity - used).tolist()
    order = np.argsort(-lengths, kind="stable")
    _best_fit(order[sequence[order] < 0], lengths, sequence, rooms, capacity)
    by = np.argsort(sequence, kind="stable")
    sums = np.cumsum(lengths[by]) - lengths[by]
    opens = np.concatenate([[True], sequence[by][1:] != sequence[by][:-1]])
    offset = np.empty(len(lengths), np.int64)
    offset[by] = sums - np.repeat(sums[opens], np.diff(np.append(np.flatnonzero(opens), len(by))))
    return sequence, offset


def pack(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each of some pieces in memory."""
    plan = Plan(np.bincount(lengths, minlength=capacity + 1), capacity)
    return fill(lengths, planned(plan, lengths, np.zeros(len(plan.rules), np.int64)), capacity)


def _best_fit(items: np.ndarray, lengths: np.ndarray, sequence: np.ndarray, rooms: list[int], capacity: int) -> None:
    """Put each item into the fullest sequence with room for it, or open a new one."""
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    for at, room in enumerate(rooms):
        free[room].append(at)
    some = sum(1 << room for room in range(1, capacity + 1) if free[room])
    for item in items.tolist():
        size = int(lengths[item])
        fits = some >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            at = free[room].pop()
            if not free[room]:
                some ^= 1 << room
        else:
            room, at = capacity, len(rooms)
            rooms.append(capacity)
        left = rooms[at] = room - size
        sequence[item] = at
        if left:
            free[left].append(at)
            some |= 1 << left


def best_fit_packing(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, block_pieces: int = BLOCK_PIECES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are one piece of length 1 (the closing 0). Longer documents are cut into
    pieces of ``capacity``. Rows that repeat an id are packed as documents of their own. Other
    columns are ignored; an empty table gives an empty result.
    """
    rows = stage(pieces(docs, tokenizer, capacity, id_col, text_col))
    histogram = np.zeros(capacity + 1, np.int64)
    for r in rows.groupBy("length").count().collect():
        histogram[r["length"]] = r["count"]
    plan = Plan(histogram, capacity)
    blocks = max(1, -(-int(histogram.sum()) // block_pieces))
    key = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(blocks)).cast("int").alias("block")
    size = F.element_at(F.array(*[F.lit(int(c)) for c in plan.classes]), F.col("length").cast("int") + 1).alias("size")
    dealt = rows.select("*", key)
    # Pieces of a size are numbered block by block; a block starts where the blocks before it end.
    counts = dealt.select("block", size).where("size >= 0").groupBy("block", "size").agg(F.count("*").alias("n"))
    before = Window.partitionBy("size").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("block", "size", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("first"))

    def fill_plan(block: pa.Table, first: pa.Table) -> pa.Table:
        block = block.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
        offsets = np.zeros(len(plan.rules), np.int64)
        offsets[first["size"].to_numpy()] = first["first"].to_numpy()
        return block.drop_columns(["block"]).append_column("sequence", pa.array(planned(plan, block["length"].to_numpy(), offsets)))

    def place(block: pa.Table) -> pa.Table:
        block = block.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
        sequence, offset = fill(block["length"].to_numpy(), block["sequence"].to_numpy(), capacity)
        number = (np.int64(block["block"][0].as_py()) << 32) + sequence
        return block.drop_columns(["block", "sequence"]).append_column("sequence_id", pa.array(number)).append_column("offset", pa.array(offset))

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    filled = dealt.groupBy("block").cogroup(starts.groupBy("block")).applyInArrow(fill_plan, f"{schema}, sequence long")
    whole = F.when(F.col("sequence") >= 0, F.col("sequence")).otherwise(F.xxhash64("doc_id", "piece", F.lit("rest")))
    filled = filled.withColumn("block", F.pmod(whole, F.lit(blocks)).cast("int"))
    return filled.groupBy("block").applyInArrow(place, f"{schema}, sequence_id long, offset long")


def public_tokenizer(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op9_best_fit_packing")
def op9_best_fit_packing(spark, sf_dir):
    return best_fit_packing(table(spark, sf_dir, "documents"), public_tokenizer())
