"""Secrets: three exact base kinds, and random-looking strings told from ordinary identifiers.

Character Markov models of second order are trained from labelled samples: one for ordinary
identifiers, one for each alphabet of random strings. A string is added as a span if the random
models make it more likely by a fixed log-likelihood ratio. Samples are counted in all texts; the
models have a fixed size whatever the corpus.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, query, table, text_chunks

KINDS = ["assign", "access", "hex", "random"]
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{32,}")
#: Texts without any of these have no base span (it also lets some through that have none).
MAYBE = r"(?i:password|passwd|secret|token|api_?key)|AKIA|[0-9a-f]{32}"
LEAST_ASSIGNED, LEAST_ACCESS = 8, 16

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
LETTERS = len(ALPHABET) + 1
#: Letter number of a byte; 0 ends a string.
LETTER = np.zeros(256, np.int64)
LETTER[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(1, LETTERS)
CELLS = LETTERS**3
#: Models: ordinary identifiers and numbers, then random strings of each alphabet.
ORDINARY = [ALPHABET, "0123456789"]
RANDOM = ["0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "abcdefghijklmnopqrstuvwxyz0123456789", ALPHABET]
MODELS = len(ORDINARY) + len(RANDOM)
_DIGIT = LETTERS - 16 <= np.arange(LETTERS)
_DIGIT &= np.arange(LETTERS) < LETTERS - 6
_LOWER = (np.arange(LETTERS) > 26) & (np.arange(LETTERS) < LETTERS - 16)
_UPPER = (np.arange(LETTERS) > 0) & (np.arange(LETTERS) <= 26)
_JOINT = np.arange(LETTERS) >= LETTERS - 6
#: Strings of at least so many characters may be secrets. Shorter ones are samples of ordinary identifiers,
#: and so are words of at least ``LEAST_SAMPLE`` small letters in longer ones; other parts of those are not, so
#: that unlabelled secrets are hardly learnt as ordinary.
LEAST_SECRET, LEAST_SAMPLE = 16, 4
#: A shorter context weighs as many letters as this in an estimate; in random strings eight times as many.
PRIOR = 32.0
#: Log-likelihoods are whole numbers of 1/UNIT, so that sums do not depend on their order.
UNIT = 1024
#: Log-likelihood ratio from which a string is a secret: one in e**12 strings would be wrong by chance.
LEAST_RATIO = 12.0


def base_spans(text: bytes) -> list[tuple[int, int, int, int]]:
    """(start, kind number, end, start of the secret) of the base kinds by byte, in order."""
    out = []
    for found in ASSIGN.finditer(text):
        if found.end(2) - found.start(2) >= LEAST_ASSIGNED:
            out.append((found.start(), 0, found.end(), found.start(2)))
    # A failing match of these two ends where its run of characters ends, so asking for the length is the same.
    for found in ACCESS.finditer(text):
        if found.end() - found.start() >= LEAST_ACCESS:
            out.append((found.start(), 1, found.end(), found.start()))
    for found in HEX.finditer(text):
        out.append((found.start(), 2, found.end(), found.start()))
    return sorted(out)


class Scan:
    """Texts of a batch as bytes, their base spans, and the runs of letters outside of base spans."""

    def __init__(self, texts: pa.Array):
        texts = texts.cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        whole = texts.buffers()[2]
        self.data = np.frombuffer(whole, np.uint8)[offsets[0] : offsets[-1]] if whole is not None else np.zeros(0, np.uint8)
        self.bounds = offsets - offsets[0]
        maybe = np.flatnonzero(pc.match_substring_regex(texts, MAYBE).to_numpy(zero_copy_only=False))
        self.spans: dict[int, list[tuple[int, int, int, int]]] = {}
        for i in maybe.tolist():
            found = base_spans(self.data[self.bounds[i] : self.bounds[i + 1]].tobytes())
            if found:
                self.spans[i] = found
        letters = LETTER[self.data]
        for i, found in self.spans.items():
            for start, _, end, _ in found:
                letters[self.bounds[i] + start : self.bounds[i] + end] = 0
        inside = np.zeros(len(letters) + 2, bool)
        inside[1:-1] = letters > 0
        begin = inside[1:] & ~inside[:-1]
        stop = inside[:-1] & ~inside[1:]
        # Letters on both sides of the end of a text belong to two runs.
        cuts = self.bounds[1:-1]
        both = cuts[(inside[cuts] & inside[cuts + 1]) if len(cuts) else np.zeros(0, bool)]
        begin[both] = stop[both] = True
        self.starts, self.ends = np.flatnonzero(begin), np.flatnonzero(stop)

    def ordinary(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Samples of ordinary identifiers and of numbers: their starts and ends."""
        letters = LETTER[self.data]
        before = np.concatenate([[0], np.cumsum(~_DIGIT[letters])])
        number = before[self.ends] == before[self.starts]
        sizes = self.ends - self.starts
        short = ~number & (sizes >= LEAST_SAMPLE) & (sizes < LEAST_SECRET)
        long = ~number & (sizes >= LEAST_SECRET)
        inside = np.zeros(len(letters) + 2, bool)
        steps = np.zeros(len(letters) + 1, np.int8)
        steps[self.starts[long]] += 1
        steps[self.ends[long]] -= 1
        run = np.cumsum(steps[:-1]) > 0
        inside[1:-1] = run & _LOWER[letters]
        starts, ends = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])
        words = ends - starts >= LEAST_SAMPLE
        starts, ends = starts[words], ends[words]
        # A word takes the capital before it with it, and the signs that stand next to it.
        joint, capital = np.zeros(len(letters) + 2, bool), np.zeros(len(letters) + 2, bool)
        joint[1:-1], capital[1:-1] = run & _JOINT[letters], run & _UPPER[letters]
        starts = starts - capital[starts]
        starts, ends = starts - joint[starts], ends + joint[ends + 1]
        return [(np.concatenate([self.starts[short], starts]), np.concatenate([self.ends[short], ends])), (self.starts[number], self.ends[number])]

    def secrets(self) -> list[bytes]:
        """The secrets of base spans, each place once."""
        out = []
        for i, found in self.spans.items():
            text = self.data[self.bounds[i] : self.bounds[i + 1]]
            out += [text[a:b].tobytes() for a, b in sorted({(at, end) for _, _, end, at in found})]
        return out


def cells(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Transitions of some strings: (letter before last, last, next) as one number, strings closed by
    an end, and where each string's transitions begin."""
    sizes = ends - starts
    first = np.cumsum(sizes + 3) - (sizes + 3)
    total = int((sizes + 3).sum())
    padded = np.zeros(total, np.int64)
    place = np.arange(int(sizes.sum())) + np.repeat(first + 2 - (np.cumsum(sizes) - sizes), sizes)
    source = np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    padded[place] = LETTER[data[source]]
    code = np.zeros(total, np.int64)
    code[2:] = (padded[:-2] * LETTERS + padded[1:-1]) * LETTERS + padded[2:]
    # A string of n letters has n + 1 transitions; the two paddings before it have none.
    keep = np.ones(total, bool)
    keep[first] = keep[first + 1] = False
    return code[keep], first - 2 * np.arange(len(first))


def alphabets(strings: list[bytes]) -> list[int]:
    """The narrowest random model of each string."""
    kinds = [frozenset(a.encode()) for a in RANDOM]
    return [len(ORDINARY) + next((k for k, kind in enumerate(kinds) if kind.issuperset(s)), len(kinds) - 1) for s in strings]


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(model, cell, n) of a task: short runs outside of base spans, words in long ones and
    numbers are ordinary, secrets of base spans random."""
    sums = np.zeros((MODELS, CELLS), np.int64)
    for batch in text_chunks(batches):
        scan = Scan(batch.column("text"))
        for model, (starts, ends) in enumerate(scan.ordinary()):
            code, _ = cells(scan.data, starts, ends)
            sums[model] += np.bincount(code, minlength=CELLS)
        _add_random(sums, scan.secrets())
    yield _sparse(sums)


def _add_random(sums: np.ndarray, strings: list[bytes]) -> None:
    for string, model in zip(strings, alphabets(strings), strict=True):
        code, _ = cells(np.frombuffer(string, np.uint8), np.array([0]), np.array([len(string)]))
        np.add.at(sums[model], code, 1)


def _sparse(sums: np.ndarray) -> pa.RecordBatch:
    model, cell = np.nonzero(sums)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (model, cell, sums[model, cell])], ["model", "cell", "n"])


def log_likelihoods(counts: np.ndarray) -> np.ndarray:
    """Model x cell: log-likelihood of the last letter after the two before it, in units of 1 / UNIT.

    Contexts are smoothed by the letter before, that by the share of letters, and that by an even
    draw from the model's alphabet; so a context without samples falls back on the next shorter one.
    """
    out = np.zeros((MODELS, CELLS), np.int64)
    for model in range(MODELS):
        own = np.zeros(LETTERS)
        own[[0, *(ALPHABET.index(c) + 1 for c in (ORDINARY + RANDOM)[model])]] = 1
        # Letters that are not of the alphabet are possible, but hardly.
        even = (own + 1e-3) / (own + 1e-3).sum()
        three = counts[model].reshape(LETTERS, LETTERS, LETTERS).astype(float)
        two = three.sum(0)
        one = two.sum(0)
        shares = (one + 8 * PRIOR * even) / (one.sum() + 8 * PRIOR)
        # What stands before a letter tells little in random strings and numbers, whatever few samples say.
        weight = 8 * PRIOR if model else PRIOR
        after = (two + weight * shares) / (two.sum(1, keepdims=True) + weight)
        full = (three + weight * after[None]) / (three.sum(2, keepdims=True) + weight)
        out[model] = np.rint(np.log(full).ravel() * UNIT).astype(np.int64)
    return out


def _collected(tallies: DataFrame) -> np.ndarray:
    counts = np.zeros((MODELS, CELLS), np.int64)
    for r in tallies.groupBy("model", "cell").agg(F.sum("n").alias("n")).toArrow().to_pylist():
        counts[r["model"], r["cell"]] = r["n"]
    return counts


def train_on_texts(texts: DataFrame) -> np.ndarray:
    """Models from the texts of a table: the values of base spans are the random samples, identifiers
    too short for a secret, words in longer ones and numbers the ordinary ones. At most ``MODELS * CELLS`` counts reach the driver."""
    return log_likelihoods(_collected(map_batches(texts.select("text"), _tally, "model long, cell long, n long")))


def train_on_samples(samples: DataFrame, value_col: str = "value", label_col: str = "secret") -> np.ndarray:
    """Models from labelled strings: ``label_col`` true for random ones. Null rows are left out;
    characters outside the alphabet end a string."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((MODELS, CELLS), np.int64)
        for batch in batches:
            for value, secret in zip(batch.column("value").to_pylist(), batch.column("secret").to_pylist(), strict=True):
                strings = re.findall(rb"[A-Za-z0-9+/_.=-]+", value.encode())
                if secret:
                    _add_random(sums, strings)
                else:
                    for s in strings:
                        code, _ = cells(np.frombuffer(s, np.uint8), np.array([0]), np.array([len(s)]))
                        np.add.at(sums[int(s.isdigit())], code, 1)
        yield _sparse(sums)

    rows = samples.select(F.col(value_col).alias("value"), F.col(label_col).cast("boolean").alias("secret")).where("value IS NOT NULL AND secret IS NOT NULL")
    return log_likelihoods(_collected(map_batches(rows, tally, "model long, cell long, n long")))


def ratios(models: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Log-likelihood ratio of each string: the best random model against the best ordinary one."""
    if not len(starts):
        return np.zeros(0)
    code, first = cells(data, starts, ends)
    sums = np.stack([np.add.reduceat(table[code], first) for table in models])
    many = len(ORDINARY)
    return (sums[many:].max(0) - sums[:many].max(0)) / UNIT - np.log(len(RANDOM))


def _trimmed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs without ``._-+/=`` before and without ``._-+/`` after them."""
    starts, ends = starts.copy(), ends.copy()
    before = np.isin(data, np.frombuffer(b"._-+/=", np.uint8))
    after = np.isin(data, np.frombuffer(b"._-+/", np.uint8))
    while True:
        cut = (starts < ends) & before[np.minimum(starts, len(data) - 1)]
        if not cut.any():
            break
        starts[cut] += 1
    while True:
        cut = (starts < ends) & after[np.maximum(ends - 1, 0)]
        if not cut.any():
            break
        ends[cut] -= 1
    return starts, ends


def find_secrets(docs: DataFrame, models: np.ndarray, least_ratio: float = LEAST_RATIO, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base (the base spans), spans (all), n_random per row.

    Spans are ``kind:start:end`` by start, then kind, comma-joined; places are code points, ends
    exclusive. Null text is empty and has none. Spans of kind ``random`` are identifiers of at least
    16 characters outside of base spans; they end where a base span begins. Equal rows get equal
    results, ids (null ones too) are kept as they are, other columns are ignored, and texts may have
    any length.
    """
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            scan = Scan(batch.column("text"))
            long = scan.ends - scan.starts >= LEAST_SECRET
            starts, ends = _trimmed(scan.data, scan.starts[long], scan.ends[long]) if long.any() else (scan.starts[long], scan.ends[long])
            long = ends - starts >= LEAST_SECRET
            starts, ends = starts[long], ends[long]
            hit = ratios(shared.value, scan.data, starts, ends) >= least_ratio
            starts, ends = starts[hit], ends[hit]
            texts = np.searchsorted(scan.bounds, starts, "right") - 1
            spans: dict[int, list[tuple[int, int, int]]] = {i: [(a, k, b) for a, k, b, _ in found] for i, found in scan.spans.items()}
            for i, a, b in zip(texts.tolist(), starts.tolist(), ends.tolist(), strict=True):
                spans.setdefault(i, []).append((a - int(scan.bounds[i]), 3, b - int(scan.bounds[i])))
            n = np.zeros((len(KINDS), len(batch)), np.int64)
            base, every = [""] * len(batch), [""] * len(batch)
            for i, found in spans.items():
                text = scan.data[scan.bounds[i] : scan.bounds[i + 1]]
                points = np.concatenate([[0], np.cumsum((text & 0xC0) != 0x80)])
                found.sort()
                named = [f"{KINDS[k]}:{points[a]}:{points[b]}" for a, k, b in found]
                every[i] = ",".join(named)
                base[i] = ",".join(name for name, (_, k, _) in zip(named, found, strict=True) if k < 3)
                for _, k, _ in found:
                    n[k, i] += 1
            columns = [batch.column("doc_id"), *(pa.array(row) for row in n[:3]), pa.array(base, pa.string()), pa.array(every, pa.string()), pa.array(n[3])]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_assign", "n_access", "n_hex", "base", "spans", "n_random"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return map_batches(rows, find, "doc_id long, n_assign long, n_access long, n_hex long, base string, spans string, n_random long")


def scanned(docs: DataFrame, least_ratio: float = LEAST_RATIO, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``find_secrets`` with models trained on the texts themselves, and the digest of base spans."""
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = find_secrets(docs, train_on_texts(texts), least_ratio, id_col, text_col)
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans", "n_random")


@query("op13_secrets")
def op13_secrets(spark, sf_dir):
    return scanned(table(spark, sf_dir, "documents"))
