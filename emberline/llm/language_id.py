"""Language identification with hyperdimensional profiles.

Every letter of any script has a random +1/-1 vector, drawn from its code point. A letter n-gram is
the element-wise product (binding) of its letters' vectors, each rotated by its place; a text is the
sum (bundle) of its n-grams, a language the sum of its training texts. A text gets the language of
the largest cosine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, query, table, text_chunks

DIMENSIONS = 1024
#: Bits of a letter in a trigram's code; 0 is the gap between words.
BITS = 21
CODES = 1 << 3 * BITS
UNKNOWN = "und"
#: Letters whose vectors a worker remembers, and trigrams whose vectors are made at once for a batch.
LETTERS, TRIGRAMS = 20_000, 1 << 14
_letters: dict[int, np.ndarray] = {}
_symbols: list[np.ndarray] = []


def _lowered() -> np.ndarray:
    """Code point of each basic character's small letter; 0 for what is no letter."""
    if not _symbols:
        low = [ord(chr(p).lower()[0]) if chr(p).isalpha() else 0 for p in range(0x10000)]
        _symbols.append(np.array(low, np.int64))
    return _symbols[0]


def _letter(point: int) -> np.ndarray:
    """The vector of a letter, the same in every process."""
    found = _letters.get(point)
    if found is None:
        if len(_letters) >= LETTERS:
            _letters.clear()
        bits = np.random.Generator(np.random.Philox(key=[7, point])).integers(0, 2, DIMENSIONS, dtype=np.int8)
        found = _letters[point] = 2 * bits - 1
    return found


def _vectors(codes: np.ndarray) -> np.ndarray:
    """Trigram vectors: a code has the letters a, b, c, which are bound rotated by 2, 1 and 0 places."""
    out = np.ones((len(codes), DIMENSIONS), np.int8)
    for place in range(3):
        points, where = np.unique((codes >> BITS * place) & ((1 << BITS) - 1), return_inverse=True)
        out *= np.stack([np.roll(_letter(int(p)), place) for p in points])[where]
    return out


def trigrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigram codes of a whole text and their counts; both empty if it has no letter."""
    points = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    basic = points < 0x10000
    found = np.zeros(len(points), np.int64)
    found[basic] = _lowered()[points[basic]]
    if not basic.all():
        rare, where = np.unique(points[~basic], return_inverse=True)
        found[~basic] = np.array([ord(chr(p).lower()[0]) if chr(p).isalpha() else 0 for p in rare.tolist()], np.int64)[where]
    if not found.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    found = np.concatenate([[0], found, [0]])
    keep = np.ones(len(found), bool)
    keep[1:] = (found[1:] != 0) | (found[:-1] != 0)  # runs of other characters are one gap
    found = found[keep]
    codes = (found[:-2] << 2 * BITS) | (found[1:-1] << BITS) | found[2:]
    codes.sort()
    at = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[at], np.diff(np.append(at, len(codes)))


def profile(codes: np.ndarray, counts: np.ndarray, known: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """Bundle of n-gram vectors, as float32; ``known`` has the vectors of sorted codes, all of them among these."""
    total = np.zeros(DIMENSIONS, np.float32)
    for lo in range(0, len(codes), 512):
        part = codes[lo : lo + 512]
        vectors = _vectors(part) if known is None else known[1][np.searchsorted(known[0], part)]
        total += counts[lo : lo + 512].astype(np.float32) @ vectors.astype(np.float32)
    return total


def profiles(texts: list[str | None]) -> Iterator[np.ndarray | None]:
    """The profile of each text, None without a letter. Vectors that a batch's texts share are made once."""
    grams = [trigrams(text) for text in texts]
    every = np.unique(np.concatenate([codes for codes, _ in grams])) if grams else np.zeros(0, np.int64)
    known = (every, _vectors(every)) if 0 < len(every) <= TRIGRAMS else None
    for codes, counts in grams:
        yield profile(codes, counts, known) if len(codes) else None


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram counts by language of each batch of texts."""
    for batch in text_chunks(batches):
        by_lang: dict[str, list] = {}
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
            by_lang.setdefault(lang, []).append(trigrams(text))
        for lang, grams in by_lang.items():
            codes, where = np.unique(np.concatenate([c for c, _ in grams]), return_inverse=True)
            sums = np.bincount(where, np.concatenate([n for _, n in grams]), len(codes)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(sums)], ["lang", "code", "n"])


def _bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One partial prototype per language of each batch of counted trigrams; whole numbers, so their order does not matter."""
    for batch in batches:
        langs, codes, counts = batch.column("lang").to_pylist(), batch.column("code").to_numpy(), batch.column("n").to_numpy()
        order = sorted(range(len(langs)), key=langs.__getitem__)
        cuts = [i for i in range(len(order)) if not i or langs[order[i]] != langs[order[i - 1]]] + [len(order)]
        names, sums = [], []
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            total = np.zeros(DIMENSIONS)
            for at in range(lo, hi, 512):
                part = np.array(order[at : min(hi, at + 512)])
                total += counts[part].astype(float) @ _vectors(codes[part]).astype(float)
            names.append(langs[order[lo]])
            sums.append(total.tolist())
        if names:
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sums, pa.list_(pa.float64()))], ["lang", "vector"])


def fit(docs: DataFrame, train: Column, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages in order of name and their unit prototypes, learned from all rows where ``train`` holds.

    Rows with null language or without a letter teach nothing. Trigrams are counted by language in
    Spark and bundled where they are counted; what reaches the driver is one vector per language.
    """
    rows = docs.where(train & F.col(lang_col).isNotNull()).select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    counts = map_batches(rows, _count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    parts = map_batches(counts, _bundles, "lang string, vector array<double>")
    sums = parts.select("lang", F.posexplode("vector").alias("place", "x")).groupBy("lang", "place").agg(F.sum("x").alias("x"))
    found = sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "x"))).alias("v")).select("lang", F.col("v.x").alias("vector")).collect()
    found = sorted(found, key=lambda row: row.lang)
    matrix = np.array([row.vector for row in found], np.float64).reshape(len(found), DIMENSIONS)
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return [row.lang for row in found], (matrix / np.where(norms > 0, norms, 1)).astype(np.float32)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score per row. ``und`` with score 0 for null texts, texts without a
    letter, or a model without languages; of equal cosines the first language by name wins. Rows that
    repeat are judged alike, null ids are kept, other columns are ignored."""
    names, prototypes = model

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            langs, scores = [], []
            for vector in profiles(batch.column("text").to_pylist()):
                if vector is None or not names:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                cosines = prototypes @ vector / max(float(np.linalg.norm(vector)), 1e-9)
                best = int(np.argmax(cosines))
                langs.append(names[best])
                scores.append(min(1.0, max(0.0, float(cosines[best]))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(rows, score, "doc_id long, lang_pred string, score double")


def held_out(id_col: str = "doc_id") -> Column:
    """Whether crc32 of the id as text has remainder 2 modulo 4; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def identified(docs: DataFrame, least: float = 0.05, enough: int = 30, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is known with a cosine of at least ``least``, all columns kept.

    A text of fewer than ``enough`` letters and gaps is too short for a cosine to speak against it; it
    stays if it has a letter.

    Prototypes come from the labelled rows of ``docs`` outside the held-out quarter. Null texts, texts
    without a letter, and all texts if no row has a label, go; ids, repeated rows and other columns do
    not matter; an empty table stays empty.
    """
    names, prototypes = fit(docs, ~held_out(id_col), text_col)
    place = docs.columns.index(text_col)

    def known(text: str | None, vector: np.ndarray | None) -> bool:
        if vector is None or not names:
            return False
        return float((prototypes @ vector).max()) >= least * float(np.linalg.norm(vector)) or int(trigrams(text)[1].sum()) < enough

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, text_col):
            texts = batch.column(place).to_pylist()
            kept = [known(text, vector) for text, vector in zip(texts, profiles(texts), strict=True)]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return map_batches(docs, keep, docs.schema)


@query("op6_language_id")
def op6_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = predict(docs, fit(docs, ~held_out()))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
