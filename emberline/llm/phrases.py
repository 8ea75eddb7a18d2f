"""Phrase collocations: repeated phrases of each language that say more than their parts.

Phrases grow word by word. Frequent phrases of one length are put into double-array tries of bounded
size, which are broadcast. In every shard of text numpy moves the states of all text positions
through a trie at once, level by level; a bincount of accepting states gives the shard's counts, and
Spark sums the shards. The same scan meets the words that follow frequent phrases: a longer phrase
is a candidate only if the phrases without its last and without its first word are frequent, and if
it was met often enough, so no frequent phrase is missed (Apriori).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import hot_split_join
from .common import Words, blob, map_batches, mix, query, sized_join, stage, table, text_chunks, windows

BREAKS = np.array([chr(b) in ".,;:!?\n\x0b\x0c\r" for b in range(256)])
SEPARATORS = BREAKS | np.array([chr(b) in " \t" for b in range(256)])
#: Phrases of one trie: more than these are counted with several tries, one scan of the text for each.
TRIE_PHRASES = 400_000
#: Places of the filter of frequent phrases, and of one page of it; it has this size for any corpus.
FILTER_BITS, PAGE_BITS = 24, 16


class Trie:
    """Double-array trie of phrases of ``depth`` words, one root per language.

    The child of state s by word w is ``base[s] + w``, if ``check`` of that place is s. Words are
    numbered from 1, those in most phrases first, so that states with many children need little
    room; ``rank`` has the numbers in the order of the hashes. Roots are the first places. An
    accepting state has no child, its ``base`` is the number of its phrase.
    """

    def __init__(self, langs: list[str], hashes: np.ndarray):
        """langs: language of each phrase; hashes: phrase x word."""
        self.depth = hashes.shape[1]
        self.roots = {lang: at for at, lang in enumerate(sorted(set(langs)))}
        self.words, codes = np.unique(hashes, return_inverse=True)
        self.rank = np.empty(len(self.words), np.int32)
        self.rank[np.argsort(-np.bincount(codes.ravel()), kind="stable")] = np.arange(1, len(self.words) + 1)
        codes = self.rank[codes.reshape(hashes.shape)].astype(np.int64)
        node = np.array([self.roots[lang] for lang in langs], np.int64)
        count, width = len(self.roots), len(self.words) + 1
        parents, letters = [], []
        for level in range(self.depth):
            edges, inverse = np.unique(node * width + codes[:, level], return_inverse=True)
            parents.append(edges // width)
            letters.append(edges % width)
            node = count + inverse
            count += len(edges)
        parent, letter = np.concatenate(parents), np.concatenate(letters)
        roots = len(self.roots)
        begin = np.searchsorted(parent, np.arange(count + 1))
        bases, size = place_rows(begin, letter, roots, width)
        slot = np.concatenate([np.arange(roots), bases[parent] + letter])
        self.base, self.check = np.zeros(size + width, np.int32), np.full(size + width, -1, np.int32)
        self.base[slot] = bases
        self.check[slot[roots:]] = slot[parent]
        self.base[slot[node]] = np.arange(len(langs))

    def codes(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of words, 0 for words the trie has not."""
        if not len(self.words):
            return np.zeros(len(hashes), np.int32)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, self.rank[at], np.int32(0))

    def advance(self, roots: np.ndarray, codes: np.ndarray, linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word positions at which a phrase begins, and its number.

        roots: each position's first state, -1 for none; linked: whether the next word is in the
        same piece. All positions take a step together, and those without a child drop out.
        """
        at = np.flatnonzero(roots >= 0)
        state = roots[at]
        for level in range(self.depth):
            if level:
                on = linked[at + (level - 1)]
                at, state = at[on], state[on]
            word = codes[at + level]
            to = self.base[state] + word
            on = (word > 0) & (self.check[to] == state)
            at, state = at[on], to[on]
        return at, self.base[state]


def _fit(free: np.ndarray, own: np.ndarray, length: int, rng: np.random.Generator) -> int:
    """A base below ``length`` under which the letters ``own`` are free, -1 if wider and wider windows have none."""
    for window in (64, 256, 1024, 4096):
        at = np.arange(window) + rng.integers(0, max(1, length - window))
        seen, more = 0, 4
        while len(at) and seen < len(own):
            at = at[free[at[:, None] + own[seen : seen + more]].all(1)]
            seen, more = seen + more, min(2 * more, max(4, (1 << 18) // max(1, len(at))))
        if len(at):
            return int(at[0])
    return -1


def place_rows(begin: np.ndarray, letter: np.ndarray, roots: int, width: int) -> tuple[np.ndarray, int]:
    """Bases under which the children of all states share one array without clashes, and its length.

    The children of state s have the letters ``letter[begin[s]:begin[s + 1]]``. States with many
    children are placed first, one by one; those with few are placed together: each proposes a base,
    and the first of those that want one place gets it, until few find room that way. The array grows
    by a quarter when a state's windows are full.
    """
    rng = np.random.default_rng(7)
    sizes = np.diff(begin)
    length = max(4096, len(letter) + len(letter) // 2 + width + roots)
    free = np.ones(length + width, bool)
    free[:roots] = False
    bases = np.zeros(len(sizes), np.int64)

    def place(states: np.ndarray) -> None:
        nonlocal free, length
        for s in states.tolist():
            own = letter[begin[s] : begin[s + 1]]
            while (at := _fit(free, own, length, rng)) < 0:
                length += length // 4
                free = np.concatenate([free, np.ones(length + width - len(free), bool)])
            bases[s] = at
            free[at + own] = False

    place(np.flatnonzero(sizes > 12)[np.argsort(-sizes[sizes > 12], kind="stable")])
    for size in range(12, 0, -1):
        left = np.flatnonzero(sizes == size)
        while len(left):
            own = letter[begin[left][:, None] + np.arange(size)]
            wanted = rng.integers(0, length, len(left))
            places = wanted[:, None] + own
            good = free[places].all(1)
            owner = np.zeros(len(free), np.int32)
            asking = np.flatnonzero(good)[::-1]
            owner[places[asking].ravel()] = np.repeat(asking + 1, size)
            good[asking] = (owner[places[asking]] == asking[:, None] + 1).all(1)
            bases[left[good]] = wanted[good]
            free[places[good].ravel()] = False
            few = 8 * int(good.sum()) < len(left)
            left = left[~good]
            if few:
                place(left)
                break
    return bases, length


class Shard:
    """Words of some texts in the order of their languages: hashes, and which word goes on with the next."""

    def __init__(self, batch: pa.RecordBatch):
        langs = batch.column("lang").to_pylist()
        order = sorted(range(len(langs)), key=langs.__getitem__)
        self.words = words = Words(batch.column("text").take(pa.array(order)), lower=True, separators=SEPARATORS)
        self.langs = [langs[i] for i in order]
        self.hashes = words.hashes
        piece = np.cumsum(BREAKS[words.data], dtype=np.uint32)[words.starts] if len(words.starts) else np.zeros(0, np.uint32)
        self.linked = np.zeros(len(piece), bool)
        self.linked[:-1] = piece[1:] == piece[:-1]
        ends = words.first[1:]
        self.linked[ends[ends > 0] - 1] = False

    def per_word(self, values: list[int], kind) -> np.ndarray:
        """A value of each text's language, by word."""
        return np.repeat(np.array(values, kind), np.diff(self.words.first))

    def by_language(self) -> Iterator[tuple[str, int, int]]:
        """Languages with their runs of words."""
        first = self.words.first
        at = 0
        for to in range(1, len(self.langs) + 1):
            if to == len(self.langs) or self.langs[to] != self.langs[at]:
                yield self.langs[at], int(first[at]), int(first[to])
                at = to

    def strings(self, at: np.ndarray) -> pa.Array:
        """The words at some positions, A-Z in lower case."""
        starts, sizes = self.words.starts[at], self.words.ends[at] - self.words.starts[at]
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        data = self.words.data[np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], sizes)]
        data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
        return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)).cast(pa.string())


def _signed(hashes: np.ndarray) -> pa.Array:
    return pa.array(hashes.view(np.int64))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, word, hash, n of each shard; a null word has the number of all words."""
    for batch in text_chunks(batches):
        shard = Shard(batch)
        for lang, lo, hi in shard.by_language():
            hashes, at, n = np.unique(shard.hashes[lo:hi], return_index=True, return_counts=True)
            words = pa.concat_arrays([pa.nulls(1, pa.string()), shard.strings(at + lo)])
            hashes, n = np.concatenate([np.zeros(1, np.uint64), hashes]), np.concatenate([[hi - lo], n])
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n)), words, _signed(hashes), pa.array(n)], ["lang", "word", "hash", "n"])


def _language(lang: str) -> int:
    return int.from_bytes(hashlib.sha1(lang.encode()).digest()[:8], "little")


def _places(hashes: np.ndarray, langs: np.ndarray) -> np.ndarray:
    """Places of phrases in the filter."""
    return (mix(hashes ^ langs) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def phrase_filter(phrases: DataFrame, size: int) -> np.ndarray:
    """Bits of all phrases of ``size`` words (columns lang, phrase), merged page by page in Spark."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << FILTER_BITS, bool)
        for batch in batches:
            words = Words(batch.column("phrase"), lower=True, separators=SEPARATORS)
            if len(words):
                langs = np.array([_language(lang) for lang in batch.column("lang").to_pylist()], np.uint64)
                bits[_places(windows(words.hashes, size)[words.first[:-1]], langs)] = True
        pages = bits.reshape(-1, 1 << PAGE_BITS)
        some = np.flatnonzero(pages.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array([blob(np.packbits(pages[p])) for p in some], pa.binary())], ["page", "bits"])

    def merge(group: pa.Table) -> pa.Table:
        bits = np.zeros(1 << (PAGE_BITS - 3), np.uint8)
        for part in group["bits"].to_pylist():
            bits |= np.frombuffer(part, np.uint8)
        return pa.table({"page": group["page"][:1], "bits": pa.array([blob(bits)], pa.binary())})

    out = np.zeros((1 << (FILTER_BITS - PAGE_BITS), 1 << (PAGE_BITS - 3)), np.uint8)
    pages = map_batches(phrases.select("lang", "phrase"), mark, "page long, bits binary")
    for r in pages.groupBy("page").applyInArrow(merge, "page long, bits binary").collect():
        out[r["page"]] = np.frombuffer(r["bits"], np.uint8)
    return np.unpackbits(out.ravel()).astype(bool)


def _summed(counts: DataFrame, *keys: str) -> DataFrame:
    """Sums of the shards' counts ``n``. A key stands once in a shard, so rows are dealt out before they are
    added: adding up a task's few shards first hardly saves rows, but holds them all in a hash table."""
    return counts.repartition(*keys).groupBy(*keys).agg(F.sum("n").alias("n"))


def _met(shard: Shard, trie: Trie, sums: np.ndarray, bits: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Add the shard's phrases to ``sums``, and give (number, hash, count) of the words that follow them.

    bits: packed filter of phrases that may be frequent, None if no followers are wanted. Nothing but
    the result outlives the call, so a task holds the arrays of one shard only.
    """
    size = trie.depth
    roots = shard.per_word([trie.roots.get(lang, -1) for lang in shard.langs], np.int32)
    at, number = trie.advance(roots, trie.codes(shard.hashes), shard.linked)
    sums += np.bincount(number, minlength=len(sums))
    if bits is not None and len(at):
        on = shard.linked[at + (size - 1)]
        at, number = at[on], number[on]
    if bits is None or not len(at):
        return number[:0], shard.hashes[:0], at[:0]
    langs = shard.per_word([_language(lang) for lang in shard.langs], np.uint64)
    places = _places(windows(shard.hashes, size)[at + 1], langs[at])
    on = (bits[places >> 3] << (places & 7).astype(np.uint8) & 0x80).astype(bool)
    at, number = at[on], number[on]
    after, code = np.unique(shard.hashes[at + size], return_inverse=True)
    pairs, n = np.unique(number.astype(np.int64) * max(1, len(after)) + code, return_counts=True)
    return pairs // max(1, len(after)), after[pairs % max(1, len(after))], n


def scan(texts: DataFrame, phrases: DataFrame, size: int, extend: bool, least: int) -> DataFrame:
    """Stored (pid, next, n): counts of the phrases (next null), and of the words that follow them ``least`` times.

    phrases: pid, lang, phrase of ``size`` words. Followers are looked for if ``extend``, and only
    where the phrase of the next ``size`` words may be frequent too. One trie is broadcast at a time,
    and given up when its scan is stored.
    """
    spark = texts.sparkSession
    chunks = max(1, -(-phrases.count() // TRIE_PHRASES))
    bits = spark.sparkContext.broadcast(np.packbits(phrase_filter(phrases, size))) if extend else None
    out = None
    for chunk in range(chunks):
        rows = phrases.where(F.pmod(F.xxhash64("pid"), F.lit(chunks)) == chunk).select("pid", "lang", "phrase").toArrow().combine_chunks()
        if not len(rows):
            continue
        words = Words(rows["phrase"].combine_chunks(), lower=True, separators=SEPARATORS)
        trie = Trie(rows["lang"].to_pylist(), words.hashes.reshape(len(rows), size))
        shared = spark.sparkContext.broadcast((trie, rows["pid"].to_numpy()))

        def count(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            trie, pids = shared.value
            sums = np.zeros(len(pids), np.int64)
            for batch in text_chunks(batches):
                number, after, n = _met(Shard(batch), trie, sums, bits.value if extend else None)
                if len(number):
                    yield pa.RecordBatch.from_arrays([pa.array(pids[number]), _signed(after), pa.array(n)], ["pid", "next", "n"])
            some = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(pids[some]), pa.nulls(len(some), pa.int64()), pa.array(sums[some])], ["pid", "next", "n"])

        sums = _summed(map_batches(texts, count, "pid long, next long, n long"), "pid", "next")
        found = stage(sums.where(F.col("next").isNull() | (F.col("n") >= least)))
        shared.destroy()
        out = found if out is None else out.union(found)
    if bits is not None:
        bits.destroy()
    return out


def _numbered(phrases: DataFrame) -> DataFrame:
    """Stored (pid, lang, phrase); numbers are stable because they are stored."""
    return stage(phrases.select(F.monotonically_increasing_id().alias("pid"), "lang", "phrase"))


def frequent_phrases(docs: DataFrame, least: int = 30, longest: int = 4, text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """Stored (lang, phrase, size, f) of all phrases of 1 to ``longest`` words met ``least`` times in
    their language, and stored (lang, n) with the number of its words.

    Null text is empty, a null language is ``und``. Every scan reads the texts again; what is stored
    are counts. On the driver: one trie of at most about ``TRIE_PHRASES`` phrases at a time.
    """
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"))
    counts = _summed(map_batches(texts, _count_words, "lang string, word string, hash long, n long"), "lang", "word", "hash")
    words = stage(counts.where((F.col("n") >= least) | F.col("word").isNull()))
    totals = stage(words.where("word IS NULL").select("lang", "n"))
    words = words.where("word IS NOT NULL")
    letters = stage(words.select("lang", F.col("hash").alias("next"), "word"))
    if not letters.groupBy("lang", "next").count().where("count > 1").isEmpty():
        raise RuntimeError("two frequent words of a language have the same 64-bit hash")
    phrases, counted = _numbered(words.select("lang", F.col("word").alias("phrase"))), []
    for size in range(1, longest + 1):
        if phrases.isEmpty():
            break
        extend = size < longest
        met = scan(texts, phrases, size, extend, least)
        f = met.where("next IS NULL").select("pid", F.col("n").alias("f"))
        counted.append(stage(sized_join(phrases, stage(f), ["pid"], "inner").select("lang", "phrase", F.lit(size).alias("size"), "f").where(F.col("f") >= least)))
        if extend:
            longer = sized_join(met.where("next IS NOT NULL"), phrases, ["pid"], "inner")
            longer = sized_join(longer, letters, ["lang", "next"], "inner")
            phrases = _numbered(longer.select("lang", F.concat_ws(" ", "phrase", "word").alias("phrase")))
    if not counted:
        return docs.sparkSession.createDataFrame([], "lang string, phrase string, size int, f long"), totals
    out = counted[0]
    for more in counted[1:]:
        out = out.union(more)
    return out, totals


def _part(words: F.Column, start, length) -> F.Column:
    return F.array_join(F.slice(words, start, length), " ")


def _runs(words: F.Column, size: F.Column, length: int) -> F.Column:
    """All runs of ``length`` of some words, each as a phrase."""
    return F.transform(F.sequence(F.lit(1), size - length + 1), lambda at: _part(words, at, F.lit(length)))


def collocations(
    docs: DataFrame,
    least: int = 30,
    longest: int = 4,
    scale: int = 2_000_000,
    covered: int = 80,
    top: int = 2000,
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of each language.

    A phrase of 2 to ``longest`` words, met a >= ``least`` times, is cut in two in every way; its
    score is the least of floor(scale * a / (l + r)), where l and r count its parts, and equal scores
    take the first cut. Phrases inside a longer candidate with at least ``covered`` per cent of
    their count are dropped. Order: score, a, phrase by bytes; rows past ``top`` are not reported.
    Words lie within pieces of text without ``.,;:!?`` and line ends, A-Z in lower case. Null text
    is empty, a null language ``und``; repeated rows count as often as they stand there; ids and
    other columns are ignored; texts may have any length; no frequent phrase, or an empty table,
    gives an empty result.
    """
    found, totals = frequent_phrases(docs, least, longest, text_col, lang_col)
    found = stage(found)
    candidates = found.where("size > 1").withColumn("words", F.split("phrase", " "))
    sides = [(k, side) for k in range(1, longest) for side in "lr"]
    parts = [F.when(F.col("size") > k, _part(F.col("words"), 1, k) if side == "l" else _part(F.col("words"), k + 1, longest)) for k, side in sides]
    names = F.array(*[F.struct(F.lit(f"{side}{k}").alias("side"), part.alias("part")) for (k, side), part in zip(sides, parts, strict=True)])
    pieces = stage(candidates.select("lang", "phrase", F.col("f").alias("a"), F.explode(names).alias("p")).select("lang", "phrase", "a", "p.side", "p.part").where("part IS NOT NULL"))
    uses = pieces.groupBy("lang", "part").agg(F.count("*").alias("uses"))
    values = uses.join(found.select("lang", F.col("phrase").alias("part"), "f"), ["lang", "part"])
    known = hot_split_join(pieces, values, ["lang", "part"], "uses", ["f"], ["phrase", "side"])
    counts = [F.max(F.when(F.col("side") == f"{side}{k}", F.col("f"))).alias(f"{side}{k}") for k, side in sides]
    known = known.groupBy("lang", "phrase", "a").agg(*counts)
    # Products may pass 64 bits.
    score = "CAST(({scale} * CAST(a AS DECIMAL(28,0))) DIV (CAST(l{k} AS DECIMAL(20,0)) + CAST(r{k} AS DECIMAL(20,0))) AS BIGINT)"
    cuts = [F.expr(f"IF(l{k} IS NULL, NULL, struct({score.format(scale=scale, k=k)} AS score, {k} AS k, l{k} AS l, r{k} AS r))") for k in range(1, longest)]
    best = known.select("lang", "phrase", "a", F.array_min(F.array(*cuts)).alias("cut")).select("lang", "phrase", "a", "cut.*")
    inner = [F.when(F.col("size") > length, _runs(F.col("words"), F.col("size"), length)) for length in range(2, longest)]
    if inner:
        inside = F.explode(F.flatten(F.array_compact(F.array(*inner))))
        within = candidates.where("size > 2").select("lang", inside.alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
        best = best.join(within, ["lang", "phrase"], "left").where(F.expr(f"longer IS NULL OR 100 * longer < {covered} * a"))
    order = F.row_number().over(_ranking())
    ranked = best.withColumn("rank", order).where(F.col("rank") <= top)
    out = sized_join(ranked, totals, ["lang"], "inner")
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _ranking():
    from pyspark.sql import Window

    return Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")


SQL = r"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang,
         regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces
  FROM documents),
p AS (SELECT lang, row_number() OVER () AS piece, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(pieces) AS piece FROM t)),
s AS (SELECT lang, piece, unnest(w) AS w1, generate_subscripts(w, 1) AS pos FROM p),
q AS (SELECT lang, w1, lead(w1, 1) OVER o AS w2, lead(w1, 2) OVER o AS w3, lead(w1, 3) OVER o AS w4 FROM s WINDOW o AS (PARTITION BY piece ORDER BY pos)),
g AS (
  SELECT lang, 1 AS k, w1 AS phrase FROM q
  UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM q WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM q WHERE w3 IS NOT NULL
  UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM q WHERE w4 IS NOT NULL),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 30),
x AS (SELECT c.lang, c.phrase, c.a, j.j, l.f AS l, r.f AS r,
             CAST((2000000 * CAST(c.a AS HUGEINT)) // (CAST(l.f AS HUGEINT) + r.f) AS BIGINT) AS score
      FROM c JOIN (SELECT unnest(range(1, 4)) AS j) j ON j.j < c.k
      JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1 : j.j], ' ')
      JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[j.j + 1 :], ' ')),
b AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
i AS (SELECT lang, f AS longer, unnest(flatten(list_transform(range(2, k), lambda m:
        list_transform(range(1, k - m + 2), lambda i: array_to_string(w[i : i + m - 1], ' '))))) AS phrase
      FROM (SELECT lang, k, a AS f, w FROM c WHERE k > 2)),
o AS (SELECT lang, phrase, max(longer) AS longer FROM i GROUP BY ALL),
e AS (SELECT b.* FROM b LEFT JOIN o USING (lang, phrase) WHERE o.longer IS NULL OR 100 * o.longer < 80 * b.a),
z AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM e)
SELECT z.lang, z.rank, z.phrase, z.a, z.l, z.r, n.n, z.score FROM z JOIN n USING (lang) WHERE z.rank <= 2000
"""


@query("op12_phrases", SQL)
def op12_phrases(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))
