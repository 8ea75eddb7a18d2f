"""N-gram Jaccard join with rare-first prefixes, and its components.

Texts become sets of word shingles (64-bit hashes). Shingles are ordered by document frequency,
rare ones first, so a text's prefix, the part that every similar text must share a shingle with,
is made of its rarest shingles. A shingle of one text alone finds nothing: texts whose whole prefix
is of that kind are left out early, by counting packed hashes, and only the rest is indexed.

Candidates meet on prefix shingles; a pair is kept if its sizes (length filter) and the places of
its first common shingle (positional filter) allow the similarity, and is then verified once, after
a look at how its sets fall apart around their middle (suffix filter). Equal sets are one class from
the start. Groups of near copies are first linked as stars around one text of each size on a shingle;
after that only texts of different components are paired, on their first common shingle, and only if
their whole prefixes allow it, so a group never yields all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, blob, map_batches, mix, query, sized_join, stage, stored_bytes, table, text_chunks, windows, with_row_key
from .components import components

#: Text bytes whose shingles a task counts at once before it hands them on.
BLOCK_BYTES = 6 << 20
#: Stored bytes of input for each group of hashes counted together.
GROUP_BYTES = 8 << 20
SEEN = np.uint16(0xFFFF)


def shingle_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text: runs of ``n`` words, or all words if fewer."""
    words = Words(texts, lower=True)
    hashes = windows(words.hashes, n)
    out = []
    for lo, hi in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if hi - lo >= n:
            own = np.sort(hashes[lo : hi - n + 1])
            out.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        elif hi > lo:
            out.append(mix(windows(words.hashes[lo:hi], hi - lo) + np.uint64(hi - lo)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _blocks(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[int, list, list[np.ndarray]]]:
    """(number, ids, sets) of blocks of consecutive texts; numbers are the same when a task runs again."""
    task, number = TaskContext.get().partitionId(), 0
    ids: list = []
    sets: list[np.ndarray] = []
    size = 0
    for batch in text_chunks(batches):
        ids += batch.column("id").to_pylist()
        sets += shingle_sets(batch.column("text"), n)
        size += batch.column("text").nbytes
        if size >= BLOCK_BYTES or len(ids) > 30_000:
            yield (task << 24) + number, ids, sets
            ids, sets, size, number = [], [], 0, number + 1
    if ids:
        yield (task << 24) + number, ids, sets


def _binary(rows: list[bytes]) -> pa.Array:
    return pa.array(rows, pa.binary())


def census(docs: DataFrame, n: int) -> DataFrame:
    """Stored: id, n, d1, d2 (digest of the set), shared: how many of its shingles another text has.

    ``shared`` may be too high by a hash collision, never too low. Per block a hash is sent once;
    hashes that a block has twice are counted there, so a hot shingle costs a row per block.
    """
    groups = max(8, -(-stored_bytes(docs) // GROUP_BYTES))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, ids, sets in _blocks(batches, n):
            for lo in range(0, len(ids), 60_000):
                yield from _post(block + (lo << 40), ids[lo : lo + 60_000], sets[lo : lo + 60_000], groups)

    def count(rows: pa.Table) -> pa.Table:
        group = rows["group"][0].as_py()
        if group < 0:
            return pa.table({c: rows[c].combine_chunks() for c in ("block", "a", "b", "c", "d")})
        parts = [np.frombuffer(x, np.uint32) for x in rows["a"].to_pylist()]
        owners = [np.frombuffer(x, np.uint16) for x in rows["b"].to_pylist()]
        hashes = np.concatenate(parts)
        order = np.argsort(hashes, kind="stable")
        ranked = hashes[order]
        same = ranked[1:] == ranked[:-1]
        shared = np.empty(len(hashes), bool)
        shared[order] = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        a, b, at = [], [], 0
        for own in owners:
            hits = own[shared[at : at + len(own)] & (own != SEEN)]
            at += len(own)
            docs_hit, times = np.unique(hits, return_counts=True)
            a.append(blob(docs_hit))
            b.append(blob(times.astype(np.uint32)))
        empty = _binary([b""] * len(a))
        return pa.table({"block": rows["block"].combine_chunks(), "a": _binary(a), "b": _binary(b), "c": empty, "d": empty})

    def gather(rows: pa.Table) -> pa.Table:
        info = next(r for r in rows.to_pylist() if r["d"])
        ids = np.frombuffer(info["a"], np.int64)
        sizes, local = np.frombuffer(info["b"], np.int64).reshape(2, -1)
        d1, d2 = np.frombuffer(info["c"], np.int64).reshape(2, -1)
        shared = local.copy()
        for a, b, d in zip(rows["a"].to_pylist(), rows["b"].to_pylist(), rows["d"].to_pylist(), strict=True):
            if not d:
                shared[np.frombuffer(a, np.uint16)] += np.frombuffer(b, np.uint32)
        known = np.frombuffer(info["d"], np.uint8) == 1
        return pa.table({"id": pa.array(ids, mask=~known), "n": sizes, "d1": d1, "d2": d2, "shared": shared})

    posted = map_batches(docs, post, "group long, block long, a binary, b binary, c binary, d binary")
    counted = posted.groupBy("group").applyInArrow(count, "block long, a binary, b binary, c binary, d binary")
    return stage(counted.groupBy("block").applyInArrow(gather, "id long, n long, d1 long, d2 long, shared long"))


def _post(block: int, ids: list, sets: list[np.ndarray], groups: int) -> Iterator[pa.RecordBatch]:
    sizes = np.array([len(s) for s in sets], np.int64)
    hashes = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes).astype(np.uint16)
    order = np.argsort(hashes)
    hashes, owner = hashes[order], owner[order]
    new = np.concatenate([[True], hashes[1:] != hashes[:-1]]) if len(hashes) else np.zeros(0, bool)
    single = new & np.concatenate([new[1:], [True]]) if len(hashes) else new
    local = np.bincount(owner[~single], minlength=len(sets)).astype(np.int64)
    hashes, owner = hashes[new], np.where(single, owner, SEEN)[new]
    with np.errstate(over="ignore"):
        d1 = np.array([mix(s + np.uint64(11)).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
        d2 = np.array([mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
    numbers = np.array([0 if i is None else i for i in ids], np.int64)
    known = np.array([1 if i is not None else 2 for i in ids], np.uint8)
    rows = [(-1 - block, block, blob(numbers), blob(np.stack([sizes, local])), blob(np.stack([d1, d2])), blob(known))]
    # The group comes from the middle bits, what is compared inside it from the low ones.
    group = (hashes >> np.uint64(32)) % np.uint64(groups)
    order = np.argsort(group, kind="stable")
    cuts = np.searchsorted(group[order], np.arange(groups + 1, dtype=np.uint64))
    low = hashes.astype(np.uint32)[order]
    owner = owner[order]
    for g, (lo, hi) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
        if hi > lo:
            rows.append((g, block, blob(low[lo:hi]), blob(owner[lo:hi]), b"", b""))
    for lo in range(0, len(rows), 64):
        columns = list(zip(*rows[lo : lo + 64], strict=True))
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), *[_binary(list(c)) for c in columns[2:]]],
            ["group", "block", "a", "b", "c", "d"],
        )


def prefix_size(n, num: int, den: int):
    """Shingles of a set of ``n`` that hold one of every set at least num/den similar."""
    return n - -(-n * num // den) + 1


def _can_match(num: int, den: int):
    """Texts with a shingle in their prefix that another text has: fewer unique ones than the prefix."""
    return (F.col("n") > 0) & (F.col("n") - F.col("shared") < F.col("n") - F.ceil(F.col("n") * num / den) + 1)


def _sets(docs: DataFrame, n: int) -> DataFrame:
    """Stored: block, id, n, shingles (sorted 64-bit hashes)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, ids, sets in _blocks(batches, n):
            for lo in range(0, len(ids), 500):
                part = sets[lo : lo + 500]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * len(part), pa.int64()), pa.array(ids[lo : lo + 500], pa.int64()), pa.array([len(s) for s in part], pa.int64()), _binary([blob(s) for s in part])],
                    ["block", "id", "n", "shingles"],
                )

    return stage(map_batches(docs, rows, "block long, id long, n long, shingles binary"))


def _index(sets: DataFrame, num: int, den: int) -> DataFrame:
    """Stored prefix entries token, id, n, place, rank, often of all texts, in the order of rising frequency.

    ``place`` counts all shingles of the text before this one, ``rank`` those that another text
    has, ``often`` the texts with this one.
    """
    groups = max(8, -(-stored_bytes(sets) // GROUP_BYTES))

    def post(rows: pa.Table) -> pa.Table:
        hashes, times = np.unique(np.concatenate([np.frombuffer(x, np.uint64) for x in rows["shingles"].to_pylist()]), return_counts=True)
        group = (hashes >> np.uint64(32)) % np.uint64(groups)
        order = np.argsort(group, kind="stable")
        cuts = np.searchsorted(group[order], np.arange(groups + 1, dtype=np.uint64)).tolist()
        parts = [(g, order[lo:hi]) for g, (lo, hi) in enumerate(zip(cuts, cuts[1:], strict=False)) if hi > lo]
        block = rows["block"][0].as_py()
        return pa.table({
            "group": pa.array([g for g, _ in parts], pa.int64()), "block": pa.array([block] * len(parts), pa.int64()),
            "hashes": _binary([blob(hashes[i]) for _, i in parts]), "times": _binary([blob(times[i].astype(np.uint32)) for _, i in parts]),
        })

    def count(rows: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x, np.uint64) for x in rows["hashes"].to_pylist()]
        times = [np.frombuffer(x, np.uint32) for x in rows["times"].to_pylist()]
        _, where = np.unique(np.concatenate(parts), return_inverse=True)
        totals = np.bincount(where, weights=np.concatenate(times)).astype(np.int64)[where]
        hashes, counts, at = [], [], 0
        for own in parts:
            of = totals[at : at + len(own)]
            at += len(own)
            hashes.append(blob(own[of > 1]))
            counts.append(blob(of[of > 1].astype(np.uint32)))
        return pa.table({"block": rows["block"].combine_chunks(), "hashes": _binary(hashes), "times": _binary(counts)})

    def entries(left: pa.Table, right: pa.Table) -> pa.Table:
        tokens, ids, sizes, places, ranks, counts = [], [], [], [], [], []
        hashes = np.concatenate([np.frombuffer(x, np.uint64) for x in right["hashes"].to_pylist()] or [np.zeros(0, np.uint64)])
        times = np.concatenate([np.frombuffer(x, np.uint32) for x in right["times"].to_pylist()] or [np.zeros(0, np.uint32)])
        order = np.argsort(hashes)
        hashes, times = hashes[order], times[order]
        for doc, n, own in zip(left["id"].to_pylist(), left["n"].to_pylist(), left["shingles"].to_pylist(), strict=True):
            own = np.frombuffer(own, np.uint64)
            at = np.searchsorted(hashes, own)
            hit = at < len(hashes)
            hit[hit] = hashes[at[hit]] == own[hit]
            common, often = own[hit], times[at[hit]]
            alone = n - len(common)
            take = prefix_size(n, num, den) - alone
            if take > 0 and len(common):
                first = np.lexsort((common, often))[:take]
                tokens.append(common[first])
                ids.append(np.full(len(first), doc))
                sizes.append(np.full(len(first), n))
                places.append(alone + np.arange(len(first)))
                ranks.append(np.arange(len(first)))
                counts.append(often[first].astype(np.int64))
        if not tokens:
            return pa.table({c: pa.array([], pa.int64()) for c in ("token", "id", "n", "place", "rank", "often")})
        return pa.table({
            "token": np.concatenate(tokens).view(np.int64), "id": np.concatenate(ids), "n": np.concatenate(sizes),
            "place": np.concatenate(places), "rank": np.concatenate(ranks), "often": np.concatenate(counts),
        })

    posted = sets.select("block", "shingles").groupBy("block").applyInArrow(post, "group long, block long, hashes binary, times binary")
    counted = posted.groupBy("group").applyInArrow(count, "block long, hashes binary, times binary")
    found = sets.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(entries, "token long, id long, n long, place long, rank long, often long")
    return stage(found)


def apart(x: np.ndarray, y: np.ndarray, depth: int = 3) -> int:
    """Lower bound of the number of shingles that only one of two sorted sets has (suffix filter)."""
    if depth == 0 or not len(x) or not len(y):
        return abs(len(x) - len(y))
    middle = y[len(y) // 2]
    cut = int(np.searchsorted(x, middle))
    here = int(cut < len(x) and x[cut] == middle)
    return apart(x[:cut], y[: len(y) // 2], depth - 1) + apart(x[cut + here :], y[len(y) // 2 + 1 :], depth - 1) + (1 - here)


def similar(x: np.ndarray, y: np.ndarray, num: int, den: int) -> bool:
    """Whether den * |x & y| >= num * |x | y| for two sorted sets."""
    total = len(x) + len(y)
    # |x & y| = (total - apart) / 2 and |x | y| = (total + apart) / 2
    if den * (total - apart(x, y)) < num * (total + apart(x, y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return den * both >= num * (total - both)


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Stored: the pairs (a, b) that are similar. ``a`` may be a hot end: its set is added last."""
    own = sets.select("id", "shingles")
    with_b = pairs.join(own.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b")
    both = with_b.join(own.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [
                similar(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), num, den)
                for x, y in zip(batch.column("x"), batch.column("y"), strict=True)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return stage(map_batches(both.select("a", "b", "x", "y"), verify, "a long, b long"))


def _fits(num: int, den: int):
    """Length and positional filter of a meeting of a and b on a common shingle.

    Of the shingles before it only those of other texts, ``rank`` many, can be common as well.
    """
    length = (F.col("na") * den >= F.col("nb") * num) & (F.col("nb") * den >= F.col("na") * num)
    most = F.least("ra", "rb") + F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    return length & (most * (den + num) >= (F.col("na") + F.col("nb")) * num)


def _possible(met: DataFrame, num: int, den: int) -> DataFrame:
    """Distinct pairs (a, b) whose first common shingle allows the similarity."""
    first = met.groupBy("a", "b").agg(*[F.min(c).alias(c) for c in ("na", "nb", "pa", "pb", "ra", "rb")])
    most = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    return first.where(most * (den + num) >= (F.col("na") + F.col("nb")) * num).select("a", "b")


def _entry(index: DataFrame, end: str, *more) -> DataFrame:
    return index.select(
        "token", F.col("id").alias(end), F.col("n").alias(f"n{end}"), F.col("place").alias(f"p{end}"), F.col("rank").alias(f"r{end}"),
        F.col("component").alias(f"c{end}"), *more,
    )


def ngram_components(
    docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, component_id per row, for texts with Jaccard similarity of at least num/den.

    Sets are the distinct shingles of ``n`` words (A-Z lower-cased) of the whole text; a text of
    fewer words is one shingle. Null texts and texts without words have the empty set and link
    with nothing. ``component_id`` is the smallest id reachable by links. Rows that share an id pool
    their links; a null id links with nothing and has a null component. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    info = census(rows, n)
    # Equal sets are one class, held by its smallest id.
    able = info.where(_can_match(num, den) & F.col("id").isNotNull())
    classes = stage(able.groupBy("d1", "d2", "n").agg(F.min("id").alias("rep"), F.count("*").alias("size")))
    again = census(sized_join(rows, classes.select(F.col("rep").alias("id")), ["id"], "left_semi"), n)
    few = stage(again.where(_can_match(num, den)).select("id").distinct())
    labels = _labels(sized_join(rows, few, ["id"], "left_semi"), n, num, den)

    copies = classes.where("size > 1").select("d1", "d2", "n", "rep")
    of_class = sized_join(info, stage(copies), ["d1", "d2", "n"], "left").select("id", "n", F.coalesce("rep", "id").alias("node"))
    found = sized_join(of_class, labels, ["node"], "left")
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "node").alias("component_id"))


def _labels(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """Stored (node, component) of the texts that are linked."""
    sets = _sets(docs, n)
    # Sets of a pair differ in size by a factor of den / num at most: by one class, or none.
    # (The classes are a little wider than that, so that rounding of logarithms cannot part a pair.)
    size_class = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.001 * den / num))).cast("int")
    index = _index(sets, num, den).withColumn("size_class", size_class)
    # Stars: on each shingle every text is tried with that of its size with the fewest shingles of
    # its own, the likeliest original of the others.
    alone = index.withColumn("component", F.col("id"))
    order = F.struct((F.col("place") - F.col("rank")).alias("own"), "id", "n", "place", "rank", "component")
    centre = alone.groupBy("token", "size_class").agg(F.min(order).alias("x")).select("token", "size_class", "x.*")
    stars = _entry(alone, "b", "size_class").join(_entry(centre, "a", "size_class"), ["token", "size_class"])
    links = _verified(_possible(stars.where((F.col("ca") != F.col("cb")) & _fits(num, den)), num, den), sets, num, den)
    # All other pairs: of different components, and only on shingles that have several.
    open_rows = _open(index, components(links))
    near = F.explode(F.array(F.col("size_class"), F.col("size_class") + 1)).alias("size_class")
    more = ["prefix", "last", "ends"]
    left = _entry(open_rows, "a", F.col("size_class").alias("own"), near, *[F.col(c).alias(f"{c}a") for c in more])
    right = _entry(open_rows, "b", "size_class", *[F.col(c).alias(f"{c}b") for c in more])
    # From a's class upwards; inside one class each pair once.
    once = (F.col("own") < F.col("size_class")) | (F.col("a") < F.col("b"))
    fits = (F.col("ca") != F.col("cb")) & once & _fits(num, den) & _prefixes_fit(num, den)
    met = left.join(right, ["token", "size_class"]).where(fits)
    more = _verified(_possible(met, num, den), sets, num, den)
    return components(links.union(more))


def _prefixes_fit(num: int, den: int):
    """Whether this is the first common shingle of a pair, and its whole prefixes allow the similarity.

    Up to the end of the shorter-reaching prefix all common shingles are in both prefixes; after
    it there are no more of them than shingles of that text.
    """
    common = F.array_intersect("prefixa", "prefixb")
    beyond = F.when(F.col("lasta") <= F.col("lastb"), F.col("na") - F.col("endsa")).otherwise(F.col("nb") - F.col("endsb"))
    enough = (F.size(common) + beyond) * (den + num) >= (F.col("na") + F.col("nb")) * num
    return enough & (F.get(common, F.lit(0)) == F.col("token"))


def _open(index: DataFrame, labels: DataFrame) -> DataFrame:
    """Stored entries, with component and whole prefix, of the shingles that stand in several components.

    ``prefix`` has the indexed shingles of the text in order, ``last`` is the last one's place in
    the order of all shingles, ``ends`` the number of shingles up to it. A prefix is as long as the
    threshold asks, whatever the size of the corpus.
    """
    named = sized_join(index.withColumnRenamed("id", "node"), labels, ["node"], "left")
    named = named.withColumn("id", F.col("node")).withColumn("component", F.coalesce("component", "node")).drop("node")
    mixed = named.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("token")
    kept = stage(named.join(mixed, "token", "left_semi"))
    entries = F.sort_array(F.collect_list(F.struct("rank", "token", "often", "place")))
    # Unsigned order of the hashes, as in the index.
    last = F.struct(F.col("x.often"), F.col("x.token").bitwiseXOR(F.lit(-(1 << 63))).alias("hash"))
    whole = (
        index.join(kept.select("id").distinct(), "id", "left_semi").groupBy("id").agg(entries.alias("e"))
        .select("id", F.transform("e", lambda x: x["token"]).alias("prefix"), F.element_at("e", -1).alias("x"))
        .select("id", "prefix", last.alias("last"), (F.col("x.place") + 1).alias("ends"))
    )
    return stage(kept.join(whole, "id"))


def one_of_each(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with the smallest id of their component, all columns kept.

    Rows go by id and text: texts that share an id are told apart, of equally small ids the row of
    the smallest key stays, and rows without an id give way to those with one. Rows equal in both
    stay or go together. Empty texts stay, and so does an empty table.
    """
    keyed, key = with_row_key(docs, id_col, text_col)
    found = ngram_components(keyed.select(F.col(key), F.col(text_col).alias("text")), n, num, den, key, "text")
    linked = stage(found.select(F.col("doc_id").alias(key), F.col("component_id").alias("component")).distinct())
    several = linked.where(F.col(key) != F.col("component")).select("component").distinct()
    members = stage(sized_join(linked, stage(several), ["component"], "left_semi"))
    ids = sized_join(keyed.select(key, F.col(id_col).cast("long").alias("id")), members, [key], "inner")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col(key).alias("key"))).alias("first")
    stays = stage(ids.groupBy("component").agg(first).select(F.col("first.key").alias(key)))
    gone = stage(sized_join(members, stays, [key], "left_anti").select(key))
    return sized_join(keyed, gone, [key], "left_anti").select(*docs.columns)


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(s, ' ') AS h FROM (
    SELECT doc_id, unnest(CASE WHEN len(ws) >= 4 THEN list_transform(range(1, len(ws) - 2), lambda i: ws[i:i + 3]) ELSE [ws] END) AS s
    FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
few AS (SELECT h FROM sh GROUP BY h HAVING count(*) > 1),
hs AS MATERIALIZED (SELECT doc_id, hash(h) AS h FROM sh SEMI JOIN few USING (h)),
links AS MATERIALIZED (
  SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM hs x JOIN hs y ON x.h = y.h AND x.doc_id < y.doc_id GROUP BY 1, 2) p
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * i >= 85 * (na.n + nb.n - i)),
both_ways AS MATERIALIZED (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT a AS node, a AS got FROM both_ways
  UNION SELECT e.a, r.got FROM reach r JOIN both_ways e ON e.b = r.node),
c AS (SELECT node, min(got) AS component FROM reach GROUP BY node)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component, w.doc_id) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN c ON c.node = w.doc_id
"""


@query("op1_ngram_join", SQL)
def op1_ngram_join(spark, sf_dir):
    return ngram_components(table(spark, sf_dir, "documents"), n=4, num=85, den=100)
