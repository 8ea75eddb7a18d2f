"""Personal data: four exact base kinds, and more spans from bootstrapped contexts.

Base spans are the seeds. The words around seeds and around other strings that look like
identifiers are lexical patterns; patterns and strings form a graph that Spark scores in turns: a
pattern is as good as the strings it stands with, a string as good as its best pattern. Strings at
patterns of high confidence are added as spans and are seeds of the next turn, so that patterns which
no base span stands with are reached as well; it ends when scores have settled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, query, sized_join, stage, table, text_chunks

KINDS = ["email", "ip", "card", "phone"]
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
#: Looser shapes, tried on what base spans leave; only their contexts can make them spans.
SHAPES = {
    "email": re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}\s?(?:@|\(at\)|\[at\]|\bat\b)\s?[A-Za-z0-9-]{1,63}(?:\s?(?:\.|\(dot\)|\[dot\]|\bdot\b)\s?[A-Za-z0-9-]{2,63})+", re.IGNORECASE),
    "ip": re.compile(r"[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\s?dot\s?)[0-9]{1,3}){3}|[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}"),
    "card": re.compile(r"(?<![0-9])[0-9]{4}(?:[\x20._/-]?[0-9]{4}){2}[\x20._/-]?[0-9]{1,7}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9])(?:\([0-9]{2,4}\)|0[0-9]{1,4}|[0-9]{3})[\x20./-]?[0-9]{3,4}[\x20./-]?[0-9]{3,4}(?![0-9])|(?<![0-9])[0-9]{3}-[0-9]{4}(?![0-9])"),
}
#: A text with a loose e-mail address has a sign and a dotted name after it; read by Arrow for a whole
#: batch. It lets some texts through that have none (its classes are wider), never the other way.
MAYBE_EMAIL = (
    r"(?i)(?:@|\(at\)|\[at\]|\bat\b)[\s\x1c-\x1f\x{85}\p{Z}]?[a-z0-9\x{17f}\x{212a}\x{130}\x{131}-]+"
    r"[\s\x1c-\x1f\x{85}\p{Z}]?(?:\.|\(dot\)|\[dot\]|\bdot\b)[\s\x1c-\x1f\x{85}\p{Z}]?[a-z0-9\x{17f}\x{212a}\x{130}\x{131}-]{2}"
)
WORDS = re.compile(r"[^\W\d_]+")
#: A context is made of the nearest words within so many characters before and after a string.
CONTEXT = 60


def luhn(digits: str) -> bool:
    """Whether the last digit is the check digit of the others."""
    total = 0
    for place, char in enumerate(reversed(digits)):
        value = ord(char) - 48
        if place % 2:
            value = value * 2 - 9 * (value > 4)
        total += value
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the four base kinds, leftmost and without overlap within a kind, in order."""
    out: list[tuple[int, int, int]] = []
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((start, 0, found.end()))
            done = found.end()
        at = text.find("@", max(done, at + 1))
    if not DIGIT.search(text):
        return sorted(out)
    for found in IP.finditer(text):
        # A part of more digits than an int may have would be far above 255 anyway.
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in found.group().split(".")):
            out.append((found.start(), 1, found.end()))
    for found in CARD.finditer(text):
        if found.end() - found.start() >= 14:
            digits = found.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((found.start(), 2, found.end()))
    if "+" in text:
        for found in PHONE.finditer(text):
            if 10 <= sum(char.isdigit() for char in found.group()) <= 15:
                out.append((found.start(), 3, found.end()))
    return sorted(out)


def loose_spans(text: str, taken: list[tuple[int, int, int]], emails: bool = True) -> list[tuple[int, int, int]]:
    """Strings that look like an identifier and overlap no base span and none of an earlier kind, in
    order. ``emails`` false: the text is known to have no loose address."""
    edges = sorted((start, end) for start, _, end in taken)
    out: list[tuple[int, int, int]] = []
    digits = DIGIT.search(text) is not None
    for number, kind in enumerate(KINDS):
        if not (digits if number else emails):
            continue
        # Both lists are in order, so one sweep tells which strings are free. (Base spans of different
        # kinds may overlap: what counts is how far the ones begun so far reach.)
        fresh, at, reach = [], 0, 0
        for found in SHAPES[kind].finditer(text):
            start, end = found.span()
            while at < len(edges) and edges[at][0] < end:
                reach = max(reach, edges[at][1])
                at += 1
            if start >= reach:
                fresh.append((start, end))
        edges = sorted(edges + fresh)
        out += [(start, number, end) for start, end in fresh]
    return sorted(out)


def contexts(text: str, start: int, end: int) -> list[str]:
    """Patterns of a place: the two words before it, and the words on either side."""
    left = [w.lower() for w in WORDS.findall(text[max(0, start - CONTEXT) : start])][-2:]
    right = [w.lower() for w in WORDS.findall(text[end : end + CONTEXT])][:1]
    out = []
    if len(left) == 2:
        out.append(f"{left[0]} {left[1]} _")
    if left and right:
        out.append(f"{left[-1]} _ {right[0]}")
    return out


SPAN = "struct<start:long,kind:int,end:long>"
MENTION = "struct<start:long,kind:int,end:long,value:string,patterns:array<string>>"


def _mentions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fields = [("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("value", pa.string()), ("patterns", pa.list_(pa.string()))]
    kind = pa.list_(pa.struct(fields))

    def named(text: str, spans: list[tuple[int, int, int]]) -> list[dict]:
        return [{"start": a, "kind": k, "end": b, "value": " ".join(text[a:b].lower().split()), "patterns": contexts(text, a, b)} for a, k, b in spans]

    for batch in text_chunks(batches):
        seeds, others = [], []
        texts = batch.column("text")
        emails = pc.match_substring_regex(texts, MAYBE_EMAIL).to_pylist()
        for text, email in zip(texts.to_pylist(), emails, strict=True):
            base = base_spans(text)
            seeds.append(named(text, base))
            others.append(named(text, loose_spans(text, base, email)))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("rid"), pa.array(seeds, kind), pa.array(others, kind)], ["doc_id", "rid", "seeds", "others"])


def confident_patterns(mentions: DataFrame, least_seeds: int = 3, confidence: float = 0.7, growth: float = 0.005) -> DataFrame:
    """Stored (pattern, kind) of high confidence.

    mentions: kind, value, seed, pattern. In each round a pattern's confidence for a kind is the sum
    of its strings' scores of that kind over one more than all its strings. Patterns with at least
    ``least_seeds`` different seeds give other strings their confidence as score; strings of patterns
    with at least ``confidence`` are seeds from then on. Scores and seeds only grow; the last round is
    one in which no pattern's confidence grew by ``growth``, so that none is new.
    """
    edges = stage(mentions.groupBy("pattern", "kind", "value").agg(F.max("seed").alias("base")))
    totals = stage(edges.groupBy("pattern").agg(F.count("*").alias("strings")))
    scores = edges.groupBy("kind", "value").agg(F.max(F.col("base").cast("double")).alias("score"), F.max("base").alias("seed"))
    before = None
    while True:
        known = edges.join(scores, ["kind", "value"])
        sums = known.groupBy("pattern", "kind").agg(F.sum("score").alias("score"), F.sum(F.col("seed").cast("long")).alias("seeds"))
        patterns = stage(
            sized_join(sums.where(F.col("seeds") >= least_seeds), totals, ["pattern"], "inner")
            .select("pattern", "kind", (F.col("score") / (F.col("strings") + 1)).alias("confidence"))
        )
        grown = patterns
        if before is not None:
            last = before.select("pattern", "kind", F.col("confidence").alias("last"))
            grown = patterns.join(last, ["pattern", "kind"], "left").where(F.col("confidence") - F.coalesce("last", F.lit(0.0)) >= growth)
        if grown.isEmpty():
            return stage(patterns.where(F.col("confidence") >= confidence).select("pattern", "kind"))
        before = patterns
        best = sized_join(edges, patterns, ["pattern", "kind"], "left")
        score = F.when(F.col("base"), 1.0).otherwise(F.coalesce("confidence", F.lit(0.0)))
        seed = F.col("base") | (F.coalesce("confidence", F.lit(0.0)) >= confidence)
        scores = stage(best.groupBy("kind", "value").agg(F.max(score).alias("score"), F.max(seed).alias("seed")))


def _joined(spans) -> F.Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _equals(number: int):
    return lambda value: value == number


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_seeds: int = 3, confidence: float = 0.7) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (all), n_added per row.

    Null text is empty: no spans, the digest of the empty string. Places are code points, ends
    exclusive. Added spans overlap no base span. Equal rows get equal results, null ids are kept
    as they are, other columns are ignored. Texts may have any length: their strings are found in
    sweeps. An empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(id_col).cast("string"), text).alias("rid"), text.alias("text"))
    found = stage(map_batches(rows, _mentions, f"doc_id long, rid long, seeds array<{MENTION}>, others array<{MENTION}>"))
    each = [found.select(F.lit(seed).alias("seed"), F.explode(c).alias("m")) for seed, c in ((True, "seeds"), (False, "others"))]
    edges = each[0].union(each[1]).select("seed", "m.kind", "m.value", F.explode("m.patterns").alias("pattern"))
    good = confident_patterns(edges, least_seeds, confidence)
    loose = found.select("rid", F.explode("others").alias("m")).select("rid", "m.start", "m.kind", "m.end", F.explode("m.patterns").alias("pattern"))
    hits = sized_join(loose, good, ["pattern", "kind"], "left_semi").select("rid", F.struct("start", "kind", "end").alias("s")).distinct()
    added = stage(hits.groupBy("rid").agg(F.sort_array(F.collect_list("s")).alias("added")))
    plain = F.transform("seeds", lambda m: F.struct(m["start"].alias("start"), m["kind"].alias("kind"), m["end"].alias("end")))
    out = sized_join(found.select("doc_id", "rid", plain.alias("base")), added, ["rid"], "left")
    more = F.coalesce("added", F.array().cast(f"array<{SPAN}>"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, _equals(k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return out.select(
        "doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.sort_array(F.concat("base", more))).alias("spans"), F.size(more).cast("long").alias("n_added"),
    )


@query("op2_pii")
def op2_pii(spark, sf_dir):
    return personal_data(table(spark, sf_dir, "documents"))
