"""Small corpora with the awkward cases that every operator meets, and rows around them."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, rid long, content string, block string, n string, digest string, group string"


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def frame(spark, texts, ids=None, langs=None):
    """Documents with extra columns whose names operators use inside."""
    ids = list(range(len(texts))) if ids is None else ids
    langs = [None] * len(texts) if langs is None else langs
    rows = [(i, t, lang, None, None, 7, None, "x", "b", None, "d", "g") for i, t, lang in zip(ids, texts, langs, strict=True)]
    return spark.createDataFrame(rows, SCHEMA)


def words(text):
    return (text or "").encode().split()


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
