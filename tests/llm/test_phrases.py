from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from emberline.llm import phrases
from emberline.llm.phrases import Trie, collocations

from .corpus import frame, lowered


def brute(texts, langs, least=30, top=2000):
    f, n = Counter(), Counter()
    for text, lang in zip(texts, langs, strict=True):
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered(text)):
            words = tuple(re.findall("[^\x20\x09]+", piece))
            n[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f[lang, words[i : i + k]] += 1
    candidates = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    dropped = set()
    for (lang, words), a in candidates.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                if 100 * a >= 80 * f[lang, words[i : i + k]]:
                    dropped.add((lang, words[i : i + k]))
    rows = {}
    for (lang, words), a in candidates.items():
        if (lang, words) not in dropped:
            cuts = [(2_000_000 * a // (f[lang, words[:k]] + f[lang, words[k:]]), k, f[lang, words[:k]], f[lang, words[k:]]) for k in range(1, len(words))]
            score, _, left, right = min(cuts)
            rows.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    return [
        (lang, rank, phrase.decode(), -a, left, right, n[lang], -score)
        for lang in sorted(rows)
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows[lang])[:top], 1)
    ]


def got(df):
    return sorted(tuple(r) for r in df.collect())


def corpus(seed, n=150):
    rng = random.Random(seed)
    stock = ["new york city hall", "New York", "ice cream", "à la carte", "x\x1fy z", "the the the the", "a b\tc  d"]
    texts = []
    for _ in range(n):
        words = [rng.choice(stock) if rng.random() < 0.3 else f"w{min(rng.randrange(40), rng.randrange(40))}" for _ in range(rng.randrange(60))]
        texts.append("".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "!"]) for w in words))
    langs = [rng.choice([None, "en", "en", "en", "und", "", "dé"]) for _ in texts]
    return texts, langs


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    texts, langs = corpus(seed)
    texts += [None, "", " . ", "one", texts[0], texts[0]]
    langs += [None, "en", None, "zz", "en", "en"]
    want = brute(texts, langs)
    assert len(want) > 20
    assert got(collocations(frame(spark, texts, langs=langs).repartition(5))) == sorted(want)


def test_several_tries_give_the_same(spark, monkeypatch):
    texts, langs = corpus(3)
    monkeypatch.setattr(phrases, "TRIE_PHRASES", 9)
    monkeypatch.setattr(phrases, "TRIE_PHRASES", 9)
    assert got(collocations(frame(spark, texts, langs=langs).repartition(3), least=25)) == sorted(brute(texts, langs, 25))


def test_best_rows_only_and_ties(spark):
    texts = [" . ".join(f"{a}{b} {b}{a}" for a in "abcdef" for b in "ghijk")] * 30
    rows = got(collocations(frame(spark, texts, langs=["en"] * 30), top=7))
    assert rows == sorted(brute(texts, ["en"] * 30, top=7)) and len(rows) == 7
    assert [r[2] for r in rows] == sorted(r[2] for r in rows)


def test_empty_tables_and_no_phrases(spark):
    assert collocations(frame(spark, [])).collect() == []
    assert collocations(frame(spark, [None, "", "a b c"])).collect() == []
    assert collocations(frame(spark, ["word. " * 50])).collect() == []


def test_one_long_text_of_one_phrase(spark):
    texts = ["go on " * 300_000, "Go on"]
    want = brute(["go on " * 3000, ""], [None] * 2)
    assert [r[2] for r in want] == [r[2] for r in got(collocations(frame(spark, texts)))]
    row = next(r for r in got(collocations(frame(spark, texts))) if r[2] == "go on go on")
    assert row[3] == 299_999 and row[6] == 600_002


def test_trie_holds_its_phrases_and_no_others():
    rng = np.random.default_rng(5)
    hashes = np.unique(rng.integers(1, 60, (4000, 3)) ** 2, axis=0).astype(np.uint64)
    langs = [("a", "b")[i % 2] for i in range(len(hashes))]
    trie = Trie(langs, hashes)
    have = {(lang, *row): i for i, (lang, row) in enumerate(zip(langs, hashes.tolist(), strict=True))}
    text = (rng.integers(1, 62, 50_000) ** 2).astype(np.uint64)
    linked = rng.random(len(text)) < 0.9
    linked[-1] = False
    for lang in "ab":
        at, number = trie.advance(np.full(len(text), trie.roots[lang], np.int32), trie.codes(text), linked)
        want = [(i, have[lang, *text[i : i + 3].tolist()]) for i in range(len(text) - 2) if linked[i] and linked[i + 1] and (lang, *text[i : i + 3].tolist()) in have]
        assert list(zip(at.tolist(), number.tolist(), strict=True)) == want and want


def test_trie_of_words_with_very_many_followers_stays_small():
    """First words with hundreds of followers each must not make the array sparse."""
    rng = np.random.default_rng(6)
    ranks = np.minimum(rng.zipf(1.3, (400_000, 2)), 20_000)
    hashes = np.unique((ranks.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), axis=0)
    trie = Trie(["en"] * len(hashes), hashes)
    assert len(trie.base) < 16 * len(hashes)
    text = hashes[rng.permutation(len(hashes))[:5000]].ravel()
    at, number = trie.advance(np.zeros(len(text), np.int32), trie.codes(text), np.arange(len(text)) % 2 == 0)
    assert at.tolist() == list(range(0, len(text), 2)) and (hashes[number].ravel() == text).all()
