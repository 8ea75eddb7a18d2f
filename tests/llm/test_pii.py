from __future__ import annotations

import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from emberline.llm.pii import KINDS, base_spans, loose_spans, luhn, personal_data

from .corpus import frame

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def check_digit(digits):
    total = sum(sum(divmod(2 * int(d), 10)) if k % 2 == 0 else int(d) for k, d in enumerate(reversed(digits)))
    return str(-total % 10)


def plain(text):
    """The base kinds, read straight from their definition."""
    out = []
    for kind, pattern in PATTERNS.items():
        for found in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", found.group())
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in found.group().split(".")),
                "card": kind == "card" and 14 <= len(digits) <= 19 and check_digit(digits[:-1]) == digits[-1],
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((found.start(), KINDS.index(kind), found.end()))
    return sorted(out)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab1230 459.@+-()%é_ 78", max_size=60))
def test_base_spans_match_their_definition(text):
    assert base_spans(text) == plain(text)


def test_luhn():
    assert luhn("4111111111111111") and not luhn("4111111111111112") and luhn("79927398713")


SAMPLES = [
    "write to a.b@c-d.example.org. or @x.y or q@z", "x@y@z.com @.a", "10.0.0.256 10.0.0.255 1.2.3.4.5 00010.0.0.1",
    "card 4111 1111-1111 1111, 4111111111111112", "call +1 (017) 555-7713 now, +12 34", "é😀 a@b.co 😀 +4915112345678", None, "",
]


def test_rows_digests_and_places(spark):
    got = {r.doc_id: r for r in personal_data(frame(spark, SAMPLES)).collect()}
    for i, text in enumerate(SAMPLES):
        base = plain(text or "")
        joined = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in base)
        row = got[i]
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(k == j for _, k, _ in base) for j in range(4)]
        assert set(filter(None, joined.split(","))) <= set(row.spans.split(","))


def test_patterns_of_seeds_find_unseen_identifiers(spark):
    rng = random.Random(4)
    texts = [f"Please call our desk at phone number +1 (20{k}) 555-01{k:02d} today {rng.random()}" for k in range(8)]
    texts += ["Dial phone number (017) 555-7713 today", "room (017) 555-7713 upstairs", "the year 2024-2025"]
    got = {r.doc_id: r for r in personal_data(frame(spark, texts)).collect()}
    assert got[8].n_added == 1 and got[8].n_phone == 0
    kind, start, end = got[8].spans.split(":")
    assert kind == "phone" and texts[8][int(start) : int(end)] == "(017) 555-7713"
    assert got[9].n_added == got[10].n_added == 0
    assert all(got[k].n_added == 0 and got[k].n_phone == 1 for k in range(8))


def test_empty_table_null_ids_repeated_rows_and_long_text(spark):
    assert personal_data(frame(spark, [])).collect() == []
    long = "word " * 100_000 + "a@b.co"
    rows = personal_data(frame(spark, ["a@b.co", "a@b.co", "a@b.co", long], [None, 1, 1, 2])).collect()
    assert len(rows) == 4 and all(r.n_email == 1 for r in rows)
    assert next(r.spans for r in rows if r.doc_id == 2) == "email:500000:500006"


def test_loose_addresses_do_not_need_other_signs_in_the_text():
    for address in ("jane at example.com", "jane AT example dot com", "jane(at)example.com", "jane [at] example [dot] com"):
        assert loose_spans(f"mail: {address}", []) == [(6, 0, 6 + len(address))]


def test_accepted_strings_are_seeds_of_the_next_turn(spark):
    """Base phones stand at pattern A; loose numbers stand at A and at B; more stand at B, then at C only."""
    numbers = [f"(0{20 + k}) 555-{1000 + 7 * k}" for k in range(24)]
    rng = random.Random(6)
    noise = lambda: f"{rng.random()} "
    texts = [f"{noise()}please dial +1 (20{k}) 555-01{k:02d} today" for k in range(8)]
    texts += [f"{noise()}please dial {n} today" for n in numbers[:8]]
    texts += [f"{noise()}reach us {n} anytime" for n in numbers[:16]]
    texts += [f"{noise()}office line {n} monday" for n in numbers[8:24]]
    texts += [f"{noise()}invoice sum {n} paid" for n in ("(111) 222-3333", "(222) 333-4444", "(333) 444-5555")]
    got = {r.doc_id: r for r in personal_data(frame(spark, texts), confidence=0.6).collect()}
    added = [got[i].n_added for i in range(len(texts))]
    assert added[:8] == [0] * 8 and added[8:48] == [1] * 40 and added[48:] == [0] * 3


def test_many_numbers_take_linear_time():
    import time

    def seconds(n):
        text = "555-1234, " * n
        begin = time.process_time()
        found = loose_spans(text, base_spans(text))
        assert len(found) == n
        return time.process_time() - begin

    seconds(1000)
    assert seconds(80_000) < 40 * max(seconds(8_000), 0.01)


def test_loose_spans_keep_clear_of_base_spans_of_other_kinds():
    text = "1.2.3.4 0171 555 7713 a@b.co 10.0.0.1"
    for start, _, end in loose_spans(text, base_spans(text)):
        assert all(end <= a or start >= b for a, _, b in base_spans(text))
