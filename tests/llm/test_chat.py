from __future__ import annotations

import itertools
import random
from collections import defaultdict

from emberline.llm.chat import INSERT, MERGE, NAME, RELABEL, ROLES, START, best_states, chunk_matrix, format_chats, repair, role_number

SCHEMA = "conv_id long, turn long, role string, text string, number string, block string, part string, place string"
NEXT = {START: [0, 1], 0: [1], 1: [2], 2: [1]}


def inserted(before, to):
    """Fewest empty turns between two roles, by trying them out."""
    front = [before]
    for n in range(4):
        if any(to in NEXT[s] for s in front):
            return n
        front = [t for s in front for t in NEXT[s]]
    return None


def brute(roles):
    best = 1 << 40
    for tos in itertools.product(range(3), repeat=len(roles)):
        for merges in itertools.product((False, True), repeat=len(roles)):
            cost, state = 0, START
            for role, to, merge in zip(roles, tos, merges, strict=True):
                cost += 0 if role == to else NAME if role < 0 else RELABEL
                n = inserted(state, to)
                if merge and state != to or not merge and n is None:
                    break
                cost, state = cost + (MERGE if merge else n * INSERT), to
            else:
                best = min(best, cost + INSERT * {0: 2, 1: 1}.get(state, 0))
    return best


def test_costs_are_least_whatever_the_chunks():
    rng = random.Random(1)
    for _ in range(200):
        roles = [rng.choice([-1, 0, 1, 2]) for _ in range(rng.randrange(6))]
        assert best_states([chunk_matrix(roles)])[0] == brute(roles)
        cut = rng.randrange(len(roles) + 1)
        assert best_states([chunk_matrix(roles[:cut]), chunk_matrix(roles[cut:])])[0] == brute(roles)
        cost, states = best_states([chunk_matrix(roles)])
        paid = INSERT * {0: 2, 1: 1}.get(states[1], 0)
        for role, (to, action, new) in zip(roles, repair(roles, states[0], states[1]), strict=True):
            paid += (0 if role == to else NAME if role < 0 else RELABEL) + MERGE * (action == "merge") + INSERT * len(new)
        assert paid == cost


def turns(rendered):
    """Roles and texts of a rendered chat."""
    assert rendered.endswith("<|end|>\n")
    return [tuple(part.split("|>\n", 1)) for part in rendered.removesuffix("<|end|>\n").split("<|")[1:]]


def chats(rows):
    out = defaultdict(list)
    for r in sorted(rows, key=lambda r: r.place):
        out[r.conv_id].append(r)
    return out


def test_conversations(spark):
    rng = random.Random(7)
    stored = []
    for conv in range(40):
        for turn in range(rng.randrange(1, 30)):
            stored.append((conv, turn, rng.choice(["user", "assistant", "system", "Human ", "narrator", None]), rng.choice([None, "", f"t{turn} <|user|> x"])))
    stored += [(None, 1, "user", "a"), (None, None, "assistant", "b"), (90, 5, "user", "q"), (90, 5, "user", "q"), (90, 5, "assistant", "r")]
    frame = spark.createDataFrame([(*row, "n", "b", "p", "x") for row in stored], SCHEMA)
    for chunk in (1000, 4, 1):
        got = chats(format_chats(frame, chunk).collect())
        assert sum(map(len, got.values())) == len(stored)
        for conv, rows in got.items():
            assert rows[0].conv_cost == best_states([chunk_matrix([role_number(r.role_in) for r in rows])])[0]
            shown = turns("".join(r.rendered for r in rows))
            state = START
            for role, _ in shown:
                assert ROLES.index(role) in NEXT[state]
                state = ROLES.index(role)
            assert state == 2
            if conv != 90:
                assert [r.turn for r in rows] == sorted((r.turn for r in rows), key=lambda t: (t is None, t))


def test_one_turn_number_with_many_rows(spark):
    rows = [(1, 0, "system", "s")] + [(1, 3, "user" if k % 3 else "assistant", f"t{k}") for k in range(300)] + [(1, 4, "user", "u"), (1, 5, "assistant", "a")]
    frame = spark.createDataFrame([(*row, "n", "b", "p", "x") for row in rows], SCHEMA)
    got = chats(format_chats(frame, 20).collect())[1]
    assert [r.turn for r in got] == [0] + [3] * 300 + [4, 5]
    whole = chats(format_chats(frame).collect())[1]
    assert "".join(r.rendered for r in got) and got[0].conv_cost == whole[0].conv_cost


def test_empty_table(spark):
    assert format_chats(spark.createDataFrame([], SCHEMA)).collect() == []
