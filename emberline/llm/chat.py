"""Chat formatting with minimum-cost role repair.

A legal conversation is an optional system turn, then user and assistant in turn, ending with the
assistant. Every stored turn keeps its role, is given another one, or is merged into the turn before
it; empty turns may be inserted. Dynamic programming over the automaton of legal turns finds the
cheapest repair. Its steps are matrices over (minimum, +), so a conversation of any length is cut
into chunks: chunks become matrices, the short list of matrices fixes the states between chunks,
and each chunk is then repaired and rendered on its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import query, sized_join, stage, table

ROLES = ["system", "user", "assistant"]
#: Other names of roles, at no cost.
ALIASES = {"human": "user", "prompter": "user", "bot": "assistant", "gpt": "assistant", "model": "assistant", "ai": "assistant", "developer": "system"}
START = 3
#: Costs: a turn merged into the one before, an empty turn inserted, a role changed, a missing or unknown role named.
MERGE, INSERT, RELABEL, NAME = 2, 3, 4, 1
FAR = 1 << 40
#: Turn numbers of one chunk.
CHUNK = 1000

#: Roles inserted between the turn before (START: none) and the next; pairs that are not listed are illegal.
LEGAL = {
    (START, 0): [], (START, 1): [], (0, 1): [], (1, 2): [], (2, 1): [],
    (START, 2): [1], (0, 2): [1], (1, 1): [2], (2, 2): [1],
}
#: Roles inserted at the end after the last turn.
CLOSING = {START: [], 0: [1, 2], 1: [2], 2: []}


def role_number(role: str | None) -> int:
    """0 to 2 for system, user, assistant; -1 for a missing or unknown role."""
    name = (role or "").strip().lower()
    name = ALIASES.get(name, name)
    return ROLES.index(name) if name in ROLES else -1


def steps(role: int) -> list[tuple[int, int, int, str, list[int]]]:
    """(from, to, cost, action, inserted) of one stored turn; earlier ones win ties."""
    out = []
    for to in range(3):
        change = 0 if to == role else NAME if role < 0 else RELABEL
        for before in (START, 0, 1, 2):
            if (before, to) in LEGAL:
                new = LEGAL[before, to]
                out.append((before, to, change + INSERT * len(new), "relabel" if change else "keep", new))
            if before == to:
                out.append((before, to, change + MERGE, "merge", []))
    return sorted(out, key=lambda s: (s[2], ("keep", "merge", "relabel").index(s[3]), s[1]))


STEPS = {role: steps(role) for role in (-1, 0, 1, 2)}


def _matrix(role: int) -> np.ndarray:
    out = np.full((4, 4), FAR, np.int64)
    for before, to, cost, _, _ in STEPS[role]:
        out[before, to] = min(out[before, to], cost)
    return out


MATRICES = {role: _matrix(role) for role in (-1, 0, 1, 2)}


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cheapest cost from state to state through both."""
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), FAR)


def chunk_matrix(roles: list[int]) -> np.ndarray:
    out = np.full((4, 4), FAR, np.int64)
    np.fill_diagonal(out, 0)
    for role in roles:
        out = product(out, MATRICES[role])
    return out


def best_states(matrices: list[np.ndarray]) -> tuple[int, list[int]]:
    """Total cost, and the states before, between and after the chunks of one conversation."""
    costs = np.full(4, FAR, np.int64)
    costs[START] = 0
    back = []
    for matrix in matrices:
        through = costs[:, None] + matrix
        back.append(through.argmin(axis=0))
        costs = np.minimum(through.min(axis=0), FAR)
    ends = costs + np.array([INSERT * len(CLOSING[s]) for s in range(4)])
    state = int(ends.argmin())
    states = [state]
    for came in reversed(back):
        state = int(came[state])
        states.append(state)
    return int(ends.min()), states[::-1]


def repair(roles: list[int], first: int, last: int) -> list[tuple[int, str, list[int]]]:
    """(role, action, inserted roles) of each turn on a cheapest way from one state to another."""
    costs = [0 if s == first else FAR for s in range(4)]
    back = []
    for role in roles:
        now, came = [FAR] * 4, [None] * 4
        for step in STEPS[role]:
            cost = costs[step[0]] + step[2]
            if cost < now[step[1]]:
                now[step[1]], came[step[1]] = cost, step
        costs = now
        back.append(came)
    out, state = [], last
    for came in reversed(back):
        before, to, _, action, new = came[state]
        out.append((to, action, new))
        state = before
    return out[::-1]


def opening(role: int) -> str:
    return f"<|{ROLES[role]}|>\n"


def clean(text: str | None) -> str:
    """Text whose own markers are defused, so that it cannot open a turn."""
    return (text or "").replace("<|", "< |")


KEYS = ["conv_id", "block", "alone", "part"]
#: Rows, and bytes of text, handled together in a task; each such group holds whole chunks of many conversations.
GROUP_ROWS, GROUP_BYTES = 20_000, 32 << 20


def _chunked(rows: DataFrame, chunk: int) -> DataFrame:
    """Adds block, alone, part: in this order, chunks of a conversation of about ``chunk`` rows at most.

    A turn number with more rows than that is cut by the hash of its rows, and what follows it in
    its block is a chunk after it.
    """
    conv = F.coalesce("conv_id", F.lit(-(1 << 62)))
    counted = rows.groupBy(conv.alias("c"), "number").count().where(F.col("count") > chunk)
    many = stage(counted.select("c", "number", F.ceil(F.col("count") / chunk).alias("parts")))
    found = rows.withColumn("c", conv).withColumn("block", F.floor(F.col("number") / chunk))
    found = sized_join(found, many, ["c", "number"], "left")
    splits = stage(many.groupBy("c").agg(F.sort_array(F.collect_list("number")).alias("splits")))
    found = sized_join(found, splits, ["c"], "left")
    split = F.col("parts").isNotNull()
    before = F.coalesce(F.array_max(F.filter("splits", lambda s: s < F.col("number"))), F.lit(-1).cast("long"))
    part = F.floor((F.col("tie") / F.lit(2.0**64) + 0.5) * F.col("parts"))
    return found.select(
        *rows.columns, "block", F.when(split, F.col("number")).otherwise(before).alias("alone"),
        F.when(split, part).otherwise(F.lit(1 << 40).cast("long")).alias("part"),
    )


def _parts(rows: pa.Table, keys: list[str]) -> list[tuple[int, int]]:
    """Bounds of the runs of equal keys in sorted rows."""
    values = list(zip(*(rows[k].to_pylist() for k in keys), strict=True))
    at = [i for i, v in enumerate(values) if not i or v != values[i - 1]]
    return list(zip(at, [*at[1:], len(values)], strict=True))


def _render(roles: list[str | None], texts: list[str | None], state: dict) -> list[tuple[str, str, int, str]]:
    """(role_out, action, inserted, rendered) of the turns of one chunk between two settled states."""
    out, started = [], state["first"] != START
    for (role, action, new), text in zip(repair([role_number(r) for r in roles], state["first"], state["last"]), texts, strict=True):
        empties = "".join(opening(r) + "\n" for r in new)
        lead = "\n\n" if action == "merge" else ("\n" if started else "") + empties + opening(role)
        out.append((ROLES[role], action, len(new), lead + clean(text)))
        started = True
    if state["closes"]:
        role, action, inserted, text = out[-1]
        ending = CLOSING[ROLES.index(role)]
        out[-1] = (role, action, inserted + len(ending), text + "\n" + "".join(opening(r) + "\n" for r in ending) + "<|end|>\n")
    return out


def format_chats(turns: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """One row per stored turn: conv_id, turn, place, role_in, role_out, action, inserted, rendered, conv_cost.

    ``rendered`` of a conversation's rows, joined by ``place``, is the repaired chat: each turn is
    a marker line and its text; merged texts are parted by an empty line; the last row carries the
    closing. Turns go by number, nulls last; equal numbers by a hash of role and text, and turns
    equal in that are interchangeable. Null texts are empty, null conversation ids form one
    conversation, null or unknown roles are named at low cost. Other columns are ignored; an empty
    table gives an empty result.
    """
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), "text",
        F.coalesce(F.col("turn").cast("long"), F.lit(1 << 62)).alias("number"), F.xxhash64("role", "text").alias("tie"),
    )
    size = rows.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0)).alias("bytes")).first()
    groups = max(8, -(-size["rows"] // GROUP_ROWS), -(-size["bytes"] // GROUP_BYTES))
    cut = _chunked(rows, chunk).withColumn("group", F.pmod(F.xxhash64(*KEYS), F.lit(groups)))
    by = [(k, "ascending") for k in [*KEYS, "number", "tie"]]

    def reduce(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by(by)
        roles = rows["role"].to_pylist()
        bounds = _parts(rows, KEYS)
        first = rows.select(KEYS).take([lo for lo, _ in bounds])
        matrices = [chunk_matrix([role_number(r) for r in roles[lo:hi]]).ravel().tolist() for lo, hi in bounds]
        return first.append_column("matrix", pa.array(matrices, pa.list_(pa.int64())))

    def settle(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([(k, "ascending") for k in KEYS])
        matrices = rows["matrix"].to_pylist()
        out: dict[str, list] = {k: [] for k in ("first", "last", "place", "closes", "cost")}
        for lo, hi in _parts(rows, ["conv_id"]):
            cost, states = best_states([np.array(m, np.int64).reshape(4, 4) for m in matrices[lo:hi]])
            out["first"] += states[:-1]
            out["last"] += states[1:]
            out["place"] += range(hi - lo)
            out["closes"] += [False] * (hi - lo - 1) + [True]
            out["cost"] += [cost] * (hi - lo)
        found = rows.select(KEYS)
        for name, values in out.items():
            found = found.append_column(name, pa.array(values))
        return found

    def render(rows: pa.Table, states: pa.Table) -> pa.Table:
        rows = rows.sort_by(by)
        states = states.sort_by([(k, "ascending") for k in KEYS]).to_pylist()
        names, texts = rows["role"].to_pylist(), rows["text"].to_pylist()
        out: list[tuple] = []
        for (lo, hi), state in zip(_parts(rows, KEYS), states, strict=True):
            for k, fixed in enumerate(_render(names[lo:hi], texts[lo:hi], state)):
                out.append(((state["place"] << 32) + k, *fixed, state["cost"]))
        place, role, action, inserted, text, cost = zip(*out, strict=True)
        return pa.table({
            "conv_id": rows["conv_id"], "turn": rows["turn"], "place": pa.array(place), "role_in": rows["role"], "role_out": pa.array(role),
            "action": pa.array(action), "inserted": pa.array(inserted), "rendered": pa.array(text), "conv_cost": pa.array(cost),
        })

    kinds = "conv_id long, block long, alone long, part long"
    matrices = cut.select(*KEYS, "number", "tie", "role", "group").groupBy("group").applyInArrow(reduce, f"{kinds}, matrix array<long>")
    of_conv = matrices.withColumn("owner", F.pmod(F.xxhash64("conv_id"), F.lit(groups))).groupBy("owner")
    states = stage(of_conv.applyInArrow(settle, f"{kinds}, first long, last long, place long, closes boolean, cost long"))
    states = states.withColumn("group", F.pmod(F.xxhash64(*KEYS), F.lit(groups)))
    schema = "conv_id long, turn long, place long, role_in string, role_out string, action string, inserted long, rendered string, conv_cost long"
    return cut.groupBy("group").cogroup(states.groupBy("group")).applyInArrow(render, schema)


@query("op4_chat_format")
def op4_chat_format(spark, sf_dir):
    return format_chats(table(spark, sf_dir, "conversations"))
