"""Chat formatting: minimum-cost repair of role sequences, then rendering.

A legal conversation is an optional system turn, then user and assistant in turn, user first. Dynamic programming over
this automaton chooses for each turn to keep it, to merge it into the turn before, to relabel it, or to put an empty turn
of the missing role in front of it, at the least total cost; among equals the first state at the ends of stretches, then
the option named first in OPTIONS.

The cost of a stretch of turns, from each state to each, is a small matrix, and matrices of neighbouring stretches
multiply (minimum for sum, sum for product). So conversations are cut into piles of STRETCH turn numbers, a pile of more
rows into several stretches, the matrices are multiplied up in a tree, the states at the ends of each stretch come down
again, and each stretch is traced on its own: no task holds a whole conversation, however long.

The result has a row for each turn, whose `rendered` pieces, put together in order, are the rendered conversation.

Defined cases: exact repetitions of a row are one turn; turns with one number follow by role, then text; a null turn
comes last; null roles and unknown ones are relabelled (at UNKNOWN, not RELABEL); a null text is empty; each row with a
null conv_id is a conversation of its own; a conversation of system turns alone gets an empty user turn. Long texts stay
whole; an empty table gives an empty one. Other columns are left aside.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from ..sources.shared import stored

STRETCH = 256
MERGE_SAME, MERGE_OTHER, RELABEL, UNKNOWN, INSERT = 1, 4, 3, 2, 2
ROLES = ("system", "user", "assistant")
# Other names of the roles.
ALIASES = {"human": "user", "prompter": "user", "customer": "user", "bot": "assistant", "gpt": "assistant", "model": "assistant", "ai": "assistant", "agent": "assistant", "developer": "system"}
#: States: nothing yet, and after a turn of each role. LEGAL: state -> role -> state after it.
START, LEGAL = 0, {0: {0: 1, 1: 2}, 1: {1: 2}, 2: {2: 3}, 3: {1: 2}}
FAR = 1 << 40
OPTIONS = ("keep", "merge", "relabel", "insert", "insert+relabel")


def _steps(role: int | None) -> list[tuple[int, int, int, str, int, int | None]]:
    """(from, to, cost, option, role, inserted role) of every option for a turn of this role, None if unknown."""
    out = []
    for state, nexts in LEGAL.items():
        if state != START:
            out.append((state, state, MERGE_SAME if role == state - 1 else MERGE_OTHER, "merge", state - 1, None))
        for new, to in nexts.items():
            own = new == role
            out.append((state, to, 0 if own else UNKNOWN if role is None else RELABEL, "keep" if own else "relabel", new, None))
            for after, end in LEGAL[to].items():
                own = after == role
                out.append((state, end, INSERT + (0 if own else UNKNOWN if role is None else RELABEL), "insert" if own else "insert+relabel", after, new))
    return sorted(out, key=lambda s: (OPTIONS.index(s[3]), s[4], s[5] if s[5] is not None else -1, s[0]))


STEPS = {role: _steps(role) for role in (None, 0, 1, 2)}


def _matrix(steps: list) -> np.ndarray:
    m = np.full((4, 4), FAR, np.int64)
    for a, b, cost, *_ in steps:
        m[a, b] = min(m[a, b], cost)
    return m


MATRICES = {role: _matrix(steps) for role, steps in STEPS.items()}


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[:, :, None] + b[None, :, :]).min(1), FAR)


def role_of(name: str | None) -> int | None:
    name = (name or "").strip().lower()
    name = ALIASES.get(name, name)
    return ROLES.index(name) if name in ROLES else None


def ending(state: int) -> int:
    """Cost of ending in a state: a system turn alone needs an empty user turn, and no turn at all is no conversation."""
    return {0: FAR, 1: INSERT}.get(state, 0)


def trace(roles: list[int | None], entry: int, exit_: int) -> list[tuple[str, int, int | None]]:
    """The option, role and inserted role of each turn on the best way from state to state."""
    n = len(roles)
    best = np.full((n + 1, 4), FAR, np.int64)
    best[n, exit_] = 0
    for i in range(n - 1, -1, -1):
        best[i] = np.minimum((MATRICES[roles[i]] + best[i + 1][None, :]).min(1), FAR)
    out, state = [], entry
    for i, role in enumerate(roles):
        for a, b, cost, option, new, inserted in STEPS[role]:
            if a == state and cost + best[i + 1, b] == best[i, state]:
                out.append((option, new, inserted))
                state = b
                break
    return out


@lru_cache(maxsize=65536)
def matrix_of(roles: tuple[int | None, ...]) -> tuple[int, ...]:
    """The costs of a stretch from each state to each, row by row."""
    total = MATRICES[roles[0]]
    for role in roles[1:]:
        total = times(total, MATRICES[role])
    return tuple(total.ravel().tolist())


@lru_cache(maxsize=65536)
def traced(roles: tuple[int | None, ...], entry: int, exit_: int) -> tuple:
    return tuple(trace(list(roles), entry, exit_))


def states_of(matrices: list, entry: int, exit_: int) -> list[tuple[int, int]]:
    """States at the ends of each part, on the best way between those of the whole."""
    parts = [np.array(m, np.int64).reshape(4, 4) for m in matrices]
    best = np.full((len(parts) + 1, 4), FAR, np.int64)
    best[-1, exit_] = 0
    for i in range(len(parts) - 1, -1, -1):
        best[i] = np.minimum((parts[i] + best[i + 1][None, :]).min(1), FAR)
    out, state = [], entry
    for i, m in enumerate(parts):
        before, state = state, int(np.argmin(m[state] + best[i + 1]))
        out.append((before, state))
    return out


def pieces_of(roles: tuple, texts: list[str], entry: int, exit_: int, last: bool) -> tuple[tuple, list[str]]:
    """The way of a stretch, and its rendered pieces."""
    way, begun, pieces = traced(roles, entry, exit_), entry != START, []
    for (option, new, inserted), text in zip(way, texts, strict=True):
        if option == "merge":
            pieces.append("\n" + text)
            continue
        front = "<|end|>\n" if begun else ""
        if inserted is not None:
            front += f"<|{ROLES[inserted]}|>\n<|end|>\n"
        pieces.append(f"{front}<|{ROLES[new]}|>\n{text}")
        begun = True
    if last:
        pieces[-1] += "<|end|>\n" + ("<|user|>\n<|end|>\n" if exit_ == 1 else "")
    return way, pieces


def _rowwise(df: DataFrame, schema: str, of: Callable[[dict], Iterable[tuple]]) -> DataFrame:
    """The rows that each row becomes, batch by batch."""
    kinds = T._parse_datatype_string(schema)
    arrow = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "array<bigint>": pa.list_(pa.int64())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(zip(*[x for r in batch.to_pylist() for x in of(r)], strict=True)) or [[] for _ in kinds.fields]
            yield pa.RecordBatch.from_arrays([pa.array(c, arrow[f.dataType.simpleString()]) for c, f in zip(columns, kinds.fields, strict=True)], names=kinds.names)

    return df.mapInArrow(run, kinds)


_NODE = "key string, place long, matrix array<long>"
_STATES = "key string, place long, entry int, exit int, last boolean, cost long"
_ROWS = "conv_id long, turn long, stretch long, at long, role string, new_role string, option string, inserted string, cost long, rendered string"


def _product(row: dict) -> Iterable[tuple]:
    total = None
    for part in row["parts"]:
        m = np.array(part["matrix"], np.int64).reshape(4, 4)
        total = m if total is None else times(total, m)
    yield row["key"], row["parent"], total.ravel().tolist()


def _root(row: dict) -> Iterable[tuple]:
    """What is below a conversation: one node."""
    total = np.array([0, FAR, FAR, FAR], np.int64)
    for part in row["parts"]:
        total = np.minimum((total[:, None] + np.array(part["matrix"], np.int64).reshape(4, 4)).min(0), FAR)
    total = total + [ending(s) for s in range(4)]
    end = int(np.argmin(total))
    yield from _children(row | {"entry": START, "exit": end, "last": True, "cost": int(total[end])})


def _children(row: dict) -> Iterable[tuple]:
    parts = row["parts"]
    for k, (part, (a, b)) in enumerate(zip(parts, states_of([p["matrix"] for p in parts], row["entry"], row["exit"]), strict=True)):
        yield row["key"], part["place"], a, b, row["last"] and k == len(parts) - 1, row["cost"]


def _turns(row: dict) -> Iterable[tuple]:
    items = row["items"]
    way, pieces = pieces_of(tuple(role_of(x["role"]) for x in items), [x["text"] or "" for x in items], row["entry"], row["exit"], row["last"])
    for k, (x, (option, new, inserted), piece) in enumerate(zip(items, way, pieces, strict=True)):
        yield row["conv_id"], x["turn"], row["place"], k, x["role"], ROLES[new], option, ROLES[inserted] if inserted is not None else None, row["cost"], piece


def _gathered(level: DataFrame, *keys: str) -> DataFrame:
    """The parts below each node, STRETCH of them at most, in order."""
    return level.withColumn("parent", F.floor(F.col("place") / STRETCH).cast("long")).groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("place", "matrix"))).alias("parts"))


def repair(conversations: DataFrame) -> DataFrame:
    """Every turn with its new role, the option taken, the role of an empty turn put in front, the conversation's cost and its rendered piece.

    Order within a conversation: stretch, then at. Rows are gathered for STRETCH turn numbers at a time.
    """
    own = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).distinct()
    alone = F.concat(F.lit("none "), F.sha2(F.to_json(F.struct("turn", "role", "text")), 256))
    turns = own.withColumn("key", F.coalesce(F.col("conv_id").cast("string"), alone)).withColumn("pile", F.coalesce(F.floor(F.col("turn") / STRETCH).cast("long"), F.lit((1 << 62) // STRETCH)))
    ranked = turns.withColumn("part", F.floor((F.row_number().over(W.partitionBy("key", "pile").orderBy("turn", "role", "text")) - 1) / STRETCH).cast("long"))
    stretches = stored(ranked.groupBy("key", "pile", "part").agg(F.min("conv_id").alias("conv_id"), F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("items")))
    leaf = lambda r: [(r["key"], r["pile"], r["part"], list(matrix_of(tuple(map(role_of, r["roles"])))))]
    leaves = _rowwise(stretches.select("key", "pile", "part", F.col("items.role").alias("roles")), "key string, pile long, part long, matrix array<long>", leaf)
    leaves = stored(leaves.withColumn("place", F.row_number().over(W.partitionBy("key").orderBy("pile", "part")).cast("long") - 1))
    levels = [leaves.select("key", "place", "matrix")]
    while levels[-1].where("place > 0").limit(1).count():
        levels.append(stored(_rowwise(_gathered(levels[-1], "key", "parent"), _NODE, _product)))
    states = _rowwise(_gathered(levels[-1], "key"), _STATES, _root)
    for level in reversed(levels[:-1]):
        above = states.withColumnRenamed("place", "parent")
        states = _rowwise(_gathered(level, "key", "parent").join(above, ["key", "parent"]), _STATES, _children)
    placed = leaves.select("key", "pile", "part", "place").join(states, ["key", "place"])
    return _rowwise(stretches.join(placed, ["key", "pile", "part"]), _ROWS, _turns)
