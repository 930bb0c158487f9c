"""Chat formatting: minimum-cost role repair over a legal-turn automaton, then rendering."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.storage import in_order, written

ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
#: Which message may come after which; a conversation ends after the assistant's.
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
#: Costs of one empty message put in, one turn merged with the message before it, and
#: one turn given another role.
INSERT, MERGE, RELABEL = 2, 1, 3
_NEVER = 1 << 40
#: Turns of a segment, and segments of a segment of the next level.
SEGMENT_BITS = 10

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def _fillings() -> dict[tuple[int, int], tuple[int, ...]]:
    """The shortest run of empty messages that leads from one state to another."""
    found = {(s, s): () for s in range(4)}
    for _ in range(3):
        for (a, b), way in list(found.items()):
            for c in NEXT[b]:
                found.setdefault((a, c), (*way, c))
    return found


FILLING = _fillings()


def _step(role: int, before: int, after: int) -> tuple[int, tuple[int, ...], str]:
    """Cheapest way for a turn to lead from one state to another: cost, messages put in, action.

    ``role`` is a state's number or 0 for one that is not known.
    """
    best = (_NEVER, (), "")
    for between in range(4):
        if after == START or (before, between) not in FILLING:
            continue
        way = FILLING[before, between]
        cost = INSERT * len(way) + RELABEL * (role != after)
        # Merging goes with the message right before, not with an empty one.
        merges = between == after and not way
        if not merges and after not in NEXT[between]:
            continue
        action = ("relabel" if role != after else "") + ("merge" if merges else "")
        best = min(best, (cost + MERGE * merges, way, action or "keep"), key=lambda b: (b[0], len(b[1])))
    return best


STEP = {(r, s, t): _step(r, s, t) for r in range(4) for s in range(4) for t in range(4)}
_COSTS = np.array([[[STEP[r, s, t][0] for t in range(4)] for s in range(4)] for r in range(4)])
#: What it costs to end in a state, by the messages still to be put in.
END = [FILLING[s, ASSISTANT] for s in range(4)]


def _through(costs: np.ndarray) -> np.ndarray:
    """Cheapest cost from each state to each through all of some parts, in order."""
    total = costs[0]
    for part in costs[1:]:
        total = np.minimum((total[:, :, None] + part[None]).min(1), _NEVER)
    return total


@lru_cache(1 << 14)
def _segment_costs(roles: bytes) -> tuple[int, ...]:
    return tuple(_through(_COSTS[list(roles)]).reshape(-1).tolist())


def _states(costs: np.ndarray, entry: int, leave: int) -> list[int]:
    """The states between the parts of a cheapest way; the lower one of equals."""
    ahead = [None] * len(costs)
    rest = np.full(4, _NEVER)
    rest[leave] = 0
    for i in range(len(costs) - 1, -1, -1):
        ahead[i] = rest
        rest = (costs[i] + rest[None]).min(1)
    states, at = [], entry
    for i, part in enumerate(costs):
        at = int(np.argmin(part[at] + ahead[i]))
        states.append(at)
    return states


@lru_cache(1 << 14)
def _repaired(roles: bytes, entry: int, leave: int) -> tuple[int, ...]:
    return tuple(_states(_COSTS[list(roles)], entry, leave))


_CODES = {None: 0} | {name: i + 1 for i, name in enumerate(ROLES)}
_LEVEL = "conv_id long, seg long, costs array<long>"
_SPANS = "conv_id long, seg long, entry int, leave int, ends boolean"


def _codes(role: pa.ChunkedArray) -> bytes:
    return bytes(_CODES.get(r, 0) for r in role.to_pylist())


def _sorted(table: pa.Table, by: str) -> pa.Table:
    return table.sort_by(by)


def _summed(table: pa.Table) -> pa.Table:
    """A segment's turns as one matrix of costs."""
    table = _sorted(table, "position")
    return pa.table(
        {
            "conv_id": table.column("conv_id")[:1],
            "seg": table.column("seg")[:1],
            "costs": pa.array([_segment_costs(_codes(table.column("role")))], pa.list_(pa.int64())),
        }
    )


def _matrices(table: pa.Table) -> np.ndarray:
    return np.array(table.column("costs").to_pylist(), np.int64).reshape(-1, 4, 4)


def _joined(key: tuple, table: pa.Table) -> pa.Table:
    """Segments of a level as one of the next, whose number the key ends with."""
    table = _sorted(table, "seg")
    costs = _through(_matrices(table)).reshape(-1).tolist()
    seg = key[-1].as_py()
    return pa.table(
        {
            "conv_id": table.column("conv_id")[:1],
            "seg": pa.array([seg], pa.int64()),
            "costs": pa.array([costs], pa.list_(pa.int64())),
        }
    )


def _parted(table: pa.Table, entry: int, leave: int, ends: bool) -> pa.Table:
    table = _sorted(table, "seg")
    states = _states(_matrices(table), entry, leave)
    n = len(states)
    return pa.table(
        {
            "conv_id": table.column("conv_id"),
            "seg": table.column("seg"),
            "entry": pa.array([entry, *states[:-1]], pa.int32()),
            "leave": pa.array(states, pa.int32()),
            "ends": pa.array([False] * (n - 1) + [ends]),
        }
    )


def _whole(table: pa.Table) -> pa.Table:
    """The last level: a conversation from its start to its cheapest end."""
    table = _sorted(table, "seg")
    totals = _through(_matrices(table))[START] + np.array([INSERT * len(w) for w in END])
    return _parted(table, START, int(np.argmin(totals)), True)


def _inner(above: pa.Table, below: pa.Table) -> pa.Table:
    """What a segment's states mean for the segments in it."""
    row = above.to_pylist()[0]
    return _parted(below, row["entry"], row["leave"], row["ends"])


def _safe(text: str | None) -> str:
    """No text can pass for a marker."""
    return (text or "").replace("<|", "<\u200b|")


def _fragments(roles: bytes, states, texts: list, entry: int, ends: bool) -> list[tuple]:
    """For each turn: new role, action, number of messages put in, cost, rendered fragment."""
    at, out = entry, []
    for role, state, text in zip(roles, states, texts):
        cost, way, action = STEP[role, at, state]
        merges = action.endswith("merge")
        pieces = ["\n"] if merges else [CLOSE if at != START else ""]
        pieces += [f"{OPEN}{ROLES[s - 1]}\n{CLOSE}" for s in way]
        if not merges:
            pieces.append(f"{OPEN}{ROLES[state - 1]}\n")
        out.append((ROLES[state - 1], action, len(way), cost, "".join(pieces) + _safe(text)))
        at = state
    if ends:
        role, action, inserted, cost, fragment = out[-1]
        fragment += CLOSE + "".join(f"{OPEN}{ROLES[s - 1]}\n{CLOSE}" for s in END[at])
        out[-1] = (role, action, inserted + len(END[at]), cost + INSERT * len(END[at]), fragment)
    return out


_MADE = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())


def _with_fragments(turns: pa.Table, made: list[tuple]) -> pa.Table:
    out = turns.select(["conv_id", "turn", "position", "role"])
    names = ("new_role", "action", "inserted", "cost", "fragment")
    for i, (name, kind) in enumerate(zip(names, _MADE)):
        out = out.append_column(name, pa.array([m[i] for m in made], kind))
    return out


def _rendered(span: pa.Table, turns: pa.Table) -> pa.Table:
    """A segment of a longer conversation, by the states it is entered and left in."""
    turns = _sorted(turns, "position")
    row = span.to_pylist()[0]
    roles = _codes(turns.column("role"))
    states = _repaired(roles, row["entry"], row["leave"])
    texts = turns.column("text").to_pylist()
    return _with_fragments(turns, _fragments(roles, states, texts, row["entry"], row["ends"]))


@lru_cache(1 << 14)
def _alone(roles: bytes) -> tuple[int, ...]:
    """The states of a whole conversation."""
    costs = np.array(_segment_costs(roles)).reshape(4, 4)[START]
    leave = int(np.argmin(costs + np.array([INSERT * len(w) for w in END])))
    return _repaired(roles, START, leave)


def _rendered_inside(turns: pa.Table, crossing: pa.Table) -> pa.Table:
    """The conversations of a segment but those that go on in another one."""
    turns = _sorted(turns, "position")
    elsewhere = set(crossing.column("conv_id").to_pylist())
    ids = turns.column("conv_id").to_pylist()
    turns = turns.filter(pa.array([i not in elsewhere for i in ids], pa.bool_()))
    ids = turns.column("conv_id").to_pylist()
    roles, texts, made = _codes(turns.column("role")), turns.column("text").to_pylist(), []
    at = 0
    while at < len(ids):
        end = at + 1
        while end < len(ids) and ids[end] == ids[at]:
            end += 1
        mine = roles[at:end]
        made += _fragments(mine, _alone(mine), texts[at:end], START, True)
        at = end
    return _with_fragments(turns, made)


_OUT = (
    "conv_id long, turn long, position long, role string, new_role string, action string, "
    "inserted long, cost long, fragment string"
)


def format_chats(turns: DataFrame) -> DataFrame:
    """Repair the roles of conversations at the least cost and render them.

    ``turns`` has ``conv_id``, ``turn``, ``role``, ``text``. A legal conversation is an
    optional system message, then user and assistant in turn, the assistant last. A
    turn is kept, merged with the message before it (1), given another role (3, also together with a
    merge), or has empty messages put before it, or after the last turn (2 each). The
    cheapest repair is found by dynamic programming over what role the message so far
    has; among equals the fewer messages put in, then the earlier role.

    The ordered turns are cut into segments of 1024, which are repaired by themselves;
    only conversations that go on in another segment (two a segment at most) need more.
    A turn depends on the ones before and after it, but through four states only. So
    their segments are summed up as 4 by 4 matrices of least costs, those by 1024
    again, until a conversation has one group; then the states at the segments' ends
    are settled from the top down, and each segment is repaired by itself. A
    conversation may have any share of all rows.

    Returns a row for each input row: ``conv_id, turn, position, role, new_role,
    action, inserted, cost, fragment``. A conversation's fragments, joined in the order of
    ``position``, are its rendered text. Turns are ordered by number, nulls first,
    then by role and text (the first 64 characters of each, then a hash of both). A null or unknown role must be given another; null text is
    empty; rows with a null ``conv_id`` are one conversation; "<|" in a text gets a
    zero-width space. An empty table gives an empty one. Other columns are not read. The
    texts of 1024 turns must fit in a task's memory some ten times.
    """
    rows = turns.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text"
    )
    # Of role and text the first characters and a hash stand for the rest: no whole texts are sampled to be
    # put in order.
    ties = [F.left("role", F.lit(64)), F.left("text", F.lit(64)), F.xxhash64("role", "text")]
    rows = rows.withColumns({f"tie{i}": tie for i, tie in enumerate(ties)})
    order = ["conv_id", "turn", *[f"tie{i}" for i in range(len(ties))]]
    rows = in_order(rows, order, "position").drop(*order[2:])
    rows = rows.withColumn("seg", F.shiftright("position", SEGMENT_BITS))
    crossing = written(_crossing(rows), "crossing")
    inside = rows.groupBy("seg").cogroup(crossing.groupBy("seg")).applyInArrow(_rendered_inside, _OUT)
    same = (rows["seg"] == crossing["seg"]) & rows["conv_id"].eqNullSafe(crossing["conv_id"])
    return inside.unionByName(_across(written(rows.join(crossing, same, "left_semi"), "across")))


def _crossing(rows: DataFrame) -> DataFrame:
    """``seg`` and ``conv_id`` of the conversations that are in several segments.

    Such a conversation is the first or the last one of each of its segments.
    """
    conversation = F.struct("conv_id")
    ends = rows.groupBy("seg").agg(
        F.array_distinct(
            F.array(F.min_by(conversation, "position"), F.max_by(conversation, "position"))
        ).alias("ends")
    )
    ends = ends.select("seg", F.explode("ends").alias("end")).select("seg", "end.conv_id")
    several = ends.groupBy(F.col("conv_id").alias("which")).count().filter("count > 1")
    return ends.join(several, F.col("conv_id").eqNullSafe(F.col("which"))).select("seg", "conv_id")


def _across(rows: DataFrame) -> DataFrame:
    by = ["conv_id", "seg"]
    levels = [
        written(rows.drop("text", "turn").groupBy(*by).applyInArrow(_summed, _LEVEL), "segments")
    ]
    while _most(levels[-1]) > 1 << SEGMENT_BITS:
        above = F.shiftright("seg", SEGMENT_BITS).alias("up")
        joined = levels[-1].groupBy("conv_id", above).applyInArrow(_joined, _LEVEL)
        levels.append(written(joined, "segments"))
    spans = levels[-1].groupBy("conv_id").applyInArrow(_whole, _SPANS)
    for level in reversed(levels[:-1]):
        up = F.shiftright("seg", SEGMENT_BITS).alias("up")
        spans = spans.groupBy(*by).cogroup(level.groupBy("conv_id", up)).applyInArrow(_inner, _SPANS)
    return spans.groupBy(*by).cogroup(rows.groupBy(*by)).applyInArrow(_rendered, _OUT)


def _most(level: DataFrame) -> int:
    """The number of segments of the conversation with the most."""
    return level.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
