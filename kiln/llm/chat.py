"""Chat formatting: minimum-cost role repair over a legal-turn automaton, then rendering.

A legal conversation is an optional system turn, then user and assistant by turns,
ending with the assistant.  Dynamic programming over the automaton's states (start,
after system, after user, after assistant) finds the cheapest repair, in which a turn

* keeps its role (0), or takes another (``RELABEL``; ``RELABEL_UNKNOWN`` if its role is
  none of the three),
* is merged into the turn before it (``MERGE``, at the price of a relabel if the roles
  differ), or
* follows an inserted empty turn of another role (``INSERT``), as may the end.

A conversation is cut into stretches of ``STRETCH`` turn numbers.  A stretch is a small
matrix of least costs from state to state; matrices multiply (by minimum and sum) up a
tree of stretches, and the best states come down again, so a long conversation is
repaired in many tasks and the result is that of one pass.  Each stretch then picks its
turns' actions between its given states.  Every input row yields its own piece of the
rendered conversation: joined in order, the pieces are the chat.

Defined cases: a null role is unknown; a null text is empty; turns sort by number, nulls
first, and equal numbers by role and text; a null conv_id is a conversation of its own;
of equally cheap repairs the first in the order of ``ACTIONS`` from the end wins; chat
markers inside texts are broken by a space; further columns are not read.
"""

from __future__ import annotations

from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import query, table, written

ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
RELABEL, RELABEL_UNKNOWN, MERGE, INSERT = 1.0, 0.5, 0.6, 2.0
STRETCH = 64
FAN = 256
#: Legal steps of the automaton: the states after which a role may follow.
BEFORE = {SYSTEM: (START,), USER: (START, SYSTEM, ASSISTANT), ASSISTANT: (USER,)}
#: Ways to take a turn: (state before, state after, inserted empty roles, merged).
ACTIONS = [(a, b, (), False) for b in BEFORE for a in BEFORE[b]] + [(a, a, (), True) for a in (SYSTEM, USER, ASSISTANT)] + [
    (a, b, (c,), False) for b in BEFORE for c in BEFORE[b] if c != START for a in BEFORE[c]]
#: Ways to end: nothing, or an empty assistant turn, before it an empty user turn if need be.
ENDS = {ASSISTANT: (), USER: (ASSISTANT,), SYSTEM: (USER, ASSISTANT), START: ()}


def price(role, action) -> float:
    _, after, inserted, merged = action
    same = role == ROLES[after - 1]
    change = 0.0 if same else RELABEL if role in ROLES else RELABEL_UNKNOWN
    return change + INSERT * len(inserted) + MERGE * merged


def choices() -> dict:
    """For each role (None: unknown) the cheapest action between two states, the first of equals."""
    out = {}
    for role in (*ROLES, None):
        best: dict = {}
        for action in ACTIONS:
            cost = price(role, action)
            if action[:2] not in best or cost < best[action[:2]][0]:
                best[action[:2]] = (cost, action)
        out[role] = best
    return out


def step_matrices(table: dict) -> dict:
    out = {}
    for role, best in table.items():
        out[role] = np.full((4, 4), np.inf)
        for (a, b), (cost, _) in best.items():
            out[role][a, b] = cost
    return out


def then(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Least costs of one stretch followed by another."""
    return (x[:, :, None] + y[None, :, :]).min(axis=1)


def rows_of(batches, names):
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names))


NODE = "conv_id bigint, level int, part bigint, cost array<double>"


def stretches(batches):
    """Matrix of each stretch, whose rows follow each other."""
    steps = step_matrices(choices())
    for (conv, part), rows in groupby(rows_of(batches, ("conv_id", "part", "role")), lambda r: r[:2]):
        cost = np.where(np.eye(4) > 0, 0.0, np.inf)
        for *_, role in rows:
            cost = then(cost, steps[role if role in ROLES else None])
        yield pa.RecordBatch.from_pydict({"conv_id": [conv], "level": [0], "part": [part], "cost": [cost.ravel().tolist()]},
                                         pa.schema([("conv_id", pa.int64()), ("level", pa.int32()), ("part", pa.int64()), ("cost", pa.list_(pa.float64()))]))


def parents(level: int):
    """Matrix of each run of FAN nodes."""
    def run(batches):
        for (conv, up), rows in groupby(rows_of(batches, ("conv_id", "up", "cost")), lambda r: r[:2]):
            cost = np.where(np.eye(4) > 0, 0.0, np.inf)
            for *_, own in rows:
                cost = then(cost, np.array(own).reshape(4, 4))
            yield pa.RecordBatch.from_pydict({"conv_id": [conv], "level": [level], "part": [up], "cost": [cost.ravel().tolist()]},
                                             pa.schema([("conv_id", pa.int64()), ("level", pa.int32()), ("part", pa.int64()), ("cost", pa.list_(pa.float64()))]))
    return run


def path(costs: list, first: int, last: int) -> list[int]:
    """The cheapest states from ``first`` to ``last`` through some matrices, between them and at both ends."""
    best = np.full(4, np.inf)
    best[first] = 0
    back = []
    for cost in costs:
        total = best[:, None] + cost
        back.append(total.argmin(axis=0))
        best = total.min(axis=0)
    out = [last]
    for choice in reversed(back):
        out.append(int(choice[out[-1]]))
    return out[::-1]


def children(batches):
    """States before and after each node of a run, from those of the run."""
    names = ("conv_id", "up", "part", "cost", "first", "last")
    for _, rows in groupby(rows_of(batches, names), lambda r: r[:2]):
        rows = list(rows)                                         # FAN at most
        states = path([np.array(r[3]).reshape(4, 4) for r in rows], rows[0][4], rows[0][5])
        yield pa.RecordBatch.from_pydict({"conv_id": [r[0] for r in rows], "part": [r[2] for r in rows], "first": states[:-1], "last": states[1:]},
                                         pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("first", pa.int32()), ("last", pa.int32())]))


def header(role: int) -> str:
    return f"<|im_start|>{ROLES[role - 1]}\n"


CLOSE = "<|im_end|>\n"


def repaired(batches):
    """A stretch's turns with their actions and their pieces of the chat."""
    table = choices()
    steps = step_matrices(table)
    names = ("conv_id", "part", "turn", "role", "text", "first", "last", "ends")
    for _, rows in groupby(rows_of(batches, names), lambda r: r[:2]):
        rows = list(rows)
        kinds = [r[3] if r[3] in ROLES else None for r in rows]
        states = path([steps[k] for k in kinds], rows[0][5], rows[0][6])
        out = []
        for row, kind, a, b, more in zip(rows, kinds, states, states[1:], [True] * (len(rows) - 1) + [False]):
            cost, (_, _, inserted, merged) = table[kind][a, b]
            text = (row[4] or "").replace("<|im_", "< |im_")
            piece = "\n\n" if merged else (CLOSE if a != START else "") + "".join(header(x) + CLOSE for x in inserted) + header(b)
            closing = ENDS[b] if row[7] and not more else None
            end = "" if closing is None else CLOSE + "".join(header(x) + CLOSE for x in closing)
            cost += 0 if closing is None else INSERT * len(closing)
            out.append((row[0], row[2], ROLES[b - 1], merged, row[3] != ROLES[b - 1], len(inserted) + len(closing or ()), cost, piece + text + end))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_(), pa.int32(), pa.float64(), pa.string()))],
                                         names=["conv_id", "turn", "role", "merged", "relabelled", "n_inserted", "cost", "rendered"])


def format_chats(turns: DataFrame, stretch: int = STRETCH, fan: int = FAN) -> DataFrame:  # fan: 2 or more
    """One row per turn: conv_id, turn, role (repaired), merged, relabelled, n_inserted (empty turns before it, or
    at the end after it), cost, rendered (its piece of the chat)."""
    number = F.coalesce(F.col("turn").cast("bigint"), F.lit(-(2 ** 62)))
    turns = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), F.col("role").cast("string").alias("role"),
                         F.col("text").cast("string").alias("text"), F.floor(number / F.lit(stretch)).cast("bigint").alias("part"))
    keys = ["conv_id", "part"]
    order = ["conv_id", "part", "turn", "role", "text"]
    dealt = turns.repartition(*keys).sortWithinPartitions(*order)
    levels, ups = [written(dealt.select(*keys, "role").mapInArrow(stretches, NODE), "stretches")], []
    while (most := levels[-1].groupBy("conv_id").count().agg(F.max("count")).first()[0] or 1) > 1:
        # a run of FAN parts has a parent; a conversation's last few parts have one whatever their numbers
        ups.append(F.lit(0).cast("bigint") if most <= fan else F.floor(F.col("part") / fan).cast("bigint"))
        up = levels[-1].withColumn("up", ups[-1])
        levels.append(written(up.repartition("conv_id", "up").sortWithinPartitions("conv_id", "up", "part").mapInArrow(parents(len(levels)), NODE), "stretches"))

    total = F.array(*(F.struct((F.get("cost", s) + INSERT * len(ENDS[s])).alias("cost"), F.lit(s).alias("last")) for s in (SYSTEM, USER, ASSISTANT)))
    states = levels[-1].select("conv_id", "part", F.lit(START).alias("first"), F.array_min(total)["last"].alias("last"))
    for level, up in zip(reversed(levels[:-1]), reversed(ups)):
        nodes = level.withColumn("up", up)
        known = states.select(F.col("conv_id").alias("c"), F.col("part").alias("u"), "first", "last")
        joined = nodes.join(known, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("up") == F.col("u")))
        states = written(joined.select("conv_id", "up", "part", "cost", "first", "last").repartition("conv_id", "up").sortWithinPartitions("conv_id", "up", "part")
                         .mapInArrow(children, "conv_id bigint, part bigint, first int, last int"), "states")
    final = levels[0].groupBy("conv_id").agg(F.max("part").alias("final"))
    states = states.join(final.withColumnRenamed("conv_id", "f"), F.col("conv_id").eqNullSafe(F.col("f")))
    states = states.select(F.col("conv_id").alias("c"), F.col("part").alias("p"), "first", "last", (F.col("part") == F.col("final")).alias("ends"))
    return (turns.join(states, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p"))).select(*order, "first", "last", "ends")
            .repartition(*keys).sortWithinPartitions(*order)
            .mapInArrow(repaired, "conv_id bigint, turn bigint, role string, merged boolean, relabelled boolean, n_inserted int, cost double, rendered string"))


@query("op2_chat_format")
def op2(spark, sf_dir):
    return format_chats(table(spark, sf_dir, "conversations"))
