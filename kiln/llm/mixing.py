"""Mixing sources to target weights by Pfair scheduling.

A source's documents form blocks of ``BLOCK``.  In the fluid schedule every source with
blocks left gets its weight's share of each slot; block k of a source with weight w
starts there at virtual time k / w and ends at (k + 1) / w, and virtual time v is slot
t(v) = sum of min(blocks, v w) over the sources.  A block is released at floor(t(start))
and due by ceil(t(end)); in every slot the released block that ends first runs.  Then
every prefix holds each source's target to within one block, at any weights and any
length, and goes on so when sources have run out.

Blocks are rows.  t comes from running sums over ranges of virtual time.  Slots are dealt
in runs of ``RUN``, or of the longest time from a release to its deadline if that is
longer, each planned by one task, so a task's rows grow with the number of sources and the
spread of their weights, but not with the documents.  A task starts one such time early from the released
blocks that end first: two plans that have filled the same slots and keep all deadlines
are the same once the blocks pending at their start are due, so the runs join to one plan.

With ``resolution``, weights are first rounded to whole shares (one at least) of a period
of so many slots, and sources that have run out start a new schedule.  It repeats with
its period, so a block's slot is arithmetic on its number; the driver holds one period
for each phase, and the sources are ``MOST_SOURCES`` at most.

A document's number in its source comes from counts of hash buckets and a ranking
inside them, so a hot source is ranked in many tasks.

Defined cases: a null source is a source of its own, and the empty text another;
sources without a weight take the least weight given; null and repeated ids have
places of their own; an empty table gives an empty result; texts are not read.
"""

from __future__ import annotations

from fractions import Fraction
from heapq import heappop, heappush

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.llm.common import query, sized, table, written

BLOCK = 8
RESOLUTION = 1000
RUN = 1024
PIECE = 4096
MOST_SOURCES = 4096
BUCKET_ROWS = 20_000


def shares(weights: dict, resolution: int = RESOLUTION) -> dict:
    """Whole shares of a period, each one at least, by the largest remainders."""
    total = sum(Fraction(w) for w in weights.values())
    slots = max(resolution, 2 * len(weights))
    exact = {s: Fraction(w) * slots / total for s, w in weights.items()}
    out = {s: max(1, int(x)) for s, x in exact.items()}
    by_rest = sorted(exact, key=lambda s: (int(exact[s]) - exact[s], str(s)))
    for s in by_rest[: max(0, slots - sum(out.values()))]:
        out[s] += 1
    return out


def period(share: dict) -> dict:
    """Slots of each source's blocks in one period, by earliest deadline among released blocks."""
    q = sum(share.values())
    names = sorted(share, key=str)
    waiting, ready, slots = [], [], {s: [] for s in names}
    for i in range(len(names)):
        heappush(waiting, (0, i))
    for slot in range(q):
        while waiting and waiting[0][0] <= slot:
            _, i = heappop(waiting)
            k, p = len(slots[names[i]]), share[names[i]]
            heappush(ready, (-(-(k + 1) * q // p), i))
        _, i = heappop(ready)
        slots[names[i]].append(slot)
        k, p = len(slots[names[i]]), share[names[i]]
        if k < p:
            heappush(waiting, (k * q // p, i))
    return slots


def phases(share: dict, blocks: dict) -> dict:
    """For each source its phases: (first block, first slot, slots of a period, length of the period)."""
    left = {s: n for s, n in blocks.items() if n > 0}
    done, slot, out = dict.fromkeys(blocks, 0), 0, {s: [] for s in blocks}
    while left:
        turns = period({s: share[s] for s in left})
        q = sum(len(x) for x in turns.values())
        last = {s: (n - 1) // len(turns[s]) * q + turns[s][(n - 1) % len(turns[s])] for s, n in left.items()}
        length = min(last.values()) + 1
        for s in left:
            out[s].append((done[s], slot, turns[s], q))
            done[s] += length // q * len(turns[s]) + sum(x < length % q for x in turns[s])
        slot += length
        left = {s: blocks[s] - done[s] for s in left if blocks[s] > done[s]}
    return out


def fluid(sources: DataFrame) -> DataFrame:
    """The blocks of sources (source, weight, blocks): source, k, end (virtual), release, deadline."""
    pieces = sources.select("source", "weight", "blocks", F.explode(F.expr(f"sequence(0L, (blocks - 1) div {PIECE})")).alias("piece")).repartition("source", "piece")
    blocks = pieces.select("source", "weight", "blocks", F.explode(F.expr(f"sequence(piece * {PIECE}, least(blocks, (piece + 1) * {PIECE}) - 1)")).alias("k"))
    last = F.col("k") == F.col("blocks") - 1
    ends = blocks.select("source", "k", ((F.col("k") + 1) / F.col("weight")).alias("end"), F.when(last, F.col("blocks")).otherwise(0).alias("gone"),
                         F.when(last, F.col("weight")).otherwise(0.0).alias("freed"))
    ends = written(ends.repartitionByRange("end", "source", "k").withColumn("part", F.spark_partition_id()), "ends")
    sums = ends.groupBy("part").agg(F.sum("gone").alias("g"), F.sum("freed").alias("f"))                       # a row a partition
    sums = sums.select("part", (F.sum("g").over(Window.orderBy("part")) - F.col("g")).alias("before"), (F.sum("f").over(Window.orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1))).alias("after"))
    up = Window.partitionBy("part").orderBy("end", "source", "k").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy("part").orderBy(F.desc("end"), F.desc("source"), F.desc("k")).rowsBetween(Window.unboundedPreceding, -1)
    running = ends.withColumn("gone", F.sum("gone").over(up)).withColumn("freed", F.coalesce(F.sum("freed").over(down), F.lit(0.0))).join(F.broadcast(sums), "part")
    at = F.col("before") + F.col("gone") + F.col("end") * (F.coalesce("after", F.lit(0.0)) + F.col("freed"))
    both = F.array(F.struct("k", F.col("at").alias("until"), "end", F.lit(None).cast("double").alias("since")),
                   F.struct((F.col("k") + 1).alias("k"), F.lit(None).cast("double").alias("until"), F.lit(None).cast("double").alias("end"), F.col("at").alias("since")))
    spans = (running.select("source", "k", "end", at.alias("at")).select("source", F.inline(both))
             .groupBy("source", "k").agg(F.max("end").alias("end"), F.max("since").alias("since"), F.max("until").alias("until")).filter("until is not null"))
    return spans.select("source", "k", "end", F.expr("bigint(floor(coalesce(since, 0) * (1 + 1e-12) + 1e-7))").alias("release"),
                        F.expr("bigint(ceil(until * (1 - 1e-12) - 1e-7))").alias("deadline"))


def run_slots(jobs):
    """The slots of one run: from its blocks by earliest end among the released ones."""
    import numpy as np
    import pandas as pd

    first, stop, since, done = (int(jobs[c].iloc[0]) for c in ("first", "stop", "since", "done"))
    names = pd.factorize(jobs["source"], sort=True)[0]
    order = np.lexsort((jobs["k"].to_numpy(), names, jobs["end"].to_numpy()))
    release = jobs["release"].to_numpy()[order]
    early = np.flatnonzero(release < since)[since - done:]             # those before them have had their slots
    later = np.flatnonzero(release >= since)
    later = later[np.argsort(release[later], kind="stable")]
    ready, waiting, at = early.tolist(), list(zip(release[later].tolist(), later.tolist())), 0
    rows, slots = [], []
    for slot in range(since, stop):
        while at < len(waiting) and (waiting[at][0] <= slot or not ready):
            heappush(ready, waiting[at][1])
            at += 1
        i = heappop(ready)
        if slot >= first:
            rows.append(order[i])
            slots.append(slot)
    return pd.DataFrame({"of": jobs["source"].to_numpy()[rows], "k": jobs["k"].to_numpy()[rows], "slot": np.array(slots, np.int64)})


def schedule(sources: DataFrame, run: int = RUN) -> DataFrame:
    """The slot of each block of sources (source, weight, blocks): of, k, slot."""
    jobs = written(fluid(sources), "blocks")
    total, reach = jobs.agg(F.count("*"), F.max(F.col("deadline") - F.col("release"))).first()
    reach = reach or 1
    run = max(run, reach)
    most = max(0, (total - 1) // run)
    since = F.greatest(F.lit(0), F.col("run") * run - reach)
    due = jobs.groupBy(F.expr(f"(deadline + {reach + run - 1}) div {run}").alias("run")).agg(F.count("*").alias("n"))
    runs = jobs.sparkSession.range(0, most + 1).select(F.col("id").alias("run"))
    due = runs.join(due, "run", "left").select("run", F.sum(F.coalesce("n", F.lit(0))).over(Window.orderBy("run")).alias("done"))    # a row a run
    dealt = jobs.withColumn("run", F.explode(F.expr(f"sequence(release div {run}, least({most}, (deadline + {reach + run - 1}) div {run} - 1))")))
    dealt = (dealt.filter(F.col("deadline") > since).join(due, "run")
             .select("source", "k", "end", "release", "run", (F.col("run") * run).alias("first"), F.least(F.lit(total), (F.col("run") + 1) * run).alias("stop"), since.alias("since"), "done"))
    return dealt.groupBy("run").applyInPandas(run_slots, f"of {sources.schema['source'].dataType.simpleString()}, k bigint, slot bigint")


def weighted(docs: DataFrame, weights: dict | None, block: int) -> DataFrame:
    """One row per source: source, n, weight, blocks."""
    counts = docs.groupBy(F.col("source").cast("string").alias("source")).agg(F.count("*").alias("n"))
    if weights is None:
        counts = counts.withColumn("weight", F.sqrt("n"))
    else:
        given = {s: float(w) for s, w in weights.items() if w and w > 0}
        known = docs.sparkSession.createDataFrame(list(given.items()), "of string, weight double")
        counts = counts.join(known, F.col("source").eqNullSafe(F.col("of")), "left").withColumn("weight", F.coalesce("weight", F.lit(min(given.values(), default=1.0))))
    return written(counts.select("source", "n", "weight", F.expr(f"(n + {block - 1}) div {block}").alias("blocks")), "sources")


def repeating(sources: DataFrame, resolution: int) -> DataFrame:
    """Schedules that repeat: of, and for each phase its first block, first slot, turns and period."""
    rows = sources.limit(MOST_SOURCES + 1).collect()
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources for a schedule that repeats")
    plan = phases(shares({r["source"]: r["weight"] for r in rows}, resolution) if rows else {}, {r["source"]: r["blocks"] for r in rows})
    return sources.sparkSession.createDataFrame([(s, [x[0] for x in p], [x[1] for x in p], [x[2] for x in p], [x[3] for x in p]) for s, p in plan.items()],
                                                "of string, firsts array<bigint>, starts array<bigint>, turns array<array<int>>, periods array<int>")


def mix(docs: DataFrame, weights: dict | None = None, block: int = BLOCK, resolution: int | None = None) -> DataFrame:
    """The rows with slot and position (in place of columns of those names): ordered by position, every prefix holds the target weights.

    ``weights``: by source; by default the square root of its rows.  Weights are met as
    given, or rounded to shares of ``resolution`` slots.  Positions are unique
    and leave gaps only where a source's last block is not full.
    """
    sources = weighted(docs, weights, block)
    buckets = -(-(sources.agg(F.sum("n")).first()[0] or 0) // BUCKET_ROWS) or 1
    # the row is one struct, so its columns may have any name; rows without an id are told apart by their other columns
    row = F.xxhash64(*docs.columns)
    rows = docs.select("source", "doc_id", row.alias("_row_hash"), F.struct(*docs.columns).alias("_row"), F.pmod(row, F.lit(buckets)).alias("_bucket"))
    offsets = (rows.groupBy("source", "_bucket").agg(F.count("*").alias("_n"))
               .withColumn("_before", F.sum("_n").over(Window.partitionBy("source").orderBy("_bucket")) - F.col("_n"))
               .select(F.col("source").alias("_source"), F.col("_bucket").alias("_b"), "_before"))
    within = Window.partitionBy("source", "_bucket").orderBy(F.xxhash64("doc_id"), "doc_id", "_row_hash")
    ranked = (rows.withColumn("_rank", F.row_number().over(within) - 1)
              .join(offsets, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_bucket") == F.col("_b")))
              .withColumn("_rank", F.col("_rank") + F.col("_before")).withColumn("_block", F.expr(f"_rank div {block}")))
    if resolution is None:
        slots = sized(schedule(sources)).withColumnsRenamed({"k": "_k", "slot": "_slot"})
        ranked = ranked.join(slots, F.col("source").eqNullSafe(F.col("of")) & (F.col("_block") == F.col("_k")))
        slot = F.col("_slot")
    else:
        ranked = ranked.join(F.broadcast(repeating(sources, resolution)), F.col("source").eqNullSafe(F.col("of")))       # a row a source
        phase = F.size(F.filter("firsts", lambda x: x <= F.col("_block"))) - 1
        ranked = ranked.withColumn("_phase", phase).withColumn("_turns", F.get("turns", F.col("_phase"))).withColumn("_k", F.col("_block") - F.get("firsts", F.col("_phase")))
        slot = F.get("starts", F.col("_phase")) + F.expr("_k div size(_turns)") * F.get("periods", F.col("_phase")) + F.get("_turns", F.expr("cast(_k % size(_turns) as int)"))
    placed = ranked.select("_row", slot.cast("long").alias("slot"), (slot.cast("long") * block + F.col("_rank") % block).alias("position"))
    kept = [F.col("_row").getField(c).alias(c) for c in docs.columns if c not in ("slot", "position")]
    return placed.select(*kept, "slot", "position")


@query("op6_mixing")
def op6(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents").select("doc_id", "source"))
