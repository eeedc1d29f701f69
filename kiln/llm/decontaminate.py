"""Benchmark decontamination by winnowing.

Every window of ``SPAN`` words keeps its smallest ``K``-word hash (the leftmost
of equals) as fingerprint.  Equal windows have equal fingerprints, so joining
training and benchmark fingerprints finds every shared span of ``SPAN`` words or
more; a hit is then extended to its windows, whose hashes must match too.

A benchmark item of fewer words is one window, its own fingerprint.  Before the
join, training windows pass a bit table of the benchmark's fingerprints whose
size is fixed (2**22 bits) whatever the benchmark's; the join itself is a Spark
join on the fingerprint and the window, so a large benchmark only shuffles.

Defined cases: a null or empty text has no words, no hits and is clean; equal
rows and rows with the same id are judged one by one; an item without words
never occurs; an item with a null id counts and is listed as ``null``; further
columns are not read.  With no items nothing is contaminated.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import query, table, text_hash, written
from kiln.llm.words import NOT_ALNUM, Words, leftmost_minimum

SPAN = 13
K = 7
SLOT_BITS = 22
SHIFT = np.uint64(64 - SLOT_BITS)

WINDOWS = pa.list_(pa.struct([("fp", pa.int64()), ("win", pa.int64()), ("pos", pa.int32()), ("len", pa.int32())]))
WINDOWS_DDL = "array<struct<fp:bigint,win:bigint,pos:int,len:int>>"


def windows_of(words: Words, part, span: int, k: int):
    """(window start, window hash, fingerprint) of every full window of a slice."""
    hashes = words.windows(part.hashes, span)
    if not len(hashes):
        return (np.empty(0, np.int64),) + (np.empty(0, np.uint64),) * 2
    grams = words.windows(part.hashes, k)
    smallest = grams[leftmost_minimum(grams, span - k + 1)]
    at = np.flatnonzero(part.left()[: len(hashes)] >= span)
    return at, hashes[at], smallest[at]


def listed(part, at, wins, fps, lens) -> pa.ListArray:
    """Windows as one list per text, in text order."""
    order = np.argsort(at, kind="stable")
    at, wins, fps, lens = at[order], wins[order], fps[order], lens[order]
    values = pa.StructArray.from_arrays(
        [pa.array(fps.view(np.int64)), pa.array(wins.view(np.int64)),
         pa.array((at - np.repeat(part.first[:-1], part.counts)[at]).astype(np.int32)), pa.array(lens.astype(np.int32))],
        ["fp", "win", "pos", "len"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(at, part.first).astype(np.int32)), values)


def training_windows(span: int, k: int, short: list[int], slots: bytes):
    """Per text: its number of words and the windows whose fingerprint the benchmark may hold."""
    def run(batches):
        words, seen = Words(NOT_ALNUM), np.unpackbits(np.frombuffer(slots, np.uint8)).astype(bool)
        for batch in batches:
            counts, lists = [], []
            for part in words.slices(batch.column("text")):
                at, wins, fps = windows_of(words, part, span, k)
                keep = seen[(fps >> SHIFT).astype(np.int64)]
                found = [(at[keep], wins[keep], fps[keep], np.full(int(keep.sum()), span))]
                for n in short:
                    hashes = words.windows(part.hashes, n)
                    at = np.flatnonzero(seen[(hashes >> SHIFT).astype(np.int64)])
                    at = at[part.left()[at] >= n]
                    found.append((at, hashes[at], hashes[at], np.full(len(at), n)))
                counts.append(part.counts)
                lists.append(listed(part, *(np.concatenate(x) for x in zip(*found))))
            if counts:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("text_hash"), pa.array(np.concatenate(counts), pa.int64()), pa.concat_arrays(lists)],
                    names=["doc_id", "text_hash", "n_words", "windows"])
    return run


def benchmark_windows(span: int, k: int):
    def run(batches):
        words = Words(NOT_ALNUM)
        for batch in batches:
            lists = []
            for part in words.slices(batch.column("text")):
                at, wins, fps = windows_of(words, part, span, k)
                found = [(at, wins, fps, np.full(len(at), span))]
                for n in np.unique(part.counts[(part.counts > 0) & (part.counts < span)]):
                    at = part.first[:-1][part.counts == n]
                    hashes = words.windows(part.hashes, int(n))[at]
                    found.append((at, hashes, hashes, np.full(len(at), n)))
                lists.append(listed(part, *(np.concatenate(x) for x in zip(*found))))
            if lists:
                yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.concat_arrays(lists)], names=["item_id", "windows"])
    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, k: int = K) -> DataFrame:
    """One row per document row: doc_id, text_hash, n_words, n_hit (words inside a window that occurs
    in an item), items (sorted ids as text), contaminated (a twentieth of the words or more)."""
    if not 0 < k <= span:
        raise ValueError("k must lie between 1 and span")
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), F.col("text").cast("string").alias("text"))
    items = written(items.mapInArrow(benchmark_windows(span, k), f"item_id string, windows {WINDOWS_DDL}")
                    .select("item_id", F.inline("windows")).select("item_id", "fp", "win", "len").distinct(), "benchmark")
    slots = np.zeros(1 << SLOT_BITS, bool)
    slots[items.select(F.shiftrightunsigned("fp", 64 - SLOT_BITS).cast("int").alias("s")).distinct().toPandas()["s"].to_numpy(np.int64)] = True  # 2**22 at most
    short = sorted(r["len"] for r in items.filter(F.col("len") < span).select("len").distinct().collect())  # span - 1 at most
    seen = written(docs.select("doc_id", text_hash().alias("text_hash"), F.col("text").cast("string").alias("text"))
                   .mapInArrow(training_windows(span, k, short, np.packbits(slots).tobytes()), f"doc_id bigint, text_hash bigint, n_words bigint, windows {WINDOWS_DDL}")
                   .withColumn("row", F.monotonically_increasing_id()), "windows")
    hits = (seen.filter(F.size("windows") > 0).select("row", F.inline("windows"))
            .join(items, ["fp", "win", "len"])
            .groupBy("row").agg(F.sort_array(F.collect_set(F.struct("pos", "len"))).alias("spans"), F.sort_array(F.collect_set("item_id")).alias("items")))
    none = F.struct(F.lit(0).cast("long").alias("words"), F.lit(0).cast("long").alias("to"))
    union = F.aggregate("spans", none, lambda x, s: F.struct(
        (x["words"] + F.greatest(F.lit(0), s["pos"] + s["len"] - F.greatest(x["to"], s["pos"]))).cast("long").alias("words"),
        F.greatest(x["to"], (s["pos"] + s["len"]).cast("long")).alias("to")))["words"]
    n_hit = F.coalesce(F.col("hit"), F.lit(0)).cast("long")
    return (seen.join(hits.select("row", union.alias("hit"), "items"), "row", "left")
            .select("doc_id", "text_hash", "n_words", n_hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                    ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated")))


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w FROM benchmark),
bp AS (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 12))) i FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, least(len(w), 13) n, array_to_string(w[i : i + 12], ' ') t FROM bp),
sizes AS (SELECT DISTINCT n FROM bw),
dp AS (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) i FROM d, sizes WHERE len(w) >= n),
dw AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') t FROM dp),
hit AS (SELECT doc_id, item_id, dw.n, i FROM dw JOIN bw ON dw.n = bw.n AND dw.t = bw.t),
words AS (SELECT doc_id, count(DISTINCT p) n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) n_items, string_agg(x, ',' ORDER BY x) s FROM (SELECT DISTINCT doc_id, item_id::VARCHAR x FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT n_words, coalesce(n_hit, 0)::BIGINT n_hit, coalesce(n_items, 0)::BIGINT n_items,
       sha256(coalesce(s, '')) items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN its USING (doc_id)
"""


@query("op10_decontaminate", ORACLE)
def op10(spark, sf_dir):
    judged = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return judged.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                         F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")
