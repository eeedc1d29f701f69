"""Substring dedup: repeated windows of words by an FM-index per shard.

1. Every window of ``WIDTH`` words has an anchor, its smallest ``ANCHOR``-word hash
   (the leftmost of equals).  Neighbouring windows with one anchor occurrence form a
   segment.  Equal windows have equal anchors, so what an anchor's segments share
   is found among them alone, and an anchor that occurs once is done with.
2. Equal segments are counted before anything moves: their windows all repeat, and
   one copy stands for them.
3. Anchors with several different segments go to shards.  A shard concatenates its
   segments, builds a compressed FM-index (packed wavelet matrix over the
   Burrows-Wheeler transform) and streams the segments through it by backward
   search; what occurs at two places or more is reported as intervals.  An anchor
   with over ``MOST_SEGMENTS`` segments is dealt out by single windows instead.
4. Intervals return to their documents.

Work and shuffle follow the number of anchors, about a twelfth of the words, and
never the pairs of a group.  The bit table that keeps single anchors from the second
shuffle has a fixed size (2**25 bits); where it fills up, more is shuffled.

Defined cases: null and empty texts have no words; texts shorter than a window lose
nothing; equal rows, with or without equal ids, repeat each other; null ids are kept;
further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import bit_table, has_bit, query, sized, table, written
from kiln.llm.fmindex import repeated_windows
from kiln.llm.words import WHITE, Words, leftmost_minimum

WIDTH = 35
ANCHOR = 10
MOST_SEGMENTS = 20_000
SHARD_WORDS = 500_000
SLOT_BITS = 25


def anchored(words: Words, part, width: int, size: int):
    """A slice's segments: anchor, first window's start, number of windows."""
    grams = words.windows(part.hashes, size)
    at = leftmost_minimum(grams, width - size + 1) if len(part.hashes) >= width else np.empty(0, np.int64)
    start = np.flatnonzero(part.left()[: len(at)] >= width)
    chosen = at[start]
    new = np.ones(len(chosen), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    return grams[chosen[first]], start[first], np.diff(np.append(first, len(chosen)))


def anchors(width: int, size: int):
    """Every segment's anchor."""
    def run(batches):
        words = Words(WHITE, lower=False)
        for batch in batches:
            for part in words.slices(batch.column("text")):
                yield pa.RecordBatch.from_arrays([pa.array(anchored(words, part, width, size)[0].view(np.int64))], names=["anchor"])
    return run


def segments(width: int, size: int, slots: bytes):
    """Segments whose anchor may occur twice: anchor, segment (its words' hash), row, start in the text, windows."""
    def run(batches):
        words, many = Words(WHITE, lower=False), has_bit(slots, SLOT_BITS)
        for batch in batches:
            rows = np.asarray(batch.column("row"))
            for part in words.slices(batch.column("text")):
                anchor, start, n = anchored(words, part, width, size)
                keep = many(anchor)
                anchor, start, n = anchor[keep], start[keep], n[keep]
                text = np.searchsorted(part.first, start, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), pa.array(words.runs(part.hashes, start, n + width - 1).view(np.int64)), pa.array(rows[part.at + text]),
                     pa.array((start - part.first[text]).astype(np.int32)), pa.array(n.astype(np.int32))],
                    names=["anchor", "segment", "row", "start", "n"])
    return run


def pieces(width: int):
    """The texts of wanted segments of one document row, by shard key; ``single`` ones window by window."""
    def run(batches):
        words = Words(WHITE, lower=False)
        for batch in batches:
            wanted, rows, out = batch.column("wanted").to_pylist(), batch.column("row").to_pylist(), []
            for part in words.slices(batch.column("text")):
                raw = part.data.tobytes()
                for i in range(len(part)):
                    at = part.first[i]
                    cuts = []
                    for w in wanted[part.at + i]:
                        if w["single"]:
                            keys = words.runs(part.hashes, at + w["start"] + np.arange(w["n"]), width).view(np.int64)
                            cuts += [(int(k), w["start"] + j, width, w["counted"]) for j, k in enumerate(keys)]
                        else:
                            cuts.append((w["anchor"], w["start"], w["n"] + width - 1, w["counted"]))
                    for key, start, size, counted in cuts:
                        out.append((key, rows[part.at + i], start, counted, raw[part.starts[at + start]: part.ends[at + start + size - 1]]))
            cols = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary()))],
                                             names=["key", "row", "start", "counted", "words"])
    return run


def search(width: int):
    """Intervals of a shard's segments that the shard holds twice or more.  A shard's rows follow each other."""
    def intervals(rows, starts, counted, texts):
        words = Words(WHITE, lower=False)
        parts = list(words.slices(pa.array(texts, pa.binary()).cast(pa.string())))
        sizes = np.concatenate([p.counts for p in parts])
        names, codes = np.unique(np.concatenate([p.hashes for p in parts]), return_inverse=True)
        ends = np.cumsum(sizes + 1) - 1
        text = np.zeros(int(ends[-1]) + 1, np.int64)                 # a 0 ends each segment
        held = np.ones(len(text), bool)
        held[ends] = False
        text[held] = codes + 1
        begins, asked = ends - sizes, np.flatnonzero(~np.array(counted))
        lane, start, n = repeated_windows(text, len(names) + 1, begins[asked], ends[asked], width)
        which = asked[lane]
        return pa.RecordBatch.from_arrays([pa.array(np.array(rows, np.int64)[which]), pa.array((np.array(starts)[which] + start - begins[which]).astype(np.int32)),
                                           pa.array((n + width - 1).astype(np.int32))], names=["row", "start", "size"])

    def run(batches):
        shard, held = None, ([], [], [], [])
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("shard", "row", "start", "counted", "words")]
            for s, *values in zip(*columns):
                if s != shard:
                    if held[0]:
                        yield intervals(*held)
                    shard, held = s, ([], [], [], [])
                for column, value in zip(held, values):
                    column.append(value)
        if held[0]:
            yield intervals(*held)
    return run


def repeated(docs: DataFrame, width: int = WIDTH, size: int = ANCHOR) -> DataFrame:
    """(row, spans): for rows with a repeated window, the word intervals (start, size) that repeated windows cover.

    ``docs`` has row, a hash of the row's id and text, and text.
    """
    many = docs.mapInArrow(anchors(width, size), "anchor bigint").groupBy("anchor").count().filter("count > 1").select("anchor")
    seen = written(docs.mapInArrow(segments(width, size, bit_table(many, SLOT_BITS)), "anchor bigint, segment bigint, row bigint, start int, n int"), "segments")
    kinds = written(seen.groupBy("anchor", "segment").agg(F.count("*").alias("uses"), F.min(F.struct("row", "start", "n")).alias("at")), "kinds")

    copies = (seen.join(kinds.filter("uses > 1").select("anchor", "segment"), ["anchor", "segment"])
              .select("row", "start", (F.col("n") + width - 1).alias("size")))
    several = kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).filter("kinds > 1")
    wanted = (kinds.join(several, "anchor")
              .select(F.col("at.row").alias("row"), F.struct("anchor", F.col("at.start").alias("start"), F.col("at.n").alias("n"), (F.col("uses") > 1).alias("counted"),
                                                             (F.col("kinds") > MOST_SEGMENTS).alias("single")).alias("w"), F.col("at.n").alias("n")))
    wanted = written(wanted, "wanted")
    total = wanted.agg(F.sum(F.col("n") + width)).first()[0] or 0
    shards = max(1, total // SHARD_WORDS)
    texts = (docs.join(sized(wanted.select("row").distinct()), "row", "left_semi").dropDuplicates(["row"])
             .join(wanted.groupBy("row").agg(F.collect_list("w").alias("wanted")), "row"))
    cut = texts.select("row", "text", "wanted").mapInArrow(pieces(width), "key bigint, row bigint, start int, counted boolean, words binary")
    near = (cut.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards))).select("shard", "row", "start", "counted", "words")
            .repartition("shard").sortWithinPartitions("shard").mapInArrow(search(width), "row bigint, start int, size int"))
    return (copies.union(near).groupBy("row").agg(F.collect_set(F.struct("start", "size")).alias("spans")))


def without(batches):
    """Texts without the words of their spans."""
    for batch in batches:
        sizes, gone, texts = [], [], []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
            words = (text or "").encode().split()                    # at ASCII white space, as WHITE
            removed = 0
            if spans:
                marks = np.zeros(len(words) + 1, np.int64)
                np.add.at(marks, [s["start"] for s in spans], 1)
                np.add.at(marks, [s["start"] + s["size"] for s in spans], -1)
                keep = np.cumsum(marks[:-1]) == 0
                removed = int(len(words) - keep.sum())
                sizes.append(len(words))
                words = [w for w, k in zip(words, keep) if k]
            else:
                sizes.append(len(words))
            gone.append(removed)
            texts.append(b" ".join(words).decode())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(texts, pa.string()), batch.column("spans")],
                                         names=["doc_id", "n_words", "n_removed", "kept", "spans"])


def remove_repeats(docs: DataFrame, width: int = WIDTH, size: int = ANCHOR) -> DataFrame:
    """One row per document row: doc_id, n_words, n_removed, kept (the words that stay, joined by spaces), spans."""
    if not 0 < size <= width:
        raise ValueError("an anchor has 1 word to a window's")
    text = F.col("text").cast("string")
    docs = docs.select("doc_id", F.xxhash64("doc_id", text).alias("row"), text.alias("text"))
    spans = written(repeated(docs.select("row", "text"), width, size), "spans")
    rows = sized(spans.select("row"))
    hit = docs.join(rows, "row", "left_semi").join(spans, "row")
    clean = docs.join(rows, "row", "left_anti").withColumn("spans", F.lit(None).cast(spans.schema["spans"].dataType))
    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept string, spans array<struct<start:int,size:int>>"
    return hit.select("doc_id", "text", "spans").unionAll(clean.select("doc_id", "text", "spans")).mapInArrow(without, schema)


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w FROM documents),
p AS (SELECT doc_id, i, sha256(array_to_string(w[i : i + 34], ' ')) t FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 34)) i FROM d WHERE len(w) >= 35)),
r AS (SELECT doc_id, i FROM p JOIN (SELECT t FROM p GROUP BY t HAVING count(*) > 1) USING (t)),
g AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 34)) i FROM r),
k AS (SELECT d.doc_id, string_agg(x, ' ' ORDER BY j) s, count(*) n FROM (SELECT doc_id, unnest(w) x, unnest(generate_series(1, len(w))) j FROM d) d
      LEFT JOIN g ON g.doc_id = d.doc_id AND g.i = j WHERE g.i IS NULL GROUP BY d.doc_id)
SELECT doc_id, len(w)::BIGINT n_words, (len(w) - coalesce(n, 0))::BIGINT n_removed, sha256(coalesce(s, '')) kept_sha256 FROM d LEFT JOIN k USING (doc_id)
"""


@query("op8_substring_dedup", ORACLE)
def op8(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
