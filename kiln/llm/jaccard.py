"""N-gram Jaccard join by a token-group matrix.

A document's set is its distinct 5-word shingles (64-bit hashes).  Equal sets are
one vertex.  Tokens are put in one order for all sets: rare ones by hash, heavy
ones (``HEAVY`` at most, from a count of every set) last, by use.  Of a set of n
only its first ``n - ceil(t n) + l`` tokens, l = n // 4, are shuffled: sets that
link share at least min(l) of these, so whatever shares fewer is out.

1. Vertices that share too few tokens with any other drop out.
2. Groups: a vertex joins the leader with which it shares most tokens; a token's leader
   is its most typical vertex (the one whose tokens have the most uses).  Members whose
   sets link with the leader's are one component from here on.
3. Token-group matrix: the union of each group's tokens, as (token, group) rows.  The
   tokens that a vertex has in a group's union bound its overlap with any member, so
   only the groups that reach the bound can hold a link.  Of two groups the smaller one
   asks; a vertex asks its own group only if it isn't in the leader's component.
4. A group's members are dealt out by ``CHUNK``.  A query meets the union of a chunk's
   whole sets first, and only chunks that reach the bound are opened: one count over the
   chunk's inverted tokens gives the overlap with every member.

Every reported link is checked on the whole sets, so hashes of shortened tokens cost
time only.  No step emits the pairs of a group: copies are one vertex, a query reports
one link a component, and what the leader links is asked about no more.

Defined cases: null and empty texts have empty sets and link with nothing; rows
with a null id have no component; rows that repeat an id are kept, each with the
component of its own text; further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.llm.common import query, sized, table, text_hash, written
from kiln.llm.graph import components
from kiln.llm.words import WHITE, Words, distinct, mix

SHINGLE = 5
HEAVY = 1 << 16
LOCAL_USES = 4           # a token in so many sets of one buffer may be heavy
BUFFER = 600_000       # tokens a task gathers before it writes them out
CHUNK = 512              # members that a query is checked against at once
TOKEN_BITS = 40          # of a token, besides its bucket


def sets(words: Words, part, size: int):
    """Distinct shingles of a slice's texts: (text, token), by text and then token."""
    hashes, left = words.windows(part.hashes, size), part.left()
    at = np.flatnonzero(left[: len(hashes)] >= size)
    text, token = part.text_of()[at], hashes[at]
    for n in range(1, size):                       # shorter texts are one shingle
        short = part.first[:-1][part.counts == n]
        text, token = np.append(text, part.text_of()[short]), np.append(token, words.windows(part.hashes, n)[short] if len(short) else token[:0])
    order = np.argsort(token, kind="stable")
    order = order[np.argsort(text[order].astype(np.uint16 if len(part) < 65536 else np.int64), kind="stable")]
    text, token = text[order], token[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (token[1:] != token[:-1])
    return text[new], token[new]


def set_sizes_and_ids(n: int, text: np.ndarray, token: np.ndarray):
    """Size and 64-bit id of each text's set."""
    size = np.bincount(text, minlength=n)
    sums = np.zeros((2, len(token) + 1), np.uint64)
    np.cumsum(mix(token), out=sums[0, 1:])
    np.cumsum(mix(token ^ np.uint64(0xA0761D6478BD642F)), out=sums[1, 1:])
    ends = np.cumsum(size)
    a, b = (x[ends] - x[ends - size] for x in sums)
    return size, mix(mix(a) + b * np.uint64(0x9E3779B97F4A7C15) + size.astype(np.uint64)).view(np.int64)


def describe(size: int):
    """One row a document (its set's size and id), and rows of tokens that many sets of a buffer hold."""
    def uses(held):
        seen, at = np.unique(np.concatenate([v for v, _, _ in held]), return_index=True)        # a set counts once
        first = np.zeros(sum(len(v) for v, _, _ in held), bool)
        first[at] = True
        tokens, lows = [], 0
        for v, text, token in held:
            tokens.append(token[first[lows: lows + len(v)][text]])
            lows += len(v)
        tokens, n = np.unique(np.concatenate(tokens), return_counts=True)
        many = n >= LOCAL_USES
        return pa.RecordBatch.from_arrays([*(pa.nulls(many.sum(), pa.int64()) for _ in range(2)), pa.array(n[many].astype(np.int64)), pa.array(tokens[many].view(np.int64)), pa.array(np.ones(many.sum(), bool))],
                                          names=["doc_id", "text_hash", "n", "v", "is_token"])

    def run(batches):
        words, held, waiting = Words(WHITE), [], 0
        for batch in batches:
            for part in words.slices(batch.column("text")):
                text, token = sets(words, part, size)
                n, v = set_sizes_and_ids(len(part), text, token)
                yield pa.RecordBatch.from_arrays([*(batch.column(x).slice(part.at, len(part)) for x in ("doc_id", "text_hash")), pa.array(n.astype(np.int64)), pa.array(v), pa.array(np.zeros(len(n), bool))],
                                                 names=["doc_id", "text_hash", "n", "v", "is_token"])
                held.append((v, text, token))
                waiting += len(token)
                if waiting >= BUFFER:
                    yield uses(held)
                    held, waiting = [], 0
        if held:
            yield uses(held)
    return run


def needed(n, t: int):
    """Tokens that a set shares with any set that links with it: t percent of its own, at least."""
    return (n * t + 99) // 100


def spare(n):
    """Tokens of a prefix beyond those that a linked set may lack."""
    return np.maximum(1, n // 4)


def least_shared(n, t: int, low=None, high=None):
    """Column: the least number of prefix tokens that a set of n shares with a linked set of low to high tokens.

    A linked set of m has a = t (n + m) / (100 + t) of its tokens in common; the k-th common token lies in a
    prefix of length p while n - a + k <= p, so min(p - n, q - m) + a are in both.  That has its
    least value at one end of the sizes; 3 make up for rounding.
    """
    low = F.ceil(n * t / 100) if low is None else F.greatest(low, F.ceil(n * t / 100))
    high = F.floor(n * 100 / t) if high is None else F.least(high, F.floor(n * 100 / t))
    kept = lambda x: F.greatest(F.lit(1), F.floor(x / 4)) - F.ceil(x * t / 100)
    shared = lambda m: F.least(kept(n), kept(m)) + F.ceil((n + m) * t / (100 + t))
    return F.greatest(F.lit(1), F.least(shared(low), shared(high)) - 3)


def prefixes(size: int, t: int, heavy: np.ndarray, buckets: int):
    """Rows of packed (token, vertex) entries, by bucket of the token: the tokens' leading bits, vertex after
    vertex, each vertex's id and number of tokens.  ``heavy`` has the heavy tokens, most used last."""
    order = np.argsort(heavy)
    ranked = heavy[order]

    def packed(entries):
        token, v, n = (np.concatenate(x) for x in zip(*entries))
        once = np.zeros(len(v), bool)
        once[np.unique(v, return_index=True)[1]] = True                   # equal sets count once
        token, v, n = token[np.repeat(once, n)], v[once], n[once]
        bucket = (mix(token) % np.uint64(buckets)).astype(np.uint16 if buckets < 65536 else np.int64)
        by = np.argsort(bucket, kind="stable")
        bucket, at = bucket[by], np.repeat(np.arange(len(v)), n)[by]
        short = np.ascontiguousarray((token[by] >> np.uint64(64 - TOKEN_BITS))[:, None].view(np.uint8)[:, :TOKEN_BITS // 8])
        starts = np.flatnonzero(np.append(True, (bucket[1:] != bucket[:-1]) | (at[1:] != at[:-1])))
        names, counts = v[at[starts]], np.diff(np.append(starts, len(at)))
        some = distinct(bucket)
        ends, runs = np.append(np.searchsorted(bucket, some), len(bucket)), np.append(np.searchsorted(bucket[starts], some), len(starts))
        rows = [(short[ends[i]: ends[i + 1]].tobytes(), (x := counts[runs[i]: runs[i + 1]]).astype(np.uint8 if x.max() < 256 else np.uint32).tobytes(), names[runs[i]: runs[i + 1]].tobytes()) for i in range(len(some))]
        return pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), *(pa.array([r[j] for r in rows], pa.binary()) for j in range(3))], names=["bucket", "tokens", "counts", "names"])

    def run(batches):
        words, held, waiting = Words(WHITE), [], 0
        for batch in batches:
            for part in words.slices(batch.column("text")):
                text, token = sets(words, part, size)
                n, v = set_sizes_and_ids(len(part), text, token)
                key = token >> np.uint64(1)
                if len(ranked):
                    at = np.minimum(np.searchsorted(ranked, token), len(ranked) - 1)
                    hot = ranked[at] == token
                    key[hot] = np.uint64(1 << 63) + order[at[hot]].astype(np.uint64)
                    by = np.lexsort((key, text))
                    token = token[by]
                keep = n - needed(n, t) + spare(n)
                first = np.arange(len(token)) - np.repeat(np.cumsum(n) - n, n) < np.repeat(keep, n)
                held.append((token[first], v, np.minimum(n, keep)))
                waiting += int(first.sum())
                if waiting >= BUFFER:
                    yield packed(held)
                    held, waiting = [], 0
        if waiting:
            yield packed(held)
    return run


def shared_tokens(batches):
    """(token, vertex) once each, for tokens of two vertices or more, and the token's number of vertices.  Equal tokens are in one task."""
    token, vertex = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for batch in batches:
        for bucket, short, counts, names in zip(*(batch.column(x) for x in ("bucket", "tokens", "counts", "names"))):
            raw = np.frombuffer(short.as_buffer(), np.uint8).reshape(-1, TOKEN_BITS // 8)
            wide = np.zeros((len(raw), 8), np.uint8)
            wide[:, :TOKEN_BITS // 8] = raw
            token.append(wide.view(np.uint64)[:, 0] + np.uint64(bucket.as_py() << TOKEN_BITS))
            names = np.frombuffer(names.as_buffer(), np.int64)
            vertex.append(np.repeat(names, np.frombuffer(counts.as_buffer(), np.uint8 if len(counts.as_buffer()) == len(names) else np.uint32)))
    token, vertex = np.concatenate(token), np.concatenate(vertex)
    if not len(token):
        return
    by = np.argsort(token, kind="stable")
    token, vertex = token[by], vertex[by]
    same = token[1:] == token[:-1]
    some = np.append(same, False) | np.append(False, same)                # drop what one row holds
    token, vertex = token[some], vertex[some]
    if not len(token):
        return
    by = np.lexsort((vertex, token))
    token, vertex = token[by], vertex[by]
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (vertex[1:] != vertex[:-1])
    token, vertex = token[new], vertex[new]
    starts = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
    uses = np.diff(np.append(starts, len(token)))
    uses = np.repeat(uses, uses)
    some = uses > 1
    yield pa.RecordBatch.from_arrays([pa.array(token[some].view(np.int64)), pa.array(vertex[some]), pa.array(uses[some].astype(np.int32))], names=["token", "v", "uses"])


class Chunk:
    """Some members of a group: their tokens, inverted."""

    def __init__(self, vs, components, held):
        self.vs, self.components = np.array(vs), np.array(components)
        self.sizes = np.array([len(x) for x in held])
        member, token = np.repeat(np.arange(len(held)), self.sizes), np.concatenate(held)
        by = np.argsort(token, kind="stable")
        self.token, self.member = token[by], member[by]

    def links(self, mine: np.ndarray, component: int, t: int):
        """A member of each other component that a set links with."""
        low, high = np.searchsorted(self.token, mine), np.searchsorted(self.token, mine, side="right")
        n = len(mine)
        least = max(needed(n, t), -(-t * (n + max(int(self.sizes.min()), needed(n, t))) // (100 + t)))
        if np.count_nonzero(high > low) < least:                       # not even the chunk's union has enough
            return self.vs[:0]
        each = high - low
        at = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each) + np.repeat(low, each)
        both = np.bincount(self.member[at], minlength=len(self.vs))
        found = np.flatnonzero((100 * both >= t * (n + self.sizes - both)) & (self.components != component))
        return self.vs[found[np.unique(self.components[found], return_index=True)[1]]]


def check_groups(size: int, t: int):
    """Links between queries and the members of their chunk, which come first in its run of rows."""
    def run(batches):
        words, name, chunk, held = Words(WHITE), None, None, ([], [], [])
        for batch in batches:
            groups, salts, asks, vs, components = (batch.column(x).to_pylist() for x in ("g", "salt", "asks", "v", "component"))
            a, b = [], []
            for part in words.slices(batch.column("text")):
                text, token = sets(words, part, size)
                n, v = set_sizes_and_ids(len(part), text, token)
                ends = np.cumsum(n)
                for i in range(len(part)):
                    row, mine = part.at + i, token[ends[i] - n[i]: ends[i]]
                    if v[i] != vs[row]:
                        continue                                # another text with the same id
                    if (groups[row], salts[row]) != name:
                        name, chunk, held = (groups[row], salts[row]), None, ([], [], [])
                    if not asks[row]:
                        for column, value in zip(held, (vs[row], components[row], mine)):
                            column.append(value)
                    elif held[0]:
                        chunk = chunk or Chunk(*held)
                        other = chunk.links(mine, components[row], t)
                        a += [vs[row]] * len(other)
                        b += other.tolist()
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    return run


def links(queries: DataFrame, members: DataFrame, texts: DataFrame, size: int, t: int) -> DataFrame:
    """Links (a, b) of queries (v, g, component) with members (v, g, component) of their groups g."""
    chunks = members.groupBy("g").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))
    asked = queries.join(chunks, "g").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)))
    dealt = members.join(queries.select("g").distinct(), "g", "left_semi").join(chunks, "g").withColumn("salt", F.pmod(F.xxhash64("v"), F.col("chunks")))
    rows = dealt.withColumn("asks", F.lit(False)).unionByName(asked.withColumn("asks", F.lit(True)))
    return (rows.join(texts, "v").select("g", "salt", "asks", "v", "component", "text")
            .repartition("g", "salt").sortWithinPartitions("g", "salt", "asks")
            .mapInArrow(check_groups(size, t), "a bigint, b bigint").distinct())


def jaccard_components(docs: DataFrame, size: int = SHINGLE, threshold: float = 0.75) -> DataFrame:
    """One row per document row: doc_id, text_hash, n_shingles, component_id (the smallest id
    that links reach), first (whether it is the component's first by id and text hash)."""
    spark, t = docs.sparkSession, round(threshold * 100)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    described = written(docs.withColumn("text_hash", text_hash()).mapInArrow(describe(size), "doc_id bigint, text_hash bigint, n bigint, v bigint, is_token boolean"), "sets")
    rows = described.filter(~F.col("is_token"))
    vertices = rows.filter((F.col("n") > 0) & F.col("doc_id").isNotNull()).groupBy("v").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"), F.first("n").alias("n")).withColumn("doc_id", F.col("first.doc_id"))
    heavy = (described.filter("is_token").groupBy("v").agg(F.sum("n").alias("uses")).orderBy(F.desc("uses"), "v").limit(HEAVY).toPandas())   # HEAVY rows at most
    heavy = heavy["v"].to_numpy(np.int64)[::-1].copy().view(np.uint64)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = written(docs.filter(F.col("doc_id").isNotNull()).mapInArrow(prefixes(size, t, heavy, buckets), "bucket int, tokens binary, counts binary, names binary")
                     .repartitionById(buckets, "bucket").mapInArrow(shared_tokens, "token bigint, v bigint, uses int"), "tokens")

    alive = written(shared.groupBy("v").agg(F.count("*").alias("share"), F.sum(F.log2("uses")).alias("typical")).join(vertices, "v")
                    .filter(F.col("share") >= least_shared(F.col("n"), t)).select("v", "n", "doc_id", (F.col("typical") / F.col("n")).alias("typical")), "alive")
    tokens = written(shared.select("token", "v").join(sized(alive.select("v", "typical")), "v"), "alive-tokens")
    texts = written(docs.join(sized(alive.select("v", "doc_id")), "doc_id").select("v", "text"), "texts")

    of_token = Window.partitionBy("token")
    led = tokens.select("v", F.max(F.struct("typical", "v")).over(of_token).alias("lead"))
    groups = written(led.groupBy("v", F.col("lead.typical").alias("typical"), F.col("lead.v").alias("g")).agg(F.count("*").alias("share"))
                     .groupBy("v").agg(F.max(F.struct("share", "typical", "g"))["g"].alias("g")), "groups")
    leaders = groups.select(F.col("g").alias("v"), "g", F.col("g").alias("component")).distinct()
    linked = written(links(groups.filter("v <> g").withColumn("component", F.col("v")), leaders, texts, size, t), "links")

    found = components(linked).select(F.col("node").alias("v"), F.col("root").alias("component"))
    members = written(groups.join(found, "v", "left").select("v", "g", F.coalesce("component", "v").alias("component")).join(alive.select("v", "n"), "v"), "members")
    of_leader = members.select(F.col("v").alias("g"), F.col("component").alias("main"))
    kinds = (members.groupBy("g").agg(F.count("*").alias("size"), F.min("n").alias("low"), F.max("n").alias("high"), F.min("component").alias("one"), F.max("component").alias("other"))
             .join(of_leader, "g"))
    rows_of = tokens.select("token", "v").join(sized(members.join(kinds.select("g", "size"), "g")), "v")
    matrix = rows_of.withColumn("groups", F.collect_set(F.struct(F.col("size").alias("to_size"), F.col("g").alias("to"))).over(of_token))
    smaller = F.struct("size", "g") <= F.struct("to_size", "to")
    asking = (matrix.select("v", "g", "component", "n", "size", F.inline("groups")).filter(smaller).groupBy("v", "g", "component", "n", "to").agg(F.count("*").alias("share"))
              .join(kinds.select(F.col("g").alias("to"), "low", "high", "one", "other", "main"), "to")
              .filter(~((F.col("component") == F.col("one")) & (F.col("component") == F.col("other"))) & ((F.col("g") != F.col("to")) | (F.col("component") != F.col("main")))
                      & (F.col("low") * t <= F.col("n") * 100) & (F.col("n") * t <= F.col("high") * 100) & (F.col("share") >= least_shared(F.col("n"), t, F.col("low"), F.col("high"))))
              .select("v", F.col("to").alias("g"), "component"))
    linked = linked.union(written(links(written(asking, "queries"), members.select("v", "g", "component"), texts, size, t), "more-links"))

    found = components(linked).select(F.col("node").alias("v"), F.col("root").alias("g"))
    named = vertices.join(found, "v", "left").select("v", F.coalesce("g", "v").alias("g"), "first")
    component = named.join(named.groupBy("g").agg(F.min("first").alias("least")), "g").select("v", "least")
    alone = F.col("doc_id").isNull() | (F.col("n") == 0)
    return (rows.join(component, "v", "left")
            .select("doc_id", "text_hash", F.col("n").alias("n_shingles"), F.when(alone, F.col("doc_id")).otherwise(F.col("least.doc_id")).alias("component_id"),
                    (alone | ((F.col("doc_id") == F.col("least.doc_id")) & (F.col("text_hash") == F.col("least.text_hash")))).alias("first")))


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') t FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id a, y.doc_id b, count(*) c FROM s x JOIN s y ON x.t = y.t AND x.doc_id <> y.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 75 * (na.n + nb.n - c)),
r AS (SELECT doc_id a, doc_id b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, coalesce(n, 0)::BIGINT n_shingles, component_id FROM d LEFT JOIN n USING (doc_id)
JOIN (SELECT a doc_id, min(b) component_id FROM r GROUP BY a) USING (doc_id)
"""


@query("op9_jaccard_components", ORACLE)
def op9(spark, sf_dir):
    return jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
