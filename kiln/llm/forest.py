"""Embedding near-duplicates: a forest of random-projection trees with spill, compared within leaves.

*Vertices.*  Equal vectors are one vertex with a count (a partial aggregate, so a vector
that a third of the rows hold costs nothing more).

*Balls.*  Large groups of near copies are found on a bounded sample (``BALL_SAMPLE``
vectors by hash): around each dense place a centre.  Vertices within half the angle of
``LEAST`` of a centre form a ball; any two of them link for certain, so their links are
counted from the ball's size and never listed.

*Trees.*  ``TREES`` trees are fitted on a bounded sample (``SAMPLE`` vectors by hash):
each node splits on the difference of two of its vectors drawn at random, at the middle;
the share ``SPILL`` on both sides of the cut goes to both children, so that a pair close
to a cut stays together in one of them.  Every vertex goes down every tree.  Leaves over
``LEAF_MOST`` rows split on, a level a round, along directions drawn from the node's
number and cut at the node's own quantiles, until none is left, so a task never holds
more than one leaf of that size.

*Leaves* multiply their vectors (16-bit floats, whose rounding bounds the cosine's error)
and list the pairs that are not in one ball.  Pairs within the error of ``LEAST`` are
verified on the whole vectors in double precision, all others are decided by the bound.
Links over balls (contracted to a node each) and vertices give the components.

Recall is that of the forest: a pair is missed if all trees separate it.  Measured against
all pairs: 0.9997 of the links on the tests' vectors with leaves of 40 (0.90 there without
balls, as a group larger than a leaf is cut), and every link of 10,256 vectors twice.

Defined cases: vectors that are null, empty, all zero or hold null or non-finite
components link with nothing, nor do vectors of another length than the first by id;
equal ids are rows of their own; a null id takes part, but is no component's id if there
is another and is never kept; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import query, sized, table, written
from kiln.llm.graph import components

LEAST = 0.9                              # least cosine of a link
TREES = 6
SPILL = 0.06
LEAF = 1024                              # vertices a leaf is aimed at, before spill
LEAF_MOST = 6144
MOST_LEAVES = 4096                       # of a tree fitted on the sample
SAMPLE = 65_536
BALL_SAMPLE = 4096
BLOCK = 512
SEED = 20_010


def units(column: pa.Array, d: int) -> np.ndarray:
    """Unit vectors of an array column without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    x = np.asarray(column.flatten()).reshape(len(column), d).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def dense_centres(x: np.ndarray, least: float) -> np.ndarray:
    """Centres of groups of three or more vectors that lie within half the linking angle of them."""
    half = np.sqrt((1 + least) / 2)
    near = x @ x.T >= least
    free, centres = np.ones(len(x), bool), []
    for i in np.argsort(-near.sum(axis=1), kind="stable"):
        members = near[i] & free
        if free[i] and members.sum() >= 3:
            centre = x[members].mean(axis=0)
            centre /= np.sqrt(centre @ centre)
            inside = free & (x @ centre >= half)
            if inside.sum() >= 3:
                centres.append(centre)
                free &= ~inside
    return np.array(centres).reshape(len(centres), x.shape[1])


def grown(x: np.ndarray, levels: int, tree: int, spill: float):
    """Directions and cuts of a tree's nodes in heap order from 1 on."""
    rng = np.random.default_rng([SEED, tree])
    direction, cut = np.zeros((1 << levels, x.shape[1]), np.float32), np.zeros((1 << levels, 2), np.float32)
    held = {1: np.arange(len(x))}
    for node in range(1, 1 << levels):
        rows = held.pop(node)
        some = x[rows[rng.integers(0, len(rows), 2)]] if len(rows) else np.zeros((2, x.shape[1]))
        line = some[0] - some[1]
        if not line.any():
            line = rng.normal(size=x.shape[1])
        direction[node] = line / np.sqrt(line @ line)
        p = x[rows].astype(np.float32) @ direction[node]
        cut[node] = np.quantile(p, [0.5 - spill, 0.5 + spill]) if len(rows) else 0
        held[2 * node], held[2 * node + 1] = rows[p <= cut[node, 1]], rows[p >= cut[node, 0]]
    return direction, cut


def leaves_of(x: np.ndarray, direction: np.ndarray, cut: np.ndarray):
    """(rows, leaves): every leaf that each vector goes to."""
    rows, nodes = np.arange(len(x)), np.ones(len(x), np.int64)
    size = len(direction)
    while size > 1:
        p = np.einsum("ij,ij->i", x[rows], direction[nodes])
        left, right = p <= cut[nodes, 1], p >= cut[nodes, 0]
        rows, nodes = np.r_[rows[left], rows[right]], np.r_[2 * nodes[left], 2 * nodes[right] + 1]
        size >>= 1
    return rows, nodes


DEALT = "tree int, node bigint, v bigint, m bigint, ball int, u binary"
DEALT_TYPES = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())


def dealt_batch(columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, DEALT_TYPES)], names=[f.split(" ")[0] for f in DEALT.split(", ")])


def split_large(dealt: DataFrame, d: int, spill: float, most: int) -> DataFrame:
    """Split the leaves of over ``most`` rows until there are none."""
    keys = ["tree", "node"]

    def projected(batches):
        import zlib
        lines: dict = {}
        for batch in batches:
            tree, node, v = (np.asarray(batch.column(i)) for i in range(3))
            u = np.frombuffer(b"".join(batch.column(5).to_pylist()), np.float16).reshape(-1, d).astype(np.float64)
            p = np.empty(len(v))
            for t, k in set(zip(tree.tolist(), node.tolist())):
                if (t, k) not in lines:
                    lines[t, k] = np.random.default_rng([SEED, t, k]).normal(size=d)
                here = (tree == t) & (node == k)
                p[here] = u[here] @ lines[t, k]
            # equal vectors of a leaf fall on either side by their own number
            p += np.array([zlib.crc32(b"%d" % x) for x in v.tolist()], float) * (1e-7 / (1 << 32)) if len(v) else 0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], names=[*batch.schema.names, "p"])

    large = sized(dealt.groupBy(*keys).count().filter(F.col("count") > most).select(*keys))
    while not large.isEmpty():
        rows = written(dealt.join(large, keys, "left_semi").select(*dealt.columns).mapInArrow(projected, DEALT + ", p double"), "projected")
        cuts = sized(rows.groupBy(*keys).agg(F.percentile_approx("p", [0.5 - spill, 0.5 + spill], 1000).alias("cut")))
        sides = F.array(F.when(F.col("p") <= F.col("cut")[1], F.col("node") * 2), F.when(F.col("p") >= F.col("cut")[0], F.col("node") * 2 + 1))
        below = rows.join(cuts, keys).select("tree", F.explode(F.array_compact(sides)).alias("node"), "v", "m", "ball", "u")
        dealt = written(dealt.join(large, keys, "left_anti").select(*dealt.columns).unionByName(below), "leaves")
        large = sized(dealt.groupBy(*keys).count().filter(F.col("count") > most).select(*keys))
    return dealt


def pairs_within(d: int, least: float):
    """Linked pairs of each leaf's rows that are not in one ball; ``sure`` if the rounding can't undo it."""
    slack = 2.0 ** -10 * 1.001 + d * 2.0 ** -22
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("ma", pa.int64()), ("mb", pa.int64()), ("sure", pa.bool_())])

    def compared(leaf):
        v, m, ball, u = (np.concatenate(c) for c in zip(*leaf))
        # a vertex's copies of the same leaf can't occur; order by number so that a < b
        at = np.argsort(v)
        v, m, ball, u = v[at], m[at], ball[at], u[at].astype(np.float32)
        for low in range(0, len(v), BLOCK):
            cosine = u[low:low + BLOCK] @ u[low:].T
            i, j = np.nonzero(cosine >= least - slack)
            keep = (j > i) & ((ball[low + i] < 0) | (ball[low + i] != ball[low + j]))
            i, j = i[keep], j[keep]
            if len(i):
                a, b = low + i, low + j
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (v[a], v[b], m[a], m[b], cosine[i, j] >= least + slack)], schema=schema)

    def pairs(batches):
        leaf, key = [], None
        for batch in batches:
            tree, node, v, m, ball = (np.asarray(batch.column(i)) for i in range(5))
            u = np.frombuffer(b"".join(batch.column(5).to_pylist()), np.float16).reshape(-1, d)
            starts = np.flatnonzero(np.r_[True, (tree[1:] != tree[:-1]) | (node[1:] != node[:-1])]) if len(v) else []
            for low, high in zip(starts, [*starts[1:], len(v)]):
                if leaf and key != (tree[low], node[low]):
                    yield from compared(leaf)
                    leaf = []
                key = tree[low], node[low]
                leaf.append((v[low:high], m[low:high], ball[low:high], u[low:high]))
        if leaf:
            yield from compared(leaf)
    return pairs


def verified(pairs: DataFrame, vertices: DataFrame, d: int, least: float) -> DataFrame:
    """Pairs whose cosine in double precision is ``least`` or more."""
    def exact(batches):
        for batch in batches:
            a, b = (units(batch.column(i), d) for i in (4, 5)) if batch.num_rows else (np.empty((0, d)),) * 2
            yield pa.RecordBatch.from_arrays(batch.columns[:4], names=batch.schema.names[:4]).filter(pa.array((a * b).sum(axis=1) >= least))

    x = vertices.select("v", "x")
    both = pairs.join(x.toDF("a", "xa"), "a").join(x.toDF("b", "xb"), "b")
    return both.select("a", "b", "ma", "mb", "xa", "xb").mapInArrow(exact, "a bigint, b bigint, ma bigint, mb bigint")


def near_vectors(vectors: DataFrame, least: float = LEAST, trees: int = TREES, spill: float = SPILL, leaf: int = LEAF,
                 leaf_most: int = LEAF_MOST, sample: int = SAMPLE, ball_sample: int = BALL_SAMPLE) -> DataFrame:
    """vec_id, n_links (other vectors linked directly), component_id (smallest id reachable) and kept, a row a vector."""
    x = F.col("embedding")
    fine = F.coalesce((F.size(x) > 0) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(x, lambda c: c != 0), F.lit(False))
    rows = vectors.select("vec_id", F.when(fine, x).alias("x"))
    first = rows.filter("x is not null").agg(F.min_by(F.size("x"), F.struct(F.col("vec_id").isNull(), "vec_id", F.size("x"))).alias("d")).first()["d"]
    alone = (F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    if first is None:
        return rows.select("vec_id", *alone)
    d = first
    ok = F.coalesce(F.size("x") == d, F.lit(False)) & F.col("x").isNotNull()
    keyed = rows.filter(ok).select("vec_id", "x", F.xxhash64("x").alias("h1"), F.xxhash64(F.lit(7), "x").alias("h2"))
    grouped = keyed.groupBy("h1", "h2").agg(F.min("vec_id").alias("low"), F.count("*").alias("m"), F.first("x").alias("x"))
    vertices = written(grouped.select(F.monotonically_increasing_id().alias("v"), "*"), "vertices")
    n = vertices.count()
    levels = 0
    while (leaf << levels) < n and (1 << levels) < MOST_LEAVES:
        levels += 1
    # a sample by hash, of its size on average; fewer vectors than that are all of it
    wanted = min(sample, max(ball_sample, 16 << levels))
    part = vertices.filter(F.pmod(F.xxhash64("h1", "h2"), F.lit(1 << 30)) < (1 << 30 if n <= wanted else int(wanted / n * (1 << 30))))
    picked = part.select("x").toArrow().column(0)
    picked = units(picked, d) if len(picked) else np.empty((0, d))
    centres = dense_centres(picked[:ball_sample], least)
    fitted = [grown(picked, levels, t, spill) for t in range(trees)] if levels else []
    half = np.sqrt((1 + least) / 2) + 1e-9

    def balls(batches):
        for batch in batches:
            u = units(batch.column(4), d) if batch.num_rows else np.empty((0, d))
            ball = np.full(len(u), -1, np.int32)
            if len(centres) and len(u):
                cosine = u @ centres.T
                best = cosine.argmax(axis=1)
                ball = np.where(cosine[np.arange(len(u)), best] >= half, best, -1).astype(np.int32)
            short = u.astype(np.float16)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], batch.column(5), pa.array(ball), pa.array([r.tobytes() for r in short], pa.binary())],
                                             names=["v", "m", "h1", "h2", "low", "ball", "u"])

    id_type = dict(vectors.dtypes)["vec_id"]
    held = written(vertices.select("v", "m", "h1", "h2", "x", "low").mapInArrow(balls, f"v bigint, m bigint, h1 bigint, h2 bigint, low {id_type}, ball int, u binary"), "balls")

    def down(batches):
        for batch in batches:
            v, m, ball = (np.asarray(batch.column(i)) for i in range(3))
            raw = batch.column(3)
            u = np.frombuffer(b"".join(raw.to_pylist()), np.float16).reshape(-1, d).astype(np.float32)
            for t in range(len(fitted)):
                at, nodes = leaves_of(u, *fitted[t])
                yield dealt_batch((np.full(len(at), t, np.int32), nodes, v[at], m[at], ball[at], raw.take(pa.array(at))))
            if not fitted:
                yield dealt_batch((np.zeros(len(v), np.int32), np.ones(len(v), np.int64), v, m, ball, raw))

    dealt = split_large(held.select("v", "m", "ball", "u").mapInArrow(down, DEALT), d, spill, leaf_most)
    found = (dealt.repartition("tree", "node").sortWithinPartitions("tree", "node")
             .mapInArrow(pairs_within(d, least), "a bigint, b bigint, ma bigint, mb bigint, sure boolean"))
    found = written(found.groupBy("a", "b").agg(F.max("sure").alias("sure"), F.max("ma").alias("ma"), F.max("mb").alias("mb")), "pairs")
    close = found.filter(~F.col("sure")).select("a", "b", "ma", "mb")
    links = written(found.filter("sure").select("a", "b", "ma", "mb").unionByName(verified(close, vertices, d, least)), "links")

    others = links.select(F.col("a").alias("v"), F.col("mb").alias("n")).unionAll(links.select(F.col("b").alias("v"), F.col("ma").alias("n"))).groupBy("v").agg(F.sum("n").alias("n"))
    sizes = F.broadcast(held.filter("ball >= 0").groupBy("ball").agg(F.sum("m").alias("in_ball")))          # a row a centre, BALL_SAMPLE / 3 at most
    narrow = (held.select("v", "m", "h1", "h2", "low", "ball", F.when(F.col("ball") >= 0, -1 - F.col("ball").cast("bigint")).otherwise(F.col("v")).alias("node"))
              .join(others, "v", "left").join(sizes, "ball", "left")
              .withColumn("n_links", F.coalesce("in_ball", "m") - 1 + F.coalesce("n", F.lit(0))))
    narrow = written(narrow.select("v", "node", "low", "h1", "h2", "n_links"), "vertices")
    # balls are one node each
    as_node = narrow.select("v", "node")
    edges = links.join(as_node.toDF("a", "na"), "a").join(as_node.toDF("b", "nb"), "b").select(F.col("na").alias("a"), F.col("nb").alias("b"))
    roots = components(edges)
    nodes = narrow.groupBy("node").agg(F.min("low").alias("low")).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    nodes = written(nodes, "nodes")
    lows = nodes.groupBy("root").agg(F.min("low").alias("component_id"))
    named = nodes.join(lows, "root").select("node", "component_id")
    of_ball = F.broadcast(named.filter("node < 0").toDF("node", "of_ball"))                                 # a row a centre
    result = (narrow.join(of_ball, "node", "left").join(named.filter("node >= 0").select(F.col("node").alias("v"), "component_id"), "v", "left")
              .select("h1", "h2", "n_links", F.coalesce("of_ball", "component_id").alias("component_id")))
    linked = keyed.select("vec_id", "h1", "h2").join(result, ["h1", "h2"])
    linked = linked.select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
    return linked.unionByName(rows.filter(~ok).select("vec_id", *alone))


@query("op13_embedding_dups")
def op13(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings"))
