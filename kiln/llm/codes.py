"""Vector code compression: product quantisation whose exact nearest entries come from slice-and-intersect bitmasks.

A vector of d components becomes integers (floor of ``SCALE`` times each) and is cut into
``PARTS`` equal parts; each part gets the number of the nearest entry (squared Euclidean,
ties to the lower number) of its own codebook of ``ENTRIES`` entries, one byte a part.

*Search.*  For every dimension of a codebook the entries' coordinates are sorted, and
beside each sorted place lies the bitmask of the entries before it (packed uint64 words).
The entries within r of x in that dimension are the mask at the range's end without the
mask at its start; ANDed over the dimensions they are exactly the entries in the box of
half-width r.  An initial radius (the middle distance of a few vectors to their nearest
entries) gives most vectors a good entry, whose distance is then the radius that proves
the result: no entry outside that box can be nearer.  A box that holds nothing doubles.

*Codebooks* start as the parts of the vectors with the smallest ids.  Each round is one
scan: tasks assign their rows and sum them by entry, Spark adds the sums, and the driver
gets the ``PARTS`` x ``ENTRIES`` rows of one codebook set, whatever the number of vectors.

Defined cases: rows whose vector is null, empty or holds a null or non-finite component
are left out; so are vectors of another length than the first kept one (by id); parts of
a length that does not divide are filled with zeros at the end; components beyond
``LARGEST`` in magnitude count as that (distances stay within 64 bits); equal ids and
null ids (after all others) are ordered by their vectors; fewer than ``ENTRIES`` vectors
make a smaller codebook; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import query, sized, table, written

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
LARGEST = 1 << 24                       # as an integer component
BLOCK = 2048                            # vectors a task searches at once
PAIRS = 1 << 15                         # candidate pairs whose distances are worked out at once
PROBES = 32


class Codebook:
    """Entries of one part with the prefix masks of their sorted coordinates."""

    def __init__(self, entries: np.ndarray):
        self.entries = np.asarray(entries, np.int64)
        n, d = self.entries.shape
        self.words = -(-n // 64)
        order = np.argsort(self.entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.entries, order, axis=0).T.copy()              # d x n
        bits = np.zeros((n, self.words), np.uint64)
        bits[np.arange(n), np.arange(n) // 64] = np.uint64(1) << (np.arange(n) % 64).astype(np.uint64)
        self.prefix = np.zeros((d, n + 1, self.words), np.uint64)
        for j in range(d):
            self.prefix[j, 1:] = np.bitwise_or.accumulate(bits[order[:, j]], axis=0)

    def box(self, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Masks of the entries within each row's radius in every dimension."""
        found = None
        for j in range(x.shape[1]):
            low = np.searchsorted(self.sorted[j], x[:, j] - radius, side="left")
            high = np.searchsorted(self.sorted[j], x[:, j] + radius, side="right")
            inside = self.prefix[j, high] & ~self.prefix[j, low]
            found = inside if found is None else found & inside
        return found

    def best(self, x: np.ndarray, masks: np.ndarray):
        """Nearest of the masked entries (-1: none) and its squared distance, ties to the lower number."""
        n, entries = len(self.entries), self.entries
        which, least = np.full(len(x), -1), np.full(len(x), np.iinfo(np.int64).max)
        largest = int(max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0)))
        if x.shape[1] * (2 * largest) ** 2 < 1 << 53:             # doubles hold every such distance exactly
            x, entries = x.astype(float), entries.astype(float)
        for at in range(0, len(x), max(1, PAIRS // n)):
            part = slice(at, at + max(1, PAIRS // n))
            held = np.unpackbits(masks[part].view(np.uint8).reshape(-1, self.words * 8), axis=1, bitorder="little")[:, :n]
            row, entry = np.nonzero(held)
            if not len(row):
                continue
            apart = x[part].take(row, axis=0, mode="clip")
            apart -= entries.take(entry, axis=0, mode="clip")
            far = np.einsum("ij,ij->i", apart, apart).astype(np.int64)
            first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            low = np.minimum.reduceat(far, first)
            hit = np.flatnonzero(far == np.repeat(low, np.diff(np.r_[first, len(row)])))
            one = hit[np.r_[True, row[hit][1:] != row[hit][:-1]]]
            which[part][row[one]], least[part][row[one]] = entry[one], far[one]
        return which, least

    def nearest(self, x: np.ndarray):
        """Entry and squared distance for each row."""
        x = np.asarray(x, np.int64)
        which, far = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        if not len(x):
            return which, far
        every = np.full((min(PROBES, len(x)), self.words), np.iinfo(np.uint64).max, np.uint64)
        radius = np.full(len(x), max(1, int(np.median(np.sqrt(self.best(x[:: max(1, len(x) // PROBES)][:len(every)], every)[1].astype(float)))) // 2))
        open_, proven = np.arange(len(x)), np.zeros(len(x), bool)
        while len(open_):
            got, d = self.best(x[open_], self.box(x[open_], radius[open_]))
            which[open_], far[open_] = got, d
            found = got >= 0
            need = np.zeros(len(open_), np.int64)
            need[found] = np.ceil(np.sqrt(d[found].astype(float)) * (1 + 1e-12)).astype(np.int64)
            done = found & (need <= radius[open_])
            radius[open_] = np.where(found, need, radius[open_] * 2)
            open_ = open_[~done]
        return which, far


def searched(books: list, x: np.ndarray):
    """Numbers (rows x parts) and summed distances of integer vectors."""
    m = x.shape[1] // len(books)
    number, error = np.empty((len(x), len(books)), np.int64), np.zeros(len(x), np.int64)
    for low in range(0, len(x), BLOCK):
        some = slice(low, low + BLOCK)
        for p, book in enumerate(books):
            which, far = book.nearest(x[some, p * m:(p + 1) * m])
            number[some, p] = which
            error[some] += far
    return number, error


def matrix(column: pa.Array, d: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten()).reshape(len(column), d)


def integer_vectors(vectors: DataFrame) -> tuple[DataFrame, int]:
    """(vec_id, label, v: array of integers) of the rows that are kept, written, and the common length of v (0: no rows)."""
    x = F.col("embedding").cast("array<double>")
    largest = F.lit(float(LARGEST))
    whole = F.transform(x, lambda c: F.least(F.greatest(F.floor(c * SCALE).cast("double"), -largest), largest).cast("bigint"))
    fine = (F.size(x) > 0) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    label = F.col("label") if "label" in vectors.columns else F.lit(None).cast("int").alias("label")
    kept = vectors.select("vec_id", label, F.when(F.coalesce(fine, F.lit(False)), whole).alias("v")).filter("v is not null")
    first = kept.agg(F.min(F.struct(F.col("vec_id").isNull(), "vec_id", "v")).alias("m")).first()["m"]
    if first is None:
        return kept, 0
    n = len(first["v"])
    d = -(-n // PARTS) * PARTS
    same = kept.filter(F.size("v") == n)
    if d > n:
        same = same.withColumn("v", F.concat("v", F.array_repeat(F.lit(0).cast("bigint"), d - n)))
    return written(same, "vectors"), d


def fit_codebooks(vectors: DataFrame, d: int, rounds: int = ROUNDS, entries: int = ENTRIES) -> list:
    """Codebooks (arrays of entries x part length) after some rounds over all vectors."""
    m = d // PARTS
    seeds = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()        # one codebook
    books = [np.array([r["v"][p * m:(p + 1) * m] for r in seeds], np.int64) for p in range(PARTS)]
    names = [f"s{j}" for j in range(m)]

    def sums(batches):
        found = [Codebook(b) for b in books]
        total, count = np.zeros((PARTS, len(seeds), m), np.int64), np.zeros((PARTS, len(seeds)), np.int64)
        for batch in batches:
            x = matrix(batch.column(0), d)
            number, _ = searched(found, x)
            for p in range(PARTS if len(x) else 0):
                order = np.argsort(number[:, p], kind="stable")
                held, first, n = np.unique(number[order, p], return_index=True, return_counts=True)
                total[p, held] += np.add.reduceat(x[order, p * m:(p + 1) * m], first, axis=0)
                count[p, held] += n
        part, entry = np.nonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(count[part, entry])]
                                         + [pa.array(total[part, entry, j]) for j in range(m)], names=["part", "entry", "n", *names])

    schema = ", ".join(["part int", "entry int", "n bigint", *(f"{c} bigint" for c in names)])
    for _ in range(rounds):
        books = [b.copy() for b in books]
        summed = vectors.select("v").mapInArrow(sums, schema).groupBy("part", "entry").agg(*(F.sum(c).alias(c) for c in ("n", *names)))
        new = [(r["part"], r["entry"], [r[c] // r["n"] for c in names]) for r in summed.collect()]       # PARTS x entries rows
        for p, e, mean in new:
            books[p][e] = mean
    return books


def encode(vectors: DataFrame, books: list, d: int) -> DataFrame:
    """vec_id, label, code (two hex digits a part) and error of every vector."""
    def coded(batches):
        found = [Codebook(b) for b in books]
        for batch in batches:
            number, error = searched(found, matrix(batch.column(2), d))
            code = [bytes(row).hex() for row in number.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(code, pa.string()), pa.array(error)],
                                             names=["vec_id", "label", "code", "error"])

    types = dict(vectors.dtypes)
    return vectors.select("vec_id", "label", "v").mapInArrow(coded, f"vec_id {types['vec_id']}, label {types['label']}, code string, error bigint")


def digest(books: list) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def compress(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error (its label's sum of errors) and codebooks_sha256 of the vectors that are kept."""
    kept, d = integer_vectors(vectors)
    if d == 0:
        return kept.select("vec_id", F.lit("").alias("code"), *(F.lit(0).cast("bigint").alias(c) for c in ("error", "label_error")), F.lit("").alias("codebooks_sha256"))
    books = fit_codebooks(kept, d)
    coded = written(encode(kept, books, d), "codes")
    errors = sized(coded.groupBy(F.col("label").alias("l")).agg(F.sum("error").alias("label_error")))
    return (coded.join(errors, F.col("label").eqNullSafe(F.col("l")), "left")
            .select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")))


@query("op12_vector_codes")
def op12(spark, sf_dir):
    return compress(table(spark, sf_dir, "embeddings"))
