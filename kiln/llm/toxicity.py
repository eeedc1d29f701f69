"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text's features are the character n-grams (3 to 5, with word borders) of its
distinct words, hashed to 2**18 buckets; a feature's value is the number of
distinct words that hold it.  Both steps of the fit use a bounded sample of the
labelled rows (about ``SAMPLE``, by a hash of the id): counts by class give each
feature its log-count ratio, features whose ratio is below ``LEAST_RATIO`` or not
clear of chance (z of ``LEAST_Z``) are left out, and a logistic regression is fitted on value x
ratio.  The sample's labels are broadcast, so fitting shuffles no text but theirs.

The weight of a text is the sum over its distinct words, so scoring is one pass.
What is broadcast is one weight a bucket, whatever the corpus.

Defined cases: null and empty texts have no features and score as the intercept
says; a label row counts once for each document row with its id, null labels
don't; with no labels, one class only or no clear feature every text scores the
smoothed share of label 1; rows with a null id are scored, never learned from.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.llm.common import query, table, written
from kiln.llm.words import WHITE, Words, distinct, give_back, mix

BITS = 18
SIZES = (3, 4, 5)
SLICE = 1 << 18          # bytes of text at once: n-grams take some 300 times that
SAMPLE = 40_000
LEAST_Z = 3.0
LEAST_RATIO = 1.0
REGULARISATION = 1e-4
BORDER = np.uint64(0x110000)
STEP = np.uint64(0xD1342543DE82EF95)


class Grams:
    """Distinct words of texts and their n-gram buckets."""

    def __init__(self):
        self.words = Words(WHITE)

    def slices(self, texts):
        """For each slice: texts' first index and number, (text, word) pairs once each, (word, bucket) pairs."""
        for part in self.words.slices(texts, SLICE):
            _, first, word = np.unique(part.hashes, return_index=True, return_inverse=True)
            pairs = distinct(part.text_of() * max(1, len(first)) + word)
            yield (part.at, len(part), *np.divmod(pairs, max(1, len(first))), *self.buckets(part, first))

    def buckets(self, part, first):
        """Buckets of the n-grams of some words of a slice: (index of the word, bucket)."""
        chars = np.frombuffer(bytes(part.data).decode("utf-8").encode("utf-32-le"), np.uint32).astype(np.uint64)
        upper = ((chars >= 65) & (chars <= 90)) | ((chars >= 0xC0) & (chars <= 0xDE) & (chars != 0xD7))
        chars = np.append(chars + np.uint64(32) * upper, BORDER)
        at = np.concatenate([[0], np.cumsum((part.data & 0xC0) != 0x80)])     # characters before each byte
        starts, ends = at[part.starts[first]], at[part.ends[first]]
        sizes = ends - starts + 2
        word = np.repeat(np.arange(len(first)), sizes)
        place = np.arange(len(word)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        inner = (place > 0) & (place < sizes[word] - 1)
        codes = mix(chars[np.where(inner, starts[word] + place - 1, len(chars) - 1)] + np.uint64(1))
        left = sizes[word] - place
        words, found = [], []
        for n in SIZES:
            grams = np.full(max(0, len(codes) - n + 1), n, np.uint64)
            for j in range(n):
                grams = grams * STEP + codes[j: j + len(grams)]
            full = left[: len(grams)] >= n
            words.append(word[: len(grams)][full])
            found.append((mix(grams[full]) >> np.uint64(64 - BITS)).astype(np.int64))
        return np.concatenate(words), np.concatenate(found)


def class_counts(batches):
    """Feature counts of a task's texts by class: (bucket, negative, positive), and under bucket -1 the texts."""
    grams, counts, texts = Grams(), np.zeros((2, 1 << BITS)), np.zeros(2)
    for batch in batches:
        toxic = np.asarray(batch.column("toxic")).astype(np.int64)
        texts += np.bincount(toxic, minlength=2)
        for at, n, text, pair_word, word, bucket in grams.slices(batch.column("text")):
            for label in (0, 1):
                uses = np.bincount(pair_word[toxic[at + text] == label], minlength=int(word.max(initial=-1)) + 1)
                counts[label] += np.bincount(bucket, uses[word], 1 << BITS)
    give_back()
    some = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1), pa.int32()), *(pa.array(np.append(counts[i, some], texts[i])) for i in (0, 1))],
                                     names=["bucket", "negative", "positive"])


def clear_ratios(counts) -> np.ndarray:
    """Log-count ratio of each bucket, 0 where it could be chance or is small."""
    ratio = np.zeros(1 << BITS)
    counts = counts[counts["bucket"] >= 0]
    n, p = counts["negative"].to_numpy() + 1, counts["positive"].to_numpy() + 1
    r = np.log(p / p.sum()) - np.log(n / n.sum())
    clear = np.abs(r) >= np.maximum(LEAST_RATIO, LEAST_Z * np.sqrt(1 / p + 1 / n))
    ratio[counts["bucket"].to_numpy()[clear]] = r[clear]
    return ratio


def scaled_features(ratio: np.ndarray):
    """Per text: label, and the features that have a ratio, as a sparse vector in its storage form."""
    place, size = np.cumsum(ratio != 0) - 1, int((ratio != 0).sum())
    names = [f.name for f in VectorUDT.sqlType()]

    def run(batches):
        grams = Grams()
        for batch in batches:
            indices, values, ends = [], [], [0]
            for _, n, text, pair_word, word, bucket in grams.slices(batch.column("text")):
                used = np.flatnonzero(ratio[bucket])
                word, bucket = word[used], bucket[used]
                order = np.argsort(word, kind="stable")
                word, bucket = word[order], bucket[order]
                low, high = np.searchsorted(word, pair_word), np.searchsorted(word, pair_word, side="right")
                sizes = high - low
                within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                cell, value = np.unique(np.repeat(text, sizes) * len(ratio) + bucket[np.repeat(low, sizes) + within], return_counts=True)
                indices.append(place[cell % len(ratio)])
                values.append(value * ratio[cell % len(ratio)])
                ends.extend(ends[-1] + np.searchsorted(cell // len(ratio), np.arange(1, n + 1)))
            if indices:
                n = batch.num_rows
                lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), x) for x in (pa.array(np.concatenate(indices), pa.int32()), pa.array(np.concatenate(values).astype(float)))]
                vectors = pa.StructArray.from_arrays([pa.array(np.zeros(n, np.int8)), pa.array(np.full(n, size, np.int32)), *lists], names)
                yield pa.RecordBatch.from_arrays([batch.column("toxic").cast(pa.float64()), vectors], names=["label", "features"])
        give_back()
    return run


def scores(weights: np.ndarray, intercept: float, column: str):
    def run(batches):
        grams = Grams()
        for batch in batches:
            out = []
            for _, n, text, pair_word, word, bucket in grams.slices(batch.column("text")):
                of_word = np.bincount(word, weights[bucket], int(word.max(initial=-1)) + 1)
                total = intercept + np.bincount(text, of_word[pair_word], n)
                out.append(1 / (1 + np.exp(-np.clip(total, -700, 700))))
            if out:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(out))], names=[*batch.schema.names, column])
        give_back()
    return run


def fit(labelled: DataFrame) -> tuple[np.ndarray, float]:
    """Weight of each bucket and the intercept, from rows (text, toxic 0 or 1)."""
    counts = (labelled.mapInArrow(class_counts, "bucket int, negative double, positive double")
              .groupBy("bucket").agg(F.sum("negative").alias("negative"), F.sum("positive").alias("positive"))).toPandas()  # a row a bucket
    texts = counts[counts["bucket"] < 0][["negative", "positive"]].sum()
    prior = (texts["positive"] + 0.5) / (texts.sum() + 1)
    ratio = clear_ratios(counts) if texts.min() > 0 else np.zeros(1 << BITS)
    size = int((ratio != 0).sum())
    if not size:
        return np.zeros(1 << BITS, np.float32), float(np.log(prior / (1 - prior)))
    schema = T.StructType([T.StructField("label", T.DoubleType()), T.StructField("features", VectorUDT())])
    points = labelled.mapInArrow(scaled_features(ratio), schema).persist()      # of SAMPLE rows
    try:
        model = LogisticRegression(maxIter=60, regParam=REGULARISATION, standardization=False).fit(points)
    finally:
        points.unpersist()
    weights = np.zeros(1 << BITS, np.float32)
    weights[ratio != 0] = model.coefficients.toArray() * ratio[ratio != 0]
    return weights, float(model.intercept)


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def sampled(labels: DataFrame, size: int) -> DataFrame:
    """About ``size`` labels at most, by a hash of the id: the same rows in every run."""
    known = labels.filter(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    share = min(1.0, size / max(1, known.count()))
    return known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, column: str = "score") -> DataFrame:
    """The rows of ``docs`` with the score of their text added as a column (in place of one of that name)."""
    docs = docs.drop(column)
    text = F.col("text").cast("string").alias("text")
    known = F.broadcast(sampled(labels, sample))                              # SAMPLE rows
    labelled = written(docs.select("doc_id", text).join(known, "doc_id").repartition("doc_id").select("text", "toxic"), "labelled")
    weights, intercept = fit(labelled)
    scored = docs.withColumn("text", text)
    return scored.mapInArrow(scores(weights, intercept, column), T.StructType([*scored.schema.fields, T.StructField(column, T.DoubleType())]))


@query("op7_toxicity")
def op7(spark, sf_dir):
    scored = toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
