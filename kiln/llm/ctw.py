"""LM scoring by context-tree weighting over binary-decomposed byte contexts.

A text is its bytes (A-Z in lower case) and an end symbol; before its start the
context is that symbol.  A byte is eight binary decisions, and each of the 255 places
in that decision tree has a context tree of its own over the preceding 0 to ``DEPTH``
bytes.  A node estimates its bit by Krichevsky-Trofimov from its counts; its weighted
probability is half its own estimate and half the product of its children's.  A text
is scored with the counts of the training texts fixed: the next bit's probability
mixes the estimates along the path by the nodes' posterior weights.

Texts are dealt to blocks of about ``BLOCK_BYTES`` by a hash, as compressed batches.
A block sends its distinct words and (DEPTH + 1)-byte strings with counts, packed by
bucket; a bucket sums them over all blocks, grows the context trees below the two
nearest bytes, which lie whole in one bucket, and answers each block's rows in their
order, so that codes need not come back.  The two upper levels have 256 x 255 nodes at
most and are the only part that is broadcast.  So a task holds one block or one bucket,
and what is shuffled follows the distinct strings of the blocks.

Defined cases: null and empty texts hold the end alone; rows with a null id train;
equal rows count each; with no training text all estimates are those of empty counts;
further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import query, table, written
from kiln.llm.words import WHITE, Words, mix

DEPTH = 5
BLOCK_BYTES = 16 << 20
PACK_BYTES = 16 << 20        # of texts that a task gathers before it packs them by block
END = 0xFF                                    # no byte of UTF-8
END_WORD = np.uint64(0x9FB21C651E98DF25)
WORDS, STRINGS, TEXTS = 0, 1, 2
LOG_HALF = float(np.log(0.5))


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for positive numbers (Stirling's series above 8)."""
    x = np.asarray(x, float)
    low, y = np.zeros_like(x), x.copy()
    for _ in range(8):
        small = y < 8
        low[small] += np.log(y[small])
        y[small] += 1
    z = 1 / (y * y)
    series = (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z * (1 / 1680 - z / 1188)))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - low


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1) - np.log(np.pi)


def own_weight(kt: np.ndarray, children: np.ndarray) -> np.ndarray:
    """Posterior weight of a node's own estimate against its children's."""
    return 1 / (1 + np.exp(np.clip(children - kt, -700, 700)))


def folded(data: np.ndarray) -> np.ndarray:
    return data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)


def strings(part, depth: int):
    """For every symbol of a slice's texts: its text, and the nearest byte first, the context and the symbol in one number."""
    sizes, n = np.diff(part.offsets), len(part)
    seq = np.full(len(part.data) + n * (depth + 1), END, np.uint8)
    base = part.offsets[:-1] + np.arange(n) * (depth + 1)
    seq[np.arange(len(part.data)) + np.repeat(np.arange(n) * (depth + 1) + depth, sizes)] = folded(part.data)
    real = np.ones(len(seq), bool)
    real[(base[:, None] + np.arange(depth)).ravel()] = False
    code = np.zeros(len(seq) - depth, np.int64)
    for back in range(1, depth + 1):
        code = code << 8 | seq[depth - back: len(seq) - back]
    return np.repeat(np.arange(n), sizes + 1), (code << 8 | seq[depth:])[real[depth:]]


def summed(codes: np.ndarray, counts: np.ndarray):
    """Distinct codes with the sums of their counts."""
    by = np.argsort(codes)
    codes, counts = codes[by], counts[by]
    first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])) if len(codes) else by
    return codes[first], np.add.reduceat(counts, first) if len(codes) else counts


MERGE_AFTER = 8               # slices whose counts wait to be merged


def pack(batches):
    """Rows of one block as a compressed Arrow stream."""
    def packed(held):
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        block = np.asarray(rows.column("block"))
        by = np.argsort(block, kind="stable")
        names, ends = np.unique(block[by], return_index=True)
        rows, streams = rows.select(["doc_id", "held_out", "text"]).take(pa.array(by)), []
        for low, high in zip(ends, np.append(ends[1:], len(by))):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(rows.slice(low, high - low))
            streams.append(sink.getvalue().to_pybytes())
        return pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(streams, pa.binary())], names=["block", "rows"])

    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.nbytes
        if size >= PACK_BYTES:
            yield packed(held)
            held, size = [], 0
    if held:
        yield packed(held)


def unpacked(stream):
    yield from pa.ipc.open_stream(pa.py_buffer(stream.as_buffer()))


class Block:
    """Words and strings of one block's texts."""

    def __init__(self, words: Words, depth: int, buckets: int, keep: bool):
        self.words, self.depth, self.buckets, self.keep = words, depth, buckets, keep
        self.found, self.parts = ([], []), []

    def add(self, rows) -> None:
        train = (~rows.column("held_out").to_numpy(zero_copy_only=False)).astype(np.int64)
        for part in self.words.slices(rows.column("text")):
            learn = train[part.at: part.at + len(part)]
            self.found[WORDS].append(summed(np.append(part.hashes, END_WORD), np.append(learn[part.text_of()], learn.sum())))
            text, code = strings(part, self.depth)
            both = np.sort(code << 1 | learn[text])
            code, learned = both >> 1, both & 1
            first = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
            self.found[STRINGS].append((code[first], np.add.reduceat(learned, first)))
            if len(self.found[WORDS]) > MERGE_AFTER:
                for kind in (WORDS, STRINGS):
                    self.found[kind][:] = [self.merged(kind)]
            if self.keep:
                part.starts = part.ends = None                       # hashes and bytes are enough
                self.parts.append((rows.slice(part.at, len(part)), part))

    def merged(self, kind: int):
        return summed(*(np.concatenate(x) for x in zip(*self.found[kind])))

    def distinct(self, kind: int):
        """Distinct codes by bucket and code, their training counts, and each bucket's end."""
        codes, counts = self.merged(kind)
        key = codes if kind == WORDS else (codes >> (8 * (self.depth - 1))).astype(np.uint64)      # strings by the two nearest bytes
        bucket = (mix(key) % np.uint64(self.buckets)).astype(np.int64)
        by = np.argsort(bucket, kind="stable")
        return codes[by], counts[by], np.searchsorted(bucket[by], np.arange(self.buckets + 1))


def requests(buckets: int, depth: int):
    """Packed distinct words and strings of each block with their training counts.  A block's rows follow each other."""
    def asked(name, block):
        for kind in (WORDS, STRINGS):
            codes, counts, ends = block.distinct(kind)
            codes, some = codes.view(np.int64), np.flatnonzero(np.diff(ends))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(some), name), pa.int32()), pa.array(np.full(len(some), kind), pa.int32()), pa.array(some, pa.int32()),
                 pa.array([narrow(codes[ends[i]: ends[i + 1]], kind) for i in some], pa.binary()),
                 pa.array([counts[ends[i]: ends[i + 1]].astype(np.uint32).tobytes() for i in some], pa.binary())],
                names=["block", "kind", "bucket", "codes", "counts"])

    def run(batches):
        words, name, block = Words(WHITE), None, None
        for batch in batches:
            for b, stream in zip(batch.column("block").to_pylist(), batch.column("rows")):
                if b != name:
                    if block:
                        yield from asked(name, block)
                    name, block = b, Block(words, depth, buckets, keep=False)
                for rows in unpacked(stream):
                    block.add(rows)
        if block:
            yield from asked(name, block)
    return run


STRING_BYTES = 6


def narrow(codes: np.ndarray, kind: int) -> bytes:
    """Codes as bytes; strings of 6 bytes at most take no more."""
    return codes.tobytes() if kind == WORDS else np.ascontiguousarray(codes[:, None].view(np.uint8)[:, :STRING_BYTES]).tobytes()


def widened(raw, kind: int) -> np.ndarray:
    if kind == WORDS:
        return np.frombuffer(raw, np.int64)
    raw = np.frombuffer(raw, np.uint8).reshape(-1, STRING_BYTES)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :STRING_BYTES] = raw
    return out.view(np.int64)[:, 0]


def gathered(batches, kind: int):
    """A task's rows: (block, bucket) of each, the distinct codes, each code's place there, training counts and each row's end."""
    rows, codes, counts = [], [], []
    for batch in batches:
        rows += zip(batch.column("block").to_pylist(), batch.column("bucket").to_pylist())
        codes += [widened(x.as_buffer(), kind) for x in batch.column("codes")]
        counts += [np.frombuffer(x.as_buffer(), np.uint32) for x in batch.column("counts")]
    if not rows:
        return None
    names, place = np.unique(np.concatenate(codes), return_inverse=True)
    return rows, names, place, np.bincount(place, np.concatenate(counts), len(names)), np.cumsum([len(c) for c in codes])


def answers(rows, place, ends, kind, values):
    """The values of each row's codes, in their order."""
    return pa.RecordBatch.from_arrays(
        [pa.array([x[0] for x in rows], pa.int32()), pa.array([kind] * len(rows), pa.int32()), pa.array([x[1] for x in rows], pa.int32()),
         pa.array([values[place[a:b]].tobytes() for a, b in zip(np.append(0, ends[:-1]), ends)], pa.binary())], names=["block", "kind", "bucket", "values"])


def word_answers(batches):
    """The training counts of each row's words; under block -1 the task's tokens and distinct words."""
    found = gathered(batches, WORDS)
    if found:
        rows, names, place, counts, ends = found
        yield answers(rows, place, ends, WORDS, counts.astype(np.int64))
        yield answers([(-1, -1)], np.arange(2), np.array([2]), WORDS, np.array([int(counts.sum()), int((counts > 0).sum())]))


class Trees:
    """The context trees of a bucket below the two nearest bytes, one for each place of a byte's decisions."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, depth: int):
        self.depth, symbol = depth, codes & 255
        self.bits = [(symbol >> (7 - k)) & 1 for k in range(8)]
        self.places = [1 << k | symbol >> (8 - k) for k in range(8)]
        self.levels = {}
        below = None
        for d in range(depth, 1, -1):
            context = codes >> (8 * (depth - d + 1))
            keys = np.concatenate([context << 8 | p for p in self.places])
            names, at = np.unique(keys, return_inverse=True)
            each, bit = np.tile(counts, 8), np.concatenate(self.bits)
            ones = np.bincount(at, each * bit, len(names))
            zeros = np.bincount(at, each, len(names)) - ones
            kt = log_kt(zeros, ones)
            if below is None:
                weight, total = np.ones(len(names)), kt
            else:
                children = np.bincount(np.searchsorted(names, below[0] >> 16 << 8 | below[0] & 255), below[1], len(names))
                weight, total = own_weight(kt, children), np.logaddexp(kt, children) + LOG_HALF
            self.levels[d] = (at.reshape(8, -1), weight, (ones + 0.5) / (zeros + ones + 1))
            below = (names, total)
            self.top = (names, zeros, ones, total)

    def log10(self, codes: np.ndarray, own: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """Log10 probability of each string's last byte.  ``own`` and ``rest``: the upper levels' part of
        the probability of a 1, and the weight of what lies below, by nearest byte and place."""
        nearest, out = codes >> (8 * self.depth), np.zeros(len(codes))
        for k in range(8):
            one = None
            for d in range(self.depth, 1, -1):
                at, weight, estimate = self.levels[d]
                w, e = weight[at[k]], estimate[at[k]]
                one = e if one is None else w * e + (1 - w) * one
            one = own[nearest, self.places[k]] + rest[nearest, self.places[k]] * one
            out += np.log10(np.where(self.bits[k] == 1, one, 1 - one))
        return out


def upper_nodes(depth: int):
    """Sums over a bucket's second-level nodes by nearest byte and place: counts and weighted log probability."""
    def run(batches):
        found = gathered(batches, STRINGS)
        if found:
            _, names, _, counts, _ = found
            keys, zeros, ones, total = Trees(names, counts, depth).top
            key, at = np.unique(keys >> 16 << 8 | keys & 255, return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array(key >> 8, pa.int32()), pa.array(key & 255, pa.int32()), *(pa.array(np.bincount(at, x, len(key))) for x in (zeros, ones, total))],
                                             names=["nearest", "place", "zeros", "ones", "below"])
    return run


def upper_levels(nodes):
    """``own`` and ``rest`` of Trees.log10 from the sums of upper_nodes."""
    zeros, ones, below = np.zeros((3, 256, 256))
    at = nodes["nearest"].to_numpy(), nodes["place"].to_numpy()
    for x, name in ((zeros, "zeros"), (ones, "ones"), (below, "below")):
        x[at] = nodes[name].to_numpy()
    kt = log_kt(zeros, ones)
    weight, total = own_weight(kt, below), np.logaddexp(kt, below) + LOG_HALF
    total[(zeros + ones) == 0] = 0.0                            # no node, no code length
    root = own_weight(log_kt(zeros.sum(axis=0), ones.sum(axis=0)), total.sum(axis=0))
    first = (ones.sum(axis=0) + 0.5) / (zeros.sum(axis=0) + ones.sum(axis=0) + 1)
    return root * first + (1 - root) * weight * (ones + 0.5) / (zeros + ones + 1), (1 - root) * (1 - weight)


def string_answers(depth: int, own: np.ndarray, rest: np.ndarray):
    def run(batches):
        found = gathered(batches, STRINGS)
        if found:
            rows, names, place, counts, ends = found
            yield answers(rows, place, ends, STRINGS, Trees(names, counts, depth).log10(names, own, rest))
    return run


def scores(tokens: int, types: int, depth: int, buckets: int):
    """Scores of a block's texts.  The answers that the block has got come first, by kind and bucket."""
    def scored(block, values):
        known = []
        for kind, wide in ((WORDS, np.int64), (STRINGS, np.float64)):
            codes = block.distinct(kind)[0].view(np.int64)
            answer = np.concatenate([np.frombuffer(x, wide) for x in values[kind]])
            by = np.argsort(codes)
            known.append((codes[by], answer[by]))
        for rows, part in block.parts:
            n = len(part)
            text = np.append(part.text_of(), np.arange(n))
            names, at = np.unique(np.append(part.hashes, np.full(n, END_WORD)).view(np.int64), return_inverse=True)
            count = known[WORDS][1][np.searchsorted(known[WORDS][0], names)]
            base = np.bincount(text, np.log10((count + 0.5) / (tokens + 0.5 * (types + 1)))[at], n)
            seen = np.bincount(text, (count > 0)[at], n)
            of, code = strings(part, depth)
            shift = max(1, n.bit_length())
            both = np.sort(code.astype(np.uint64) << np.uint64(shift) | of.astype(np.uint64))
            code, of = (both >> np.uint64(shift)).astype(np.int64), (both & np.uint64((1 << shift) - 1)).astype(np.int64)
            new = np.append(True, code[1:] != code[:-1])
            value = known[STRINGS][1][np.searchsorted(known[STRINGS][0], code[new])]
            total = np.bincount(of, value[np.cumsum(new) - 1], n)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("held_out"), pa.array(part.counts + 1, pa.int64()), pa.array(seen.astype(np.int64)),
                 pa.array(np.full(n, tokens), pa.int64()), pa.array(base), pa.array(total), pa.array(-total * np.log2(10) / (np.diff(part.offsets) + 1))],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"])

    def run(batches):
        words, name, block, values = Words(WHITE), None, None, None
        for batch in batches:
            for b, kind, value, stream in zip(*(batch.column(x) for x in ("block", "kind", "values", "rows"))):
                if b.as_py() != name:
                    if block:
                        yield from scored(block, values)
                    name, block, values = b.as_py(), Block(words, depth, buckets, keep=True), ([], [])
                if kind.as_py() == TEXTS:
                    for rows in unpacked(stream):
                        block.add(rows)
                else:
                    values[kind.as_py()].append(value.as_py())
        if block:
            yield from scored(block, values)
    return run


def score(docs: DataFrame, held_out, depth: int = DEPTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document row: doc_id, held_out (as the given column says; else it trains), n_tokens,
    n_known, train_tokens, base_score, score (log10 probability of the text), bits_per_byte."""
    if not 2 <= depth <= 5:
        raise ValueError("depth is 2 to 5: a string and a text's number share 64 bits")
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    total = docs.agg(F.sum(F.octet_length(text) + 1)).first()[0] or 0
    blocks = -(-total // block_bytes) or 1
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = (docs.select("doc_id", held_out.alias("held_out"), text.alias("text"), F.pmod(F.xxhash64("doc_id", text), F.lit(blocks)).cast("int").alias("block"))
              .mapInArrow(pack, "block int, rows binary"))
    asked = written(packed.repartition("block").sortWithinPartitions("block").mapInArrow(requests(buckets, depth), "block int, kind int, bucket int, codes binary, counts binary"), "requests")
    schema = "block int, kind int, bucket int, values binary"
    of_words = written(asked.filter(F.col("kind") == WORDS).repartition("bucket").mapInArrow(word_answers, schema), "words")
    sums = [np.frombuffer(r["values"], np.int64) for r in of_words.filter("block < 0").select("values").collect()]                  # a row a task
    tokens, types = (sum(int(x[i]) for x in sums) for i in (0, 1))
    of_strings = asked.filter(F.col("kind") == STRINGS).repartition("bucket")
    nodes = (of_strings.mapInArrow(upper_nodes(depth), "nearest int, place int, zeros double, ones double, below double")
             .groupBy("nearest", "place").agg(*(F.sum(x).alias(x) for x in ("zeros", "ones", "below")))).toPandas()              # 256 x 255 rows at most
    strings_known = of_strings.mapInArrow(string_answers(depth, *upper_levels(nodes)), schema)
    none = F.lit(None).cast("binary")
    rows = (of_words.filter("block >= 0").unionAll(strings_known).withColumn("rows", none)
            .unionAll(packed.select("block", F.lit(TEXTS), F.lit(0), none, "rows")))
    return (rows.repartition("block").sortWithinPartitions("block", "kind", "bucket")
            .mapInArrow(scores(tokens, types, depth, buckets), "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, bits_per_byte double"))


@query("op5_context_tree")
def op5(spark, sf_dir):
    return score(table(spark, sf_dir, "documents"), F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 1, F.lit(False)))
