"""Token ids in seekable zstandard shards.

A shard is a sequence of independent zstandard frames, one for each document (its
ids as little-endian unsigned 32-bit integers, the end id last), then a skippable
frame with the document ids, then the seek table in the layout of the zstandard
seekable format: compressed size, size and checksum (the low half of XXH64) of
each frame.  Any zstandard reader can unpack a shard; :class:`Shard` reads only
the frames of the documents asked for and checks each against its checksum.

``write_tokens`` deals documents to shards by ranges of the order (the id, unless
told otherwise) and writes each shard as a stream; a task writes under a name of
its own and renames, so a lost or repeated task leaves one whole shard.  Text is
encoded by the tokenizers library, piece by piece: pieces end where the byte-level
pre-tokenizer always ends a token, and a worker remembers ``REMEMBERED`` of them.

Defined cases: null and empty texts hold the end id alone; a null document id is
kept and sorts first; rows that repeat an id are documents of their own; an empty
table gives no shard; a document of 4 GiB of ids or more raises.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from itertools import islice
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import query, shared_folder, table, worker_state
from kiln.llm.words import give_back

END_ID = 2
LEVEL = 3
REMEMBERED = 300_000
IDS_MAGIC, TABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5D, 0x184D2A5E, 0x8F92EAB1
CHECKSUMS = 0x80
ENTRY_BYTES, FOOTER = 12, "<IBI"
READ_BYTES = 8 << 20
LONG_TEXT = 4 << 20

SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LETTER, MARK = "A-Za-zÀ-ÖØ-öø-ÿ", re.escape(".,!?;:*%&$#")
#: Words, marks after a word, single line ends; else white space and what follows, up to the next white space.
PIECE = re.compile(rf" ?[{LETTER}]++(?=[ \n{MARK}])|[{MARK}]++(?=[ \n])|\n(?=[{LETTER}])|[{SPACE}]*+[^{SPACE}]++|[{SPACE}]++")
SPACED_WORD = re.compile(rf" [{LETTER}]+").fullmatch
#: Pieces that no token leaves where a line end comes before and after; longer ones need no run.
LINE = re.compile(rf" ?[^{SPACE}]{{1,255}}").fullmatch
RUN = 1000


class Encoder:
    """Texts to packed ids with a tokenizer of the byte-level kind without normalizer or added prefix space."""

    def __init__(self, tokenizer: str, end_id: int):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")              # Spark's tasks already fill the cores
        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.end = struct.pack("<I", end_id)
        self.known: dict[str, bytes] = {}
        self.sizes = np.zeros(self.tokenizer.get_vocab_size(), np.int64)      # bytes of each token
        for token, i in self.tokenizer.get_vocab().items():
            self.sizes[i] = len(token)

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, np.uint32) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encoded(self, pieces: list[str]) -> dict[str, bytes]:
        """Packed ids of pieces, which are encoded in runs: words with a leading space as they are, as a
        token never crosses from one to the next, others a line each; white space and long pieces alone."""
        words, lines, others = [], [], []
        for p in pieces:
            (words if SPACED_WORD(p) else lines if LINE(p) else others).append(p)
        out: dict[str, bytes] = {}
        for some, apart in ((words, ""), (lines, "\n")):
            runs = [some[at: at + RUN] for at in range(0, len(some), RUN)]
            for run, ids in zip(runs, self.ids([apart + apart.join(r) for r in runs])):
                if not self.told_apart(run, len(apart), ids, out):
                    others += run
        out.update(zip(others, (ids.tobytes() for ids in self.ids(others))))
        return out

    def told_apart(self, run: list[str], gap: int, ids: np.ndarray, out: dict[str, bytes]) -> bool:
        """Adds each piece's ids by the sizes of the tokens; false if tokens do not end where pieces do."""
        sums = np.concatenate([[0], np.cumsum(self.sizes[ids])])
        stops = np.cumsum([len(p.encode()) + gap for p in run])
        begins = np.concatenate([[0], stops[:-1]]) + gap
        starts, ends = np.searchsorted(sums, begins), np.searchsorted(sums, stops)
        if sums[-1] != stops[-1] or (sums[starts] != begins).any() or (sums[ends] != stops).any():
            return False
        packed = ids.tobytes()
        out.update((p, packed[start:end]) for p, start, end in zip(run, (4 * starts).tolist(), (4 * ends).tolist()))
        return True

    def join(self, texts) -> list[bytes]:
        """Packed ids of texts that are cut to pieces; new pieces are remembered while there is room.
        A text's pieces are looked up as they come, while they are in the core's cache; only new ones are kept."""
        known, out, gaps = self.known, [], []
        for pieces in texts:
            ids = list(map(known.get, pieces))
            if None in ids:
                at = [i for i, x in enumerate(ids) if x is None]
                gaps.append((len(out), at, [pieces[i] for i in at]))
                out.append(ids)
            else:
                out.append(b"".join(ids))
        new = self.encoded(list({p for _n, _at, missing in gaps for p in missing}))
        for n, at, missing in gaps:
            ids = out[n]
            for i, piece in zip(at, missing):
                ids[i] = new[piece]
            out[n] = b"".join(ids)
        known.update(islice(new.items(), max(0, REMEMBERED - len(known))))
        return out

    def packed(self, texts: list) -> list[bytes]:
        return [ids + self.end for ids in self.join(PIECE.findall(t or "") for t in texts)]

    def long(self, text: str):
        """Packed ids of a long text, in parts."""
        found = PIECE.finditer(text)
        while pieces := [m[0] for m in islice(found, 200_000)]:
            yield from self.join([pieces])
        yield self.end


def filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub("^file:/+", "/", uri))


class ShardWriter:
    def __init__(self, out):
        import xxhash
        import zstandard

        self.out, self.hash, self.zstd = out, xxhash.xxh64, zstandard.ZstdCompressor(level=LEVEL)
        self.entries, self.ids, self.tokens = [], [], 0

    def add(self, doc_id, parts) -> None:
        """One document, its packed ids in one or several parts."""
        digest, packer, size, packed = self.hash(), self.zstd.compressobj(), 0, 0
        for part in parts:
            digest.update(part)
            size += len(part)
            packed += self.out.write(packer.compress(part))
        packed += self.out.write(packer.flush())
        self.entries.append((packed, size, digest.intdigest() & 0xFFFFFFFF))
        self.ids.append(doc_id)
        self.tokens += size // 4

    def close(self) -> None:
        ids = np.array([i or 0 for i in self.ids], "<i8").tobytes() + np.packbits([i is None for i in self.ids]).tobytes()
        self.out.write(struct.pack("<II", IDS_MAGIC, len(ids)) + ids)
        self.entries.append((8 + len(ids), 0, self.hash(b"").intdigest() & 0xFFFFFFFF))
        body = np.array(self.entries, "<u4").tobytes() + struct.pack(FOOTER, len(self.entries), CHECKSUMS, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", TABLE_MAGIC, len(body)) + body)


class Shard:
    """Reads a shard's seek table and document ids, and the frames that are asked for."""

    def __init__(self, uri: str):
        import xxhash
        import zstandard

        self.hash, self.zstd = xxhash.xxh64_intdigest, zstandard.ZstdDecompressor()
        files, path = filesystem(uri)
        self.file = files.open_input_file(path)
        size = self.file.size()
        n, flags, magic = struct.unpack(FOOTER, self.file.read_at(9, size - 9))
        if (flags, magic) != (CHECKSUMS, SEEKABLE_MAGIC):
            raise ValueError(f"{uri} has no seek table")
        rows = np.frombuffer(self.file.read_at(n * ENTRY_BYTES, size - 9 - n * ENTRY_BYTES), "<u4").reshape(n, 3)
        self.sizes, self.checksums = rows[:-1, 1].astype(np.int64), rows[:-1, 2]
        self.starts = np.concatenate([[0], np.cumsum(rows[:, 0], dtype=np.int64)])
        held = self.file.read_at(int(rows[-1, 0]) - 8, int(self.starts[-2]) + 8)
        nulls = np.unpackbits(np.frombuffer(held[8 * (n - 1):], np.uint8))[: n - 1]
        self.ids = [None if z else i for i, z in zip(np.frombuffer(held[: 8 * (n - 1)], "<i8").tolist(), nulls)]

    def unpack(self, i: int, frame: bytes) -> bytes:
        ids = self.zstd.decompress(frame, max_output_size=int(self.sizes[i]))
        if len(ids) != self.sizes[i] or self.hash(ids) & 0xFFFFFFFF != self.checksums[i]:
            raise ValueError(f"frame {i} is damaged")
        return ids

    def read(self, i: int) -> bytes:
        """Packed ids of the i-th document."""
        return self.unpack(i, self.file.read_at(int(self.starts[i + 1] - self.starts[i]), int(self.starts[i])))

    def documents(self):
        """(document id, packed ids) of all, read in runs of about READ_BYTES."""
        i, n = 0, len(self.ids)
        while i < n:
            to = max(i + 1, min(n, int(np.searchsorted(self.starts, self.starts[i] + READ_BYTES, side="right")) - 1))
            raw = self.file.read_at(int(self.starts[to] - self.starts[i]), int(self.starts[i]))
            for j in range(i, to):
                yield self.ids[j], self.unpack(j, raw[self.starts[j] - self.starts[i]: self.starts[j + 1] - self.starts[i]])
            i = to


def shards(folder: str, tokenizer: str, end_id: int):
    """Writes a task's documents, which come in order, as one shard; gives the shard's line of the manifest."""
    def run(batches):
        from pyspark import TaskContext

        task, state, writer = TaskContext.get(), worker_state(), None
        key = (hash(tokenizer), end_id)
        if state.get("encoder_key") != key:
            state.update(encoder=Encoder(tokenizer, end_id), encoder_key=key)
        encoder = state["encoder"]
        files, base = filesystem(folder)
        name = f"shard-{task.partitionId():06d}.zst"
        own = f"{base}/_{name}-{task.taskAttemptId()}"
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                ids, texts = (batch.column(c).slice(at, 500).to_pylist() for c in ("doc_id", "text"))
                if writer is None:
                    writer = ShardWriter(files.open_output_stream(own))
                short = [t if t is None or len(t) < LONG_TEXT else "" for t in texts]
                for doc_id, text, packed in zip(ids, texts, encoder.packed(short)):
                    writer.add(doc_id, (packed,) if text is None or len(text) < LONG_TEXT else encoder.long(text))
        give_back()
        if writer is not None:
            writer.close()
            size = writer.out.tell()
            writer.out.close()
            if files.get_file_info(f"{base}/{name}").type.name == "NotFound" or files.type_name in ("local", "subtree"):
                files.move(own, f"{base}/{name}")                     # the same bytes whichever attempt wrote them
            else:
                files.delete_file(own)
            yield pa.RecordBatch.from_pydict({"shard": [task.partitionId()], "name": [name], "docs": [len(writer.ids)], "tokens": [writer.tokens], "bytes": [size]},
                                             pa.schema([("shard", pa.int32()), ("name", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64()), ("bytes", pa.int64())]))
    return run


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, order: tuple = ("doc_id",), end_id: int = END_ID) -> DataFrame:
    """Write shards and a manifest (shard, name, docs, tokens, bytes, start) to a new folder; returns the manifest.

    ``tokenizer`` is the text of a tokenizer file.  The manifest has a row a shard.
    """
    filesystem(folder)[0].create_dir(filesystem(folder)[1], recursive=True)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), *(F.col(c).alias(f"order{i}") for i, c in enumerate(order)))
    keys = [*(f"order{i}" for i in range(len(order))), "tie"]
    ordered = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
    lines = ordered.mapInArrow(shards(folder, tokenizer, end_id), "shard int, name string, docs bigint, tokens bigint, bytes bigint").toPandas().sort_values("shard")
    lines["start"] = lines["tokens"].cumsum() - lines["tokens"]
    schema = "shard int, name string, docs bigint, tokens bigint, bytes bigint, start bigint"
    manifest = docs.sparkSession.createDataFrame(list(lines.itertuples(index=False, name=None)), schema)
    manifest.coalesce(1).write.parquet(f"{folder}/manifest")
    return manifest


def digests(folder: str):
    def run(batches):
        worker_state().clear()                     # the encoder: all shards are written
        give_back()
        for batch in batches:
            for name, start in zip(batch.column("name").to_pylist(), batch.column("start").to_pylist()):
                ids, counts, sums = [], [], []
                for doc_id, packed in Shard(f"{folder}/{name}").documents():
                    ids.append(doc_id)
                    counts.append(len(packed) // 4)
                    sums.append(zlib.crc32(packed))
                counts = np.array(counts, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(start + np.cumsum(counts) - counts), pa.array(counts), pa.array(sums, pa.int64())],
                                                 names=["doc_id", "start", "n_tokens", "ids_crc32"])
    return run


def read_digests(folder: str, manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read from the shards."""
    n = max(1, manifest.count())
    return (manifest.select("name", "start", "shard").repartitionByRange(n, "shard").select("name", "start")
            .mapInArrow(digests(folder), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"))


def tokenize(docs: DataFrame, order: tuple = ("doc_id",)) -> DataFrame:
    """Write all documents with the byte_bpe_50k tokenizer and give what the files hold."""
    import public_tokenizers

    folder = shared_folder(docs.sparkSession, "tokens")
    manifest = write_tokens(docs, folder, Path(public_tokenizers.path("byte_bpe_50k.json")).read_text(encoding="utf-8"), order)
    return read_digests(folder, manifest)


@query("op1_token_ids")
def op1(spark, sf_dir):
    return tokenize(table(spark, sf_dir, "documents"))
