"""Shared helpers: registered queries, written tables, unique row ids."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.session import ensure_checkpoint_dir

QUERIES: dict = {}
ORACLE: dict = {}


def query(key: str, sql: str | None = None):
    def register(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the cluster's shared checkpoint folder, one parent per application."""
    return f"{ensure_checkpoint_dir(spark)}/kiln-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it: cuts lineage, and lost executors cost nothing."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BROADCAST_ROWS = 1_000_000


def sized(keys: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A written table of a few fixed-size keys, to be broadcast if it has ``limit`` rows at most; else joins shuffle it."""
    keys = written(keys, "keys")
    return F.broadcast(keys) if keys.count() <= limit else keys


def text_hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


CHUNK_BITS = 15


def bit_chunks(batches):
    """Packed bits of each chunk of slots; a chunk's rows are in one task."""
    import numpy as np
    import pyarrow as pa

    chunks: dict = {}
    for batch in batches:
        slots = np.asarray(batch.column("slot")).astype(np.int64)
        for chunk in np.unique(slots >> CHUNK_BITS).tolist():
            bits = chunks.setdefault(chunk, np.zeros(1 << CHUNK_BITS, bool))
            bits[slots[slots >> CHUNK_BITS == chunk] & ((1 << CHUNK_BITS) - 1)] = True
    yield pa.RecordBatch.from_pydict({"chunk": list(chunks), "bits": [np.packbits(b, bitorder="little").tobytes() for b in chunks.values()]},
                                     pa.schema([("chunk", pa.int32()), ("bits", pa.binary())]))


def bit_table(hashes: DataFrame, bits: int) -> bytes:
    """A table of 2**bits bits that has the leading bits of the one column's 64-bit hashes; what the driver gets has that size at most."""
    slot = F.shiftrightunsigned(hashes.columns[0], 64 - bits).cast("int")
    rows = hashes.select(slot.alias("slot")).distinct().withColumn("chunk", F.shiftright("slot", CHUNK_BITS)).repartition("chunk").select("slot")
    out = bytearray(1 << (bits - 3))
    for r in rows.mapInArrow(bit_chunks, "chunk int, bits binary").collect():
        out[r["chunk"] << (CHUNK_BITS - 3): (r["chunk"] + 1) << (CHUNK_BITS - 3)] = r["bits"]
    return bytes(out)


def has_bit(table: bytes, bits: int):
    """Which 64-bit hashes a bit table may hold."""
    import numpy as np

    packed = np.frombuffer(table, np.uint8)

    def test(hashes):
        slot = (hashes >> np.uint64(64 - bits)).astype(np.int64)
        return (packed[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)
    return test


def worker_state() -> dict:
    """A dictionary that lives as long as the Python worker, for what tasks would build again."""
    import sys
    import types

    return vars(sys.modules.setdefault("kiln_worker_state", types.ModuleType("kiln_worker_state")))
