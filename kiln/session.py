"""Session helpers: building a session for tests/bench and cutting lineage.

Everything in the library takes the caller's ``SparkSession``; these helpers
only fill in settings that are unset, never override what a cluster set.
"""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on.  Applied with ``setdefault`` semantics.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", app: str = "kiln",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench (the driver/cluster brings its own)."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "16g"))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_defaults(spark: SparkSession) -> None:
    """Apply DEFAULT_CONF for keys the session has not set."""
    for k, v in DEFAULT_CONF.items():
        try:
            if spark.conf.get(k, None) is None:
                spark.conf.set(k, v)
        except Exception:  # static confs cannot be set at runtime
            pass


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Resolve the reliable checkpoint folder.

    Order: an already-set SparkContext checkpoint dir; the shared folder named
    by ``spark.checkpoint.dir``; and only for a local master (tests) a fresh
    scratch folder.  On a cluster without ``spark.checkpoint.dir`` we refuse
    rather than write to a machine-local folder.
    """
    sc = spark.sparkContext
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if shared:
        sc.setCheckpointDir(shared)
        return shared
    if sc.master.startswith("local"):
        path = tempfile.mkdtemp(prefix="kiln-ckpt-", dir=os.environ.get("KILN_SCRATCH", "/tmp"))
        sc.setCheckpointDir(path)
        return path
    raise RuntimeError("set spark.checkpoint.dir to a shared folder before running iterative operators")


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: cuts lineage and survives executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


CACHE_INPUTS = "spark.kiln.cacheInputs"


def reads_cache(df: DataFrame) -> bool:
    """True when the plan already reads cached data (nested multi-pass use)."""
    if df.storageLevel.useMemory or df.storageLevel.useDisk:
        return True
    try:
        return "InMemoryRelation" in df._jdf.queryExecution().withCachedData().toString()
    except Exception:  # noqa: BLE001
        return False


@contextmanager
def held(df: DataFrame):
    """``df`` cached (memory, then disk) for the passes of the block unless the caller cached it; later uses compute it again."""
    from pyspark import StorageLevel
    level = df.storageLevel
    mine = not (level.useMemory or level.useDisk)
    if mine:
        df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        if mine:
            df.unpersist()


class PassInput:
    """Input for operators that scan the same rows several times (profile,
    quantile refinement, Yeo-Johnson search, cleaning fits).

    By default each pass re-scans the source with column pruning and nothing is
    pinned.  A caller who knows that the input fits sets ``spark.kiln.cacheInputs``
    to true: the input is then spread over the cores and cached for the passes.
    Use as a context manager; the cache is released on exit.
    """

    def __init__(self, df: DataFrame):
        self.src = df
        self._cached = None

    def __enter__(self) -> DataFrame:
        spark = self.src.sparkSession
        if self.src.isStreaming or spark.conf.get(CACHE_INPUTS, "false").lower() != "true" or reads_cache(self.src):
            return self.src
        from pyspark import StorageLevel
        self._cached = self.src.repartition(spark.sparkContext.defaultParallelism).persist(StorageLevel.MEMORY_AND_DISK)
        return self._cached

    def __exit__(self, *exc):
        if self._cached is not None:
            self._cached.unpersist()
        return False
