"""Corpus pipeline: toxicity, near copies, benchmark decontamination, mixing, token files.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame that is written as
Parquet and read again as the next stage's docs.  All but the last keep the columns
of ``docs``, by value and whatever their names; rows are decided by their own id and
text, so extra columns, null or repeated ids and empty texts pass through.  A row
without an id takes part in the near-copy stage under a number made from its text.

The mixing stage's decision is the order of the rows in its files; the last stage
writes tokens in the order of the files that it reads (or by id, if its rows don't
come from files).

Texts go to Python workers ``BATCH_ROWS`` rows at a time, unless the session says
otherwise: a batch lies in the JVM's and in the worker's memory at once.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.llm.common import sized, shared_folder, table, text_hash
from kiln.llm.decontaminate import decontaminate
from kiln.llm.jaccard import jaccard_components
from kiln.llm.mixing import mix
from kiln.llm.tokens import tokenize
from kiln.llm.toxicity import toxicity

BATCH_ROWS = 1000
ROWS_SETTING, SPARKS_OWN = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def small_batches(spark: SparkSession) -> None:
    """Fewer rows a batch for this session's Python workers, where nobody chose a number."""
    if spark.conf.get(ROWS_SETTING) == SPARKS_OWN:
        spark.conf.set(ROWS_SETTING, str(BATCH_ROWS))


def free_name(docs: DataFrame, name: str) -> str:
    """A column name that the table lacks."""
    held = {c.lower() for c in docs.columns}
    while name in held:
        name += "_"
    return name


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go."""
    small_batches(spark)
    score = free_name(docs, "toxicity")
    scored = toxicity(docs, table(spark, sf_dir, "labels"), column=score)
    return scored.filter(F.col(score) < 0.5).select(docs.columns)


def near_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the first stays, by id (rows without one last) and text hash; of equal rows one."""
    small_batches(spark)
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(1 << 62) + F.shiftrightunsigned(text_hash(), 3))
    rows = docs.select(key.alias("doc_id"), text_hash().alias("text_hash"), F.struct(*docs.columns).alias("row"))
    judged = jaccard_components(docs.select(key.alias("doc_id"), "text"))
    keys = ["doc_id", "text_hash"]
    gone = sized(judged.filter(~F.col("first")).select(keys).distinct())
    several = sized(judged.filter(F.col("first") & (F.col("n_shingles") > 0)).groupBy(keys).count().filter("count > 1").select(keys))
    left = rows.join(gone, keys, "left_anti")
    repeated = left.join(several, keys, "left_semi").dropDuplicates(keys)
    return left.join(several, keys, "left_anti").unionByName(repeated).select("row.*")


def benchmark_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    small_batches(spark)
    key = free_name(docs, "text_hash")
    gone = sized(decontaminate(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark")).filter("contaminated").select(F.col("text_hash").alias(key)).distinct())
    return docs.withColumn(key, text_hash()).join(gone, key, "left_anti").select(docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order in which sources interleave to their target weights."""
    packed = docs.select("doc_id", "source", F.struct(*docs.columns).alias("row"))
    return mix(packed).orderBy("position").select("row.*")


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards in the order of the rows' files; what the shards hold."""
    small_batches(spark)
    try:
        docs = docs.select("doc_id", "text", "_metadata.file_path", "_metadata.row_index")
    except AnalysisException:                     # not read from files, so there is no such order
        return tokenize(docs)
    return tokenize(docs, ("file_path", "row_index"))


STAGES = [("toxicity", toxic_out), ("near_copies", near_copies_out), ("decontaminate", benchmark_out), ("mix", mixed), ("token_files", token_files)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = shared_folder(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}-{name}")
        docs = spark.read.parquet(f"{folder}/{i}-{name}")
    return docs
