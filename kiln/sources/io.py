"""Sources and sinks (SRC-01..03, SNK-01..04).

CSV type inference is done the way a distributed reader should: read every
column as string, turn NA tokens into NULL, then one aggregate counts, per
column, how many non-null values cast cleanly to long / double / boolean /
timestamp; each column gets the narrowest type every value fits.  Parquet is
the native path (schema from the file, pushdown, pruning).
"""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.functions.stats import qcol
from kiln.operators.profile import nan_to_null

# Tokens read as missing (the reference's reader defaults).
NA_VALUES = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
             "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
TYPE_ORDER = ["long", "double", "boolean", "timestamp_ntz"]


def _infer(df: DataFrame) -> DataFrame:
    aggs = []
    for i, c in enumerate(df.columns):
        x = qcol(c)
        aggs.append(F.count(x).alias(f"n{i}"))
        for t in TYPE_ORDER:
            if t == "boolean":      # only the words; Y, N, yes and no are text
                cast = F.when(F.lower(x).isin("true", "false"), True)
            else:
                cast = x.try_cast(t) if t != "timestamp_ntz" else F.try_to_timestamp(x).cast("timestamp_ntz")
            aggs.append(F.count(cast).alias(f"{t}{i}"))
    r = df.agg(*aggs).first()
    out = []
    for i, c in enumerate(df.columns):
        n = r[f"n{i}"]
        chosen = next((t for t in TYPE_ORDER if n > 0 and r[f"{t}{i}"] == n), None)
        if chosen is None:
            out.append(qcol(c))
        elif chosen == "timestamp_ntz":
            out.append(F.try_to_timestamp(qcol(c)).cast("timestamp_ntz").alias(c))
        else:
            out.append(qcol(c).try_cast(chosen).alias(c))
    return df.select(*out)


def read_table(spark: SparkSession, path: str, fmt: str = "csv", encoding: str = "UTF-8",
               na_values=None, schema=None, infer: bool = True, multi_line: bool = True,
               row_id: str | None = None) -> DataFrame:
    """SRC-01: header CSV (latin1 via encoding="ISO-8859-1") or parquet/json/orc.

    ``multi_line`` allows line ends inside quotes; then a file is one task's work.
    Turn it off for large files without such records, which Spark then splits.
    ``row_id`` names a column that gets each record's place in the order of the files."""
    if row_id is not None:
        df = read_table(spark, path, fmt, encoding, na_values, schema, infer, multi_line)
        return df.withColumn(row_id, F.monotonically_increasing_id())
    if fmt != "csv":
        df = spark.read.format(fmt).load(path) if schema is None else spark.read.schema(schema).format(fmt).load(path)
        return nan_to_null(df)
    reader = spark.read.option("header", True).option("encoding", encoding).option("multiLine", multi_line).option("escape", '"')
    if schema is not None:
        return nan_to_null(reader.schema(schema).csv(path))
    raw = reader.option("inferSchema", False).csv(path)
    na = na_values if na_values is not None else NA_VALUES
    raw = raw.select(*[F.when(qcol(c).isin(na), F.lit(None)).otherwise(qcol(c)).alias(c) for c in raw.columns])
    return nan_to_null(_infer(raw)) if infer else raw


def write_layer(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet",
                partition_by=None) -> None:
    """SNK-01/02: write a layer; keys stay ordinary columns."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True).option("escape", '"')
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def save_plan(spark: SparkSession, doc: dict, path: str) -> None:
    """SNK-03: a plan/persona document as one JSON text file."""
    spark.createDataFrame([(json.dumps(doc, indent=2),)], "value string").coalesce(1) \
        .write.mode("overwrite").text(path)


def load_plan(spark: SparkSession, path: str) -> dict:
    """SRC-02: read a JSON plan written by save_plan (or any single JSON document)."""
    text = spark.read.text(path, wholetext=True).first()["value"]
    return json.loads(text)


def save_model(model: PipelineModel, path: str) -> None:
    """SNK-04: Spark ML persistence (fitted kiln steps included)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
