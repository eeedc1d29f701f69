"""Registry of checkable queries: key -> (Spark callable, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6, per_col: dict | None = None) -> DataFrame:
    """Round every double column (both engines round the same way); ints -> bigint."""
    per_col = per_col or {}
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            out.append(F.round(c.cast("double"), per_col.get(f.name, digits)).alias(f.name))
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            out.append(c.cast("long").alias(f.name))
        else:
            out.append(c)
    return df.select(*out)
