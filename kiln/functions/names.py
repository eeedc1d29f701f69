"""Column-name helpers (PRJ-02/03/04/08)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from kiln.functions.stats import qcol

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)
INTEGRAL_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def semantic_type(dt: T.DataType) -> str:
    """Numeric / Boolean / DateTime / Text / Unsupported."""
    if isinstance(dt, NUMERIC_TYPES):
        return "Numeric"
    if isinstance(dt, T.BooleanType):
        return "Boolean"
    if isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "DateTime"
    if isinstance(dt, (T.StringType, T.VarcharType, T.CharType)):
        return "Text"
    return "Unsupported"


def select_types(df: DataFrame, kinds=("Numeric",)) -> list[str]:
    """Column names whose semantic type is in ``kinds`` (booleans excluded from Numeric)."""
    return [f.name for f in df.schema.fields if semantic_type(f.dataType) in kinds]


def strip_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def resolve_column(df: DataFrame, name: str) -> str:
    """Case-insensitive lookup; the error lists the available columns."""
    for c in df.columns:
        if c.lower() == name.lower():
            return c
    raise ValueError(f"column {name!r} not found in {df.columns}")


_CAMEL = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")


def name_tokens(name: str) -> list[str]:
    out = []
    for part in re.split(r"[^0-9A-Za-z]+", name):
        out.extend(t.lower() for t in _CAMEL.findall(part))
    return out


def columns_like(df_or_cols, token: str, loose: bool = False) -> list[str]:
    """Columns whose name has ``token`` as a word (``loose``: as a substring)."""
    cols = df_or_cols.columns if isinstance(df_or_cols, DataFrame) else list(df_or_cols)
    t = token.lower()
    if loose:
        return [c for c in cols if t in c.lower()]
    return [c for c in cols if t in name_tokens(c)]


def drop_columns(df: DataFrame, cols) -> DataFrame:
    """Drop listed columns; absent names are ignored."""
    present = [c for c in cols if c in df.columns]
    return df.drop(*present) if present else df


def align_schema(df: DataFrame, cols, fill=0) -> DataFrame:
    """Exactly ``cols`` in that order; absent ones become a literal ``fill``."""
    from pyspark.sql import functions as F
    return df.select(*[qcol(c) if c in df.columns else F.lit(fill).alias(c) for c in cols])


def as_entity(df: DataFrame, key: str | None) -> DataFrame:
    """Drop the CSV index artefact and put the key, found under any case, first; Spark rows have no index."""
    out = drop_columns(df, ["Unnamed: 0"])
    if key is None:
        return out
    name = resolve_column(out, key)
    return out.select(qcol(name), *[qcol(c) for c in out.columns if c != name])
