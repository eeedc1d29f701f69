"""Row-level integrity: keep-first dedup, conflicting labels, complete rows.

WIN-07 keep-first dedup is written as ``groupBy(signal).agg(min(struct(order,
row)))`` instead of ``row_number()`` over a window: the aggregate combines
map-side, so a signal group holding a third of all rows is reduced inside each
task and never sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.functions.stats import qcol


def dedup_signal(df: DataFrame, id_cols=(), order_by=None) -> DataFrame:
    """Drop rows whose signal columns (all but ``id_cols``) repeat an earlier
    row; "earlier" = smallest ``order_by`` (then smallest id values).  Nulls
    compare equal, as in the reference."""
    ids = [c for c in id_cols if c in df.columns]
    order = list(order_by) if isinstance(order_by, (list, tuple)) else ([order_by] if order_by else [])
    signal = [c for c in df.columns if c not in set(ids)]
    carry = order + [c for c in ids if c not in order]
    if not carry:  # nothing distinguishes duplicates: plain distinct
        return df.dropDuplicates(signal)
    first = F.min(F.struct(*[qcol(c).alias(f"__k{i}") for i, c in enumerate(carry)])).alias("__first")
    out = df.groupBy(*[qcol(c).alias(c) for c in signal]).agg(first)
    return out.select(*[qcol(c) if c in signal else F.col(f"__first.__k{carry.index(c)}").alias(c)
                        for c in df.columns])


def drop_conflicting_labels(df: DataFrame, target: str, keys=None) -> DataFrame:
    """JOIN-01: drop every row whose feature tuple maps to more than one label.

    Conflicting tuples: ``groupBy(keys)`` with ``min(target) <> max(target)``
    (partial aggregate).  They are removed with a left-anti join on plain
    equality, so a tuple with a null never matches and always survives (the
    reference's groupby drops null keys).  Spark picks the join by the key set's
    size; AQE splits hot keys of a shuffle join.
    """
    keys = list(keys) if keys else [c for c in df.columns if c != target]
    bad = (df.groupBy(*[qcol(k).alias(k) for k in keys])
           .agg(F.min(qcol(target)).alias("__lo"), F.max(qcol(target)).alias("__hi"))
           .where(F.col("__lo") != F.col("__hi")).select(*[qcol(k).alias(f"__b{i}") for i, k in enumerate(keys)]))
    cond = [qcol(k) == F.col(f"__b{i}") for i, k in enumerate(keys)]
    return df.join(bad, cond, "left_anti")


def complete_rows(df: DataFrame, cols=None) -> DataFrame:
    """FLT-01: drop rows with a null in any listed (default: numeric) column."""
    return df.dropna("any", subset=list(cols) if cols else None)
