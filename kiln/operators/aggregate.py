"""Group aggregates (AGG-01..05, 09, 11).

All of these are ``groupBy().agg()`` with map-side partial aggregation, so a
key that holds a third of the rows is combined inside each task before the
shuffle; nothing collects a group's rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.functions.stats import qcol, without_nan


def mode_expr(c: str) -> Column:
    """AGG-02: most frequent non-null value, smallest on ties (``mode()[0]``)."""
    return F.mode(qcol(c), deterministic=True)


def entity_aggregate(df: DataFrame, key: str, sum_cols=(), mean_cols=(), mode_cols=(),
                     suffix: bool = False) -> DataFrame:
    """AGG-05: per ``key``: sum / mean / mode of the listed columns.

    Sums and means are one partial aggregate.  Modes use :func:`entity_mode`
    (count per (key, value), then the top value per key -- both partial
    aggregates) rather than Spark's ``mode``, whose per-group value map would
    put all distinct values of a hot key into one task; the per-key results
    are joined on the key (one row per key on every side; null is a key like any
    other).  Null and NaN values are missing.
    """
    df = without_nan(df, [c for c in {*sum_cols, *mean_cols, *mode_cols} if c != key])
    name = (lambda c, s: f"{c}_{s}") if suffix else (lambda c, s: c)
    aggs = ([F.sum(qcol(c)).alias(name(c, "sum")) for c in sum_cols]
            + [F.avg(qcol(c)).alias(name(c, "mean")) for c in mean_cols])
    keys = df.select(qcol(key).alias(key)).distinct() if not aggs else None
    out = df.groupBy(qcol(key).alias(key)).agg(*aggs) if aggs else keys
    for c in mode_cols:
        found = entity_mode(df, key, c, "__m").withColumnRenamed(key, "__k")
        out = out.join(found, qcol(key).eqNullSafe(F.col("__k")), "left").withColumn(name(c, "mode"), F.col("__m")).drop("__k", "__m")
    return out


def entity_mode(df: DataFrame, key: str, col: str, out: str | None = None) -> DataFrame:
    """Mode per key as count -> max_by: (key, value) counts, then per key the
    value with the highest count, smallest value on ties.  Both steps are
    partial aggregates, so a hot key or a wide value domain never sits in one
    map in one task."""
    counts = df.where(qcol(col).isNotNull()).groupBy(qcol(key).alias(key), qcol(col).alias("__v")).count()
    # min over (-count, value): highest count first, smallest value on ties
    best = counts.groupBy(key).agg(F.min(F.struct((-F.col("count")).alias("nc"), F.col("__v").alias("v")))
                                   .alias("__m"))
    return best.select(key, F.col("__m.v").alias(out or col))


def cluster_means(df: DataFrame, cluster: str, cols) -> DataFrame:
    """AGG-01 / CLU-08: mean of each column per cluster."""
    return df.groupBy(cluster).agg(*[F.avg(qcol(c)).alias(c) for c in cols])


def cluster_sizes(df: DataFrame, cluster: str, certainty: str | None = None) -> DataFrame:
    """AGG-03: size and mean certainty per cluster."""
    aggs = [F.count(F.lit(1)).alias("sample_size")]
    if certainty:
        aggs.append(F.avg(certainty).alias("mean_certainty"))
    return df.groupBy(cluster).agg(*aggs)


def duplicate_ratio(df: DataFrame, exclude=()) -> float:
    """AGG-09: 1 - distinct rows / rows over the non-excluded columns."""
    cols = [c for c in df.columns if c not in set(exclude)]
    n = df.count()
    if n == 0:
        return 0.0
    d = df.select(*[qcol(c) for c in cols]).distinct().count()
    return 1.0 - d / n


def duplicate_ratio_df(df: DataFrame, exclude=()) -> DataFrame:
    """AGG-09 as a one-row DataFrame (n_rows, n_distinct, duplicate_ratio)."""
    cols = [c for c in df.columns if c not in set(exclude)]
    per = df.groupBy(*[qcol(c) for c in cols]).agg(F.count(F.lit(1)).alias("__c"))
    return per.agg(F.sum("__c").alias("n_rows"), F.count(F.lit(1)).alias("n_distinct")).select(
        "n_rows", "n_distinct", (1 - F.col("n_distinct") / F.col("n_rows")).alias("duplicate_ratio"))
