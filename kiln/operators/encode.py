"""Categorical encoders (ENC-01..03)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.functions.stats import qcol
from kiln.operators.base import ColumnRules, register

MAX_ONE_HOT_LEVELS = 1000  # wider one-hot blocks are almost surely a mistake


def _value_counts(df: DataFrame, cols) -> DataFrame:
    """(i, value, count) for the listed columns in one shuffle (map-side combine)."""
    parts = [F.struct(F.lit(i).alias("i"), qcol(c).cast("string").alias("v")) for i, c in enumerate(cols)]
    return (df.select(F.explode(F.array(*parts)).alias("p")).select("p.*")
            .where(F.col("v").isNotNull()).groupBy("i", "v").count())


# ---------------------------------------------------------------- rare label
@register("rare_label")
def _apply_rare(spec: dict, df: DataFrame) -> DataFrame:
    out = {}
    for c, keep in spec["keep"].items():
        if c not in df.columns or keep is None:
            continue
        x = qcol(c)
        out[c] = (F.when(x.isNull(), x).when(x.isin(keep), x)
                  .otherwise(F.lit(spec.get("replace_with", "Rare"))))
    return df.withColumns(out) if out else df


def fit_rare_label(df: DataFrame, cols, tol: float = 0.05, min_categories: int = 10,
                   replace_with: str = "Rare") -> ColumnRules:
    """Categories with frequency < tol become ``Rare``; only in columns with
    more than ``min_categories`` categories.  At most 1/tol categories per
    column can be frequent, so the collected keep-list is bounded."""
    cols = [c for c in cols if c in df.columns]
    keep: dict[str, list | None] = {}
    if cols:
        vc = _value_counts(df, cols).persist()
        # per column: number of categories and non-null total (one row per column)
        tot = {r["i"]: (r["ncat"], r["tot"]) for r in
               vc.groupBy("i").agg(F.count(F.lit(1)).alias("ncat"), F.sum("count").alias("tot")).collect()}
        ncat = {i: t[0] for i, t in tot.items()}
        wide = [i for i, (n, _t) in tot.items() if n > min_categories]
        frequent = []
        if wide:
            total = F.lit(None).cast("double")
            for i in wide:
                total = F.when(F.col("i") == i, F.lit(float(tot[i][1]))).otherwise(total)
            frequent = vc.where(F.col("i").isin(wide) & (F.col("count") / total >= tol)).collect()
        vc.unpersist()
        for i, c in enumerate(cols):
            if ncat.get(i, 0) > min_categories:
                keep[c] = sorted(r["v"] for r in frequent if r["i"] == i)
            else:
                keep[c] = None
    return ColumnRules.of("rare_label", {"keep": keep, "replace_with": replace_with, "tol": tol})


# ---------------------------------------------------------------- one-hot
@register("one_hot")
def _apply_one_hot(spec: dict, df: DataFrame) -> DataFrame:
    levels = {c: lv for c, lv in spec["levels"].items() if c in df.columns}
    keep = [qcol(c) for c in df.columns if c not in levels]
    new = [F.when(qcol(c) == F.lit(v), 1).otherwise(0).alias(f"{c}_{v}")
           for c, lv in levels.items() for v in lv]
    return df.select(*keep, *new)


def fit_one_hot(df: DataFrame, cols, levels: dict | None = None,
                max_levels: int = MAX_ONE_HOT_LEVELS, order_by: str | None = None) -> ColumnRules:
    """All levels kept, columns ``{col}_{level}``, source removed.  Level order:
    sorted, or with ``order_by`` the order of first appearance (the reference's
    order).  Level counts are checked before anything is collected."""
    cols = [c for c in cols if c in df.columns]
    found = dict(levels or {})
    todo = [c for c in cols if c not in found]
    if todo:
        vc = _value_counts(df, todo)
        sizes = {r["i"]: r["n"] for r in vc.groupBy("i").agg(F.count(F.lit(1)).alias("n")).collect()}
        too_wide = [todo[i] for i, n in sizes.items() if n > max_levels]
        if too_wide:
            raise ValueError(f"one-hot of {too_wide}: more than {max_levels} levels; use rare_label first")
        if order_by is None:
            got = vc.select("i", "v").collect()
            for i, c in enumerate(todo):
                found[c] = sorted(r["v"] for r in got if r["i"] == i)
        else:
            parts = [F.struct(F.lit(i).alias("i"), qcol(c).cast("string").alias("v")) for i, c in enumerate(todo)]
            first = (df.select(qcol(order_by).alias("__o"), F.explode(F.array(*parts)).alias("p"))
                     .select("__o", "p.*").where(F.col("v").isNotNull())
                     .groupBy("i", "v").agg(F.min("__o").alias("first")).collect())
            for i, c in enumerate(todo):
                found[c] = [r["v"] for r in sorted((r for r in first if r["i"] == i),
                                                   key=lambda r: (r["first"], r["v"]))]
    return ColumnRules.of("one_hot", {"levels": {c: found[c] for c in cols}})


# ---------------------------------------------------------------- factorize
LEVELS_PER_TASK = 100_000
BROADCAST_LEVELS = 10_000


def _dense_codes(firsts: DataFrame) -> DataFrame:
    """(level, code) with code = rank of (first, level) from 0.

    A distributed rank: range-sort the levels, count rows per partition (one row
    each), turn the counts into offsets with a window over that tiny table, add the
    within-partition row number.  The sorted table is checkpointed first so the
    range bounds are computed once.  Up to ``BROADCAST_LEVELS`` levels go to the joins
    as a broadcast: a checkpointed table has no size for Spark to go by, and the rows
    would be shuffled by a handful of levels.
    """
    from kiln.session import materialize
    n = firsts.count()
    parts = max(1, -(-n // LEVELS_PER_TASK))
    ranked = materialize(firsts.repartitionByRange(parts, "__first", "__lvl")
                         .withColumn("__pid", F.spark_partition_id()))
    offsets = ranked.groupBy("__pid").count().select(
        "__pid", (F.sum("count").over(Window.orderBy("__pid")) - F.col("count")).alias("__off"))
    local = F.row_number().over(Window.partitionBy("__pid").orderBy("__first", "__lvl")) - 1
    codes = (ranked.withColumn("__local", local).join(offsets, "__pid")
             .select("__lvl", (F.col("__off") + F.col("__local")).alias("__code")))
    return F.broadcast(codes) if n <= BROADCAST_LEVELS else codes


def factorize(df: DataFrame, cols, order_by: str, suffix: str = "") -> DataFrame:
    """Code levels by first appearance in ``order_by`` order, null -> -1 (ENC-03).

    Per column: level -> min(order_by) (partial aggregate), rank of those
    minima (:func:`_dense_codes`), joined back; few levels are broadcast, else Spark picks the join.
    """
    out = df
    for c in cols:
        firsts = (df.where(qcol(c).isNotNull()).groupBy(qcol(c).alias("__lvl"))
                  .agg(F.min(qcol(order_by)).alias("__first")))
        right = _dense_codes(firsts)
        name = f"{c}{suffix}"
        out = (out.join(right, qcol(c) == F.col("__lvl"), "left")
               .withColumn(name, F.coalesce(F.col("__code"), F.lit(-1)).cast("long"))
               .drop("__lvl", "__code"))
    return out
