"""Column profile (PROF-01..13): one row per column.

Work plan, whatever the width of the table:
  1. one wide ``agg`` for counts and moments of every column (map-side partial
     aggregation, a single shuffle of one row per task);
  2. one value-count stage: unpivot to (column, value) and
     ``groupBy(column, value).count()`` then roll up to n_distinct, n_unique
     and entropy — instead of one ``count_distinct`` per column, which would
     Expand the input once per column;
  3. exact quantiles with bounded memory (``kiln.functions.stats.quantiles``)
     and a second quantile pass for the median absolute deviation.
The profile itself is tiny (one row per column) and is returned as a DataFrame
so every plan rule over it is a DataFrame expression too.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.functions.names import INTEGRAL_TYPES, semantic_type
from kiln.functions.stats import g1_from_g1pop, g2_from_g2pop, qcol, quantiles

PROBS = [0.05, 0.25, 0.5, 0.75, 0.95]

PROFILE_SCHEMA = T.StructType([
    T.StructField("position", T.IntegerType()),
    T.StructField("column", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("is_integral", T.BooleanType()),
    T.StructField("n", T.LongType()),
    T.StructField("count", T.LongType()),
    T.StructField("n_missing", T.LongType()),
    T.StructField("p_missing", T.DoubleType()),
    T.StructField("n_distinct", T.LongType()),
    T.StructField("p_distinct", T.DoubleType()),
    T.StructField("n_unique", T.LongType()),
    T.StructField("is_unique", T.BooleanType()),
    T.StructField("entropy", T.DoubleType()),
    T.StructField("mean", T.DoubleType()),
    T.StructField("std", T.DoubleType()),
    T.StructField("variance", T.DoubleType()),
    T.StructField("min", T.DoubleType()),
    T.StructField("max", T.DoubleType()),
    T.StructField("sum", T.DoubleType()),
    T.StructField("skewness", T.DoubleType()),
    T.StructField("kurtosis", T.DoubleType()),
    T.StructField("q05", T.DoubleType()),
    T.StructField("q25", T.DoubleType()),
    T.StructField("q50", T.DoubleType()),
    T.StructField("q75", T.DoubleType()),
    T.StructField("q95", T.DoubleType()),
    T.StructField("iqr", T.DoubleType()),
    T.StructField("cv", T.DoubleType()),
    T.StructField("mad", T.DoubleType()),
    T.StructField("n_zeros", T.LongType()),
    T.StructField("n_negative", T.LongType()),
    T.StructField("n_infinite", T.LongType()),
    T.StructField("range", T.DoubleType()),
    T.StructField("lowest", T.StringType()),
    T.StructField("highest", T.StringType()),
    T.StructField("is_sequence", T.BooleanType()),
])


def nan_to_null(df: DataFrame) -> DataFrame:
    """Spark keeps NaN beside NULL; the reference's frames have one missing marker."""
    fl = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    if not fl:
        return df
    return df.select(*[F.when(F.isnan(qcol(c)), F.lit(None).cast(df.schema[c].dataType))
                       .otherwise(qcol(c)).alias(c) if c in fl else qcol(c) for c in df.columns])


def _clean(v):
    if v is None:
        return None
    v = float(v)
    return None if math.isnan(v) else v


def profile(df: DataFrame, exact_quantiles: bool = True, with_mad: bool = True,
            exact_distinct: bool = True, rsd: float = 0.01) -> DataFrame:
    """Profile every column of ``df``; returns PROFILE_SCHEMA rows ordered by position.

    ``exact_distinct=False`` replaces the value-count shuffle by HyperLogLog
    sketches inside the moments pass (``approx_count_distinct(rsd)``):
    n_distinct is then approximate, n_unique and entropy are null and
    is_unique means "distinct estimate within rsd of the count".

    ``lowest`` and ``highest`` are the least and greatest number or time as text of the
    column's own type (``min`` and ``max`` are doubles, inexact beyond 2**53);
    ``range`` and ``is_sequence`` (unique integers without a gap or a null) come from them."""
    from kiln.session import PassInput
    with PassInput(nan_to_null(df)) as src:
        return _profile(src, exact_quantiles, with_mad, exact_distinct, rsd)


def _profile(df: DataFrame, exact_quantiles: bool, with_mad: bool, exact_distinct: bool = True,
             rsd: float = 0.01) -> DataFrame:
    spark = df.sparkSession
    fields = df.schema.fields
    types = [semantic_type(f.dataType) for f in fields]
    num_idx = [i for i, t in enumerate(types) if t == "Numeric"]

    # 1. counts and moments, one pass
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, f in enumerate(fields):
        c = qcol(f.name)
        aggs.append(F.count(c).alias(f"cnt{i}"))
        if not exact_distinct and types[i] != "Unsupported":
            aggs.append(F.approx_count_distinct(c, rsd).alias(f"hll{i}"))
        if types[i] in ("Numeric", "DateTime"):
            aggs += [F.min(c).cast("string").alias(f"lo{i}"), F.max(c).cast("string").alias(f"hi{i}")]
        if i in num_idx:
            x = c.cast("double")
            finite = F.when(~x.isin(float("inf"), float("-inf")), x)
            aggs += [F.avg(finite).alias(f"mean{i}"), F.stddev_samp(finite).alias(f"std{i}"),
                     F.var_samp(finite).alias(f"var{i}"), F.min(x).alias(f"min{i}"),
                     F.max(x).alias(f"max{i}"), F.sum(finite).alias(f"sum{i}"),
                     F.skewness(finite).alias(f"g1{i}"), F.kurtosis(finite).alias(f"g2{i}"),
                     F.count_if(x == 0).alias(f"z{i}"), F.count_if(x < 0).alias(f"neg{i}"),
                     F.count_if(x.isin(float("inf"), float("-inf"))).alias(f"inf{i}")]
    m = df.agg(*aggs).first()
    n = m["__n"]

    # 2. value counts -> distinct / unique / entropy
    parts = []
    for i, f in enumerate(fields):
        if types[i] == "Unsupported":
            continue
        c = qcol(f.name)
        # values are counted by a 128-bit hash of their own type: exact for large ids, and no
        # text longer than the hash is shuffled
        parts.append(F.struct(F.lit(i).alias("i"), F.xxhash64(F.lit(1), c).alias("d"), F.xxhash64(F.lit(2), c).alias("s"),
                              c.isNull().alias("null")))
    dist = {}
    if not exact_distinct:
        for i in range(len(fields)):
            if types[i] != "Unsupported":
                nd = m[f"hll{i}"]
                dist[i] = (min(nd, m[f"cnt{i}"]), None, None)
        parts = []
    if parts:
        vc = (df.select(F.explode(F.array(*parts)).alias("p")).select("p.*")
              .where(~F.col("null")).groupBy("i", "d", "s").count())
        for r in vc.groupBy("i").agg(
                F.count(F.lit(1)).alias("nd"), F.count_if(F.col("count") == 1).alias("nu"),
                F.sum(F.col("count") * F.log(F.col("count"))).alias("clogc"),
                F.sum("count").alias("tot")).collect():
            tot = r["tot"]
            ent = math.log(tot) - r["clogc"] / tot if tot else None
            dist[r["i"]] = (r["nd"], r["nu"], ent)

    # 3. quantiles and MAD
    num_cols = [fields[i].name for i in num_idx]
    qs = quantiles(df, num_cols, PROBS, exact=exact_quantiles) if num_cols else {}
    mad = {}
    if with_mad and num_cols:
        live = [c for c in num_cols if qs[c][2] is not None]
        dev = df.select(*[F.abs(qcol(c).cast("double") - F.lit(qs[c][2])).alias(c) for c in live])
        mad = {c: v[0] for c, v in quantiles(dev, live, [0.5], exact=exact_quantiles).items()}

    rows = []
    for i, f in enumerate(fields):
        cnt = m[f"cnt{i}"]
        nd, nu, ent = dist.get(i, (None, None, None) if types[i] == "Unsupported" else (0, 0, None))
        rec = dict(position=i, column=f.name, type=types[i],
                   is_integral=isinstance(f.dataType, INTEGRAL_TYPES), n=n, count=cnt,
                   n_missing=n - cnt, p_missing=(n - cnt) / n if n else 0.0,
                   n_distinct=nd, p_distinct=(nd / cnt) if (nd is not None and cnt) else 0.0,
                   n_unique=nu,
                   is_unique=(bool(cnt > 0 and nd == cnt) if exact_distinct else bool(cnt > 0 and nd >= cnt * (1 - rsd)))
                   if nd is not None else False,
                   entropy=ent)
        if i in num_idx:
            mean, std = _clean(m[f"mean{i}"]), _clean(m[f"std{i}"])
            q = qs[f.name]
            g1 = _clean(m[f"g1{i}"])
            g2 = _clean(m[f"g2{i}"])
            fc = cnt - m[f"inf{i}"]
            rec.update(
                mean=mean, std=std, variance=_clean(m[f"var{i}"]), min=_clean(m[f"min{i}"]),
                max=_clean(m[f"max{i}"]), sum=_clean(m[f"sum{i}"]),
                skewness=(g1 * math.sqrt(fc * (fc - 1)) / (fc - 2)) if (g1 is not None and fc > 2) else None,
                kurtosis=(((fc + 1) * g2 + 6) * (fc - 1) / ((fc - 2) * (fc - 3)))
                if (g2 is not None and fc > 3) else None,
                q05=q[0], q25=q[1], q50=q[2], q75=q[3], q95=q[4],
                iqr=(q[3] - q[1]) if q[1] is not None else None,
                cv=(std / mean) if (std is not None and mean not in (None, 0.0)) else None,
                mad=mad.get(f.name), n_zeros=m[f"z{i}"], n_negative=m[f"neg{i}"],
                n_infinite=m[f"inf{i}"])
            if rec["is_integral"] and cnt:
                span = int(m[f"hi{i}"]) - int(m[f"lo{i}"])
                rec.update(range=float(span), is_sequence=rec["is_unique"] and n == cnt and span + 1 == cnt)
            elif rec["min"] is not None:
                rec["range"] = _clean(rec["max"] - rec["min"])   # null where both are the same infinity
        if types[i] in ("Numeric", "DateTime"):
            rec.update(lowest=m[f"lo{i}"], highest=m[f"hi{i}"])
        rec.setdefault("is_sequence", False)
        rows.append(tuple(rec.get(fl.name) for fl in PROFILE_SCHEMA.fields))
    return spark.createDataFrame(rows, PROFILE_SCHEMA)


def profile_table(df: DataFrame) -> dict:
    """PROF-01: table-level n and n_var."""
    return {"n": df.count(), "n_var": len(df.columns)}


def value_counts(df: DataFrame, col: str, top: int = 10) -> DataFrame:
    """PROF-13 top-k value counts of one column (k is the feature)."""
    return (df.groupBy(qcol(col).alias("value")).count()
            .orderBy(F.desc("count"), F.asc_nulls_last("value")).limit(top))


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """PROF-13 equal-width histogram: (bin, lower, upper, count)."""
    x = qcol(col).cast("double")
    mm = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    lo, hi = mm["lo"], mm["hi"]
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, lower double, upper double, count long")
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    return (df.where(x.isNotNull()).groupBy(b.alias("bin")).count()
            .select("bin", (F.lit(lo) + F.col("bin") * width).alias("lower"),
                    (F.lit(lo) + (F.col("bin") + 1) * width).alias("upper"), "count")
            .orderBy("bin"))


__all__ = ["profile", "profile_table", "nan_to_null", "value_counts", "histogram",
           "PROFILE_SCHEMA", "g1_from_g1pop", "g2_from_g2pop"]
