"""Ordered-series operators (WIN-01..06, SORT-01).

Spark rows have no order, so every operator takes an explicit ``order_by``
(and optional ``partition_by`` keys).  A plain window over a key puts the
whole key -- possibly a third of the table -- into one task, and a window with
no key puts the whole table there.  Instead every operator here runs a
*segmented scan*:

1. range-partition the rows on the whole tuple (keys, order columns, a hash of the row as
   tie-breaker), whatever the columns' types, and number the parts: segments (``__b``) hold
   about equally many rows, however the values are spread, tied or nested, and a hot key
   spans many segments.  Sampled cuts differ from plan to plan, so the numbered table is
   written once (reliable checkpoint) and every later branch reads the same segments;
2. run the window inside (keys, __b) -- bounded work per task;
3. summarise each segment in one row (last / first non-null value, last
   order value) and carry those across segments with a window over the tiny
   segment table (at most keys + segments rows);
4. join the carry back on (keys, __b) -- the big side is already partitioned
   on those columns, so only the small side moves.

Rows that tie in all order columns follow each other by the hash of the row (``__t``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.functions.stats import qcol
from kiln.session import materialize


ROWS_PER_SEGMENT = 2_000_000


def _as_list(x):
    if x is None:
        return []
    return list(x) if isinstance(x, (list, tuple)) else [x]


def _segment(df: DataFrame, order, keys, buckets: int | None) -> DataFrame:
    """The rows with ``__t`` (tie-breaker) and ``__b``: contiguous, equally large parts of the rows
    in the order of (keys, order, __t), nulls first; written, so that every branch sees the same."""
    n = buckets
    if not n:  # at least the shuffle-partition count and one segment per ROWS_PER_SEGMENT rows
        n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // ROWS_PER_SEGMENT))
    hashed = [qcol(c) for c, t in df.dtypes if "map<" not in t and "variant" not in t]
    tied = df.withColumn("__t", F.xxhash64(*hashed))
    # rows that are equal in everything are alike wherever they lie: the last column spreads them
    ranged = tied.repartitionByRange(n, *[qcol(c) for c in [*keys, *order]], "__t", F.monotonically_increasing_id())
    return materialize(ranged.withColumn("__b", F.spark_partition_id()))


def _join_keys(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    """Left join on keys of which null is a value like any other."""
    right = right.select(*[qcol(k).alias(f"__k{i}") for i, k in enumerate(keys)],
                         *[qcol(c) for c in right.columns if c not in keys])
    on = [qcol(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return left.join(right, cond, "left").drop(*[f"__k{i}" for i in range(len(keys))])


def _ord(order) -> Column:
    return F.struct(*[qcol(c).alias(f"o{i}") for i, c in enumerate(order)])


def _place(order) -> Column:
    """A row's place among its key's rows: the order columns, then the tie-breaker."""
    return F.struct(*[qcol(c).alias(f"o{i}") for i, c in enumerate(order)], F.col("__t").alias("t"))


def _gap(kind: str, a: Column, b: Column) -> Column:
    """b - a of an order column: microseconds, days or its own unit, free of time zones."""
    if kind.startswith("timestamp"):
        return F.timestamp_diff("MICROSECOND", a, b)
    return F.date_diff(b, a).cast("bigint") if kind == "date" else b - a


def _carry_prev(seg: DataFrame, keys, order, values: dict[str, Column]) -> DataFrame:
    """For each row: the last non-null of each value strictly before it in
    (keys, order), searching earlier segments too.  Adds ``__prev_<name>``
    (struct of value and its order) columns."""
    o = _ord(order)
    w_in = Window.partitionBy(*[qcol(k) for k in keys], "__b").orderBy(*[qcol(c) for c in order], "__t") \
        .rowsBetween(Window.unboundedPreceding, -1)
    local = seg.select("*", *[F.last(F.when(v.isNotNull(), F.struct(v.alias("v"), o.alias("o"))),
                                     ignorenulls=True).over(w_in).alias(f"__lp_{n}")
                              for n, v in values.items()])
    summary = seg.groupBy(*[qcol(k).alias(k) for k in keys], "__b").agg(
        *[F.max_by(F.struct(v.alias("v"), o.alias("o")), F.when(v.isNotNull(), _place(order))).alias(f"__s_{n}")
          for n, v in values.items()])
    w_seg = Window.partitionBy(*[qcol(k) for k in keys]).orderBy("__b") \
        .rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(*[qcol(k) for k in keys], "__b",
                           *[F.last(F.col(f"__s_{n}"), ignorenulls=True).over(w_seg).alias(f"__c_{n}")
                             for n in values])
    joined = _join_keys(local, carry, keys + ["__b"])
    return joined.select(*[c for c in local.columns if not c.startswith("__lp_")],
                         *[F.coalesce(F.col(f"__lp_{n}"), F.col(f"__c_{n}")).alias(f"__prev_{n}")
                           for n in values])


def _carry_next(seg: DataFrame, keys, order, values: dict[str, Column]) -> DataFrame:
    """Mirror of _carry_prev: first non-null strictly after each row (``__next_<name>``)."""
    o = _ord(order)
    w_in = Window.partitionBy(*[qcol(k) for k in keys], "__b").orderBy(*[qcol(c) for c in order], "__t") \
        .rowsBetween(1, Window.unboundedFollowing)
    local = seg.select("*", *[F.first(F.when(v.isNotNull(), F.struct(v.alias("v"), o.alias("o"))),
                                      ignorenulls=True).over(w_in).alias(f"__ln_{n}")
                              for n, v in values.items()])
    summary = seg.groupBy(*[qcol(k).alias(k) for k in keys], "__b").agg(
        *[F.min_by(F.struct(v.alias("v"), o.alias("o")), F.when(v.isNotNull(), _place(order))).alias(f"__s_{n}")
          for n, v in values.items()])
    w_seg = Window.partitionBy(*[qcol(k) for k in keys]).orderBy("__b") \
        .rowsBetween(1, Window.unboundedFollowing)
    carry = summary.select(*[qcol(k) for k in keys], "__b",
                           *[F.first(F.col(f"__s_{n}"), ignorenulls=True).over(w_seg).alias(f"__c_{n}")
                             for n in values])
    joined = _join_keys(local, carry, keys + ["__b"])
    return joined.select(*[c for c in local.columns if not c.startswith("__ln_")],
                         *[F.coalesce(F.col(f"__ln_{n}"), F.col(f"__c_{n}")).alias(f"__next_{n}")
                           for n in values])


def fill_forward(df: DataFrame, order_by, partition_by=None, cols=None,
                 leading: str | None = "backfill", buckets: int | None = None) -> DataFrame:
    """WIN-01/02: last known value in order; leading gap optionally back-filled
    with the first non-null value (``df.ffill().bfill()``)."""
    order, keys = _as_list(order_by), _as_list(partition_by)
    cols = [c for c in (cols or df.columns) if c not in order + keys]
    seg = _segment(df, order, keys, buckets)
    vals = {str(i): qcol(c) for i, c in enumerate(cols)}
    out = _carry_prev(seg, keys, order, vals)
    fills = {c: F.coalesce(qcol(c), F.col(f"__prev_{i}.v")) for i, c in enumerate(cols)}
    if leading == "backfill":
        firsts = seg.groupBy(*[qcol(k).alias(k) for k in keys]).agg(
            *[F.min_by(qcol(c), F.when(qcol(c).isNotNull(), _place(order))).alias(f"__f{i}")
              for i, c in enumerate(cols)])
        if keys:
            out = _join_keys(out, firsts, keys)
            first = {i: F.col(f"__f{i}") for i in range(len(cols))}
        else:  # one row: read it and inline the values
            row = firsts.first()
            first = {i: F.lit(row[f"__f{i}"]) for i in range(len(cols))}
        fills = {c: F.coalesce(e, first[i]) for i, (c, e) in enumerate(fills.items())}
    return out.select(*[fills[c].alias(c) if c in fills else qcol(c) for c in df.columns])


def interpolate_linear(df: DataFrame, order_by: str, partition_by=None, cols=None,
                       buckets: int | None = None) -> DataFrame:
    """WIN-04: fill interior numeric gaps on the straight line between the
    previous and next known values, by the (numeric, date or timestamp) order value."""
    keys = _as_list(partition_by)
    if cols is None:
        numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
        cols = [c for c in df.columns if c in numeric and c not in [order_by, *keys]]
    cols = [c for c in cols if c in df.columns]
    seg = _segment(df, [order_by], keys, buckets)
    vals = {str(i): qcol(c).cast("double") for i, c in enumerate(cols)}
    prev = _carry_prev(seg, keys, [order_by], vals)
    both = _carry_next(prev, keys, [order_by], vals)

    kind = dict(df.dtypes)[order_by]

    def dist(a: Column, b: Column) -> Column:
        return _gap(kind, a, b).cast("double")

    x = qcol(order_by)
    fills = {}
    for i, c in enumerate(cols):
        p, nx = F.col(f"__prev_{i}"), F.col(f"__next_{i}")
        x0, x1 = p["o"]["o0"], nx["o"]["o0"]
        y0, y1 = p["v"], nx["v"]
        span = dist(x0, x1)
        interp = F.when(span == 0, y0).otherwise(y0 + (y1 - y0) * F.try_divide(dist(x0, x), span))
        fills[c] = F.coalesce(qcol(c).cast("double"), interp)
    return both.select(*[fills[c].alias(c) if c in fills else qcol(c) for c in df.columns])


def with_previous(df: DataFrame, order_by, partition_by=None, buckets: int | None = None,
                  values: dict[str, Column] | None = None) -> DataFrame:
    """The row before (lag 1): its order value (``__prev_order.v``) and optional values
    (``__prev_<name>.v.x``, null where that row's value is null), segment-aware."""
    order, keys = _as_list(order_by), _as_list(partition_by)
    seg = _segment(df, order, keys, buckets)
    vals = {"order": _ord(order)}
    vals.update({n: F.struct(v.alias("x")) for n, v in (values or {}).items()})
    return _carry_prev(seg, keys, order, vals)


def ordered_check(df: DataFrame, order_by: str, position: str, partition_by=None) -> DataFrame:
    """WIN-03 as a one-row DataFrame (n_rows, n_inversions, is_sorted): is
    ``order_by`` non-decreasing along ``position`` (within keys)?"""
    keys = _as_list(partition_by)
    pv = with_previous(df, [position], keys, values={"v": qcol(order_by)})
    inv = F.col("__prev_v.v.x") > qcol(order_by)
    return pv.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(inv).alias("n_inversions")) \
        .withColumn("is_sorted", F.col("n_inversions") == 0)


def is_ordered(df: DataFrame, order_by, position: str | None = None, partition_by=None) -> bool | None:
    """WIN-03: True when no row follows a larger ``order_by`` value in ``position`` order;
    None without a position, as rows then have no order."""
    if position is None:
        return None
    return bool(ordered_check(df, order_by, position, partition_by).first()["is_sorted"])


def detect_gaps(df: DataFrame, order_by: str, partition_by=None, step=None,
                buckets: int | None = None) -> DataFrame:
    """WIN-05: rows whose distance to the previous row exceeds the expected step.

    step defaults to the most frequent delta (smallest on ties).  Output:
    keys..., prev, cur, delta, step, missing_steps (delta / step - 1, floored).
    For timestamps delta and step are seconds with microseconds, for dates days; ``step`` is given so, too.
    """
    keys = _as_list(partition_by)
    kind = dict(df.dtypes)[order_by]
    is_ts = kind.startswith("timestamp")
    pv = with_previous(df.select(*[qcol(k) for k in keys], qcol(order_by)), [order_by], keys, buckets)
    prev = F.col("__prev_order")["v"]["o0"]
    delta = _gap(kind, prev, qcol(order_by)).alias("delta")
    if is_ts and step is not None:
        step = round(step * 1_000_000)
    d = pv.select(*[qcol(k) for k in keys], prev.alias("prev"), qcol(order_by).alias("cur"), delta) \
        .where(F.col("prev").isNotNull())
    if step is None:  # most frequent delta, smallest on ties: counts, then a min over (-count, delta)
        row = (d.groupBy("delta").count()
               .agg(F.min(F.struct((-F.col("count")).alias("nc"), F.col("delta").alias("v"))).alias("m")).first())
        step = row["m"]["v"] if row["m"] is not None else None
    unit = (lambda c: c / F.lit(1e6)) if is_ts else (lambda c: c)
    if step is None or step == 0:
        return d.limit(0).withColumn("delta", unit(F.col("delta"))).withColumn("step", F.lit(step)).withColumn("missing_steps", F.lit(0).cast("long"))
    missing = (F.floor(F.col("delta") / F.lit(step)) - 1).cast("long")
    return (d.where(F.col("delta") > step).withColumn("missing_steps", missing)
            .select(*[qcol(k) for k in keys], "prev", "cur", unit(F.col("delta")).alias("delta"), unit(F.lit(step)).alias("step"), "missing_steps"))


def stationarity(df: DataFrame, order_by: str, col: str, partition_by=None,
                 buckets: int | None = None) -> DataFrame:
    """WIN-06: lag-1 Dickey-Fuller regression  dy_t = a + b * y_{t-1}.

    Returns keys..., n, slope, t_stat with t = b / sqrt((Syy - b Sxy) / ((n-2) Sxx)).
    """
    keys = _as_list(partition_by)
    pv = with_previous(df, order_by, keys, buckets, values={"y": qcol(col).cast("double")})
    y0 = F.col("__prev_y.v.x")
    dy = qcol(col).cast("double") - y0
    reg = pv.where(y0.isNotNull() & qcol(col).isNotNull()) \
        .groupBy(*[qcol(k).alias(k) for k in keys]).agg(
            F.regr_count(dy, y0).alias("n"), F.regr_slope(dy, y0).alias("slope"),
            F.regr_sxx(dy, y0).alias("sxx"), F.regr_syy(dy, y0).alias("syy"), F.regr_sxy(dy, y0).alias("sxy"))
    se = F.sqrt(F.try_divide(F.col("syy") - F.col("slope") * F.col("sxy"), (F.col("n") - 2) * F.col("sxx")))
    return reg.select(*keys, "n", "slope", F.try_divide(F.col("slope"), se).alias("t_stat"))
