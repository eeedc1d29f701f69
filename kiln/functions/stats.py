"""Column statistics shared by profile, estimators and selection.

The important piece is :func:`quantiles`: exact, linearly interpolated
quantiles (pandas / DuckDB ``quantile_cont`` semantics) that never hold more
than a bounded number of values in any task or on the driver.

One path serves every size: histogram refinement.  Each pass is one distributed
``groupBy(interval, bucket).agg(count, min, max)`` with map-side combine; the
driver keeps only the bucket table and narrows every target rank to the values
between one bucket's minimum and maximum.  An interval's smallest and largest
value always fall into different buckets, so every pass narrows every interval.
When an interval holds <= ``collect_limit`` values, an executor sorts them and
returns only the wanted order statistics.  -inf, inf and NaN are placed by their
counts (NaN last) and never enter the histogram.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COLLECT_LIMIT = 20_000
BUCKETS = 4096


def qcol(name: str) -> Column:
    """Column reference that survives spaces, dots, `$`, parentheses."""
    return F.col("`" + name.replace("`", "``") + "`")


def known(x: Column) -> Column:
    """A floating-point column with NaN as null: both mean missing."""
    return F.when(~F.isnan(x), x)


def without_nan(df: DataFrame, cols=None) -> DataFrame:
    """The frame with NaN as null in the given (default: all) floating-point columns."""
    kinds = dict(df.dtypes)
    out = {c: known(qcol(c)) for c in (df.columns if cols is None else cols) if kinds.get(c) in ("double", "float")}
    return df.withColumns(out) if out else df


def g1_from_g1pop(g1: Column, n: Column) -> Column:
    """Bias-corrected sample skewness G1 from Spark's population g1."""
    return F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def g2_from_g2pop(g2: Column, n: Column) -> Column:
    """Bias-corrected excess kurtosis G2 from Spark's population excess g2."""
    return F.when(n > 3, ((n + 1) * g2 + 6) * (n - 1) / ((n - 2) * (n - 3)))


def _interp(lo: float, hi: float, frac: float) -> float:
    if frac == 0 or lo == hi:
        return lo
    if math.isinf(lo) or math.isinf(hi):  # between an infinity and a number: the infinity
        return lo + hi if math.isinf(lo) and math.isinf(hi) else (lo if math.isinf(lo) else hi)
    return lo + (hi - lo) * frac


def _targets(n: int, probs: Sequence[float]) -> list[tuple[int, int, float]]:
    out = []
    for p in probs:
        h = (n - 1) * p
        k1 = int(math.floor(h))
        frac = h - k1
        k2 = min(k1 + 1, n - 1) if frac > 0 else k1
        out.append((k1, k2, frac))
    return out


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
              collect_limit: int = COLLECT_LIMIT, buckets: int = BUCKETS, exact: bool = True,
              accuracy: int = 10000) -> dict[str, list[float | None]]:
    """Exact linear-interpolated quantiles of numeric columns (nulls skipped).

    Returns ``{col: [q(p) for p in probs]}``; an all-null column gives Nones.
    ``exact=False`` uses ``percentile_approx(accuracy)`` in one pass.
    """
    from kiln.session import PassInput
    cols = list(cols)
    probs = [float(p) for p in probs]
    if not cols:
        return {}
    x = {c: qcol(c).cast("double") for c in cols}
    if not exact:
        row = df.agg(*[F.percentile_approx(x[c], probs, accuracy).alias(f"q{i}")
                       for i, c in enumerate(cols)]).first()
        return {c: list(row[f"q{i}"]) if row[f"q{i}"] is not None else [None] * len(probs)
                for i, c in enumerate(cols)}
    inf = float("inf")
    with PassInput(df.select(*[x[c].alias(f"v{i}") for i, c in enumerate(cols)])) as base:
        aggs = []
        for i in range(len(cols)):
            v = F.col(f"v{i}")
            finite = F.when((v > -inf) & (v < inf), v)
            aggs += [F.count(v).alias(f"n{i}"), F.count_if(v == -inf).alias(f"neg{i}"), F.count(finite).alias(f"fin{i}"),
                     F.count_if(v == inf).alias(f"pos{i}"), F.min(finite).alias(f"lo{i}"), F.max(finite).alias(f"hi{i}")]
        r = base.agg(*aggs).first()
        found: dict[tuple[int, int], float] = {}
        state: dict[int, dict[int, list]] = {}   # column: rank -> interval [lo, hi, rank below, count]
        wanted: dict[int, list[tuple[int, int, float]]] = {}
        result: dict[str, list[float | None]] = {}
        for i, c in enumerate(cols):
            n, neg, fin, pos = (r[f"{k}{i}"] for k in ("n", "neg", "fin", "pos"))
            if not n:
                result[c] = [None] * len(probs)
                continue
            wanted[i] = _targets(n, probs)
            state[i] = {}
            for k in sorted({k for t in wanted[i] for k in t[:2]}):
                if k < neg:
                    found[(i, k)] = -inf
                elif k >= neg + fin:
                    found[(i, k)] = inf if k < neg + fin + pos else float("nan")
                else:
                    state[i][k] = [r[f"lo{i}"], r[f"hi{i}"], neg, fin]
        _refine(base, state, found, collect_limit, buckets)
    for i, targets in wanted.items():
        result[cols[i]] = [_interp(found[(i, k1)], found[(i, k2)], frac) for k1, k2, frac in targets]
    return {c: result[c] for c in cols}


def _refine(base: DataFrame, state, found, collect_limit, buckets):
    """Narrow the interval of every wanted rank to one value (see module doc)."""
    before = None
    while True:
        open_iv: dict[int, list[tuple]] = {}
        for i, ranks in state.items():
            ivs = {}
            for k, (lo, hi, below, cnt) in ranks.items():
                if (i, k) in found:
                    continue
                if lo == hi:
                    found[(i, k)] = lo
                    continue
                ivs[(lo, hi)] = (below, cnt)
            if ivs:
                open_iv[i] = sorted((lo, hi, b, c) for (lo, hi), (b, c) in ivs.items())
        if not open_iv:
            return
        if open_iv == before:
            raise RuntimeError(f"quantile intervals no longer narrow: {open_iv}")
        before = open_iv
        small = {i: [iv for iv in ivs if iv[3] <= collect_limit] for i, ivs in open_iv.items()}
        large = {i: [iv for iv in ivs if iv[3] > collect_limit] for i, ivs in open_iv.items()}
        if any(small.values()):
            _pick_pass(base, small, state, found)
        if any(large.values()):
            _histogram_pass(base, large, state, buckets)


def _interval_table(groups: dict[int, list]):
    """Flatten per-column intervals into array literals (folded by Catalyst
    into single array constants, which codegen references instead of
    inlining -- the generated code is identical for every refinement pass).

    Returns (cols, off, cnt, los, his) where column position k covers flat
    intervals off[k] .. off[k] + cnt[k] - 1."""
    cols, off, cnt, los, his = [], [], [], [], []
    for i, ivs in groups.items():
        if not ivs:
            continue
        cols.append(i)
        off.append(len(los))
        cnt.append(len(ivs))
        for lo, hi, _b, _c in ivs:
            los.append(float(lo))
            his.append(float(hi))
    return cols, off, cnt, los, his


def _long_with_interval(base, groups):
    """(k, g, v): k = position of the column, g = flat interval index holding
    v (rows outside every open interval are dropped)."""
    cols, off, cnt, los, his = _interval_table(groups)
    lo_a, hi_a = F.lit(los), F.lit(his)
    off_a, cnt_a = F.lit(off), F.lit(cnt)
    long = base.select(F.inline(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"v{i}").alias("v"))
                                         for k, i in enumerate(cols)])))
    if all(c == 1 for c in cnt):  # one open interval per column (the usual first pass)
        g = F.when((F.col("v") >= F.element_at(lo_a, F.col("k") + 1))
                   & (F.col("v") <= F.element_at(hi_a, F.col("k") + 1)), F.col("k")).otherwise(F.lit(-1))
    else:
        first = F.element_at(off_a, F.col("k") + 1)
        idx = F.sequence(first, first + F.element_at(cnt_a, F.col("k") + 1) - 1)
        g = F.aggregate(idx, F.lit(-1), lambda acc, j: F.when(
            (F.col("v") >= F.element_at(lo_a, j + 1)) & (F.col("v") <= F.element_at(hi_a, j + 1)), j)
            .otherwise(acc))
    out = long.where(F.col("v").isNotNull()).withColumn("g", g).where(F.col("g") >= 0)
    return out, cols, off, los, his


def _pick_pass(base, small, state, found):
    """Sort the bounded values of every small interval in an executor and
    return only the wanted order statistics."""
    rows, cols, off, los, _his = _long_with_interval(base, small)
    picks: list[list[tuple[int, int]]] = [[] for _ in los]
    for k, i in enumerate(cols):
        for j, (lo, hi, below, _c) in enumerate(small[i]):
            picks[off[k] + j] = [(rk, rk - below) for rk, st in state[i].items()
                                 if st[0] == lo and st[1] == hi and (i, rk) not in found]
    places = F.element_at(F.array(*[F.array(*[F.lit(at + 1) for _rk, at in p]) for p in picks]), F.col("g") + 1)
    got = (rows.groupBy("g").agg(F.sort_array(F.collect_list("v")).alias("vs"))
           .select("g", F.transform(places, lambda at: F.element_at("vs", at)).alias("q")).collect())
    by_g = {r["g"]: r["q"] for r in got}
    for k, i in enumerate(cols):
        for j in range(len(small[i])):
            for (rk, _at), v in zip(picks[off[k] + j], by_g[off[k] + j]):
                found[(i, rk)] = float(v)


def _histogram_pass(base, large, state, buckets):
    """One refinement pass: bucket (count, min, max) per open interval with
    map-side combine.  The result is bounded by intervals x buckets whatever
    the data size; it comes back through Arrow and the running counts are
    taken with numpy."""
    import numpy as np
    rows, cols, off, los, his = _long_with_interval(base, large)
    scale = []
    for lo, h in zip(los, his):
        half = h / 2 - lo / 2                       # h - lo itself may overflow
        sc = buckets / half if half > 0 else math.inf
        scale.append(sc if math.isfinite(sc) else 0.0)
    lo_g = F.element_at(F.lit(los), F.col("g") + 1)
    hi_g = F.element_at(F.lit(his), F.col("g") + 1)
    sc_g = F.element_at(F.lit(scale), F.col("g") + 1)
    inner = F.floor((F.col("v") / 2 - lo_g / 2) * sc_g).cast("int")
    b = (F.when(F.col("v") == lo_g, 0).when(F.col("v") == hi_g, buckets)
         .otherwise(F.greatest(F.lit(0), F.least(inner, F.lit(buckets - 1)))))
    hist = (rows.groupBy("g", b.alias("b"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("mn"), F.max("v").alias("mx"))
            .toPandas().sort_values(["g", "b"]))
    groups = {key: grp for key, grp in hist.groupby("g", sort=False)}
    for k, i in enumerate(cols):
        for j, (lo, hi, below, _cnt) in enumerate(large[i]):
            grp = groups.get(off[k] + j)
            if grp is None:
                continue
            n = grp["n"].to_numpy()
            ends = np.cumsum(n)
            for rk, st in state[i].items():
                if st[0] != lo or st[1] != hi:
                    continue
                r = rk - below
                pos = int(np.searchsorted(ends, r, side="right"))
                state[i][rk] = [float(grp["mn"].iloc[pos]), float(grp["mx"].iloc[pos]),
                                below + int(ends[pos] - n[pos]), int(n[pos])]
