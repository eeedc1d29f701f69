"""Correlation and statistical feature selection (AGG-07/08, SEL-01..04, SEL-08).

Correlations come from :mod:`kiln.operators.gram`.  The d x d matrix lives on the
driver; VIF needs only that matrix, so the iterative VIF loop is linear algebra with
no further Spark jobs.  Null and NaN are missing.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.functions.stats import known, qcol, quantiles, without_nan
from kiln.operators.gram import correlation_long, correlation_matrix, pair_corr  # noqa: F401


def variances(df: DataFrame, cols) -> dict[str, float | None]:
    """AGG-07 sample variance per column."""
    row = df.agg(*[F.var_samp(known(qcol(c).cast("double"))).alias(str(i)) for i, c in enumerate(cols)]).first()
    return {c: row[str(i)] for i, c in enumerate(cols)}


def variance_filter(df: DataFrame, cols, threshold: float = 0.01, keep=()) -> list[str]:
    """SEL-01: surviving columns (var_samp < threshold dropped unless kept; null variance survives)."""
    v = variances(df, cols)
    return [c for c in cols if c in keep or v[c] is None or not (v[c] < threshold)]


def corr_filter(df: DataFrame, cols, threshold: float = 0.85, keep=(), greedy: bool = False,
                matrix: np.ndarray | None = None, order: str = "given") -> list[str]:
    """SEL-02 (non-greedy) / SEL-03 (greedy) correlation filter; returns survivors.

    non-greedy: drop j when any earlier i (dropped or not) has |r| > threshold,
    unless j is force-kept.  greedy: scan in order; a kept column evicts every
    later column correlated above the threshold with it.  ``order="name"``
    scans in sorted column-name order (the survivors keep the input order).
    """
    cols = list(cols)
    if order == "name":
        by_name = sorted(cols)
        got = set(corr_filter(df, by_name, threshold, keep, greedy))
        return [c for c in cols if c in got]
    if greedy and len(cols) < 2:
        return cols
    m = np.abs(correlation_matrix(df, cols) if matrix is None else matrix)
    with np.errstate(invalid="ignore"):
        high = np.nan_to_num(m, nan=0.0) > threshold
    if not greedy:
        return [c for j, c in enumerate(cols) if c in keep or not high[:j, j].any()]
    dropped = set()
    for i in range(len(cols)):
        if i in dropped:
            continue
        for j in range(i + 1, len(cols)):
            if j not in dropped and high[i, j]:
                dropped.add(j)
    return [c for j, c in enumerate(cols) if j not in dropped]


def vif_scores(m: np.ndarray) -> np.ndarray:
    """VIF = diagonal of the inverse correlation matrix (+inf when singular)."""
    try:
        inv = np.linalg.inv(m)
        d = np.diag(inv).copy()
        if not np.all(np.isfinite(d)):
            raise np.linalg.LinAlgError
        cond = np.linalg.cond(m)
        if cond > 1e12:
            d = np.where(d > 0, d, np.inf)
        return d
    except np.linalg.LinAlgError:
        return np.full(m.shape[0], np.inf)


def vif_filter(df: DataFrame, cols, threshold: float = 10.0) -> tuple[list[str], list[tuple[str, float]]]:
    """SEL-04 iterative VIF.  Returns (dropped in order, [(column, vif)] of survivors).

    As the reference: median-fill, constant columns left out, drop the worst
    while max VIF > threshold and more than one column remains.  One Spark pass
    for the medians and one for the correlation matrix of the filled data.
    """
    cols = list(cols)
    df = without_nan(df, cols)
    med = quantiles(df, cols, [0.5])
    filled = df.select(*[F.coalesce(qcol(c).cast("double"), F.lit(med[c][0])).alias(c)
                         for c in cols if med[c][0] is not None])
    var = variances(filled, filled.columns)
    live = [c for c in filled.columns if var[c] not in (None, 0.0) and var[c] > 0]
    if len(live) < 2:
        return [], [(c, 1.0) for c in live]
    full = correlation_matrix(filled, live)
    idx = list(range(len(live)))
    dropped = []
    while len(idx) > 1:
        sub = full[np.ix_(idx, idx)]
        v = vif_scores(sub)
        worst = int(np.argmax(v))
        if not v[worst] > threshold:
            break
        dropped.append(live[idx[worst]])
        idx.pop(worst)
    sub = full[np.ix_(idx, idx)]
    v = vif_scores(sub) if len(idx) > 1 else np.ones(1)
    return dropped, [(live[i], float(x)) for i, x in zip(idx, v)]


def top_correlated(df: DataFrame, target: str, cols, n: int = 30) -> list[tuple[str, float]]:
    """SORT-02 / SEL-08: top-n columns by |corr with target| (target itself skipped)."""
    cols = [c for c in cols if c != target]
    row = df.agg(*[pair_corr(known(qcol(c).cast("double")), known(qcol(target).cast("double"))).alias(str(i))
                   for i, c in enumerate(cols)]).first()
    scored = [(c, abs(row[str(i)])) for i, c in enumerate(cols) if row[str(i)] is not None]
    scored.sort(key=lambda t: -t[1])
    return scored[:n]
