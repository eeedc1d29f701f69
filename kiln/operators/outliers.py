"""Outlier capping (OUT-01/02): fit = exact quantiles, transform = cap."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.functions.stats import known, qcol, quantiles, without_nan
from kiln.operators.base import ColumnRules, register


@register("cap")
def _apply_cap(spec: dict, df: DataFrame) -> DataFrame:
    out = {}
    for c, (lo, hi) in spec["bounds"].items():
        if c not in df.columns:
            continue
        x = qcol(c)
        if df.schema[c].dataType.typeName() in ("double", "float"):
            x = known(x)                       # NaN is larger than any number, and missing
        e = x
        if hi is not None:
            e = F.when(x > F.lit(hi), F.lit(hi)).otherwise(e)
        if lo is not None:
            e = F.when(x < F.lit(lo), F.lit(lo)).otherwise(e)
        out[c] = e
    return df.withColumns(out) if out else df


def fit_clip_iqr(df: DataFrame, cols, fold: float = 1.5, tail: str = "right") -> ColumnRules:
    """Winsorize at Q3 + fold*IQR (right), Q1 - fold*IQR (left) or both."""
    cols = [c for c in cols if c in df.columns]
    q = quantiles(without_nan(df, cols), cols, [0.25, 0.75])
    bounds = {}
    for c in cols:
        q1, q3 = q[c]
        if q1 is None:
            continue
        iqr = q3 - q1
        bounds[c] = (q1 - fold * iqr if tail in ("left", "both") else None,
                     q3 + fold * iqr if tail in ("right", "both") else None)
    return ColumnRules.of("cap", {"bounds": bounds})


def fit_clip_percentile(df: DataFrame, cols, pct: float = 99.0) -> ColumnRules:
    """Cap above the ``pct`` percentile (linear interpolation); nulls stay null."""
    cols = [c for c in cols if c in df.columns]
    q = quantiles(without_nan(df, cols), cols, [pct / 100.0])
    return ColumnRules.of("cap", {"bounds": {c: (None, q[c][0]) for c in cols if q[c][0] is not None}})
