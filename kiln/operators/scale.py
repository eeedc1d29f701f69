"""Scalers (SC-01/02) and the power transform (TRF-03).

Exact semantics of the reference's library defaults:
* robust: (x - median) / IQR, linear-interpolated quantiles, IQR 0 -> 1;
* standard: (x - mean) / population std, std 0 -> 1.
Spark ML's RobustScaler is approximate and StandardScaler uses the sample
std, so both are expressed here as fitted column expressions instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.functions.stats import known, qcol, quantiles, without_nan
from kiln.operators.base import ColumnRules, register


@register("affine")
def _apply_affine(spec: dict, df: DataFrame) -> DataFrame:
    out = {c: (qcol(c).cast("double") - F.lit(center)) / F.lit(scale)
           for c, (center, scale) in spec["params"].items() if c in df.columns}
    return df.withColumns(out) if out else df


def fit_robust_scale(df: DataFrame, cols, exact: bool = True) -> ColumnRules:
    cols = [c for c in cols if c in df.columns]
    q = quantiles(without_nan(df, cols), cols, [0.25, 0.5, 0.75], exact=exact)
    params = {}
    for c in cols:
        q1, med, q3 = q[c]
        if med is None:
            continue
        iqr = q3 - q1
        params[c] = (med, iqr if iqr != 0 else 1.0)
    return ColumnRules.of("affine", {"method": "robust", "params": params})


def fit_standard_scale(df: DataFrame, cols) -> ColumnRules:
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return ColumnRules.of("affine", {"method": "standard", "params": {}})
    row = df.agg(*[e for i, c in enumerate(cols) for e in (
        F.avg(known(qcol(c).cast("double"))).alias(f"m{i}"),
        F.stddev_pop(known(qcol(c).cast("double"))).alias(f"s{i}"))]).first()
    params = {}
    for i, c in enumerate(cols):
        m, s = row[f"m{i}"], row[f"s{i}"]
        if m is None:
            continue
        params[c] = (m, s if s else 1.0)
    return ColumnRules.of("affine", {"method": "standard", "params": params})


def fit_power_transform(df: DataFrame, cols):
    """Yeo-Johnson then standardise (population std): returns [yj, scaler]."""
    from kiln.operators.transform import fit_yeo_johnson
    yj = fit_yeo_johnson(df, cols)
    sc = fit_standard_scale(yj.transform(df), cols)
    return [yj, sc]
