"""Imputation (IMP-01..04, AGG-12): fit = one aggregate, transform = coalesce.  Null and NaN are missing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.functions.stats import known, qcol, quantiles, without_nan
from kiln.operators.base import ColumnRules, register


@register("fill")
def _apply_fill(spec: dict, df: DataFrame) -> DataFrame:
    """coalesce(column, fill), NaN as null.  An integral column keeps its type when the
    fill value is a whole number; otherwise it widens to double."""
    from kiln.functions.names import INTEGRAL_TYPES
    fill = {c: v for c, v in spec["fill"].items() if c in df.columns}
    if not fill:
        return df
    out = {}
    for c, v in fill.items():
        dt = df.schema[c].dataType
        if isinstance(dt, INTEGRAL_TYPES) and isinstance(v, (int, float)) and float(v).is_integer():
            out[c] = F.coalesce(qcol(c), F.lit(int(v)).cast(dt))
        else:
            x = known(qcol(c)) if dt.typeName() in ("double", "float") else qcol(c)
            out[c] = F.coalesce(x, F.lit(v))
    return df.withColumns(out)


def fit_impute(df: DataFrame, cols, method: str = "median", value=None,
               exact: bool = True) -> ColumnRules:
    """method: mean | median | constant (``value``, default ``Missing``) | zero."""
    cols = [c for c in cols if c in df.columns]
    df = without_nan(df, cols)
    if method == "mean":
        row = df.agg(*[F.avg(qcol(c).cast("double")).alias(str(i)) for i, c in enumerate(cols)]).first() \
            if cols else None
        fill = {c: row[str(i)] for i, c in enumerate(cols)} if cols else {}
    elif method == "median":
        q = quantiles(df, cols, [0.5], exact=exact)
        fill = {c: q[c][0] for c in cols}
    elif method == "constant":
        fill = {c: ("Missing" if value is None else value) for c in cols}
    elif method == "zero":
        fill = {c: 0 for c in cols}
    else:
        raise ValueError(f"unknown imputation method {method!r}")
    # an all-null column has no statistic: leave it (reported by the profile)
    return ColumnRules.of("fill", {"method": method, "fill": {c: v for c, v in fill.items() if v is not None}})


def impute(df: DataFrame, cols, method: str = "median", value=None) -> DataFrame:
    return fit_impute(df, cols, method, value).transform(df)


def null_cells(df: DataFrame) -> int:
    """AGG-10: total missing cells (null or NaN), one pass."""
    if not df.columns:
        return 0
    df = without_nan(df)
    return df.agg(sum(F.count_if(qcol(c).isNull()) for c in df.columns).alias("n")).first()["n"] or 0
