"""Time-series path: audit (PLAN-06) and cleaning (fill, drop ids, no dedup)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from kiln.functions.names import drop_columns
from kiln.functions.stats import qcol
from kiln.operators.profile import profile
from kiln.operators.timeseries import fill_forward
from kiln.plans.rules import plan_timeseries


def audit(df: DataFrame, order_by: str, position: str | None = None, partition_by=None) -> dict:
    return plan_timeseries(df, profile(df, with_mad=False), order_by, partition_by, position)


def clean(df: DataFrame, plan: dict, order_by, partition_by=None) -> DataFrame:
    """Forward fill in time order (first rows back-filled), then drop id
    columns; duplicates are kept (repeated readings are normal in series).
    A series that the audit found out of order (``is_sorted`` false) is put out
    in time order (SORT-01: a range-partitioned sort, so files follow each other);
    else rows stay where they lie."""
    order, keys = ([x] if isinstance(x, str) else list(x or []) for x in (order_by, partition_by))
    filled = fill_forward(df, order, keys)
    out = drop_columns(filled, [c for c in plan.get("id_cols", []) if c not in {*order, *keys}])
    if plan.get("temporal_consistency", {}).get("is_sorted") is False:
        out = out.orderBy(*[qcol(c) for c in order])
    return out
