"""Feature construction (FE-01..12).

All features are column expressions added in one ``select``; only the
percentile caps of interactions need data, and those are batched per
dependency level into one quantile job.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.functions.stats import qcol, quantiles
from kiln.operators.base import ColumnRules, register

# Fixed values of the reference's feature rules.
RATIO_EPS = 1e-6          # interaction ratio: c1 / (c2 + 1e-6)
PAIR_RATIO_EPS = 1e-5     # pairwise ratio: a / (b + 1e-5)
DEFAULT_CLIP_PCT = 99     # interaction cap percentile


def _num(c: str) -> Column:
    return qcol(c).cast("double")


def ratio_expr(a: str, b: str, zero_fill: bool = False) -> Column:
    """FE-01: a / (b + 1e-6); zero_fill: b == 0 -> null first, null result -> 0."""
    den = F.nullif(_num(b), F.lit(0.0)) if zero_fill else _num(b)
    r = F.try_divide(_num(a), den + F.lit(RATIO_EPS))
    return F.coalesce(r, F.lit(0.0)) if zero_fill else r


def product_expr(a: str, b: str) -> Column:
    """FE-02: a * b (booleans count as 0/1)."""
    return _num(a) * _num(b)


def interaction_expr(spec: dict) -> Column:
    a, b = spec["pair"]
    if spec["logic"] == "ratio":
        return ratio_expr(a, b, spec.get("error_handling") == "zero_fill")
    if spec["logic"] == "multiplication":
        return product_expr(a, b)
    raise ValueError(f"interaction {spec.get('name')}: unknown logic {spec['logic']!r}")


@register("interactions")
def _apply_interactions(spec: dict, df: DataFrame) -> DataFrame:
    for one in spec["specs"]:
        if all(c in df.columns for c in one["pair"]):
            cap, name = one.get("cap"), one["name"]
            df = df.withColumn(name, interaction_expr(one))
            if cap is not None:
                df = df.withColumn(name, F.when(qcol(name) > F.lit(cap), F.lit(cap)).otherwise(qcol(name)))
    return df


def build_interactions(df: DataFrame, specs: list[dict], clip: bool = True) -> DataFrame:
    """FE-03: the table with its interactions, see :func:`fit_interactions`."""
    return fit_interactions(df, specs, clip).transform(df)


def fit_interactions(df: DataFrame, specs: list[dict], clip: bool = True) -> ColumnRules:
    """FE-03 as a fitted step: specs in order (later pairs may use earlier results) with their caps.

    A spec whose columns are absent at its turn is skipped.  Each result is
    capped at its ``outlier_clipping_percentile`` (default 99) unless ``clip``
    is False.  Consecutive independent specs form one level: one quantile job
    for all their caps.
    """
    fitted: list[dict] = []

    def flush(df, level):
        if not level:
            return df
        caps = {}
        if clip:  # one quantile job for the whole level (every column's own percentile)
            built = df.withColumns({s["name"]: interaction_expr(s) for s in level})
            pct = {s["name"]: s.get("outlier_clipping_percentile", DEFAULT_CLIP_PCT) / 100.0 for s in level}
            probs = sorted(set(pct.values()))
            q = quantiles(built, list(pct), probs)
            caps = {c: q[c][probs.index(p)] for c, p in pct.items()}
        fitted.extend({**s, "cap": caps.get(s["name"])} for s in level)
        return _apply_interactions({"specs": fitted[-len(level):]}, df)

    level: list[dict] = []
    for s in specs:
        a, b = s["pair"]
        outs = {t["name"] for t in level}
        ins = {x for t in level for x in t["pair"]}
        if a in outs or b in outs or s["name"] in outs or s["name"] in ins:
            df, level = flush(df, level), []
        have = set(df.columns) | {t["name"] for t in level}
        if a in have and b in have:
            level.append(s)
    flush(df, level)
    return ColumnRules.of("interactions", {"specs": fitted})


def pairwise(df: DataFrame, cols, minus: bool = True, ratio: bool = True) -> DataFrame:
    """FE-04/05: for every i < j, ``{a}_minus_{b}`` and ``{a}_ratio_{b}`` in one select."""
    new = []
    for a, b in combinations(cols, 2):
        if minus:
            new.append((_num(a) - _num(b)).alias(f"{a}_minus_{b}"))
        if ratio:
            new.append(F.try_divide(_num(a), _num(b) + F.lit(PAIR_RATIO_EPS)).alias(f"{a}_ratio_{b}"))
    return df.select("*", *new)


def as_timestamp(df: DataFrame, c: str) -> Column:
    """FE-07: lenient parse; bad strings become null."""
    dt = df.schema[c].dataType
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return qcol(c)
    if isinstance(dt, T.DateType):
        return qcol(c).cast("timestamp_ntz")
    return F.try_to_timestamp(qcol(c).cast("string")).cast("timestamp_ntz")


def date_parts(df: DataFrame, cols) -> DataFrame:
    """FE-06: ``{c}_year``, ``{c}_month``, ``{c}_dow`` (Monday = 0)."""
    new = []
    for c in cols:
        t = as_timestamp(df, c)
        new += [F.year(t).alias(f"{c}_year"), F.month(t).alias(f"{c}_month"),
                F.weekday(t).alias(f"{c}_dow")]
    return df.select("*", *new)


def elapsed_days(a: Column, b: Column) -> Column:
    """Whole elapsed 24 h days from a to b, floored (time-of-day matters)."""
    micros = F.timestamp_diff("MICROSECOND", a, b)
    return F.floor(micros / F.lit(86_400_000_000)).cast("long")


def date_diffs(df: DataFrame, cols) -> DataFrame:
    """FE-08: for i < j, ``{c2}_minus_{c1}_days``."""
    ts = {c: as_timestamp(df, c) for c in cols}
    new = [elapsed_days(ts[a], ts[b]).alias(f"{b}_minus_{a}_days") for a, b in combinations(cols, 2)]
    return df.select("*", *new)


# ---------------------------------------------------------------- labels
# Age limits of the segment-name prefix.
YOUNG_AGE, SENIOR_AGE = 30, 50


def segment_name(inc: Column, spd: Column, age: Column, default: str = "") -> Column:
    """FE-11: rule ladder, then "Young " (age < 30) / "Senior " (age > 50) prefix."""
    label = (F.when((inc > 70) & (spd > 70), "VIP / Top Spenders")
             .when((inc > 70) & (spd < 40), "High-Income / Frugal")
             .when((inc < 40) & (spd > 70), "Young / Trend-Setters")
             .when((inc < 40) & (spd < 40), "Budget Conscious")
             .when((inc >= 40) & (inc <= 70), "Middle-Class / Average")
             .otherwise(F.lit(default)))
    return (F.when(age < YOUNG_AGE, F.concat(F.lit("Young "), label))
            .when(age > SENIOR_AGE, F.concat(F.lit("Senior "), label)).otherwise(label))


def trait(z: Column, hi: float = 0.5, lo: float = -0.5) -> Column:
    """FE-12: z > 0.5 High, z < -0.5 Low, otherwise (null included) Average."""
    return F.when(z > hi, "High").when(z < lo, "Low").otherwise("Average")
