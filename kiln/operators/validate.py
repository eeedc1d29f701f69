"""Data-integrity suite (VAL-01..12) as one findings table.

Output: (check, column, value, limit, passed).  Each family of checks is one
aggregate over the table (text checks share one unpivoted value-count stage),
so the suite costs a handful of passes whatever the width of the table.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.functions.names import select_types
from kiln.functions.names import semantic_type
from kiln.functions.stats import known, qcol, quantiles

# Default limits of the integrity checks and the null spellings.
NULL_SPELLINGS = ["", "null", "none", "nan", "na", "n/a", "-", "?"]
SPECIAL_ONLY = r"^[^\p{L}\p{N}]+$"
LIMITS = {"single_value": 1.0, "special_characters": 0.001, "mixed_nulls": 1.0,
          "mixed_types_low": 0.01, "mixed_types_high": 0.2, "string_mismatch": 0.0,
          "duplicates": 0.05, "string_length": 0.05, "conflicting_labels": 0.0,
          "outliers": 0.05, "local_outliers": 0.05, "feature_correlation": 0.9, "feature_label_pps": 0.8}
FENCE = 1.5
SPARSE = 1.5        # a local outlier factor above it marks a row

SCHEMA = "check string, column string, value double, limit double, passed boolean"


def validate(df: DataFrame, label: str | None = None, limits: dict | None = None,
             with_pps: bool = False, id_cols=(), with_local_outliers: bool = False) -> DataFrame:
    """Findings table.  With a ``label``: conflicting labels (VAL-08) and, when
    ``with_pps``, feature-label PPS < 0.8 (VAL-10) and identifier-label PPS
    = 0 (VAL-11) from shallow-tree predictive power scores.  With
    ``with_local_outliers`` (it needs every row's exact neighbours): the share of
    rows that lie sparser than their neighbours, numeric columns over their range."""
    from kiln.session import PassInput
    with PassInput(df) as src:
        return _validate(src, label, limits, with_pps, id_cols, with_local_outliers)


def local_outlier_share(df: DataFrame, num) -> float:
    """Share of local outliers among the rows with every numeric value; 0 without such rows."""
    from kiln.operators.neighbours import local_outliers
    value = {c: F.when(F.abs(x) < float("inf"), x) for c, x in ((c, known(qcol(c).cast("double"))) for c in num)}
    ends = df.agg(*[f(value[c]).alias(f"{e}{i}") for i, c in enumerate(num) for e, f in (("low", F.min), ("high", F.max))]).first()
    live = [(i, c) for i, c in enumerate(num) if ends[f"low{i}"] is not None]
    if not live:
        return 0.0
    scaled = df.select(*[((value[c] - ends[f"low{i}"]) / ((ends[f"high{i}"] - ends[f"low{i}"]) or 1.0)).alias(f"x{i}") for i, c in live])
    r = local_outliers(scaled, scaled.columns).agg(F.count("lof").alias("n"), F.count_if(F.col("lof") > SPARSE).alias("o")).first()
    return r["o"] / r["n"] if r["n"] else 0.0


def _validate(df: DataFrame, label, limits, with_pps, id_cols, with_local_outliers=False) -> DataFrame:
    lim = {**LIMITS, **(limits or {})}
    spark = df.sparkSession
    cols = [c for c in df.columns if c != label]
    text = [c for c in select_types(df, ("Text",)) if c != label]
    num = [c for c in select_types(df, ("Numeric",)) if c != label]
    rows = []

    # VAL-01 single value (distinct non-null values per column, one value-count stage)
    parts = [F.struct(F.lit(i).alias("i"), qcol(c).cast("string").alias("v")) for i, c in enumerate(cols)]
    nd = {r["i"]: r["n"] for r in df.select(F.explode(F.array(*parts)).alias("p")).select("p.*")
          .where(F.col("v").isNotNull()).groupBy("i", "v").count()
          .groupBy("i").agg(F.count(F.lit(1)).alias("n")).collect()}
    for i, c in enumerate(cols):
        v = float(nd.get(i, 0))
        rows.append(("single_value", c, v, lim["single_value"], v > lim["single_value"]))

    # VAL-02/03/04/07 text checks in one aggregate
    if text:
        aggs = []
        for i, c in enumerate(text):
            x = qcol(c).cast("string")
            norm = F.lower(F.trim(x))
            aggs += [F.count(x).alias(f"n{i}"),
                     F.count_if(x.rlike(SPECIAL_ONLY)).alias(f"sp{i}"),
                     F.count_if(x.isNull()).alias(f"nl{i}"),
                     # spellings present: one count_if per spelling (no count_distinct -> no Expand)
                     sum(F.when(F.count_if(norm == sp) > 0, 1).otherwise(0) for sp in NULL_SPELLINGS)
                     .alias(f"ns{i}"),
                     F.count_if(x.try_cast("double").isNotNull()).alias(f"num{i}")]
        r = df.agg(*aggs).first()
        for i, c in enumerate(text):
            n = r[f"n{i}"]
            sp = r[f"sp{i}"] / n if n else 0.0
            rows.append(("special_characters", c, sp, lim["special_characters"], sp <= lim["special_characters"]))
            kinds = float(r[f"ns{i}"] + (1 if r[f"nl{i}"] > 0 else 0))
            rows.append(("mixed_nulls", c, kinds, lim["mixed_nulls"], kinds <= lim["mixed_nulls"]))
            p = r[f"num{i}"] / n if n else 0.0
            minority = min(p, 1 - p)
            rows.append(("mixed_types", c, minority, lim["mixed_types_high"],
                         not (lim["mixed_types_low"] <= minority <= lim["mixed_types_high"])))
        # VAL-05 string mismatch: normalised forms with more than one raw variant
        sparts = [F.struct(F.lit(i).alias("i"), qcol(c).cast("string").alias("v")) for i, c in enumerate(text)]
        mm = {r["i"]: r["n"] for r in
              df.select(F.explode(F.array(*sparts)).alias("p")).select("p.*").where(F.col("v").isNotNull())
              .groupBy("i", F.regexp_replace(F.lower("v"), "[^\\p{L}\\p{N}]", "").alias("k"))
              .agg(F.count_distinct("v").alias("variants")).where("variants > 1")
              .groupBy("i").agg(F.count(F.lit(1)).alias("n")).collect()}
        for i, c in enumerate(text):
            v = float(mm.get(i, 0))
            rows.append(("string_mismatch", c, v, lim["string_mismatch"], v <= lim["string_mismatch"]))
        # VAL-07 string length outside the IQR fences of lengths
        lens = df.select(*[F.length(qcol(c)).alias(c) for c in text])
        q = quantiles(lens, text, [0.25, 0.75])
        out = lens.agg(*[F.count_if((F.col(c) < q[c][0] - FENCE * (q[c][1] - q[c][0]))
                                    | (F.col(c) > q[c][1] + FENCE * (q[c][1] - q[c][0]))).alias(f"o{i}")
                         for i, c in enumerate(text) if q[c][0] is not None]
                       + [F.count(F.lit(1)).alias("__n")]).first()
        for i, c in enumerate(text):
            if q[c][0] is None:
                continue
            v = out[f"o{i}"] / out["__n"] if out["__n"] else 0.0
            rows.append(("string_length", c, v, lim["string_length"], v <= lim["string_length"]))

    # VAL-06 duplicates
    from kiln.operators.aggregate import duplicate_ratio_df
    dr = duplicate_ratio_df(df).first()["duplicate_ratio"] if df.columns else 0.0
    dr = float(dr or 0.0)
    rows.append(("duplicates", "*", dr, lim["duplicates"], dr <= lim["duplicates"]))

    # VAL-08 conflicting labels
    if label:
        feats = [c for c in df.columns if c != label]
        g = df.groupBy(*[qcol(c) for c in feats]).agg(
            F.count(F.lit(1)).alias("n"), (F.min(qcol(label)) != F.max(qcol(label))).alias("bad"))
        r = g.agg(F.sum("n").alias("n"), F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)).alias("b")).first()
        v = (r["b"] or 0) / r["n"] if r["n"] else 0.0
        rows.append(("conflicting_labels", label, v, lim["conflicting_labels"], v <= lim["conflicting_labels"]))

    # VAL-10/11 predictive power of features / identifiers for the label
    if label and with_pps:
        from kiln.operators.model_select import predictive_power
        ids = [c for c in id_cols if c in df.columns and c != label]
        feats = [f.name for f in df.schema.fields if f.name not in [*ids, label] and semantic_type(f.dataType) != "Unsupported"]
        for c, v in predictive_power(df, feats + ids, label):
            if c in ids:
                rows.append(("identifier_label_pps", c, v, 0.0, v <= 0.0))
            else:
                rows.append(("feature_label_pps", c, v, lim["feature_label_pps"], v < lim["feature_label_pps"]))

    # VAL-09 outliers: rows outside the IQR fences, per numeric column
    if num:
        q = quantiles(df, num, [0.25, 0.75])
        live = [c for c in num if q[c][0] is not None]
        r = df.agg(*[F.count_if((qcol(c) < q[c][0] - FENCE * (q[c][1] - q[c][0]))
                                | (qcol(c) > q[c][1] + FENCE * (q[c][1] - q[c][0]))).alias(f"o{i}")
                     for i, c in enumerate(live)] + [F.count(F.lit(1)).alias("__n")]).first()
        for i, c in enumerate(live):
            v = r[f"o{i}"] / r["__n"] if r["__n"] else 0.0
            rows.append(("outliers", c, v, lim["outliers"], v <= lim["outliers"]))

    if num and with_local_outliers:
        v = local_outlier_share(df, num)
        rows.append(("local_outliers", "*", v, lim["local_outliers"], v <= lim["local_outliers"]))

    # VAL-12 feature-feature correlation
    if len(num) > 1:
        from kiln.operators.select import correlation_matrix
        m = correlation_matrix(df, num)
        for i, j in combinations(range(len(num)), 2):
            v = m[i, j]
            if v == v:  # not NaN
                rows.append(("feature_correlation", f"{num[i]}|{num[j]}", abs(float(v)),
                             lim["feature_correlation"], abs(float(v)) < lim["feature_correlation"]))
    return spark.createDataFrame(rows, SCHEMA)
