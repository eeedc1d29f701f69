"""Supervised path: audit (PLAN-03/04/05), silver cleaning, gold features (FE-09).

audit:  id columns, dynamic (pps, vif) thresholds, duplicate ratio, weak features
clean:  split -> importance filter -> VIF -> median/categorical impute ->
        greedy correlation filter -> keep-first dedup -> conflicting labels
gold:   date parts + date diffs + numerics + pairwise + factorized codes ->
        align to base columns -> median impute -> robust scale -> selection
"""

from __future__ import annotations

from itertools import combinations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.functions.names import columns_like, drop_columns, select_types
from kiln.functions.stats import qcol
from kiln.operators.aggregate import duplicate_ratio
from kiln.operators.dedup import dedup_signal, drop_conflicting_labels
from kiln.operators.impute import fit_impute
from kiln.operators.profile import profile
from kiln.operators.scale import fit_robust_scale
from kiln.operators.select import corr_filter, vif_filter
from kiln.session import held
from kiln.plans.rules import id_columns, split_columns, thresholds

GREEDY_CORR = 0.8  # fixed value: silver correlation filter threshold
GREEDY_ORDER = "name"  # scan order of the greedy filter (evidence: the iris silver golden)


def audit(df: DataFrame, target: str, with_pps: bool = True) -> dict:
    prof = profile(df, with_mad=False)
    n_var = len(df.columns)
    ids = [r["column"] for r in id_columns(prof).orderBy("position").collect()]
    th = thresholds(n_var)
    weak, strong = [], None
    if with_pps:
        from kiln.operators.model_select import predictive_power
        feats = [c for c in select_types(df, ("Numeric", "Boolean", "DateTime", "Text")) if c != target and c not in ids]
        pps = predictive_power(df, feats, target) if feats else []
        weak = [c for c, v in pps if v < th["pps_threshold"]]
        strong = len([c for c, v in pps if v > 0.1])
        th = thresholds(n_var, strong)
    return {"config": {"pps_threshold": th["pps_threshold"], "vif_threshold": th["vif_threshold"]},
            "id_cols": ids, "duplicate_ratio": duplicate_ratio(df, exclude=ids), "weak_features": weak}


def clean(df: DataFrame, target: str, plan: dict, order_by: str | None = None,
          with_importance: bool = True) -> DataFrame:
    """Silver chain.  ``order_by`` (row order for keep-first dedup) is carried
    as a hidden column even when the split drops it as an id."""
    prof = profile(df, with_mad=False)
    roles = {r["column"]: r["role"] for r in split_columns(prof, target).collect()}
    to_drop = [c for c, r in roles.items() if r == "drop"]
    num = [c for c in df.columns if roles.get(c) == "numeric"]
    cat = [c for c in df.columns if roles.get(c) == "categorical"]
    active = [c for c in num if c not in to_drop]
    if with_importance and active:
        from kiln.operators.model_select import importance_filter
        _imp, weak = importance_filter(df, active, target, plan["config"]["pps_threshold"])
        to_drop += weak
    active = [c for c in active if c not in to_drop]
    if len(active) > 1:
        dropped, _ = vif_filter(df, active, plan["config"]["vif_threshold"])
        to_drop += dropped
    final_num = [c for c in num if c not in to_drop]
    final_cat = [c for c in cat if c not in to_drop]
    src = df.withColumn("__order", qcol(order_by)) if order_by else df
    out = drop_columns(src, to_drop)
    if final_num:
        out = fit_impute(out, final_num, "median").transform(out)
        if len(final_num) >= 2:
            keep = corr_filter(out, final_num, GREEDY_CORR, greedy=True, order=GREEDY_ORDER)
            out = drop_columns(out, [c for c in final_num if c not in keep])
    final_text = [c for c in final_cat if out.schema[c].dataType.simpleString() == "string"]
    if final_text:  # other types have no room for a word: their nulls stay
        out = fit_impute(out, final_text, "constant", "Missing").transform(out)
    ids = [c for c in plan.get("id_cols", []) if c in out.columns]
    hidden = ["__order"] if order_by else []
    out = dedup_signal(out, ids + hidden, hidden[0] if hidden else (ids[0] if ids else None))
    return drop_conflicting_labels(out.drop(*hidden), target)


def generate_features(df: DataFrame, order_by: str | None = None, carry=()) -> DataFrame:
    """FE-09 feature frame: dates -> parts and pairwise day differences,
    numerics + pairwise minus/ratio, strings -> first-appearance codes.
    ``carry`` columns pass through untouched (e.g. the target).  Names are trimmed first."""
    from kiln.functions.names import strip_names
    from kiln.operators.encode import factorize
    from kiln.operators.features import as_timestamp, elapsed_days
    df, order_by = strip_names(df), order_by.strip() if order_by else order_by
    carry = [c for c in (x.strip() for x in carry) if c in df.columns]
    src = [c for c in df.columns if c not in carry]
    dates = [c for c in columns_like(src, "date", loose=True)]
    nums = [c for c in select_types(df.select(*[qcol(c) for c in src]), ("Numeric",)) if c not in dates]
    cats = [c for c in select_types(df.select(*[qcol(c) for c in src]), ("Text",)) if c not in dates]
    sel = []
    for c in dates:
        t = as_timestamp(df, c)
        sel += [F.year(t).alias(f"{c}_year"), F.month(t).alias(f"{c}_month"), F.weekday(t).alias(f"{c}_dow")]
    for a, b in combinations(dates, 2):
        sel.append(elapsed_days(as_timestamp(df, a), as_timestamp(df, b)).alias(f"{b}_minus_{a}_days"))
    sel += [qcol(c) for c in nums]
    for a, b in combinations(nums, 2):
        sel.append((qcol(a) - qcol(b)).alias(f"{a}_minus_{b}"))
        sel.append(F.try_divide(qcol(a).cast("double"), qcol(b).cast("double") + F.lit(1e-5)).alias(f"{a}_ratio_{b}"))
    extra = [qcol(order_by).alias("__order")] if (cats and order_by) else []
    out = df.select(*sel, *[qcol(c) for c in cats], *extra, *[qcol(c) for c in carry])
    if cats:
        if not order_by:
            raise ValueError("factorize needs order_by (first appearance)")
        out = factorize(out, cats, "__order").drop("__order")
    return out


def gold_features(silver: DataFrame, plan: dict, order_by: str | None = None) -> tuple[DataFrame, PipelineModel]:
    """plan: selected_features, base_columns, target_column, target_exists.
    Features are aligned to base_columns (absent -> 0), median-imputed and
    robust-scaled; the target stays in the same row (no positional zip)."""
    from kiln.functions.names import align_schema, strip_names
    silver, target = strip_names(silver), plan["target_column"].strip()
    has_target = bool(plan.get("target_exists")) and target in silver.columns
    base_cols = [c for c in plan["base_columns"] if c != target]
    with held(silver):      # the ranks, medians and quartiles below are passes over the same rows
        eng = generate_features(silver, order_by, carry=[target] if has_target else [])
        X = align_schema(eng, base_cols + ([target] if has_target else []))
        imp = fit_impute(X, base_cols, "median")
        X = imp.transform(X)
        sc = fit_robust_scale(X, base_cols)
        X = sc.transform(X)
    out_cols = list(plan["selected_features"]) + ([target] if has_target else [])
    return X.select(*[qcol(c) for c in out_cols]), PipelineModel([imp, sc])


def plan_gold_supervised(silver: DataFrame, target: str, max_features: int = 30,
                         order_by: str | None = None) -> dict:
    """Gold audit over columns of every type: names trimmed, id-named columns out, SULOV
    + boosted trees, then RFE to at most ``max_features``.  With fewer than two labels
    the most correlated columns stand in."""
    from kiln.functions.names import resolve_column, strip_names
    from kiln.operators.model_select import rfe, sulov_select
    from kiln.operators.select import top_correlated
    from kiln.plans.rules import problem_type
    silver = strip_names(silver)
    target = resolve_column(silver, target)
    ids = [c for c in columns_like(silver, "id") if c != target]
    clean = drop_columns(silver, ids)
    feats = [c for c in select_types(clean, ("Numeric", "Boolean", "DateTime", "Text")) if c != target]
    labels = clean.where(qcol(target).isNotNull()).select(target).distinct().limit(2).count()
    if labels < 2:  # nothing to tell apart: no model can be fitted
        nums = [c for c in select_types(clean, ("Numeric",)) if c != target]
        ranked = top_correlated(clean, target, nums, max_features) if target in select_types(clean, ("Numeric",)) else []
        selected = [c for c, _ in ranked] or feats[:max_features]
    else:
        selected, _mi = sulov_select(clean, feats, target)
    if len(selected) > 1:
        selected = rfe(clean, selected, target, n=min(max_features, len(selected)))
    return {"selected_features": selected, "base_columns": [c for c in clean.columns if c != target],
            "target_column": target, "target_exists": True, "model_type": problem_type(silver, target, "gold")}
