"""Clustering path: execute a cleaning contract (raw -> silver).

Fixed step order: drop -> impute -> rare label -> one-hot -> clip -> log /
Yeo-Johnson -> scale.  Each step is fitted on the lazily transformed frame of
the previous steps (no intermediate table), so every fit is one aggregate over
the pruned source columns and the final silver frame is one fused projection.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from kiln.functions.names import drop_columns
from kiln.operators.encode import fit_one_hot, fit_rare_label
from kiln.operators.impute import fit_impute
from kiln.operators.outliers import fit_clip_iqr
from kiln.operators.scale import fit_robust_scale, fit_standard_scale
from kiln.operators.transform import fit_log, fit_yeo_johnson


def fit_cleaning(df: DataFrame, contract: dict, scale: bool = True) -> tuple[DataFrame, PipelineModel]:
    """Returns (silver DataFrame, fitted PipelineModel of the steps after the drop).
    ``scale=False`` stops before the scalers (see :func:`fit_scaling`)."""
    df = drop_columns(df, contract.get("drop_features", []))
    stages = []

    def step(fitted):
        nonlocal df
        stages.append(fitted)
        df = fitted.transform(df)

    imp = contract.get("imputation", {})
    if imp.get("mean"):
        step(fit_impute(df, imp["mean"], "mean"))
    if imp.get("median"):
        step(fit_impute(df, imp["median"], "median"))
    if imp.get("categorical"):
        step(fit_impute(df, imp["categorical"], "constant", "Missing"))
    enc = contract.get("encoding", {})
    if enc.get("rare_label"):
        step(fit_rare_label(df, enc["rare_label"]))
    if enc.get("one_hot"):
        step(fit_one_hot(df, enc["one_hot"]))
    tr = contract.get("transformations", {})
    if tr.get("outlier_clipping"):
        step(fit_clip_iqr(df, tr["outlier_clipping"], fold=1.5, tail="right"))
    if tr.get("log"):
        step(fit_log(df, tr["log"]))
    if tr.get("yeo_johnson"):
        step(fit_yeo_johnson(df, tr["yeo_johnson"]))
    if scale:
        scaled, scalers = fit_scaling(df, contract)
        stages += list(scalers.stages)
        df = scaled
    return df, PipelineModel(stages)


def fit_scaling(df: DataFrame, contract: dict) -> tuple[DataFrame, PipelineModel]:
    """The contract's robust / standard scalers (the last cleaning step)."""
    stages = []
    sc = contract.get("scaling", {})
    if sc.get("robust"):
        stages.append(fit_robust_scale(df, sc["robust"]))
        df = stages[-1].transform(df)
    if sc.get("standard"):
        stages.append(fit_standard_scale(df, sc["standard"]))
        df = stages[-1].transform(df)
    return df, PipelineModel(stages)


def clean(df: DataFrame, contract: dict) -> DataFrame:
    return fit_cleaning(df, contract)[0]


def audit_and_clean(df: DataFrame, policy_overrides: dict | None = None):
    """profile -> policy -> contract -> silver, all on Spark."""
    from kiln.operators.profile import profile
    from kiln.plans.rules import contract_dict, derive_policy, plan_cleaning
    prof = profile(df)
    roles = derive_policy(prof, policy_overrides)
    plan = plan_cleaning(prof, roles)
    contract = contract_dict(plan)
    silver, model = fit_cleaning(df, contract)
    return silver, contract, model


def fit_gold(silver: DataFrame, plan: dict, clip: bool = True, scaler: str | None = None,
             interactions_ready: bool = False):
    """Clustering gold path: interactions -> numeric features -> variance and
    correlation filters (force-kept interactions survive) -> imputation ->
    PowerTransformer (Yeo-Johnson + standardise) or robust scaling -> PCA when
    the plan asks for it.  Features are the plan's base metrics plus the
    interactions, the entity key excluded and carried through unscaled.
    Returns (gold DataFrame, fitted PipelineModel, feature list)."""
    from kiln.functions.names import select_types
    from kiln.operators.cluster import fit_pca
    from kiln.operators.features import fit_interactions
    from kiln.operators.scale import fit_power_transform
    from kiln.operators.select import corr_filter, variance_filter
    key = plan.get("subject_id")
    inter = plan.get("priority_interactions", []) or []
    stages = [] if interactions_ready else [fit_interactions(silver, inter, clip=clip)]
    df = silver if interactions_ready else stages[0].transform(silver)
    base = plan.get("base_metrics") or select_types(silver, ("Numeric",))
    feats = [c for c in list(base) + [i["name"] for i in inter] if c in df.columns and c != key]
    feats = list(dict.fromkeys(feats))
    sel = plan.get("selection_params", {}) or {}
    keep = sel.get("force_keep", []) or []
    feats = variance_filter(df, feats, sel.get("variance_threshold", 0.01), keep)
    feats = corr_filter(df, feats, sel.get("correlation_threshold", 0.85), keep)
    prep = plan.get("preprocessing", {}) or {}
    stages.append(fit_impute(df, feats, prep.get("imputation", "median")))
    df = stages[-1].transform(df)
    kind = scaler or prep.get("scaler") or plan.get("scaling") or "PowerTransformer"
    scale = fit_power_transform(df, feats) if kind == "PowerTransformer" else [fit_robust_scale(df, feats)]
    for st in scale:
        df = st.transform(df)
    stages += scale
    carry = [key] if key and key in df.columns else []
    pca_cfg = prep.get("pca", {}) or {}
    if pca_cfg.get("method") == "PCA":
        step, ratios = fit_pca(df, feats, retain=pca_cfg.get("variance_retention_threshold", 0.95))
        names = [f"PC{i + 1}" for i in range(len(ratios))]
        return step.transform(df).select(*carry, *names), PipelineModel([*stages, step]), names
    return df.select(*carry, *feats), PipelineModel(stages), feats


def segment(df: DataFrame, strategy: dict | None = None, algo: str | None = None,
            policy_overrides: dict | None = None, k: int | None = None, clip: bool = True,
            interactions_on: str = "unscaled", min_cluster_size: int = 0) -> dict:
    """The whole clustering path as one call (the reference's launch scripts):
    profile -> policy -> contract -> silver -> gold plan -> gold features ->
    k sweep / fit -> personas.  Every stage runs on Spark; the returned dict
    holds the plans (small documents) and the lazy DataFrames / fitted models.

    ``interactions_on="unscaled"`` (default) builds the strategy's interactions
    from the cleaned but not yet scaled columns, so ratios do not divide by
    scaled values that cross zero; ``"scaled"`` reproduces the reference, which
    builds them from the scaled silver table.  ``min_cluster_size`` bars mixtures
    with a smaller cluster from the sweep's choice (:func:`fit_clusters`)."""
    from kiln.operators.cluster import fit_clusters, personas
    from kiln.operators.profile import profile
    from kiln.plans.rules import contract_dict, derive_policy, plan_cleaning, plan_gold, policy_dict
    prof = profile(df)
    roles = derive_policy(prof, policy_overrides)
    policy = policy_dict(roles)
    contract = contract_dict(plan_cleaning(prof, roles))
    strategy = strategy or {}
    if interactions_on == "unscaled":
        from kiln.operators.features import fit_interactions
        unscaled, clean_model = fit_cleaning(df, contract, scale=False)
        inter = fit_interactions(unscaled, strategy.get("interaction_priorities", []) or [], clip=clip)
        silver, scalers = fit_scaling(inter.transform(unscaled), contract)
        clean_model = PipelineModel([*clean_model.stages, inter, *scalers.stages])
    else:
        silver, clean_model = fit_cleaning(df, contract)
    gold_plan = plan_gold(profile(silver, with_mad=False), policy, strategy)
    if algo:
        gold_plan["recommended_algorithm"] = algo
    gold, gold_model, feats = fit_gold(silver, gold_plan, clip=clip,
                                       interactions_ready=interactions_on == "unscaled")
    algo_used = gold_plan["recommended_algorithm"]
    model, labeled, curve = fit_clusters(gold, feats, "GMM" if algo_used == "GMM" else "KMeans", k=k,
                                         min_cluster_size=min_cluster_size)
    return {"policy": policy, "contract": contract, "gold_plan": gold_plan, "silver": silver,
            "gold": gold, "features": feats, "curve": curve, "model": model, "labeled": labeled,
            "personas": personas(labeled, feats), "prep": PipelineModel(list(clean_model.stages)
                                                                         + list(gold_model.stages))}
