"""Plan rules (PLAN-01..09): decision tables over the profile DataFrame.

Every rule is a ``when``/``otherwise`` expression over the one-row-per-column
profile, so the plan is itself a (tiny) DataFrame that can be shown, saved,
joined or checked with SQL.  ``*_dict`` helpers collect a plan (bounded by the
number of columns) into the JSON-shaped documents the reference writes.
"""

from __future__ import annotations

import json
from collections import ChainMap
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Column names that contain "id" as a word: snake/space separated or camel case.
ID_NAME_REGEX = r"(^|[^A-Za-z0-9])(id|Id|ID)([^a-z]|$)|[a-z0-9](Id|ID)([^a-z]|$)"
DROP_MISSING = 0.6            # drop when p_missing > 0.6
DROP_DISTINCT = 1             # ... or n_distinct <= 1
MEDIAN_SKEW = 1.0             # numeric imputation: median if |skew| > 1 else mean
ONE_HOT_MAX = 10              # Text: one-hot if n_distinct <= 10 else rare label
IQR_FOLD = 1.5                # clip if max > q75 + 1.5 * iqr
TRANSFORM_SKEW = 0.75         # |skew| > 0.75: log if min > 0 else Yeo-Johnson
ROBUST_CV = 0.5               # scale: robust if cv > 0.5 else standard
GARBAGE_DISTINCT = 0.95       # id-named and >= 95 % distinct -> garbage
LOW_ENTROPY = 0.05            # normalised entropy below this -> garbage
PROTECT_CV = 0.5              # |cv| > 0.5 numeric -> protected
SUPERVISED_DROP_MISSING = 0.70

STEPS = ["drop", "impute_mean", "impute_median", "impute_categorical", "rare_label", "one_hot",
         "clip_iqr", "log", "yeo_johnson", "scale_robust", "scale_standard"]


def id_named(col: str = "column"):
    return F.col(col).rlike(ID_NAME_REGEX)


# ---------------------------------------------------------------- PLAN-01
def derive_policy(profile: DataFrame, overrides: dict | None = None) -> DataFrame:
    """Roles per column: (position, column, role) with role subject_id/garbage/protected."""
    p = profile
    idn = id_named()
    seq_id = F.col("is_sequence")
    low_ent = (F.col("type") == "Text") & (
        (F.col("n_distinct") <= 1)
        | (F.try_divide(F.col("entropy"), F.ln(F.col("n_distinct").cast("double"))) < LOW_ENTROPY))
    garbage = (idn & (F.col("is_unique") | (F.col("p_distinct") >= GARBAGE_DISTINCT))) | seq_id | low_ent
    subject_cand = idn & F.col("type").isin("Numeric", "Text") & (F.col("p_distinct") < GARBAGE_DISTINCT) \
        & (F.col("count") > 0)
    flagged = p.select("position", "column", "type", "cv",
                       F.coalesce(garbage, F.lit(False)).alias("g"),
                       F.coalesce(subject_cand, F.lit(False)).alias("s"))
    subj = flagged.where("s").agg(F.min_by("column", "position").alias("subject")).first()["subject"]
    ov = overrides or {}
    if "subject_id" in ov:
        subj = ov["subject_id"]
    rows = flagged.select(
        "position", "column",
        F.array_compact(F.array(
            F.when(F.col("column") == F.lit(subj), F.lit("subject_id")),
            F.when(F.col("g"), F.lit("garbage")),
            F.when(~F.col("g") & (F.col("type") == "Numeric") & (F.abs(F.col("cv")) > PROTECT_CV),
                   F.lit("protected")))).alias("roles"))
    roles = rows.select("position", "column", F.explode("roles").alias("role"))
    if ov.get("protected_features") is not None or ov.get("technical_garbage") is not None:
        spark = profile.sparkSession
        pos = {r["column"]: r["position"] for r in profile.select("column", "position").collect()}
        replaced = [r for r, k in (("protected", "protected_features"), ("garbage", "technical_garbage"))
                    if ov.get(k) is not None]
        keep = roles.where(~F.col("role").isin(*replaced))
        extra = [(pos.get(c, -1), c, "protected") for c in ov.get("protected_features") or []] + \
                [(pos.get(c, -1), c, "garbage") for c in ov.get("technical_garbage") or []]
        roles = keep.unionByName(spark.createDataFrame(extra, "position int, column string, role string")) \
            if extra else keep
    return roles


def policy_dict(roles: DataFrame, domain: str = "") -> dict:
    rs = roles.orderBy("position").collect()
    subj = [r["column"] for r in rs if r["role"] == "subject_id"]
    return {"domain": domain, "subject_id": subj[0] if subj else None,
            "protected_features": [r["column"] for r in rs if r["role"] == "protected"],
            "technical_garbage": [r["column"] for r in rs if r["role"] == "garbage"]}


# ---------------------------------------------------------------- PLAN-02
def plan_cleaning(profile: DataFrame, roles: DataFrame) -> DataFrame:
    """Clustering cleaning contract, long form: (position, column, step)."""
    r = (roles.groupBy("column").agg(
        F.bool_or(F.col("role") == "subject_id").alias("is_subject"),
        F.bool_or(F.col("role") == "garbage").alias("is_garbage"),
        F.bool_or(F.col("role") == "protected").alias("is_protected")))
    p = profile.join(F.broadcast(r), "column", "left").select(
        "*", *[F.coalesce(F.col(c), F.lit(False)).alias(c + "_")
               for c in ("is_subject", "is_garbage", "is_protected")])
    subj, garb, prot = F.col("is_subject_"), F.col("is_garbage_"), F.col("is_protected_")
    num, txt = F.col("type") == "Numeric", F.col("type") == "Text"
    skew = F.coalesce(F.col("skewness"), F.lit(0.0))
    quality_drop = (F.col("p_missing") > DROP_MISSING) | (F.coalesce(F.col("n_distinct"), F.lit(0)) <= DROP_DISTINCT)
    live = ~garb & ~subj & ~quality_drop
    miss = F.col("n_missing") > 0
    iqr, q75, mx = (F.coalesce(F.col(c), F.lit(0.0)) for c in ("iqr", "q75", "max"))
    steps = F.array(
        F.when(garb & ~subj, "drop").when(~garb & ~subj & quality_drop, "drop"),
        F.when(live & miss & num & (F.abs(skew) > MEDIAN_SKEW), "impute_median")
         .when(live & miss & num, "impute_mean").when(live & miss & txt, "impute_categorical"),
        F.when(live & txt & (F.col("n_distinct") <= ONE_HOT_MAX), "one_hot").when(live & txt, "rare_label"),
        F.when(live & num & ~prot & (iqr > 0) & (mx > q75 + IQR_FOLD * iqr), "clip_iqr"),
        F.when(live & num & ~prot & (F.abs(skew) > TRANSFORM_SKEW) & (F.coalesce(F.col("min"), F.lit(0.0)) > 0),
               "log").when(live & num & ~prot & (F.abs(skew) > TRANSFORM_SKEW), "yeo_johnson"),
        F.when(live & num & (F.coalesce(F.col("cv"), F.lit(0.0)) > ROBUST_CV), "scale_robust")
         .when(live & num, "scale_standard"),
        F.when(subj, "subject_id"))
    return p.select("position", "column", F.explode(F.array_compact(steps)).alias("step"))


def contract_dict(plan: DataFrame) -> dict:
    rs = plan.orderBy("position").collect()
    by = lambda s: [r["column"] for r in rs if r["step"] == s]
    subj = by("subject_id")
    return {"drop_features": by("drop"), "subject_id": subj[0] if subj else None,
            "imputation": {"mean": by("impute_mean"), "median": by("impute_median"),
                           "categorical": by("impute_categorical")},
            "encoding": {"one_hot": by("one_hot"), "rare_label": by("rare_label")},
            "transformations": {"log": by("log"), "yeo_johnson": by("yeo_johnson"),
                                "outlier_clipping": by("clip_iqr")},
            "scaling": {"robust": by("scale_robust"), "standard": by("scale_standard")}}


# ---------------------------------------------------------------- PLAN-03/04/05
def id_columns(profile: DataFrame, n_rows_col: str = "n") -> DataFrame:
    """is_unique or n_distinct == number of rows."""
    return profile.where(F.col("is_unique") | (F.col("n_distinct") == F.col(n_rows_col))) \
        .select("position", "column")


# The audit's thresholds by table width (columns up to and including the limit).
WIDTH_TIERS = (
    # limit, pps, vif
    (14, 0.005, 20.0),
    (50, 0.02, 10.0),
    (None, 0.05, 5.0),
)
# Thresholds and limits of the raise for tables with many strong features.
RAISED = {"pps": 0.001, "vif": 25.0}
RAISE_STRONG, RAISE_VIF_BELOW, RAISE_FLAGGED_SHARE, RAISE_SURVIVORS = 15, 20.0, 0.8, 10


def _tier(n_var: int) -> tuple[float, float]:
    return next((pps, vif) for limit, pps, vif in WIDTH_TIERS if limit is None or n_var <= limit)


def thresholds(n_var: int, strong_features: int | None = None, preserve_on_flagged: bool = False,
               n_flagged: int | None = None, n_features: int | None = None) -> dict:
    """Thresholds of the table's width, raised when it has many strong features.

    ``preserve_on_flagged`` adds the documented second trigger: most features are
    flagged weak, or few would survive."""
    pps, vif = _tier(n_var)
    many_strong = (strong_features or 0) > RAISE_STRONG and vif < RAISE_VIF_BELOW
    flagged = bool(preserve_on_flagged and n_features and n_flagged is not None
                   and (n_flagged / n_features > RAISE_FLAGGED_SHARE or n_features - n_flagged < RAISE_SURVIVORS))
    final = (RAISED["pps"], RAISED["vif"]) if many_strong or flagged else (pps, vif)
    return {"pps_threshold": final[0], "vif_threshold": final[1], "initial": (pps, vif)}


def thresholds_expr(n_var: F.Column):
    """The width's thresholds as a column expression pair (pps, vif), without the raise."""
    out = []
    for at in (1, 2):
        expr = F.lit(WIDTH_TIERS[-1][at])
        for tier in reversed(WIDTH_TIERS[:-1]):
            expr = F.when(n_var <= tier[0], tier[at]).otherwise(expr)
        out.append(expr)
    return tuple(out)


def split_columns(profile: DataFrame, target: str) -> DataFrame:
    """(position, column, role) role in drop / numeric / categorical; target skipped."""
    return profile.where(F.col("column") != target).select(
        "position", "column",
        F.when((F.col("n_missing") / F.col("n") > SUPERVISED_DROP_MISSING) | F.col("is_unique"), "drop")
        .when(F.col("type") == "Numeric", "numeric").otherwise("categorical").alias("role"))


# ---------------------------------------------------------------- PLAN-06
# What every time-series audit document says about its treatment.
TIMESERIES_CONFIG = {"imputation_strategy": "forward_fill", "interpolation": "linear",
                     "preserve_order": True, "stationarity_test_required": True}


def plan_timeseries(df: DataFrame, profile: DataFrame, order_by: str, partition_by=None, position: str | None = None) -> dict:
    """``position``: the column that holds the rows' order of arrival (``read_table(row_id=...)``
    stamps it).  Without one a table has no order, and is_sorted is None."""
    from kiln.operators.timeseries import is_ordered
    ids = [r["column"] for r in profile.where("is_unique").orderBy("position").collect()]
    return {"config": dict(TIMESERIES_CONFIG), "id_cols": ids,
            "temporal_consistency": {
                "is_sorted": is_ordered(df, order_by, position, partition_by),
                "has_date_column": any(c.lower() in ("date", "time", "timestamp") for c in df.columns)}}


# ---------------------------------------------------------------- PLAN-07/08/09
@dataclass(frozen=True)
class Selection:
    """Limits of the feature filters; named features are kept whatever they score."""
    correlation_threshold: float
    variance_threshold: float
    force_keep: tuple[str, ...]


@dataclass(frozen=True)
class Preprocessing:
    scaler: str
    imputation: str
    encoding: str
    pca: dict


# What a strategy document may leave out.
STRATEGY_DEFAULTS = {"max_correlation_threshold": 0.85, "variance_threshold": 0.01, "recommended_scaler": "PowerTransformer",
                     "imputation_strategy": "median", "categorical_encoding": "one-hot", "recommended_algorithm": "KMeans"}


@dataclass(frozen=True)
class GoldPlan:
    """A clustering gold plan: the entity key, what to build, what to select and how to prepare it."""
    subject_id: str | None
    recommended_algorithm: str
    priority_interactions: tuple[dict, ...]
    base_metrics: tuple[str, ...]
    aggregation_strategy: dict
    selection_params: Selection
    preprocessing: Preprocessing

    @classmethod
    def parse(cls, strategy: dict, numeric: list[str], subject: str | None) -> GoldPlan:
        """From a strategy document, the numeric columns and the policy's key."""
        def section(name: str) -> ChainMap:
            return ChainMap(strategy.get(name) or {}, STRATEGY_DEFAULTS)

        limits, prep = section("feature_selection"), section("preprocessing_metadata")
        wanted = tuple(strategy.get("interaction_priorities") or ())
        key = strategy.get("subject_id") or subject
        return cls(
            key, ChainMap(strategy, STRATEGY_DEFAULTS)["recommended_algorithm"], wanted, tuple(c for c in numeric if c != key), strategy.get("aggregation_strategy") or {},
            Selection(limits["max_correlation_threshold"], limits["variance_threshold"], tuple(x["name"] for x in wanted)),
            Preprocessing(prep["recommended_scaler"], prep["imputation_strategy"], prep["categorical_encoding"], prep.get("dimensionality_reduction_recommendation") or {}))

    def document(self) -> dict:
        """As a JSON document."""
        return json.loads(json.dumps(asdict(self)))


def plan_gold(profile: DataFrame, policy: dict, strategy: dict) -> dict:
    numeric = [r["column"] for r in profile.where(F.col("type") == "Numeric").orderBy("position").collect()]
    return GoldPlan.parse(strategy, numeric, policy.get("subject_id")).document()


def problem_type(df: DataFrame, target: str, rule: str = "gold") -> str:
    """gold: regression iff numeric and > 20 distinct; silver: classifier iff < 20 or string."""
    from kiln.functions.names import semantic_type
    from kiln.functions.stats import qcol
    nd = df.agg(F.count_distinct(qcol(target)).alias("n")).first()["n"]
    numeric = semantic_type(df.schema[target].dataType) == "Numeric"
    if rule == "gold":
        return "regression" if (numeric and nd > 20) else "classification"
    return "classification" if (nd < 20 or not numeric) else "regression"


def validate_strategy(strategy: dict, profile: DataFrame) -> list[str]:
    """Problems with a user-supplied feature strategy (empty list = valid)."""
    errs = []
    cols = {r["column"]: r for r in profile.collect()}
    made: set[str] = set()                       # interactions are built in order, so a later one may use an earlier one
    for it in strategy.get("interaction_priorities", []):
        if it.get("logic") not in ("ratio", "multiplication"):
            errs.append(f"interaction {it.get('name')}: logic must be ratio or multiplication")
        for c in it.get("pair", []):
            if c not in cols and c not in made:
                errs.append(f"interaction {it.get('name')}: unknown column {c}")
        made.add(it.get("name"))
    subj = strategy.get("subject_id")
    if subj and subj in cols and cols[subj]["is_unique"]:
        errs.append(f"subject_id {subj} is 1:1 with rows: not an entity key")
    n_generated = len(strategy.get("interaction_priorities", []))
    pca = (strategy.get("preprocessing_metadata", {}) or {}).get("dimensionality_reduction_recommendation", {})
    if n_generated > 15 and (pca or {}).get("method") != "PCA":
        errs.append("more than 15 generated features: PCA recommended")
    return errs
