"""Checkable queries over the driver tables: profile, plans, fitted steps,
features, aggregates, selection, integrity, ordered series, personas.

Every query reads whole tables.  Where the driver tables have no nulls, nulls
are injected by a fixed key rule in both engines (``CASE WHEN key % m = 0``),
"""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.catalog.registry import query, rounded, table

LI_NUM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
          "l_discount", "l_tax"]


def _union(parts):
    return "\nUNION ALL\n".join(parts)


# ====================================================================== profile
def _num_profile_sql(tbl, cols):
    parts = []
    for c in cols:
        parts.append(f"""SELECT '{c}' AS "column", count(*)::BIGINT AS n,
  (count(*) - count({c}))::BIGINT AS n_missing, count(DISTINCT {c})::BIGINT AS n_distinct,
  round(avg({c}), 5) AS mean, round(stddev_samp({c}), 6) AS std,
  round(min({c})::DOUBLE, 6) AS min, round(max({c})::DOUBLE, 6) AS max,
  round(skewness({c}), 6) AS skewness, round(kurtosis({c}), 6) AS kurtosis,
  round(quantile_cont({c}, 0.05), 6) AS q05, round(quantile_cont({c}, 0.25), 6) AS q25,
  round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75,
  round(quantile_cont({c}, 0.95), 6) AS q95,
  round(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25), 6) AS iqr,
  round(stddev_samp({c}) / avg({c}), 6) AS cv,
  round(quantile_cont(abs({c} - (SELECT quantile_cont({c}, 0.5) FROM {tbl})), 0.5), 6) AS mad,
  count_if({c} = 0)::BIGINT AS n_zeros, count_if({c} < 0)::BIGINT AS n_negative
FROM {tbl}""")
    return _union(parts)


@query("profile_numeric", _num_profile_sql("lineitem", LI_NUM))
def profile_numeric(spark, d):
    from kiln.operators.profile import profile
    p = profile(table(spark, d, "lineitem")).where(F.col("type") == "Numeric")
    return rounded(p.select("column", "n", "n_missing", "n_distinct", "mean", "std", "min", "max",
                            "skewness", "kurtosis", "q05", "q25", "q50", "q75", "q95", "iqr", "cv", "mad",
                            "n_zeros", "n_negative"), per_col={"mean": 5})


EV_TYPES = {"event_id": "Numeric", "ts": "DateTime", "user_id": "Numeric", "event_type": "Text",
            "value": "Numeric", "props": "Text"}


def _distinct_profile_sql(tbl, types):
    parts = []
    for c, t in types.items():
        parts.append(f"""SELECT '{c}' AS "column", '{t}' AS type, (SELECT count(*) FROM {tbl})::BIGINT AS n,
  ((SELECT count(*) FROM {tbl}) - coalesce(sum(k), 0))::BIGINT AS n_missing,
  count(*)::BIGINT AS n_distinct, round(count(*) / sum(k), 6) AS p_distinct,
  count_if(k = 1)::BIGINT AS n_unique, (count(*) = sum(k)) AS is_unique
FROM (SELECT {c} AS v, count(*) AS k FROM {tbl} WHERE {c} IS NOT NULL GROUP BY {c})""")
    return _union(parts)


@query("profile_distinct", _distinct_profile_sql("events", EV_TYPES))
def profile_distinct(spark, d):
    from kiln.operators.profile import profile
    p = profile(table(spark, d, "events"), with_mad=False)
    return rounded(p.select("column", "type", "n", "n_missing", "n_distinct", "p_distinct", "n_unique",
                            "is_unique"))


# ====================================================================== plans
ID_RE = r"(^|[^A-Za-z0-9])(id|Id|ID)([^a-z]|$)|[a-z0-9](Id|ID)([^a-z]|$)"


def _plan_profile_sql(tbl, cols):
    """Profile CTE (one row per column) with what the plan rules read.
    cols: list of (name, type, is_integral)."""
    parts = []
    for pos, (c, t, integral) in enumerate(cols):
        num = t == "Numeric"
        parts.append(f"""SELECT {pos} AS position, '{c}' AS "column", '{t}' AS type, {str(integral).upper()} AS is_integral,
  (SELECT count(*) FROM {tbl}) AS n, (SELECT count({c}) FROM {tbl}) AS cnt,
  (SELECT count(*) - count({c}) FROM {tbl}) AS n_missing,
  (SELECT (count(*) - count({c})) / count(*) FROM {tbl}) AS p_missing,
  (SELECT count(DISTINCT {c}) FROM {tbl}) AS n_distinct,
  (SELECT count(DISTINCT {c}) / count({c}) FROM {tbl}) AS p_distinct,
  (SELECT count(DISTINCT {c}) = count({c}) AND count({c}) > 0 FROM {tbl}) AS is_unique,
  (SELECT ln(sum(k)) - sum(k * ln(k)) / sum(k) FROM (SELECT count(*) AS k FROM {tbl} WHERE {c} IS NOT NULL GROUP BY {c})) AS entropy,
  {f"(SELECT min({c})::DOUBLE FROM {tbl})" if num else "NULL::DOUBLE"} AS min,
  {f"(SELECT max({c})::DOUBLE FROM {tbl})" if num else "NULL::DOUBLE"} AS max,
  {f"(SELECT skewness({c}) FROM {tbl})" if num else "NULL::DOUBLE"} AS skewness,
  {f"(SELECT quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) FROM {tbl})" if num else "NULL::DOUBLE"} AS iqr,
  {f"(SELECT quantile_cont({c}, 0.75) FROM {tbl})" if num else "NULL::DOUBLE"} AS q75,
  {f"(SELECT stddev_samp({c}) / avg({c}) FROM {tbl})" if num else "NULL::DOUBLE"} AS cv""")
    return _union(parts)


def _policy_sql(prof_sql):
    return f"""WITH p AS ({prof_sql}),
f AS (SELECT *, regexp_matches("column", '{ID_RE}') AS idn FROM p),
g AS (SELECT *,
  coalesce((idn AND (is_unique OR p_distinct >= 0.95))
    OR (is_integral AND is_unique AND n_missing = 0 AND max - min + 1 = cnt)
    OR (type = 'Text' AND (n_distinct <= 1 OR entropy / ln(n_distinct) < 0.05)), FALSE) AS garbage,
  coalesce(idn AND type IN ('Numeric', 'Text') AND p_distinct < 0.95 AND cnt > 0, FALSE) AS subj_cand
  FROM f),
s AS (SELECT min_by("column", position) AS subject FROM g WHERE subj_cand),
roles AS (
  SELECT position, "column", 'subject_id' AS role FROM g WHERE "column" = (SELECT subject FROM s)
  UNION ALL SELECT position, "column", 'garbage' FROM g WHERE garbage
  UNION ALL SELECT position, "column", 'protected' FROM g
    WHERE NOT garbage AND type = 'Numeric' AND abs(cv) > 0.5)"""


EVENTS_PLAN = [("event_id", "Numeric", True), ("ts", "DateTime", False), ("user_id", "Numeric", True),
               ("event_type", "Text", False), ("value", "Numeric", False), ("props", "Text", False)]


@query("plan_policy", _policy_sql(_plan_profile_sql("events", EVENTS_PLAN))
       + "\nSELECT position::BIGINT AS position, \"column\", role FROM roles")
def plan_policy(spark, d):
    from kiln.operators.profile import profile
    from kiln.plans.rules import derive_policy
    prof = profile(table(spark, d, "events"), with_mad=False)
    return rounded(derive_policy(prof))


CUSTOMER_NULLS_SQL = """(SELECT c_custkey, c_name, c_nationkey,
  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
  CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer)"""


def customer_with_nulls(spark, d):
    c = table(spark, d, "customer")
    return c.select("c_custkey", "c_name", "c_nationkey",
                    F.when(F.col("c_custkey") % 7 == 0, F.lit(None)).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
                    F.when(F.col("c_custkey") % 11 == 0, F.lit(None)).otherwise(F.col("c_mktsegment"))
                    .alias("c_mktsegment"))


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]

CUSTOMER_PLAN = [("c_custkey", "Numeric", True), ("c_name", "Text", False), ("c_nationkey", "Numeric", True),
                 ("c_acctbal", "Numeric", False), ("c_mktsegment", "Text", False)]


def _contract_sql(prof_sql):
    return _policy_sql(prof_sql) + """,
r AS (SELECT "column", bool_or(role = 'subject_id') AS subj, bool_or(role = 'garbage') AS garb,
             bool_or(role = 'protected') AS prot FROM roles GROUP BY "column"),
q AS (SELECT p.*, coalesce(r.subj, FALSE) AS subj, coalesce(r.garb, FALSE) AS garb, coalesce(r.prot, FALSE) AS prot,
        (p.p_missing > 0.6 OR coalesce(p.n_distinct, 0) <= 1) AS qdrop, coalesce(p.skewness, 0.0) AS sk
      FROM p LEFT JOIN r USING ("column")),
l AS (SELECT *, (NOT garb AND NOT subj AND NOT qdrop) AS live FROM q),
steps AS (
  SELECT position, "column", 'drop' AS step FROM l WHERE (garb AND NOT subj) OR (NOT garb AND NOT subj AND qdrop)
  UNION ALL SELECT position, "column", CASE WHEN type = 'Numeric' AND abs(sk) > 1.0 THEN 'impute_median'
      WHEN type = 'Numeric' THEN 'impute_mean' ELSE 'impute_categorical' END
    FROM l WHERE live AND n_missing > 0 AND type IN ('Numeric', 'Text')
  UNION ALL SELECT position, "column", CASE WHEN n_distinct <= 10 THEN 'one_hot' ELSE 'rare_label' END
    FROM l WHERE live AND type = 'Text'
  UNION ALL SELECT position, "column", 'clip_iqr' FROM l
    WHERE live AND type = 'Numeric' AND NOT prot AND coalesce(iqr, 0) > 0 AND coalesce(max, 0) > coalesce(q75, 0) + 1.5 * coalesce(iqr, 0)
  UNION ALL SELECT position, "column", CASE WHEN coalesce(min, 0) > 0 THEN 'log' ELSE 'yeo_johnson' END
    FROM l WHERE live AND type = 'Numeric' AND NOT prot AND abs(sk) > 0.75
  UNION ALL SELECT position, "column", CASE WHEN coalesce(cv, 0) > 0.5 THEN 'scale_robust' ELSE 'scale_standard' END
    FROM l WHERE live AND type = 'Numeric'
  UNION ALL SELECT position, "column", 'subject_id' FROM l WHERE subj)
SELECT position::BIGINT AS position, "column", step FROM steps"""


@query("plan_cleaning_contract", _contract_sql(_plan_profile_sql(CUSTOMER_NULLS_SQL, CUSTOMER_PLAN)))
def plan_cleaning_contract(spark, d):
    from kiln.operators.profile import profile
    from kiln.plans.rules import derive_policy, plan_cleaning
    prof = profile(customer_with_nulls(spark, d), with_mad=False).cache()
    return rounded(plan_cleaning(prof, derive_policy(prof)))


ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query("plan_id_columns", _union([
    f"""SELECT {i}::BIGINT AS position, '{c}' AS "column" FROM orders
HAVING count(DISTINCT {c}) = count({c}) AND count({c}) > 0 OR count(DISTINCT {c}) = count(*)"""
    for i, c in enumerate(ORDERS_COLS)]))
def plan_id_columns(spark, d):
    from kiln.operators.profile import profile
    from kiln.plans.rules import id_columns
    return rounded(id_columns(profile(table(spark, d, "orders"), with_mad=False)))


@query("supervised_audit", """WITH ids AS (
  SELECT 'doc_id' AS c WHERE (SELECT count(DISTINCT doc_id) = count(doc_id) OR count(DISTINCT doc_id) = count(*) FROM documents)
  UNION ALL SELECT 'text' WHERE (SELECT count(DISTINCT text) = count(text) OR count(DISTINCT text) = count(*) FROM documents)
  UNION ALL SELECT 'lang' WHERE (SELECT count(DISTINCT lang) = count(lang) OR count(DISTINCT lang) = count(*) FROM documents)
  UNION ALL SELECT 'source' WHERE (SELECT count(DISTINCT source) = count(source) OR count(DISTINCT source) = count(*) FROM documents)
  UNION ALL SELECT 'n_chars' WHERE (SELECT count(DISTINCT n_chars) = count(n_chars) OR count(DISTINCT n_chars) = count(*) FROM documents))
SELECT (SELECT count(*) FROM documents)::BIGINT AS n_rows, 5::BIGINT AS n_var,
  (SELECT count(*) FROM ids)::BIGINT AS n_id_cols, 0.005::DOUBLE AS pps_threshold, 20.0::DOUBLE AS vif_threshold,
  round(1 - (SELECT count(*) FROM (SELECT DISTINCT
      CASE WHEN 'text' IN (SELECT c FROM ids) THEN NULL ELSE text END,
      CASE WHEN 'lang' IN (SELECT c FROM ids) THEN NULL ELSE lang END,
      CASE WHEN 'source' IN (SELECT c FROM ids) THEN NULL ELSE source END,
      CASE WHEN 'n_chars' IN (SELECT c FROM ids) THEN NULL ELSE n_chars END,
      CASE WHEN 'doc_id' IN (SELECT c FROM ids) THEN NULL ELSE doc_id END FROM documents)) / (SELECT count(*) FROM documents), 6)
  AS duplicate_ratio""")
def supervised_audit(spark, d):
    from kiln.operators.aggregate import duplicate_ratio_df
    from kiln.operators.profile import profile
    from kiln.plans.rules import id_columns, thresholds_expr
    docs = table(spark, d, "documents")
    ids = [r["column"] for r in id_columns(profile(docs, with_mad=False)).collect()]
    n_var = F.lit(len(docs.columns))
    pps, vif = thresholds_expr(n_var)
    dup = duplicate_ratio_df(docs, exclude=ids)
    return rounded(dup.select(F.col("n_rows").cast("long"), n_var.cast("long").alias("n_var"),
                              F.lit(len(ids)).cast("long").alias("n_id_cols"),
                              pps.alias("pps_threshold"), vif.alias("vif_threshold"), "duplicate_ratio"))


LI_TYPES = [("l_orderkey", "Numeric"), ("l_partkey", "Numeric"), ("l_suppkey", "Numeric"),
            ("l_linenumber", "Numeric"), ("l_quantity", "Numeric"), ("l_extendedprice", "Numeric"),
            ("l_discount", "Numeric"), ("l_tax", "Numeric"), ("l_returnflag", "Text"),
            ("l_linestatus", "Text"), ("l_shipdate", "DateTime")]


@query("split_columns", _union([
    f"""SELECT {i}::BIGINT AS position, '{c}' AS "column",
  CASE WHEN (count(*) - count({c})) / count(*) > 0.70 OR (count(DISTINCT {c}) = count({c}) AND count({c}) > 0) THEN 'drop'
       WHEN '{t}' = 'Numeric' THEN 'numeric' ELSE 'categorical' END AS role FROM lineitem"""
    for i, (c, t) in enumerate(LI_TYPES) if c != "l_returnflag"]))
def split_columns_q(spark, d):
    from kiln.operators.profile import profile
    from kiln.plans.rules import split_columns
    return rounded(split_columns(profile(table(spark, d, "lineitem"), with_mad=False), "l_returnflag"))


# ====================================================================== imputation
@query("impute_mean", """WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS v FROM orders)
SELECT o_orderkey, round(coalesce(v, (SELECT avg(v) FROM o)), 6) AS o_totalprice FROM o""")
def impute_mean(spark, d):
    from kiln.operators.impute import impute
    o = table(spark, d, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 7 == 0, F.lit(None)).otherwise(F.col("o_totalprice")).alias("o_totalprice"))
    return rounded(impute(o, ["o_totalprice"], "mean"))


@query("impute_median", """WITH l AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_extendedprice END AS v FROM lineitem)
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, round(coalesce(v, (SELECT quantile_cont(v, 0.5) FROM l)), 6) AS l_extendedprice FROM l""")
def impute_median(spark, d):
    from kiln.operators.impute import impute
    li = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_orderkey") % 5 == 0, F.lit(None)).otherwise(F.col("l_extendedprice")).alias("l_extendedprice"))
    return rounded(impute(li, ["l_extendedprice"], "median"))


@query("impute_category", """SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderpriority END, 'Missing') AS o_orderpriority FROM orders""")
def impute_category(spark, d):
    from kiln.operators.impute import impute
    o = table(spark, d, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 9 == 0, F.lit(None)).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"))
    return impute(o, ["o_orderpriority"], "constant", "Missing")


@query("null_cells", """SELECT (count_if(v IS NULL) + count_if(t IS NULL))::BIGINT AS null_cells FROM
 (SELECT CASE WHEN event_id % 4 = 0 THEN NULL ELSE value END AS v, CASE WHEN event_id % 6 = 0 THEN NULL ELSE event_type END AS t FROM events)""")
def null_cells_q(spark, d):
    e = table(spark, d, "events").select(
        F.when(F.col("event_id") % 4 == 0, F.lit(None)).otherwise(F.col("value")).alias("v"),
        F.when(F.col("event_id") % 6 == 0, F.lit(None)).otherwise(F.col("event_type")).alias("t"))
    from kiln.operators.impute import null_cells
    return spark.createDataFrame([(null_cells(e),)], "null_cells bigint")


# ====================================================================== encoding
@query("rare_label", """WITH f AS (SELECT p_brand, count(*) / (SELECT count(p_brand) FROM part) AS freq FROM part WHERE p_brand IS NOT NULL GROUP BY p_brand)
SELECT p_partkey, CASE WHEN p_brand IS NULL THEN NULL
  WHEN (SELECT count(*) FROM f) <= 10 OR p_brand IN (SELECT p_brand FROM f WHERE freq >= 0.04) THEN p_brand ELSE 'Rare' END AS p_brand
FROM part""")
def rare_label(spark, d):
    from kiln.operators.encode import fit_rare_label
    p = table(spark, d, "part").select("p_partkey", "p_brand")
    return fit_rare_label(p, ["p_brand"], tol=0.04, min_categories=10).transform(p)


@query("one_hot", "SELECT c_custkey, " + ", ".join(
    f"CASE WHEN c_mktsegment = '{s}' THEN 1 ELSE 0 END::BIGINT AS c_mktsegment_{s}" for s in SEGMENTS)
    + " FROM customer")
def one_hot(spark, d):
    from kiln.operators.encode import fit_one_hot
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return rounded(fit_one_hot(c, ["c_mktsegment"]).transform(c))


@query("factorize", """WITH p AS (SELECT o_orderpriority AS lvl, dense_rank() OVER (ORDER BY min(o_orderkey), o_orderpriority) - 1 AS code FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1),
s AS (SELECT o_orderstatus AS lvl, dense_rank() OVER (ORDER BY min(o_orderkey), o_orderstatus) - 1 AS code FROM orders WHERE o_orderstatus IS NOT NULL GROUP BY 1)
SELECT o.o_orderkey, coalesce(p.code, -1)::BIGINT AS o_orderpriority_code, coalesce(s.code, -1)::BIGINT AS o_orderstatus_code
FROM orders o LEFT JOIN p ON o.o_orderpriority = p.lvl LEFT JOIN s ON o.o_orderstatus = s.lvl""")
def factorize_q(spark, d):
    from kiln.operators.encode import factorize
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return factorize(o, ["o_orderpriority", "o_orderstatus"], "o_orderkey", suffix="_code") \
        .select("o_orderkey", "o_orderpriority_code", "o_orderstatus_code")


# ====================================================================== outliers / transforms / scaling
@query("clip_iqr", """WITH q AS (SELECT quantile_cont(value, 0.75) + 1.5 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) AS hi FROM events)
SELECT event_id, round(CASE WHEN value > (SELECT hi FROM q) THEN (SELECT hi FROM q) ELSE value END, 6) AS value FROM events""")
def clip_iqr(spark, d):
    from kiln.operators.outliers import fit_clip_iqr
    e = table(spark, d, "events").select("event_id", "value")
    return rounded(fit_clip_iqr(e, ["value"]).transform(e))


@query("clip_percentile", """SELECT event_id, round(CASE WHEN value > (SELECT quantile_cont(value, 0.99) FROM events)
  THEN (SELECT quantile_cont(value, 0.99) FROM events) ELSE value END, 6) AS value FROM events""")
def clip_percentile(spark, d):
    from kiln.operators.outliers import fit_clip_percentile
    e = table(spark, d, "events").select("event_id", "value")
    return rounded(fit_clip_percentile(e, ["value"], 99).transform(e))


@query("log_transform", "SELECT event_id, round(ln(value), 6) AS value FROM events")
def log_transform(spark, d):
    """TRF-01: every event; 0 gives -inf, as ln does in the SQL."""
    from kiln.operators.transform import fit_log
    e = table(spark, d, "events").select("event_id", "value")
    return rounded(fit_log(e, ["value"], outside="limit").transform(e))


@query("robust_scale", """WITH q AS (SELECT quantile_cont(c_acctbal, 0.5) AS med, quantile_cont(c_acctbal, 0.75) - quantile_cont(c_acctbal, 0.25) AS iqr FROM customer)
SELECT c_custkey, round((c_acctbal - (SELECT med FROM q)) / (SELECT CASE WHEN iqr = 0 THEN 1 ELSE iqr END FROM q), 6) AS c_acctbal FROM customer""")
def robust_scale(spark, d):
    from kiln.operators.scale import fit_robust_scale
    c = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    return rounded(fit_robust_scale(c, ["c_acctbal"]).transform(c))


@query("standard_scale", """WITH s AS (SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS sd FROM customer)
SELECT c_custkey, round((c_acctbal - (SELECT m FROM s)) / (SELECT CASE WHEN sd = 0 THEN 1 ELSE sd END FROM s), 6) AS c_acctbal FROM customer""")
def standard_scale(spark, d):
    from kiln.operators.scale import fit_standard_scale
    c = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    return rounded(fit_standard_scale(c, ["c_acctbal"]).transform(c))


@query("yeo_johnson")
def yeo_johnson(spark, d):
    """Rows-only: lambda is an iterative maximum-likelihood search."""
    from kiln.operators.transform import fit_yeo_johnson
    e = table(spark, d, "events").select("event_id", "value")
    return rounded(fit_yeo_johnson(e, ["value"]).transform(e))


@query("power_transform")
def power_transform(spark, d):
    from pyspark.ml import PipelineModel

    from kiln.operators.scale import fit_power_transform
    c = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    return rounded(PipelineModel(fit_power_transform(c, ["c_acctbal"])).transform(c))


CLEAN_CONTRACT_SQL = f"""WITH c AS {CUSTOMER_NULLS_SQL},
i AS (SELECT c_name, c_nationkey, coalesce(c_acctbal, (SELECT avg(c_acctbal) FROM c)) AS c_acctbal,
             coalesce(c_mktsegment, 'Missing') AS seg FROM c),
f AS (SELECT c_name AS v FROM i WHERE c_name IS NOT NULL GROUP BY 1
      HAVING count(*) / (SELECT count(c_name) FROM i) >= 0.05),
q AS (SELECT quantile_cont(c_nationkey, 0.5) AS mn, quantile_cont(c_nationkey, 0.75) - quantile_cont(c_nationkey, 0.25) AS iqn,
             quantile_cont(c_acctbal, 0.5) AS ma, quantile_cont(c_acctbal, 0.75) - quantile_cont(c_acctbal, 0.25) AS iqa FROM i)
SELECT CASE WHEN c_name IS NULL THEN NULL
            WHEN (SELECT count(DISTINCT c_name) FROM i) <= 10 OR c_name IN (SELECT v FROM f) THEN c_name ELSE 'Rare' END AS c_name,
  round((c_nationkey - (SELECT mn FROM q)) / (SELECT CASE WHEN iqn = 0 THEN 1 ELSE iqn END FROM q), 6) AS c_nationkey,
  round((c_acctbal - (SELECT ma FROM q)) / (SELECT CASE WHEN iqa = 0 THEN 1 ELSE iqa END FROM q), 6) AS c_acctbal,
  """ + ", ".join(f"CASE WHEN seg = '{v}' THEN 1 ELSE 0 END::BIGINT AS c_mktsegment_{v}"
                  for v in SEGMENTS + ["Missing"]) + " FROM i"


@query("clean_contract", CLEAN_CONTRACT_SQL)
def clean_contract(spark, d):
    """Flagship: profile -> policy -> contract -> silver of customer (with nulls).
    The contract chosen here (drop c_custkey; mean-impute and robust-scale
    c_acctbal; robust-scale c_nationkey; rare-label c_name; impute + one-hot
    c_mktsegment) is itself checked by ``plan_cleaning_contract``."""
    from kiln.plans.clustering import audit_and_clean
    silver, _contract, _model = audit_and_clean(customer_with_nulls(spark, d))
    return rounded(silver)


# ====================================================================== features
INTERACTIONS = [
    {"pair": ["l_extendedprice", "l_quantity"], "logic": "ratio", "name": "unit_price",
     "error_handling": "zero_fill", "outlier_clipping_percentile": 99},
    {"pair": ["l_quantity", "l_discount"], "logic": "multiplication", "name": "qty_x_discount",
     "outlier_clipping_percentile": 95},
    {"pair": ["unit_price", "l_tax"], "logic": "multiplication", "name": "unit_tax"},
    {"pair": ["l_quantity", "missing_column"], "logic": "ratio", "name": "skipped"},
]


@query("interactions", """WITH a AS (SELECT l_orderkey, l_linenumber, l_tax,
    coalesce(l_extendedprice / (nullif(l_quantity, 0) + 1e-6), 0) AS up, l_quantity * l_discount AS qd FROM lineitem),
b AS (SELECT l_orderkey, l_linenumber, l_tax,
    least(up, (SELECT quantile_cont(up, 0.99) FROM a)) AS unit_price,
    least(qd, (SELECT quantile_cont(qd, 0.95) FROM a)) AS qty_x_discount FROM a),
c AS (SELECT *, unit_price * l_tax AS ut FROM b)
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, round(unit_price, 6) AS unit_price,
  round(qty_x_discount, 6) AS qty_x_discount, round(least(ut, (SELECT quantile_cont(ut, 0.99) FROM c)), 6) AS unit_tax FROM c""")
def interactions(spark, d):
    from kiln.operators.features import build_interactions
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity",
                                            "l_discount", "l_tax")
    out = build_interactions(li, INTERACTIONS)
    return rounded(out.select("l_orderkey", "l_linenumber", "unit_price", "qty_x_discount", "unit_tax"))


PAIR_COLS = ["l_quantity", "l_discount", "l_tax"]


@query("pairwise_features", "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, " + ", ".join(
    f"round({a} - {b}, 6) AS {a}_minus_{b}, round({a} / ({b} + 1e-5), 6) AS {a}_ratio_{b}"
    for i, a in enumerate(PAIR_COLS) for b in PAIR_COLS[i + 1:]) + " FROM lineitem")
def pairwise_features(spark, d):
    from kiln.operators.features import pairwise
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *PAIR_COLS)
    return rounded(pairwise(li, PAIR_COLS).drop(*PAIR_COLS))


@query("date_parts", """SELECT o_orderkey, year(o_orderdate)::BIGINT AS o_orderdate_year, month(o_orderdate)::BIGINT AS o_orderdate_month,
  (isodow(o_orderdate) - 1)::BIGINT AS o_orderdate_dow FROM orders""")
def date_parts_q(spark, d):
    from kiln.operators.features import date_parts
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return rounded(date_parts(o, ["o_orderdate"]).drop("o_orderdate"))


@query("date_diffs", """SELECT l.l_orderkey, l.l_linenumber::BIGINT AS l_linenumber,
  floor((epoch_us(l.l_shipdate) - epoch_us(o.o_orderdate)) / 86400000000.0)::BIGINT AS l_shipdate_minus_o_orderdate_days
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""")
def date_diffs_q(spark, d):
    from kiln.operators.features import date_diffs
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return rounded(date_diffs(j, ["o_orderdate", "l_shipdate"])
                   .select("l_orderkey", "l_linenumber", "l_shipdate_minus_o_orderdate_days"))


# Customer "income / spending / age" stand-ins derived from the driver tables.
CUST_FEATURES_SQL = """(SELECT c.c_custkey, c.c_mktsegment, c.c_nationkey, c.c_acctbal / 100 AS inc,
   avg(o.o_totalprice) / 3000 AS spd, 3 * count(o.o_orderkey) + 10 AS age
 FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey
 GROUP BY c.c_custkey, c.c_mktsegment, c.c_nationkey, c.c_acctbal)"""


def customer_features(spark, d):
    c = table(spark, d, "customer")
    per = table(spark, d, "orders").groupBy("o_custkey").agg(
        F.avg("o_totalprice").alias("avg_price"), F.count("o_orderkey").alias("n_orders"))
    j = c.join(per, c.c_custkey == per.o_custkey, "left")
    return j.select("c_custkey", "c_mktsegment", "c_nationkey", (F.col("c_acctbal") / 100).alias("inc"),
                    (F.col("avg_price") / 3000).alias("spd"),
                    (3 * F.coalesce(F.col("n_orders"), F.lit(0)) + 10).alias("age"))


SEGMENT_SQL = """(CASE WHEN {age} < 30 THEN 'Young ' WHEN {age} > 50 THEN 'Senior ' ELSE '' END ||
  CASE WHEN {inc} > 70 AND {spd} > 70 THEN 'VIP / Top Spenders'
       WHEN {inc} > 70 AND {spd} < 40 THEN 'High-Income / Frugal'
       WHEN {inc} < 40 AND {spd} > 70 THEN 'Young / Trend-Setters'
       WHEN {inc} < 40 AND {spd} < 40 THEN 'Budget Conscious'
       WHEN {inc} >= 40 AND {inc} <= 70 THEN 'Middle-Class / Average' ELSE '' END)"""


@query("segment_name", "SELECT c_custkey, " + SEGMENT_SQL.format(age="age", inc="inc", spd="spd")
       + " AS segment FROM " + CUST_FEATURES_SQL)
def segment_name_q(spark, d):
    from kiln.operators.features import segment_name
    f = customer_features(spark, d)
    return f.select("c_custkey", segment_name(F.col("inc"), F.col("spd"), F.col("age")).alias("segment"))


@query("cluster_profile", """WITH f AS """ + CUST_FEATURES_SQL + """,
m AS (SELECT c_mktsegment AS cluster, avg(inc) AS inc, avg(spd) AS spd, avg(age) AS age FROM f GROUP BY 1),
nc AS (SELECT f.c_mktsegment AS cluster, n.n_name, count(*) AS k FROM f JOIN nation n ON f.c_nationkey = n.n_nationkey GROUP BY 1, 2),
md AS (SELECT cluster, n_name FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY k DESC, n_name) AS rn FROM nc) WHERE rn = 1)
SELECT m.cluster, round(m.inc, 6) AS inc, round(m.spd, 6) AS spd, round(m.age, 6) AS age, md.n_name AS nation_mode,
  """ + SEGMENT_SQL.format(age="m.age", inc="m.inc", spd="m.spd") + """ AS persona_name
FROM m JOIN md USING (cluster)""")
def cluster_profile(spark, d):
    """CLU-12: per cluster (market segment): mean features, mode nation, segment name."""
    from kiln.operators.aggregate import mode_expr
    from kiln.operators.features import segment_name
    f = customer_features(spark, d)
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    j = f.join(F.broadcast(n), f.c_nationkey == n.n_nationkey)
    g = j.groupBy(F.col("c_mktsegment").alias("cluster")).agg(
        F.avg("inc").alias("inc"), F.avg("spd").alias("spd"), F.avg("age").alias("age"),
        mode_expr("n_name").alias("nation_mode"))
    out = g.select("cluster", "inc", "spd", "age", "nation_mode",
                   segment_name(F.col("inc"), F.col("spd"), F.col("age")).alias("persona_name"))
    return rounded(out)


# ====================================================================== entity aggregation
def _mode_sql(tbl, key, col):
    return f"""(SELECT {key}, {col} FROM (SELECT {key}, {col}, row_number() OVER (PARTITION BY {key} ORDER BY count(*) DESC, {col}) AS rn
   FROM {tbl} WHERE {col} IS NOT NULL GROUP BY {key}, {col}) WHERE rn = 1)"""


@query("entity_aggregate_orders", f"""SELECT a.o_custkey, round(a.s, 2) AS o_totalprice_sum, round(a.m, 6) AS o_totalprice_mean,
  p.o_orderpriority AS o_orderpriority_mode, s.o_orderstatus AS o_orderstatus_mode
FROM (SELECT o_custkey, sum(o_totalprice) AS s, avg(o_totalprice) AS m FROM orders GROUP BY 1) a
LEFT JOIN {_mode_sql('orders', 'o_custkey', 'o_orderpriority')} p USING (o_custkey)
LEFT JOIN {_mode_sql('orders', 'o_custkey', 'o_orderstatus')} s USING (o_custkey)""")
def entity_aggregate_orders(spark, d):
    from kiln.operators.aggregate import entity_aggregate
    o = table(spark, d, "orders")
    out = entity_aggregate(o, "o_custkey", sum_cols=["o_totalprice"], mean_cols=["o_totalprice"],
                           mode_cols=["o_orderpriority", "o_orderstatus"], suffix=True)
    return rounded(out, per_col={"o_totalprice_sum": 2})


@query("entity_aggregate_events", f"""SELECT a.user_id, round(a.s, 4) AS value_sum, round(a.m, 6) AS value_mean, t.event_type AS event_type_mode
FROM (SELECT user_id, sum(value) AS s, avg(value) AS m FROM events GROUP BY 1) a
LEFT JOIN {_mode_sql('events', 'user_id', 'event_type')} t USING (user_id)""")
def entity_aggregate_events(spark, d):
    from kiln.operators.aggregate import entity_aggregate, entity_mode
    e = table(spark, d, "events")
    sums = entity_aggregate(e, "user_id", sum_cols=["value"], mean_cols=["value"], suffix=True)
    mode = entity_mode(e, "user_id", "event_type", "event_type_mode")
    return rounded(sums.join(mode, "user_id", "left"), per_col={"value_sum": 4})


# ====================================================================== selection
SEL_SQL_BASE = "(SELECT l_quantity, l_extendedprice, l_extendedprice * (1 - l_discount) AS net_price, l_discount, l_tax FROM lineitem)"
SEL_COLS = ["l_quantity", "l_extendedprice", "net_price", "l_discount", "l_tax"]


def selection_frame(spark, d):
    li = table(spark, d, "lineitem")
    return li.select("l_quantity", "l_extendedprice",
                     (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net_price"), "l_discount", "l_tax")


def _pairs_sql():
    return _union([f"SELECT {i} AS i, {j} AS j, '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM {SEL_SQL_BASE}"
                   for i, a in enumerate(SEL_COLS) for j, b in enumerate(SEL_COLS) if i < j])


@query("correlation_long", f"SELECT a, b, round(r, 6) AS r FROM ({_pairs_sql()})")
def correlation_long_q(spark, d):
    from kiln.operators.select import correlation_long
    return rounded(correlation_long(selection_frame(spark, d), SEL_COLS))


@query("variance_filter", _union([
    f"SELECT '{c}' AS \"column\", coalesce(NOT (var_samp({c}) < 0.01), TRUE) AS kept FROM {SEL_SQL_BASE}" for c in SEL_COLS]))
def variance_filter_q(spark, d):
    from kiln.operators.select import variance_filter
    kept = set(variance_filter(selection_frame(spark, d), SEL_COLS, 0.01))
    return spark.createDataFrame([(c, c in kept) for c in SEL_COLS], "column string, kept boolean")


@query("corr_filter", f"""WITH p AS ({_pairs_sql()}),
c AS (SELECT * FROM (VALUES {", ".join(f"({i}, '{c}')" for i, c in enumerate(SEL_COLS))}) t(pos, name))
SELECT c.pos::BIGINT AS position, c.name AS "column",
  NOT EXISTS (SELECT 1 FROM p WHERE p.j = c.pos AND abs(p.r) > 0.85) AS kept FROM c""")
def corr_filter_q(spark, d):
    from kiln.operators.select import corr_filter
    kept = set(corr_filter(selection_frame(spark, d), SEL_COLS, 0.85))
    return spark.createDataFrame([(i, c, c in kept) for i, c in enumerate(SEL_COLS)],
                                 "position long, column string, kept boolean")


@query("top_correlated", f"""SELECT row_number() OVER (ORDER BY abs(r) DESC)::BIGINT AS rank, "column", round(abs(r), 6) AS abs_r FROM (
  {_union([f"SELECT '{c}' AS \"column\", corr({c}, l_extendedprice) AS r FROM {SEL_SQL_BASE}" for c in SEL_COLS if c != 'l_extendedprice'])})
QUALIFY rank <= 3""")
def top_correlated_q(spark, d):
    from kiln.operators.select import top_correlated
    top = top_correlated(selection_frame(spark, d), "l_extendedprice", SEL_COLS, n=3)
    return rounded(spark.createDataFrame([(i + 1, c, r) for i, (c, r) in enumerate(top)],
                                         "rank long, column string, abs_r double"))


VIF_COLS = ["l_quantity", "l_extendedprice", "net_price"]


@query("vif_filter", f"""WITH r AS (SELECT corr(l_quantity, l_extendedprice) AS r01, corr(l_quantity, net_price) AS r02,
    corr(l_extendedprice, net_price) AS r12 FROM {SEL_SQL_BASE}),
v AS (SELECT 1 / (1 - (r01*r01 + r02*r02 - 2*r01*r02*r12) / (1 - r12*r12)) AS v0,
             1 / (1 - (r01*r01 + r12*r12 - 2*r01*r12*r02) / (1 - r02*r02)) AS v1,
             1 / (1 - (r02*r02 + r12*r12 - 2*r02*r12*r01) / (1 - r01*r01)) AS v2, r01, r02, r12 FROM r),
w AS (SELECT *, CASE WHEN v0 >= v1 AND v0 >= v2 THEN 0 WHEN v1 >= v2 THEN 1 ELSE 2 END AS worst,
             greatest(v0, v1, v2) AS vmax FROM v),
rest AS (SELECT *, CASE worst WHEN 0 THEN r12 WHEN 1 THEN r02 ELSE r01 END AS rr FROM w)
SELECT "column", status, round(vif, 3) AS vif FROM (
  SELECT 'l_quantity' AS "column", 0 AS i, * FROM rest UNION ALL SELECT 'l_extendedprice', 1, * FROM rest
  UNION ALL SELECT 'net_price', 2, * FROM rest) x,
LATERAL (SELECT
  CASE WHEN vmax <= 10 THEN 'kept' WHEN i = worst THEN 'dropped'
       WHEN 1 / (1 - rr*rr) > 10 AND i = (CASE worst WHEN 0 THEN 1 ELSE 0 END) THEN 'dropped' ELSE 'kept' END AS status,
  CASE WHEN vmax <= 10 THEN (CASE i WHEN 0 THEN v0 WHEN 1 THEN v1 ELSE v2 END)
       WHEN i = worst THEN vmax
       WHEN 1 / (1 - rr*rr) > 10 AND i = (CASE worst WHEN 0 THEN 1 ELSE 0 END) THEN 1 / (1 - rr*rr)
       WHEN 1 / (1 - rr*rr) > 10 THEN 1.0
       ELSE 1 / (1 - rr*rr) END AS vif)""")
def vif_filter_q(spark, d):
    from kiln.operators.select import vif_filter
    dropped, kept = vif_filter(selection_frame(spark, d), VIF_COLS, threshold=10.0)
    from kiln.operators.select import correlation_matrix, vif_scores
    import numpy as np
    # VIF at the moment each column was dropped, for the report
    m = correlation_matrix(selection_frame(spark, d), VIF_COLS)
    live, rows = list(range(len(VIF_COLS))), []
    for name in dropped:
        v = vif_scores(m[np.ix_(live, live)])
        k = live.index(VIF_COLS.index(name))
        rows.append((name, "dropped", float(v[k])))
        live.pop(k)
    rows += [(c, "kept", v) for c, v in kept]
    return rounded(spark.createDataFrame(rows, "column string, status string, vif double"), 3)


# ====================================================================== integrity
@query("dedup_signal", """SELECT min(event_id) AS event_id, user_id, event_type FROM events GROUP BY user_id, event_type""")
def dedup_signal_q(spark, d):
    from kiln.operators.dedup import dedup_signal
    e = table(spark, d, "events").select("event_id", "user_id", "event_type")
    return dedup_signal(e, id_cols=["event_id"], order_by="event_id")


@query("drop_conflicting_labels", """WITH t AS (SELECT d.source, l.toxic::BIGINT AS toxic, l.quality::BIGINT AS quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id)
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM (SELECT source, toxic FROM t GROUP BY 1, 2 HAVING count(DISTINCT quality) > 1) b
  WHERE b.source = t.source AND b.toxic = t.toxic)""")
def drop_conflicting_labels_q(spark, d):
    from kiln.operators.dedup import drop_conflicting_labels
    docs = table(spark, d, "documents").select("doc_id", "source")
    lab = table(spark, d, "labels")
    t = docs.join(lab, "doc_id").select("source", F.col("toxic").cast("long"), F.col("quality").cast("long"))
    return drop_conflicting_labels(t, "quality")


@query("duplicate_ratio", """SELECT count(*)::BIGINT AS n_rows, (SELECT count(*) FROM (SELECT DISTINCT text, lang, source, n_chars FROM documents))::BIGINT AS n_distinct,
  round(1 - (SELECT count(*) FROM (SELECT DISTINCT text, lang, source, n_chars FROM documents)) / count(*), 6) AS duplicate_ratio FROM documents""")
def duplicate_ratio_q(spark, d):
    from kiln.operators.aggregate import duplicate_ratio_df
    return rounded(duplicate_ratio_df(table(spark, d, "documents"), exclude=["doc_id"]))


PART_TEXT = ["p_name", "p_brand", "p_type"]
PART_NUM = ["p_partkey", "p_size", "p_retailprice"]


def _validate_sql(tbl="part", cols=("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"),
                  text=PART_TEXT, nums=PART_NUM, label=None):
    parts = [f"SELECT 'single_value' AS \"check\", '{c}' AS \"column\", count(DISTINCT {c})::DOUBLE AS value, 1.0::DOUBLE AS \"limit\", count(DISTINCT {c}) > 1 AS passed FROM {tbl}" for c in cols]
    nulls = ", ".join(f"'{s}'" for s in ["", "null", "none", "nan", "na", "n/a", "-", "?"])
    for c in text:
        parts.append(f"SELECT 'special_characters', '{c}', round(count_if(regexp_matches({c}, '^[^\\p{{L}}\\p{{N}}]+$')) / count({c}), 6), 0.001::DOUBLE, count_if(regexp_matches({c}, '^[^\\p{{L}}\\p{{N}}]+$')) / count({c}) <= 0.001 FROM {tbl}")
        parts.append(f"SELECT 'mixed_nulls', '{c}', (count(DISTINCT CASE WHEN lower(trim({c})) IN ({nulls}) THEN lower(trim({c})) END) + CASE WHEN count_if({c} IS NULL) > 0 THEN 1 ELSE 0 END)::DOUBLE, 1.0::DOUBLE, (count(DISTINCT CASE WHEN lower(trim({c})) IN ({nulls}) THEN lower(trim({c})) END) + CASE WHEN count_if({c} IS NULL) > 0 THEN 1 ELSE 0 END) <= 1 FROM {tbl}")
        parts.append(f"SELECT 'mixed_types', '{c}', round(least(p, 1 - p), 6), 0.2::DOUBLE, NOT (least(p, 1 - p) >= 0.01 AND least(p, 1 - p) <= 0.2) FROM (SELECT count_if(try_cast({c} AS DOUBLE) IS NOT NULL) / count({c}) AS p FROM {tbl})")
        parts.append(f"SELECT 'string_mismatch', '{c}', count(*)::DOUBLE, 0.0::DOUBLE, count(*) = 0 FROM (SELECT regexp_replace(lower({c}), '[^\\p{{L}}\\p{{N}}]', '', 'g') AS k FROM {tbl} WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(DISTINCT {c}) > 1)")
        parts.append(f"""SELECT 'string_length', '{c}', round(count_if(len < q1 - 1.5 * (q3 - q1) OR len > q3 + 1.5 * (q3 - q1)) / count(*), 6), 0.05::DOUBLE,
  count_if(len < q1 - 1.5 * (q3 - q1) OR len > q3 + 1.5 * (q3 - q1)) / count(*) <= 0.05
FROM (SELECT length({c}) AS len, (SELECT quantile_cont(length({c}), 0.25) FROM {tbl}) AS q1, (SELECT quantile_cont(length({c}), 0.75) FROM {tbl}) AS q3 FROM {tbl})""")
    allc = ", ".join(list(cols) + ([label] if label else []))
    parts.append(f"SELECT 'duplicates', '*', round(1 - (SELECT count(*) FROM (SELECT DISTINCT {allc} FROM {tbl})) / count(*), 6), 0.05::DOUBLE, 1 - (SELECT count(*) FROM (SELECT DISTINCT {allc} FROM {tbl})) / count(*) <= 0.05 FROM {tbl}")
    if label:
        feats = ", ".join(cols)
        parts.append(f"""SELECT 'conflicting_labels', '{label}', round(coalesce(sum(CASE WHEN lo <> hi THEN n END), 0) / sum(n), 6), 0.0::DOUBLE,
  coalesce(sum(CASE WHEN lo <> hi THEN n END), 0) / sum(n) <= 0 FROM (SELECT count(*) AS n, min({label}) AS lo, max({label}) AS hi FROM {tbl} GROUP BY {feats})""")
    for c in nums:
        parts.append(f"""SELECT 'outliers', '{c}', round(count_if(x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) / count(*), 6), 0.05::DOUBLE,
  count_if(x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) / count(*) <= 0.05
FROM (SELECT {c} AS x, (SELECT quantile_cont({c}, 0.25) FROM {tbl}) AS q1, (SELECT quantile_cont({c}, 0.75) FROM {tbl}) AS q3 FROM {tbl})""")
    for i, a in enumerate(nums):
        for b in nums[i + 1:]:
            parts.append(f"SELECT 'feature_correlation', '{a}|{b}', round(abs(corr({a}, {b})), 6), 0.9::DOUBLE, abs(corr({a}, {b})) < 0.9 FROM {tbl}")
    return _union(parts)


@query("validate_suite", _validate_sql())
def validate_suite(spark, d):
    from kiln.operators.validate import validate
    return rounded(validate(table(spark, d, "part")))


LABELED_SQL = """(SELECT d.lang, d.source, d.n_chars, l.toxic::BIGINT AS toxic, l.quality::BIGINT AS quality
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


def labeled_frame(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    lab = table(spark, d, "labels")
    return docs.join(lab, "doc_id").select("lang", "source", "n_chars", F.col("toxic").cast("long"),
                                           F.col("quality").cast("long"))


@query("validate_labeled", _validate_sql(LABELED_SQL, ("lang", "source", "n_chars", "toxic"), ["lang", "source"],
                                         ["n_chars", "toxic"], label="quality"))
def validate_labeled(spark, d):
    """VAL suite with a label: adds the conflicting-label share (VAL-08)."""
    from kiln.operators.validate import validate
    return rounded(validate(labeled_frame(spark, d), label="quality"))


# ====================================================================== ordered series
EV_NULL_SQL = "(SELECT event_id, user_id, ts, CASE WHEN event_id % 4 = 0 THEN NULL ELSE value END AS value FROM events)"


def events_with_nulls(spark, d):
    e = table(spark, d, "events")
    return e.select("event_id", "user_id", "ts",
                    F.when(F.col("event_id") % 4 == 0, F.lit(None)).otherwise(F.col("value")).alias("value"))


@query("fill_forward", f"""SELECT event_id, round(coalesce(value,
  last_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)), 6) AS value
FROM {EV_NULL_SQL}""")
def fill_forward_q(spark, d):
    from kiln.operators.timeseries import fill_forward
    e = events_with_nulls(spark, d)
    return rounded(fill_forward(e, ["ts", "event_id"], "user_id", ["value"]).select("event_id", "value"))


@query("interpolate_linear", f"""WITH w AS (SELECT event_id, value, ts,
  last_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS y0,
  last_value(CASE WHEN value IS NOT NULL THEN ts END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS t0,
  first_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS y1,
  first_value(CASE WHEN value IS NOT NULL THEN ts END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS t1
  FROM {EV_NULL_SQL})
SELECT event_id, round(coalesce(value, CASE WHEN epoch_us(t1) = epoch_us(t0) THEN y0
  ELSE y0 + (y1 - y0) * ((epoch_us(ts) - epoch_us(t0))::DOUBLE / (epoch_us(t1) - epoch_us(t0))::DOUBLE) END), 6) AS value FROM w""")
def interpolate_linear_q(spark, d):
    from kiln.operators.timeseries import interpolate_linear
    e = events_with_nulls(spark, d)
    return rounded(interpolate_linear(e, "ts", "user_id", ["value"]).select("event_id", "value"))


@query("detect_gaps", """WITH d AS (SELECT DISTINCT o_orderdate AS t FROM orders),
l AS (SELECT lag(t) OVER (ORDER BY t) AS prev, t AS cur FROM d),
x AS (SELECT prev, cur, (epoch(cur) - epoch(prev))::BIGINT AS delta FROM l WHERE prev IS NOT NULL),
s AS (SELECT delta AS step FROM x GROUP BY delta ORDER BY count(*) DESC, delta LIMIT 1)
SELECT strftime(prev, '%Y-%m-%d') AS prev, strftime(cur, '%Y-%m-%d') AS cur, delta, (SELECT step FROM s)::BIGINT AS step,
  (floor(delta / (SELECT step FROM s)) - 1)::BIGINT AS missing_steps FROM x WHERE delta > (SELECT step FROM s)""")
def detect_gaps_q(spark, d):
    from kiln.operators.timeseries import detect_gaps
    dates = table(spark, d, "orders").select("o_orderdate").distinct()
    g = detect_gaps(dates, "o_orderdate")
    return g.select(F.date_format("prev", "yyyy-MM-dd").alias("prev"), F.date_format("cur", "yyyy-MM-dd").alias("cur"),
                    F.col("delta").cast("long"), F.col("step").cast("long"), F.col("missing_steps").cast("long"))


@query("is_ordered", """SELECT count(*)::BIGINT AS n_rows, count_if(prev > ts)::BIGINT AS n_inversions, count_if(prev > ts) = 0 AS is_sorted
FROM (SELECT ts, lag(ts) OVER (ORDER BY event_id) AS prev FROM events)""")
def is_ordered_q(spark, d):
    from kiln.operators.timeseries import ordered_check
    return ordered_check(table(spark, d, "events"), "ts", "event_id")


@query("stationarity", """WITH l AS (SELECT user_id, value - lag(value) OVER w AS dy, lag(value) OVER w AS y0 FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
r AS (SELECT user_id, regr_count(dy, y0) AS n, regr_slope(dy, y0) AS slope, regr_sxx(dy, y0) AS sxx, regr_syy(dy, y0) AS syy, regr_sxy(dy, y0) AS sxy
  FROM l WHERE y0 IS NOT NULL GROUP BY user_id)
SELECT user_id, n::BIGINT AS n, round(slope, 6) AS slope, round(slope / sqrt((syy - slope * sxy) / ((n - 2) * sxx)), 6) AS t_stat FROM r""")
def stationarity_q(spark, d):
    from kiln.operators.timeseries import stationarity
    return rounded(stationarity(table(spark, d, "events"), ["ts", "event_id"], "value", "user_id"))


# ====================================================================== personas on a fixed label
EMB_LONG_SQL = """(SELECT label AS cluster, printf('d%02d', pos - 1) AS feature, x::DOUBLE AS x
  FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings))"""


@query("personas_by_label", f"""WITH l AS {EMB_LONG_SQL},
g AS (SELECT feature, avg(x) AS mu, stddev_pop(x) AS sd FROM l GROUP BY 1),
c AS (SELECT cluster, feature, avg(x) AS m FROM l GROUP BY 1, 2),
z AS (SELECT c.cluster, c.feature, (c.m - g.mu) / CASE WHEN g.sd > 0 THEN g.sd ELSE 1 END AS mean_z FROM c JOIN g USING (feature))
SELECT cluster::BIGINT AS cluster, feature, round(mean_z, 6) AS mean_z,
  CASE WHEN mean_z > 0.5 THEN 'High' WHEN mean_z < -0.5 THEN 'Low' ELSE 'Average' END AS trait FROM z""")
def personas_by_label(spark, d):
    from kiln.operators.cluster import persona_traits
    return rounded(persona_traits(table(spark, d, "embeddings"), ["embedding"], cluster="label"))


@query("persona_sizes", "SELECT label::BIGINT AS cluster, count(*)::BIGINT AS sample_size, 1.0::DOUBLE AS mean_certainty FROM embeddings GROUP BY 1")
def persona_sizes(spark, d):
    from kiln.operators.aggregate import cluster_sizes
    e = table(spark, d, "embeddings").withColumn("certainty", F.lit(1.0))
    return rounded(cluster_sizes(e, "label", "certainty").withColumnRenamed("label", "cluster"))


@query("calinski_harabasz", f"""WITH l AS {EMB_LONG_SQL},
p AS (SELECT cluster, feature, count(x) AS n, avg(x) AS m, var_pop(x) AS v FROM l GROUP BY 1, 2),
g AS (SELECT feature, avg(x) AS mu FROM l GROUP BY 1),
s AS (SELECT count(DISTINCT cluster) AS k, sum(n) / count(DISTINCT feature) AS n, sum(n * (m - mu) ^ 2) AS between_ss, sum(n * v) AS within_ss
      FROM p JOIN g USING (feature))
SELECT k::BIGINT AS k, n::BIGINT AS n, round(between_ss, 4) AS between, round(within_ss, 4) AS within,
  round((between_ss / (k - 1)) / (within_ss / (n - k)), 6) AS score FROM s""")
def calinski_harabasz_q(spark, d):
    from kiln.operators.cluster import calinski_harabasz
    out = calinski_harabasz(table(spark, d, "embeddings"), ["embedding"], cluster="label")
    return rounded(out, per_col={"between": 4, "within": 4})


@query("attach_persona", """SELECT c.c_custkey, c.c_nationkey::BIGINT AS cluster, coalesce(p.persona, 'Unknown') AS persona
FROM customer c LEFT JOIN (SELECT n.n_nationkey AS cl, n.n_name || ' / ' || r.r_name AS persona FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey) p
ON c.c_nationkey = p.cl""")
def attach_persona_q(spark, d):
    from kiln.operators.score import attach_persona
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    personas = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").alias("cluster"), F.concat_ws(" / ", "n_name", "r_name").alias("persona"))
    c = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").cast("long").alias("cluster"))
    return attach_persona(c, personas, "cluster")


@query("value_counts", """SELECT p_brand AS value, count(*)::BIGINT AS count FROM part GROUP BY 1 ORDER BY count DESC, value LIMIT 10""")
def value_counts_q(spark, d):
    from kiln.operators.profile import value_counts
    return value_counts(table(spark, d, "part"), "p_brand", 10)


@query("histogram", """WITH m AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
b AS (SELECT least(floor((value - (SELECT lo FROM m)) / ((SELECT hi - lo FROM m) / 10)), 9)::BIGINT AS bin FROM events WHERE value IS NOT NULL)
SELECT bin, round((SELECT lo FROM m) + bin * ((SELECT hi - lo FROM m) / 10), 6) AS lower,
  round((SELECT lo FROM m) + (bin + 1) * ((SELECT hi - lo FROM m) / 10), 6) AS upper, count(*)::BIGINT AS count FROM b GROUP BY bin""")
def histogram_q(spark, d):
    from kiln.operators.profile import histogram
    return rounded(histogram(table(spark, d, "events"), "value", 10))


# ====================================================================== small single-operator keys
@query("trait_labels", """WITH s AS (SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS sd FROM customer)
SELECT c_custkey, round((c_acctbal - (SELECT m FROM s)) / (SELECT sd FROM s), 6) AS z,
  CASE WHEN (c_acctbal - (SELECT m FROM s)) / (SELECT sd FROM s) > 0.5 THEN 'High'
       WHEN (c_acctbal - (SELECT m FROM s)) / (SELECT sd FROM s) < -0.5 THEN 'Low' ELSE 'Average' END AS trait
FROM customer""")
def trait_labels(spark, d):
    """FE-12 on standardised account balances."""
    from kiln.operators.features import trait
    from kiln.operators.scale import fit_standard_scale
    c = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    z = fit_standard_scale(c, ["c_acctbal"]).transform(c).withColumnRenamed("c_acctbal", "z")
    return rounded(z.withColumn("trait", trait(F.col("z"))))


@query("problem_type", _union([
    f"""SELECT '{t}' AS target, count(DISTINCT {t})::BIGINT AS n_distinct,
  CASE WHEN {num} AND count(DISTINCT {t}) > 20 THEN 'regression' ELSE 'classification' END AS gold_rule,
  CASE WHEN count(DISTINCT {t}) < 20 OR NOT {num} THEN 'classification' ELSE 'regression' END AS silver_rule
FROM lineitem""" for t, num in (("l_linenumber", "TRUE"), ("l_quantity", "TRUE"), ("l_discount", "TRUE"),
                                ("l_returnflag", "FALSE"))]))
def problem_type_q(spark, d):
    """PLAN-08 under both rules (they differ at exactly 20 classes)."""
    from kiln.plans.rules import problem_type
    li = table(spark, d, "lineitem")
    out = []
    for t in ("l_linenumber", "l_quantity", "l_discount", "l_returnflag"):
        nd = li.agg(F.count_distinct(t)).first()[0]
        out.append((t, nd, problem_type(li, t, "gold"), problem_type(li, t, "silver")))
    return spark.createDataFrame(out, "target string, n_distinct long, gold_rule string, silver_rule string")


@query("cluster_means", f"""SELECT cluster::BIGINT AS cluster, feature, round(avg(x), 6) AS mean FROM {EMB_LONG_SQL} GROUP BY 1, 2""")
def cluster_means_q(spark, d):
    """AGG-01 / CLU-08: raw (unscaled) mean of every dimension per label, long form."""
    from kiln.operators.aggregate import cluster_means
    from kiln.operators.cluster import long_features
    emb = table(spark, d, "embeddings")
    names = [r["feature"] for r in long_features(emb.limit(1), ["embedding"], cluster="label").select("feature").distinct().collect()]
    size = len(names)
    wide = emb.select("label", *[F.col("embedding")[i].cast("double").alias(f"x{i}") for i in range(size)])
    means = cluster_means(wide, "label", [f"x{i}" for i in range(size)])
    order = sorted(names, key=lambda f: int("".join(ch for ch in str(f) if ch.isdigit()) or 0))
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"x{i}").alias("mean")) for i, f in enumerate(order)]))
    return rounded(means.select(F.col("label").alias("cluster"), pairs.alias("p")).select("cluster", "p.feature", "p.mean"))


@query("complete_rows", f"SELECT event_id, user_id, round(value, 6) AS value FROM {EV_NULL_SQL} WHERE value IS NOT NULL")
def complete_rows_q(spark, d):
    """FLT-01: rows with no null feature (the training input filter)."""
    from kiln.operators.dedup import complete_rows
    e = events_with_nulls(spark, d).select("event_id", "user_id", "value")
    return rounded(complete_rows(e, ["value"]))


@query("align_schema", "SELECT o_totalprice, 0::BIGINT AS o_missing_feature, o_orderkey FROM orders")
def align_schema_q(spark, d):
    """PRJ-05: exactly the expected columns in order, absent ones as literal 0."""
    from kiln.functions.names import align_schema
    o = table(spark, d, "orders")
    return rounded(align_schema(o, ["o_totalprice", "o_missing_feature", "o_orderkey"], fill=0)
                   .withColumn("o_missing_feature", F.col("o_missing_feature").cast("long")))
