"""Queries on awkward values: infinities, large ids, null keys, outliers, sub-second steps, CSV text.

The driver tables hold none of these, so each is made from a key rule that both engines apply
to every row of a table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.catalog.registry import query, rounded, table

PROBS = [0.05, 0.25, 0.5, 0.75, 0.95]
INF_SQL = "(SELECT CASE WHEN l_orderkey % 100 = 1 THEN 'infinity'::DOUBLE WHEN l_orderkey % 100 = 2 THEN '-infinity'::DOUBLE ELSE l_extendedprice END AS x FROM lineitem)"


@query("quantiles_with_infinities", " UNION ALL ".join(f"SELECT {p}::DOUBLE AS p, round(quantile_cont(x, {p}), 6) AS q FROM {INF_SQL}" for p in PROBS))
def quantiles_with_infinities(spark, d):
    from kiln.functions.stats import quantiles
    key = F.col("l_orderkey") % 100
    li = table(spark, d, "lineitem").select(F.when(key == 1, float("inf")).when(key == 2, float("-inf")).otherwise(F.col("l_extendedprice")).alias("x"))
    return rounded(spark.createDataFrame(list(zip(PROBS, quantiles(li, ["x"], PROBS)["x"])), "p double, q double"))


LARGE_IDS = {"k": ("lineitem", "l_orderkey"), "o": ("lineitem", "l_orderkey * 10 + l_linenumber"), "s": ("customer", "c_custkey")}


@query("distinct_large_ids", " UNION ALL ".join(f"""SELECT '{c}' AS "column", sum(m)::BIGINT AS n, count(*)::BIGINT AS n_distinct, count_if(m = 1)::BIGINT AS n_unique,
  count(*) = sum(m) AS is_unique, min(v)::VARCHAR AS lowest, max(v)::VARCHAR AS highest, (max(v) - min(v))::DOUBLE AS range,
  count(*) = sum(m) AND max(v) - min(v) + 1 = count(*) AS is_sequence
FROM (SELECT {x} + 1152921504606846976 AS v, count(*) AS m FROM {t} GROUP BY 1)""" for c, (t, x) in LARGE_IDS.items()))
def distinct_large_ids(spark, d):
    """PROF-05/06/07/10/12 and PLAN-01's sequence rule on ids beyond 2**53."""
    from kiln.operators.profile import profile
    big = F.lit(1152921504606846976)
    li = table(spark, d, "lineitem").select((F.col("l_orderkey") + big).alias("k"), (F.col("l_orderkey") * 10 + F.col("l_linenumber") + big).alias("o"))
    s = table(spark, d, "customer").select((F.col("c_custkey") + big).alias("s"))
    return profile(li, with_mad=False).unionByName(profile(s, with_mad=False)).select(
        "column", "n", "n_distinct", "n_unique", "is_unique", "lowest", "highest", "range", "is_sequence")


MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate"]


@query("profile_ranges", " UNION ALL ".join(f"""SELECT '{c}' AS "column", round(max({c}) - min({c}), 6) AS range, round(sum({c}) / 1e6, 6) AS sum_millions,
  round(var_samp({c}) / 1e3, 4) AS variance_thousands, count_if(isinf({c}))::BIGINT AS n_infinite, NULL::VARCHAR AS lowest, NULL::VARCHAR AS highest FROM lineitem""" for c in MEASURES[:4])
       + """ UNION ALL SELECT 'l_shipdate', NULL, NULL, NULL, NULL, strftime(min(l_shipdate), '%Y-%m-%d %H:%M:%S'), strftime(max(l_shipdate), '%Y-%m-%d %H:%M:%S') FROM lineitem""")
def profile_ranges(spark, d):
    """PROF-10/12: range, sum, variance and infinities of numbers, least and greatest time."""
    from kiln.operators.profile import profile
    p = profile(table(spark, d, "lineitem").select(*MEASURES), with_mad=False)
    time = F.col("type") == "DateTime"
    return rounded(p.select("column", "range", (F.col("sum") / 1e6).alias("sum_millions"), F.round(F.col("variance") / 1e3, 4).alias("variance_thousands"),
                            "n_infinite", F.when(time, F.col("lowest")).alias("lowest"), F.when(time, F.col("highest")).alias("highest")))


KEYED_SQL = """(SELECT event_id, CASE WHEN user_id % 7 = 0 THEN NULL ELSE user_id END AS user_id,
  CASE WHEN event_id % 4 = 0 THEN NULL ELSE value END AS value FROM events)"""


def keyed_events(spark, d):
    return table(spark, d, "events").select(
        "event_id", F.when(F.col("user_id") % 7 != 0, F.col("user_id")).alias("user_id"), F.when(F.col("event_id") % 4 != 0, F.col("value")).alias("value"))


@query("fill_forward_null_key", f"""SELECT event_id, round(coalesce(value,
  last_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)), 6) AS value
FROM {KEYED_SQL}""")
def fill_forward_null_key(spark, d):
    """WIN-01/02: rows with a null key are a series of their own."""
    from kiln.operators.timeseries import fill_forward
    return rounded(fill_forward(keyed_events(spark, d), "event_id", "user_id", ["value"], buckets=16).select("event_id", "value"))


OUTLIER_SQL = """(SELECT event_id, CASE WHEN event_id = (SELECT min(event_id) FROM events) THEN 1000000000000 ELSE event_id END AS place,
  CASE WHEN event_id % 4 = 0 THEN NULL ELSE value END AS value FROM events)"""


@query("fill_forward_outlier", f"""SELECT event_id, round(coalesce(value,
  last_value(value IGNORE NULLS) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(value IGNORE NULLS) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)), 6) AS value
FROM {OUTLIER_SQL}""")
def fill_forward_outlier(spark, d):
    """WIN-01 without a key and with one far-future order value."""
    from kiln.operators.timeseries import fill_forward
    e = table(spark, d, "events")
    first = e.agg(F.min("event_id")).first()[0]
    at = F.when(F.col("event_id") == first, F.lit(10 ** 12)).otherwise(F.col("event_id"))
    e = e.select("event_id", at.alias("at"), F.when(F.col("event_id") % 4 != 0, F.col("value")).alias("value"))
    return rounded(fill_forward(e, "at", None, ["value"], buckets=16).select("event_id", "value"))


@query("detect_gaps_subsecond", """WITH t AS (SELECT event_id * 100 AS ms FROM events WHERE event_id % 50 NOT BETWEEN 7 AND 11),
g AS (SELECT ms, lag(ms) OVER (ORDER BY ms) AS prev FROM t)
SELECT prev AS prev_ms, ms AS cur_ms, round((ms - prev) / 1000.0, 6)::DOUBLE AS delta, 0.1::DOUBLE AS step, ((ms - prev) // 100 - 1)::BIGINT AS missing_steps
FROM g WHERE ms - prev > 100""")
def detect_gaps_subsecond(spark, d):
    """WIN-05 on a series of 100 ms steps."""
    from kiln.operators.timeseries import detect_gaps
    e = table(spark, d, "events").filter(~(F.col("event_id") % 50).between(7, 11)).select(F.timestamp_millis(F.col("event_id") * 100).alias("t"))
    return rounded(detect_gaps(e, "t").select(F.unix_millis("prev").alias("prev_ms"), F.unix_millis("cur").alias("cur_ms"), "delta", "step", "missing_steps"))


@query("fill_forward_text_order", """WITH e AS (SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS told, CASE WHEN event_id % 4 = 0 THEN NULL ELSE value END AS value FROM events)
SELECT event_id, round(coalesce(value, last_value(value IGNORE NULLS) OVER w,
  first_value(value IGNORE NULLS) OVER (ORDER BY told, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)), 6) AS value
FROM e WINDOW w AS (ORDER BY told, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def fill_forward_text_order(spark, d):
    """WIN-01/02 along times written as text, without a key."""
    from kiln.operators.timeseries import fill_forward
    e = table(spark, d, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("told"), F.when(F.col("event_id") % 4 != 0, F.col("value")).alias("value"))
    return rounded(fill_forward(e, ["told", "event_id"], None, ["value"], buckets=16).select("event_id", "value"))


@query("fill_forward_tied_order", """WITH e AS (SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE value END AS value FROM events)
SELECT event_id, round(coalesce(value, last_value(value IGNORE NULLS) OVER w,
  first_value(value IGNORE NULLS) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)), 6) AS value
FROM e WINDOW w AS (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def fill_forward_tied_order(spark, d):
    """WIN-01/02 where the first order column is the same in every row."""
    from kiln.operators.timeseries import fill_forward
    e = table(spark, d, "events").select("event_id", F.lit("same").alias("day"), F.when(F.col("event_id") % 4 != 0, F.col("value")).alias("value"))
    return rounded(fill_forward(e, ["day", "event_id"], None, ["value"], buckets=16).select("event_id", "value"))


DAILY_SQL = "(SELECT o_orderdate::DATE AS day, count(*) AS n, avg(o_totalprice) AS price FROM orders WHERE o_orderkey % 13 <> 0 GROUP BY 1 HAVING day(day) NOT BETWEEN 10 AND 12)"


def daily_orders(spark, d):
    """One row a day of orders, without the 10th to 12th of each month."""
    o = table(spark, d, "orders").filter("o_orderkey % 13 <> 0")
    return (o.groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(F.count("*").alias("n"), F.avg("o_totalprice").alias("price"))
            .filter(~F.dayofmonth("day").between(10, 12)))


@query("gaps_daily", f"""WITH g AS (SELECT lag(day) OVER (ORDER BY day) AS prev, day AS cur FROM {DAILY_SQL}),
s AS (SELECT cur - prev AS step FROM g WHERE prev IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT strftime(prev, '%Y-%m-%d') AS prev, strftime(cur, '%Y-%m-%d') AS cur, (cur - prev)::BIGINT AS delta, step::BIGINT AS step, ((cur - prev) // step - 1)::BIGINT AS missing_steps
FROM g, s WHERE cur - prev > step""")
def gaps_daily(spark, d):
    """WIN-05 on a DATE column: days."""
    from kiln.operators.timeseries import detect_gaps
    g = detect_gaps(daily_orders(spark, d), "day")
    return g.select(*[F.date_format(c, "yyyy-MM-dd").alias(c) for c in ("prev", "cur")], *[F.col(c).cast("long").alias(c) for c in ("delta", "step", "missing_steps")])


@query("interpolate_daily", f"""WITH e AS (SELECT day, CASE WHEN day(day) % 3 = 0 THEN NULL ELSE price END AS price FROM {DAILY_SQL}),
w AS (SELECT day, price, last_value(CASE WHEN price IS NOT NULL THEN day END IGNORE NULLS) OVER b AS x0, last_value(price IGNORE NULLS) OVER b AS y0,
  first_value(CASE WHEN price IS NOT NULL THEN day END IGNORE NULLS) OVER a AS x1, first_value(price IGNORE NULLS) OVER a AS y1
  FROM e WINDOW b AS (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), a AS (ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT strftime(day, '%Y-%m-%d') AS day, round(coalesce(price, y0 + (y1 - y0) * (day - x0) / (x1 - x0)), 6) AS price FROM w""")
def interpolate_daily(spark, d):
    """WIN-04 on a DATE column."""
    from kiln.operators.timeseries import interpolate_linear
    e = daily_orders(spark, d).select("day", F.when(F.dayofmonth("day") % 3 != 0, F.col("price")).alias("price"))
    return rounded(interpolate_linear(e, "day", None, ["price"]).select(F.date_format("day", "yyyy-MM-dd").alias("day"), "price"))


@query("stationarity_null_readings", """WITH e AS (SELECT user_id, ts, event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE value END AS value FROM events),
l AS (SELECT user_id, value - lag(value) OVER w AS dy, lag(value) OVER w AS y0 FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
r AS (SELECT user_id, regr_count(dy, y0) AS n, regr_slope(dy, y0) AS slope, regr_sxx(dy, y0) AS sxx, regr_syy(dy, y0) AS syy, regr_sxy(dy, y0) AS sxy
  FROM l WHERE y0 IS NOT NULL AND dy IS NOT NULL GROUP BY user_id)
SELECT user_id, n::BIGINT AS n, round(slope, 6) AS slope, round(CASE WHEN n > 2 AND sxx > 0 THEN slope / sqrt((syy - slope * sxy) / ((n - 2) * sxx)) END, 4) AS t_stat FROM r""")
def stationarity_null_readings(spark, d):
    """WIN-06: the lag is the row before, null readings included."""
    from kiln.operators.timeseries import stationarity
    e = table(spark, d, "events").select("user_id", "ts", "event_id", F.when(F.col("event_id") % 4 != 0, F.col("value")).alias("value"))
    return rounded(stationarity(e, ["ts", "event_id"], "value", "user_id"), per_col={"t_stat": 4})


@query("csv_round_trip", """SELECT s_suppkey::BIGINT AS s_suppkey, CASE WHEN s_suppkey % 5 <> 0 THEN s_name || chr(10) || '"quoted", line' END AS note,
  CASE WHEN s_suppkey % 2 = 0 THEN 'Y' ELSE 'N' END AS yn, s_suppkey % 3 = 0 AS flag, round(s_acctbal, 6) AS s_acctbal FROM supplier""")
def csv_round_trip(spark, d):
    """SNK-01, SRC-01: a table written as CSV and read again with inferred types."""
    import uuid

    from kiln.session import ensure_checkpoint_dir
    from kiln.sources.io import read_table, write_layer
    s = table(spark, d, "supplier")
    key = F.col("s_suppkey")
    out = s.select(key, F.when(key % 5 != 0, F.concat("s_name", F.lit('\n"quoted", line'))).alias("note"), F.when(key % 2 == 0, "Y").otherwise("N").alias("yn"),
                   (key % 3 == 0).alias("flag"), "s_acctbal")
    path = f"{ensure_checkpoint_dir(spark)}/csv-{uuid.uuid4().hex}"
    write_layer(out, path, fmt="csv")
    return rounded(read_table(spark, path))


@query("impute_zero", "SELECT event_id, round(coalesce(value, 0), 6) AS value FROM (SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE value END AS value FROM events)")
def impute_zero(spark, d):
    """IMP-04."""
    from kiln.operators.impute import impute
    e = table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 4 != 0, F.col("value")).alias("value"))
    return rounded(impute(e, ["value"], "zero"))


NAN_SQL = """(SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 7 <> 0 THEN l_quantity END AS q, CASE WHEN (l_orderkey + l_linenumber) % 5 <> 0 THEN l_extendedprice END AS p,
  CASE WHEN l_linenumber % 3 <> 0 THEN l_discount END AS dsc, l_tax, l_suppkey % 11 AS s FROM lineitem)"""


def with_nan(spark, d):
    """Missing numbers as NaN, as frames of other libraries mark them, and as null."""
    nan, key, line = F.lit(float("nan")), F.col("l_orderkey"), F.col("l_linenumber")
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(key % 7 != 0, F.col("l_quantity")).otherwise(nan).alias("q"),
        F.when((key + line) % 5 != 0, F.col("l_extendedprice")).when(line % 2 == 0, nan).alias("p"),
        F.when(line % 3 != 0, F.col("l_discount")).otherwise(nan).alias("dsc"), "l_tax", (F.col("l_suppkey") % 11).alias("s"))


@query("correlation_nan", " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM {NAN_SQL}"
                                             for i, a in enumerate(("q", "p", "dsc", "l_tax", "s")) for b in ("q", "p", "dsc", "l_tax", "s")[i + 1:]))
def correlation_nan(spark, d):
    """AGG-08 with NaN cells, by the block products that wide frames take."""
    from kiln.operators.gram import correlation_long
    return rounded(correlation_long(with_nan(spark, d), ["q", "p", "dsc", "l_tax", "s"], block=2, tiles=3, few=0))


@query("impute_nan", f"""SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, round(coalesce(q, (SELECT avg(q) FROM {NAN_SQL})), 6) AS q, round(coalesce(p, (SELECT median(p) FROM {NAN_SQL})), 6) AS p,
  round(coalesce(dsc, 0), 6) AS dsc FROM {NAN_SQL}""")
def impute_nan(spark, d):
    """IMP-01/02/04 where NaN marks the missing cells."""
    from kiln.operators.impute import impute
    df = with_nan(spark, d).select("l_orderkey", "l_linenumber", "q", "p", "dsc")
    return rounded(impute(impute(impute(df, ["q"], "mean"), ["p"], "median"), ["dsc"], "zero"))


@query("entity_mode_null_key", """WITH e AS (SELECT CASE WHEN user_id % 7 = 0 THEN NULL ELSE user_id END AS u, event_type, value FROM events),
m AS (SELECT u, event_type, row_number() OVER (PARTITION BY u ORDER BY count(*) DESC, event_type) AS k FROM e GROUP BY u, event_type)
SELECT a.u, round(a.total, 4) AS "value", m.event_type FROM (SELECT u, sum(value) AS total FROM e GROUP BY u) a JOIN m ON m.u IS NOT DISTINCT FROM a.u AND m.k = 1""")
def entity_mode_null_key(spark, d):
    """AGG-05: rows with a null key are an entity with its own sum and mode."""
    from kiln.operators.aggregate import entity_aggregate
    u = F.col("user_id")
    e = table(spark, d, "events").select(F.when(u % 7 != 0, u).alias("u"), "event_type", "value")
    return rounded(entity_aggregate(e, "u", sum_cols=["value"], mode_cols=["event_type"]), 4)


@query("timeseries_audit", """SELECT 'event_id' || CASE WHEN count(DISTINCT ts) = count(*) THEN ',ts' ELSE '' END AS id_cols, count_if(prev > ts) = 0 AS is_sorted, false AS has_date_column, 'forward_fill' AS imputation_strategy
FROM (SELECT ts, lag(ts) OVER (ORDER BY event_id) AS prev FROM events)""")
def timeseries_audit(spark, d):
    """PLAN-06, SORT-01: the audit's order check along the arrival column."""
    from kiln.plans import timeseries as TS
    plan = TS.audit(table(spark, d, "events").select("event_id", "user_id", "ts", "event_type"), "ts", position="event_id")
    tc = plan["temporal_consistency"]
    return spark.createDataFrame([(",".join(plan["id_cols"]), tc["is_sorted"], tc["has_date_column"], plan["config"]["imputation_strategy"])],
                                 "id_cols string, is_sorted boolean, has_date_column boolean, imputation_strategy string")


@query("gold_plan", """SELECT * FROM (VALUES ('subject_id', 'c_custkey'), ('algorithm', 'KMeans'), ('metrics', 'c_nationkey,c_acctbal'), ('limits', '0.9 0.01'),
  ('keep', 'bal_per_nation'), ('scaler', 'PowerTransformer')) t(key, value) WHERE (SELECT count(*) FROM customer) > 0""")
def gold_plan(spark, d):
    """PLAN-07: the gold plan of customer for a strategy with one interaction."""
    from kiln.operators.profile import profile
    from kiln.plans.rules import plan_gold
    plan = plan_gold(profile(table(spark, d, "customer"), with_mad=False), {"subject_id": "c_custkey"}, {
        "interaction_priorities": [{"pair": ["c_acctbal", "c_nationkey"], "logic": "ratio", "name": "bal_per_nation"}], "feature_selection": {"max_correlation_threshold": 0.9}})
    sel = plan["selection_params"]
    rows = [("subject_id", plan["subject_id"]), ("algorithm", plan["recommended_algorithm"]), ("metrics", ",".join(plan["base_metrics"])),
            ("limits", f"{sel['correlation_threshold']} {sel['variance_threshold']}"), ("keep", ",".join(sel["force_keep"])), ("scaler", plan["preprocessing"]["scaler"])]
    return spark.createDataFrame(rows, "key string, value string")


@query("gold_audit_supervised")
def gold_audit_supervised(spark, d):
    """SEL-10: the supervised gold audit over columns of every type of documents x labels."""
    from kiln.catalog.models import supervised_frame
    from kiln.plans.supervised import plan_gold_supervised
    plan = plan_gold_supervised(supervised_frame(spark, d), "quality", max_features=3)
    return spark.createDataFrame([(c, c in plan["selected_features"]) for c in plan["base_columns"]], "feature string, selected boolean")


@query("segment_score")
def segment_score(spark, d):
    """SCO-01: rows scored with the fitted path of ``segment``, its interaction and components included."""
    from kiln.operators.score import score
    from kiln.plans.clustering import segment
    c = table(spark, d, "customer").select("c_custkey", "c_acctbal", "c_nationkey", "c_mktsegment")
    res = segment(c, {"interaction_priorities": [{"pair": ["c_acctbal", "c_nationkey"], "logic": "multiplication", "name": "bal_nation"}],
                      "preprocessing_metadata": {"dimensionality_reduction_recommendation": {"method": "PCA"}}}, k=4)
    return score(c, res["prep"], res["model"], res["features"]).select("c_custkey", F.col("cluster").cast("long").alias("cluster"))
