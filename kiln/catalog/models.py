"""Model-based queries.  Their checks are rows-only: the fits are iterative or
randomised (seeded), so no SQL oracle reproduces them exactly."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.catalog.core import EV_NULL_SQL, customer_features, customer_with_nulls, events_with_nulls
from kiln.catalog.registry import query, rounded, table
from kiln.session import materialize

CUST_FEATS = ["inc", "spd", "age"]


def scaled_customer_features(spark, d):
    from kiln.operators.scale import fit_standard_scale
    f = customer_features(spark, d).fillna(0.0, subset=["spd"])
    return fit_standard_scale(f, CUST_FEATS).transform(f)


def supervised_frame(spark, d):
    """documents x labels: numeric and text features, target ``quality``."""
    docs = table(spark, d, "documents").select(
        "doc_id", "n_chars", F.size(F.split("text", r"\s+")).alias("n_words"), "lang", "source")   # counted here: no text is shuffled
    lab = table(spark, d, "labels")
    return docs.join(lab, "doc_id").select(
        "doc_id", "n_chars", "n_words", "lang", "source",
        F.col("toxic").cast("long").alias("toxic"), F.col("quality").cast("long").alias("quality"))


SUP_FEATS = ["n_chars", "n_words", "toxic", "lang", "source"]


@query("k_sweep_elbow")
def k_sweep_elbow(spark, d):
    """CLU-02/03: inertia for k = 2..10 (best of 10 starts) and the Kneedle knee."""
    from kiln.operators.cluster import assemble, choose_k, k_sweep
    vec = assemble(scaled_customer_features(spark, d), CUST_FEATS)
    curve = k_sweep(vec, "KMeans")
    k = choose_k(curve, "KMeans")
    return rounded(spark.createDataFrame([(kk, v, kk == k) for kk, v in curve],
                                         "k long, inertia double, chosen boolean"), 4)


@query("kmeans_personas")
def kmeans_personas(spark, d):
    """CLU-01/06/07: k-means (k=5, best of 10), clusters relabelled by size, personas long form."""
    from kiln.operators.cluster import fit_clusters, persona_traits, relabel_by_size
    _m, labeled, _ = fit_clusters(scaled_customer_features(spark, d), CUST_FEATS, "KMeans", k=5)
    labeled = relabel_by_size(labeled)
    traits = persona_traits(labeled, CUST_FEATS)
    sizes = labeled.groupBy("cluster").agg(F.count(F.lit(1)).alias("sample_size"),
                                           F.avg("certainty").alias("mean_certainty"))
    return rounded(traits.join(sizes, "cluster"))


@query("gmm_certainty")
def gmm_certainty(spark, d):
    """DIM-01 + CLU-04/05/06: PCA(5) of the embeddings, GMM k by min BIC over 2..10, certainty."""
    from kiln.operators.cluster import fit_clusters, pca
    reduced, _ = pca(table(spark, d, "embeddings"), ["embedding"], components=5, keep=["vec_id"])
    cols = [f"PC{i}" for i in range(1, 6)]
    _m, labeled, _curve = fit_clusters(reduced, cols, "GMM")
    return rounded(labeled.select("vec_id", "cluster", "certainty"))


STEP_START = ((0.4, (2.0, 6.0), (9.0, 1.0, 30.0)), (0.6, (6.0, 16.0), (12.0, -2.0, 40.0)))   # weight, mean, covariance

MIXTURE_STEP_SQL = "WITH t AS (SELECT c_custkey AS i, c_acctbal / 1000 AS x, c_nationkey::DOUBLE AS y FROM customer), p AS (" + " UNION ALL ".join(
    f"SELECT i, x, y, {c} AS c, ln({w}) - ln(2 * pi()) - 0.5 * ln({a * g - b * b}) - ({g} * (x - {mx}) ** 2 - 2 * ({b}) * (x - {mx}) * (y - {my})"
    f" + {a} * (y - {my}) ** 2) / (2 * {a * g - b * b}) AS l FROM t" for c, (w, (mx, my), (a, b, g)) in enumerate(STEP_START)) + """),
d AS (SELECT i, ln(sum(exp(l))) AS l FROM p GROUP BY i),
r AS (SELECT p.x, p.y, p.c, exp(p.l - d.l) AS r FROM p JOIN d USING (i)),
m AS (SELECT c, sum(r) AS n, sum(r * x) / sum(r) AS mx, sum(r * y) / sum(r) AS my FROM r GROUP BY c)
SELECT m.c::BIGINT AS component, round(any_value(m.n) / (SELECT count(*) FROM t), 6) AS weight, round(any_value(m.mx), 6) AS mean_x, round(any_value(m.my), 6) AS mean_y,
  round(sum(r * (x - m.mx) ** 2) / any_value(m.n) + 1e-6, 6) AS var_x, round(sum(r * (x - m.mx) * (y - m.my)) / any_value(m.n), 6) AS cov_xy,
  round(sum(r * (y - m.my) ** 2) / any_value(m.n) + 1e-6, 6) AS var_y, round((SELECT avg(l) FROM d), 6) AS mean_log_likelihood
FROM r JOIN m USING (c) GROUP BY m.c"""


@query("mixture_step", MIXTURE_STEP_SQL)
def mixture_step(spark, d):
    """CLU-04: one E and M step of a two-component mixture of customers from given parameters."""
    import numpy as np

    from kiln.operators.cluster import assemble
    from kiln.operators.mixtures import Mixture, em_step
    c = table(spark, d, "customer").select((F.col("c_acctbal") / 1000).alias("x"), F.col("c_nationkey").cast("double").alias("y"))
    start = Mixture(np.array([w for w, _m, _c in STEP_START]), np.array([m for _w, m, _c in STEP_START]),
                    np.array([[[a, b], [b, g]] for _w, _m, (a, b, g) in STEP_START]))
    got = em_step(assemble(c, ["x", "y"]), start)
    rows = [(i, float(w), *map(float, mu), float(s[0, 0]), float(s[0, 1]), float(s[1, 1]), got.log_likelihood / got.n)
            for i, (w, mu, s) in enumerate(zip(got.weights, got.means, got.covs))]
    return rounded(spark.createDataFrame(rows, "component bigint, weight double, mean_x double, mean_y double, var_x double, "
                                               "cov_xy double, var_y double, mean_log_likelihood double"))


KMEANS_START = ((1.0, 4.0), (3.0, 20.0), (7.0, 12.0))


def _kmeans_steps_sql(steps):
    ctes = ["t AS (SELECT c_custkey AS i, c_acctbal / 1000 AS x, c_nationkey::DOUBLE AS y FROM customer)",
            "k0(c, cx, cy) AS (VALUES " + ", ".join(f"({i}, {x}::DOUBLE, {y}::DOUBLE)" for i, (x, y) in enumerate(KMEANS_START)) + ")"]
    for s in range(steps + 1):
        ctes.append(f"a{s} AS (SELECT i, x, y, c, (x - cx) ** 2 + (y - cy) ** 2 AS d2 FROM t CROSS JOIN k{s} "
                    "QUALIFY row_number() OVER (PARTITION BY i ORDER BY d2, c) = 1)")
        ctes.append(f"k{s + 1} AS (SELECT c, avg(x) AS cx, avg(y) AS cy FROM a{s} GROUP BY c)")
    return (f"WITH {', '.join(ctes)} SELECT k.c::BIGINT AS cluster, round(k.cx, 6) AS x, round(k.cy, 6) AS y, "
            f"(SELECT count(*) FROM a{steps} a WHERE a.c = k.c)::BIGINT AS n, round((SELECT sum(d2) FROM a{steps}), 4) AS inertia FROM k{steps} k")


@query("kmeans_steps", _kmeans_steps_sql(3))
def kmeans_steps(spark, d):
    """CLU-01: three Lloyd steps of three clusters of customers from given centres, and the rows nearest each."""
    import numpy as np

    from kiln.operators.cluster import assemble
    from kiln.operators.multikmeans import centroid_model, multi_kmeans
    c = table(spark, d, "customer").select((F.col("c_acctbal") / 1000).alias("x"), F.col("c_nationkey").cast("double").alias("y"))
    vec = assemble(c, ["x", "y"])
    centres, inertia = multi_kmeans(vec, [(3, 0)], max_iter=3, tol=-1.0, init={(3, 0): np.array(KMEANS_START)})[(3, 0)]
    at = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(centres)], "cluster bigint, x double, y double")
    near = centroid_model(centres, "features", "cluster").transform(vec).groupBy(F.col("cluster").cast("bigint").alias("cluster")).agg(
        F.count("*").alias("n"))
    return rounded(at.join(near, "cluster").withColumn("inertia", F.round(F.lit(inertia), 4)))


@query("pca_retain")
def pca_retain(spark, d):
    """DIM-01: components kept for 95 % variance; long form (vec_id, component, score)."""
    from kiln.operators.cluster import pca
    out, _ratios = pca(table(spark, d, "embeddings"), ["embedding"], retain=0.95, keep=["vec_id"])
    pcs = [c for c in out.columns if c.startswith("PC")]
    long = out.select("vec_id", F.explode(F.array(*[F.struct(F.lit(c).alias("component"), F.col(c).alias("score"))
                                                    for c in pcs])).alias("p")).select("vec_id", "p.*")
    return rounded(long)


@query("cluster_coords")
def cluster_coords(spark, d):
    """DIM-02: 2-D PCA coordinates per labelled row (the data behind the plot)."""
    from kiln.operators.cluster import pca
    out, _ = pca(table(spark, d, "embeddings"), ["embedding"], components=2, keep=["vec_id", "label"])
    return rounded(out)


SILHOUETTE_SQL = """WITH l AS (SELECT vec_id, label, pos, x::DOUBLE AS x
    FROM (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings)),
pn AS (SELECT vec_id, label, sum(x * x) AS nn FROM l GROUP BY 1, 2),
cs AS (SELECT label, pos, sum(x) AS s FROM l GROUP BY 1, 2),
cq AS (SELECT label, count(*) AS n, sum(nn) AS q FROM pn GROUP BY 1),
dt AS (SELECT l.vec_id, cs.label AS cl, sum(l.x * cs.s) AS d FROM l JOIN cs ON l.pos = cs.pos GROUP BY 1, 2),
md AS (SELECT pn.vec_id, pn.label, dt.cl, cq.n, (cq.n * pn.nn - 2 * dt.d + cq.q) AS tot
    FROM pn JOIN dt ON pn.vec_id = dt.vec_id JOIN cq ON cq.label = dt.cl),
s AS (SELECT vec_id, label, max(CASE WHEN cl = label THEN n END) AS own_n,
    max(CASE WHEN cl = label AND n > 1 THEN tot / (n - 1) END) AS a, min(CASE WHEN cl <> label THEN tot / n END) AS b
    FROM md GROUP BY 1, 2)
SELECT count(DISTINCT label)::BIGINT AS k,
  round(avg(CASE WHEN own_n = 1 THEN 0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0 END), 6) AS silhouette
FROM s"""


@query("silhouette_euclidean", """WITH t AS (SELECT c_custkey AS i, c_mktsegment AS c, c_acctbal / 1000 AS x, c_nationkey AS y FROM customer),
p AS (SELECT a.i, a.c, b.c AS o, sum(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2)) AS s, count(*) AS n FROM t a CROSS JOIN t b GROUP BY ALL),
r AS (SELECT i, max(CASE WHEN o = c THEN s / (n - 1) END) AS a, min(CASE WHEN o <> c THEN s / n END) AS b FROM p GROUP BY i)
SELECT count(*)::BIGINT AS n, round(avg((b - a) / greatest(a, b)), 6) AS silhouette FROM r""")
def silhouette_euclidean(spark, d):
    """CLU-09 with Euclidean distances; clusters below the sample size are taken whole."""
    from kiln.operators.silhouette import euclidean_silhouette
    c = table(spark, d, "customer").select((F.col("c_acctbal") / 1000).alias("x"), F.col("c_nationkey").alias("y"), "c_mktsegment")
    got = euclidean_silhouette(c, ["x", "y"], "c_mktsegment")
    return rounded(spark.createDataFrame([(got["n"], got["silhouette"])], "n bigint, silhouette double"))


LOF_SQL = """WITH t AS (SELECT c_custkey AS i, c_acctbal / 1000 AS x, c_nationkey AS y FROM customer),
p AS (SELECT i, j, d FROM (SELECT a.i, b.i AS j, sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) AS d FROM t a JOIN t b ON a.i <> b.i)
  QUALIFY row_number() OVER (PARTITION BY i ORDER BY d, j) <= 20),
f AS (SELECT i, max(d) AS far FROM p GROUP BY i),
l AS (SELECT p.i, count(*) / sum(greatest(p.d, f.far)) AS own FROM p JOIN f ON f.i = p.j GROUP BY p.i)
SELECT p.i AS c_custkey, round(avg(b.own) / any_value(a.own), 6) AS lof FROM p JOIN l a ON a.i = p.i JOIN l b ON b.i = p.j GROUP BY p.i"""


@query("local_outliers", LOF_SQL)
def local_outliers_q(spark, d):
    """VAL-09: local outlier factor of every customer among its 20 nearest."""
    from kiln.operators.neighbours import local_outliers
    c = table(spark, d, "customer").select("c_custkey", (F.col("c_acctbal") / 1000).alias("x"), F.col("c_nationkey").alias("y"))
    return rounded(local_outliers(c, ["x", "y"]).select("c_custkey", "lof"))


@query("silhouette", SILHOUETTE_SQL)
def silhouette_q(spark, d):
    """CLU-09: silhouette of the fixed labels (squared Euclidean, Spark's O(n k) form)."""
    from kiln.operators.cluster import silhouette
    emb = table(spark, d, "embeddings")
    s = silhouette(emb, ["embedding"], cluster="label")
    return rounded(emb.agg(F.count_distinct("label").cast("long").alias("k")).select(
        "k", F.lit(s).alias("silhouette")))


@query("bisecting")
def bisecting(spark, d):
    """CLU-11: divisive hierarchical clustering of customer features, k=4."""
    from kiln.operators.cluster import bisecting_kmeans
    _m, out = bisecting_kmeans(scaled_customer_features(spark, d), CUST_FEATS, 4)
    return out.select("c_custkey", F.col("cluster").cast("long"))


@query("ward_ladder")
def ward_ladder(spark, d):
    """CLU-11: sum of squares within and Calinski-Harabasz of Ward's clusters of customers, k=2..10."""
    from kiln.operators.agglomerative import fit_ward
    tree = fit_ward(scaled_customer_features(spark, d), CUST_FEATS)
    return rounded(spark.createDataFrame(tree.ladder(range(2, 11)), "k bigint, within double, score double"), 4)


@query("ward_clusters", """WITH t AS (SELECT l_linenumber::DOUBLE AS x, l_orderkey % 2 AS g FROM lineitem),
r AS (SELECT x + 1000 * (x % 3) + 1e6 * g AS v, x % 3 AS m, g FROM t)
SELECT m::BIGINT AS third, g::BIGINT AS side, count(*)::BIGINT AS n, (row_number() OVER (ORDER BY count(*) DESC, min(v)) - 1)::BIGINT AS cluster FROM r GROUP BY ALL""")
def ward_clusters(spark, d):
    """CLU-11 on lines in six far groups: each is a cluster, the largest first."""
    from kiln.operators.agglomerative import agglomerative
    line = table(spark, d, "lineitem").select((F.col("l_linenumber") % 3).cast("long").alias("third"), (F.col("l_orderkey") % 2).cast("long").alias("side"), "l_linenumber")
    _tree, out = agglomerative(line.withColumn("v", F.col("l_linenumber") + 1000 * F.col("third") + 1e6 * F.col("side")), ["v"], 6)
    return rounded(out.groupBy("third", "side", "cluster").agg(F.count("*").alias("n")))


@query("score_new")
def score_new(spark, d):
    """SCO-01: fit clean + k-means on customers, name clusters with the segment
    ladder over cluster means, then score the customer rows."""
    from pyspark.ml import PipelineModel

    from kiln.operators.cluster import fit_clusters
    from kiln.operators.features import segment_name
    from kiln.operators.scale import fit_standard_scale
    from kiln.operators.score import score
    raw = customer_features(spark, d).fillna(0.0, subset=["spd"])
    prep = PipelineModel([fit_standard_scale(raw, CUST_FEATS)])
    model, labeled, _ = fit_clusters(prep.transform(raw), CUST_FEATS, "KMeans", k=5)
    means = raw.join(labeled.select("c_custkey", "cluster"), "c_custkey").groupBy("cluster").agg(
        *[F.avg(c).alias(c) for c in CUST_FEATS])
    personas = means.select("cluster", segment_name(F.col("inc"), F.col("spd"), F.col("age")).alias("persona"))
    return rounded(score(raw, prep, model, CUST_FEATS, personas).select("c_custkey", "cluster", "persona"))


@query("importance_filter")
def importance_filter_q(spark, d):
    """SEL-05: permutation importance (50-tree forest, 3 repeats); weak < 0.02, best kept."""
    from kiln.operators.model_select import importance_filter
    imp, weak = importance_filter(supervised_frame(spark, d), SUP_FEATS, "quality", 0.02)
    return rounded(spark.createDataFrame([(c, v, c in weak) for c, v in imp],
                                         "feature string, importance double, weak boolean"))


@query("predictive_power")
def predictive_power_q(spark, d):
    """SEL-06: predictive power score of each feature for quality."""
    from kiln.operators.model_select import predictive_power
    pps = predictive_power(supervised_frame(spark, d), SUP_FEATS, "quality")
    return rounded(spark.createDataFrame(pps, "feature string, pps double"))


LINES_SQL = """r AS (SELECT l_linenumber AS x, l_orderkey % 4 AS k, CASE WHEN l_linenumber % 2 = 0 THEN l_linestatus ELSE l_returnflag END AS y,
  l_quantity * (1 + l_linenumber % 3) AS v FROM lineitem)"""


def lines_frame(spark, d):
    line = F.col("l_linenumber")
    return table(spark, d, "lineitem").select(line.alias("x"), (F.col("l_orderkey") % 4).alias("k"), "l_tax",
                                              F.when(line % 2 == 0, F.col("l_linestatus")).otherwise(F.col("l_returnflag")).alias("y"), (F.col("l_quantity") * (1 + line % 3)).alias("v"))


@query("predictive_power_classes", f"""WITH {LINES_SQL},
p AS (SELECT x, k, y AS said FROM (SELECT a.x, f.k, a.y, row_number() OVER (PARTITION BY a.x, f.k ORDER BY count(*) DESC, a.y) AS i
  FROM r a JOIN (VALUES (0), (1), (2), (3)) f(k) ON a.k <> f.k GROUP BY a.x, f.k, a.y) WHERE i = 1),
c AS (SELECT y, said, count(*) AS n FROM r JOIN p USING (x, k) GROUP BY ALL),
f AS (SELECT sum(a.n * coalesce(2.0 * h.n / (a.n + coalesce(s.n, 0)), 0)) / sum(a.n) AS f1 FROM (SELECT y, sum(n) AS n FROM c GROUP BY y) a
  LEFT JOIN (SELECT said AS y, sum(n) AS n FROM c GROUP BY said) s USING (y) LEFT JOIN (SELECT y, n FROM c WHERE y = said) h USING (y)),
b AS (SELECT max(n) * (2.0 * max(n) / (max(n) + sum(n))) / sum(n) AS f1 FROM (SELECT count(*) AS n FROM r GROUP BY y))
SELECT 'x' AS feature, round(greatest(0, (f.f1 - b.f1) / (1 - b.f1)), 6) AS pps FROM f, b""")
def predictive_power_classes(spark, d):
    """SEL-06 with given folds; at depth 6 a tree over seven values tells each value's commonest class."""
    from kiln.operators.model_select import predictive_power
    pps = predictive_power(lines_frame(spark, d), ["x"], "y", max_depth=6, fold="k")
    return rounded(spark.createDataFrame(pps, "feature string, pps double"))


@query("predictive_power_numbers", f"""WITH {LINES_SQL},
p AS (SELECT a.x, f.k, avg(a.v) AS said FROM r a JOIN (VALUES (0), (1), (2), (3)) f(k) ON a.k <> f.k GROUP BY a.x, f.k)
SELECT 'x' AS feature, round(greatest(0, 1 - (SELECT avg(abs(v - said)) FROM r JOIN p USING (x, k)) / (SELECT avg(abs(v - (SELECT median(v) FROM r))) FROM r)), 6) AS pps""")
def predictive_power_numbers(spark, d):
    """SEL-06 of a numeric target with given folds: each value's mean."""
    from kiln.operators.model_select import predictive_power
    pps = predictive_power(lines_frame(spark, d), ["x"], "v", max_depth=6, fold="k")
    return rounded(spark.createDataFrame(pps, "feature string, pps double"))


@query("rotate_columns", """WITH e AS (SELECT event_id, value, user_id, row_number() OVER (ORDER BY event_id) - 1 AS i, count(*) OVER () AS n FROM events)
SELECT a.event_id, round(a.value, 6) AS value, round(b.value, 6) AS value_1, c.user_id::DOUBLE AS user_7 FROM e a JOIN e b ON b.i = (a.i + 1) % a.n JOIN e c ON c.i = (a.i + 7) % a.n""")
def rotate_columns(spark, d):
    """SEL-05's rotation: values of rows 1 and 7 places on, in one circle of all rows."""
    from kiln.operators.model_select import rotated
    e = rotated(table(spark, d, "events").select("event_id", "value", "user_id"), ["value", "user_id"], [1, 7], order_by="event_id", buckets=1)
    return rounded(e.select("event_id", "value", F.col("__r")[0][0].alias("value_1"), F.col("__r")[1][1].alias("user_7")))


@query("softmax_importance")
def softmax_importance(spark, d):
    """SEL-07: gains of three-class softmax boosting over numbers of lineitem."""
    from kiln.operators.histogram import softmax_boost
    from kiln.operators.model_select import _prepare
    feats = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate", "l_linestatus"]
    base = _prepare(table(spark, d, "lineitem"), feats, "l_returnflag", True)
    gains = softmax_boost(base, feats, 3, rounds=5)[0]
    return rounded(spark.createDataFrame([(c, gains.get(c, 0.0)) for c in feats], "feature string, gain double"), 4)


@query("sulov_select")
def sulov_select_q(spark, d):
    """SEL-07: SULOV by mutual information (limit 0.70), then boosted-tree importances."""
    from kiln.operators.model_select import sulov_select
    f = supervised_frame(spark, d).withColumn("n_chars_x2", F.col("n_chars") * 2 + 1)
    feats = SUP_FEATS + ["n_chars_x2"]
    keep, mi = sulov_select(f, feats, "quality")
    return rounded(spark.createDataFrame([(c, v, c in keep) for c, v in mi],
                                         "feature string, mi double, selected boolean"))


@query("validate_pps")
def validate_pps(spark, d):
    """VAL-10/11: feature-label and identifier-label predictive power findings."""
    from kiln.operators.validate import validate
    f = supervised_frame(spark, d)
    out = validate(f, label="quality", with_pps=True, id_cols=["doc_id"])
    return rounded(out.where(F.col("check").endswith("_pps")))


@query("rfe")
def rfe_q(spark, d):
    """SEL-09: recursive elimination with a 30-tree forest down to 2 features."""
    from kiln.operators.model_select import rfe
    keep = rfe(supervised_frame(spark, d), SUP_FEATS, "quality", n=2)
    return spark.createDataFrame([(c, c in keep) for c in SUP_FEATS], "feature string, selected boolean")


SUPERVISED_CLEAN_SQL = r"""WITH s AS (SELECT d.doc_id, len(regexp_split_to_array(d.text, '\s+'))::BIGINT AS n_words, d.lang, d.source,
    l.quality::BIGINT AS quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
f AS (SELECT DISTINCT n_words, lang, source, quality FROM s),
b AS (SELECT n_words, lang, source FROM f GROUP BY 1, 2, 3 HAVING min(quality) <> max(quality))
SELECT * FROM f WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.n_words = f.n_words AND b.lang = f.lang
  AND b.source = f.source)"""


@query("supervised_clean", SUPERVISED_CLEAN_SQL)
def supervised_clean(spark, d):
    """Supervised silver: audit (ids, thresholds, duplicates, predictive power) then the whole cleaning chain.
    Here the split drops doc_id (unique), permutation importance drops toxic (at most 0.003 at sf0.01,
    threshold 0.005), VIF (threshold 20) drops n_chars (r = 0.997 with n_words; see ``vif_filter``), so n_words
    is left of the numbers; keep-first dedup and conflicting labels finish it."""
    from kiln.plans import supervised as S
    f = materialize(supervised_frame(spark, d))   # every step is passes over these columns: texts are split once
    plan = S.audit(f, "quality")
    return rounded(S.clean(f, "quality", plan, order_by="doc_id"))


GOLD_SELECTED = ["o_totalprice", "l_quantity", "o_totalprice_ratio_l_quantity",
                 "l_last_shipdate_minus_o_orderdate_days", "o_orderpriority"]

SUPERVISED_GOLD_SQL = """WITH li AS (SELECT l_orderkey, max(l_shipdate) AS l_last_shipdate, sum(l_quantity) AS l_quantity
    FROM lineitem GROUP BY 1),
j AS (SELECT o.o_orderkey, o.o_totalprice, o.o_orderdate, o.o_orderpriority, o.o_orderstatus, li.l_last_shipdate,
    li.l_quantity FROM orders o JOIN li ON o.o_orderkey = li.l_orderkey),
pc AS (SELECT o_orderpriority AS lvl, dense_rank() OVER (ORDER BY min(o_orderkey), o_orderpriority) - 1 AS code
    FROM j WHERE o_orderpriority IS NOT NULL GROUP BY 1),
f AS (SELECT j.o_totalprice, j.l_quantity, j.o_totalprice / (j.l_quantity + 1e-5) AS o_totalprice_ratio_l_quantity,
    floor((epoch_us(j.l_last_shipdate) - epoch_us(j.o_orderdate)) / 86400000000.0) AS l_last_shipdate_minus_o_orderdate_days,
    coalesce(pc.code, -1) AS o_orderpriority, j.o_orderstatus FROM j LEFT JOIN pc ON j.o_orderpriority = pc.lvl)
SELECT """ + ", ".join(
    f"round(({c} - (SELECT quantile_cont({c}, 0.5) FROM f)) / (SELECT CASE WHEN quantile_cont({c}, 0.75) - "
    f"quantile_cont({c}, 0.25) = 0 THEN 1 ELSE quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) END FROM f), 6) AS {c}"
    for c in GOLD_SELECTED) + ", o_orderstatus FROM f"


@query("supervised_gold", SUPERVISED_GOLD_SQL)
def supervised_gold(spark, d):
    """FE-09: engineered features aligned to the base columns, imputed, robust-scaled."""
    from kiln.plans import supervised as S
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority",
                                         F.col("o_orderstatus"))
    li = table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.max("l_shipdate").alias("l_last_shipdate"), F.sum("l_quantity").alias("l_quantity"))
    silver = o.join(li, o.o_orderkey == li.l_orderkey).drop("l_orderkey")
    plan = {"selected_features": GOLD_SELECTED,
            "base_columns": ["o_totalprice", "l_quantity", "o_totalprice_ratio_l_quantity",
                             "l_last_shipdate_minus_o_orderdate_days", "o_orderdate_year", "o_orderpriority"],
            "target_column": "o_orderstatus", "target_exists": True}
    out, _ = S.gold_features(silver, plan, order_by="o_orderkey")
    return rounded(out)


TS_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


@query("timeseries_clean", f"""SELECT user_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, round(coalesce(value,
  last_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)), 6) AS value
FROM {EV_NULL_SQL}""")
def timeseries_clean(spark, d):
    """Time-series silver: audit (ids by uniqueness), forward/back fill per user, ids dropped."""
    from kiln.plans import timeseries as TS
    e = events_with_nulls(spark, d)
    plan = TS.audit(e, "ts", position="event_id")
    out = TS.clean(e, plan, ["ts"], "user_id")
    return rounded(out.withColumn("ts", F.date_format("ts", TS_FMT)))


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query("clean_contract_events", """WITH q AS (SELECT quantile_cont(value, 0.5) AS m,
    quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS iq FROM events)
SELECT strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id,
  round((value - (SELECT m FROM q)) / (SELECT CASE WHEN iq = 0 THEN 1 ELSE iq END FROM q), 6) AS value, """
       + ", ".join(f"CASE WHEN event_type = '{t}' THEN 1 ELSE 0 END::BIGINT AS event_type_{t}" for t in EVENT_TYPES)
       + """, CASE WHEN count(*) OVER (PARTITION BY props) >= 0.05 * (SELECT count(*) FROM events) THEN props ELSE 'Rare' END AS props FROM events""")
def clean_contract_events(spark, d):
    """Clustering silver of events: the policy makes user_id the subject and
    event_id garbage; value is protected (no clip / transform) and robust-scaled;
    the many texts of props keep the levels of at least 5 % of the rows."""
    from kiln.plans.clustering import audit_and_clean
    silver, _c, _m = audit_and_clean(table(spark, d, "events"))
    return rounded(silver.withColumn("ts", F.date_format("ts", TS_FMT)))


__all__ = ["customer_with_nulls"]


def _greedy_sql():
    from kiln.catalog.core import SEL_COLS, SEL_SQL_BASE
    pairs = " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM {SEL_SQL_BASE}"
        for a in SEL_COLS for b in SEL_COLS if a != b)
    names = ", ".join(f"({i}, '{c}')" for i, c in enumerate(SEL_COLS))
    return f"""WITH RECURSIVE p AS ({pairs}),
c AS (SELECT pos, name, row_number() OVER (ORDER BY name) AS k FROM (VALUES {names}) t(pos, name)),
walk(k, kept) AS (
  SELECT 0, []::VARCHAR[]
  UNION ALL
  SELECT w.k + 1, CASE WHEN EXISTS (SELECT 1 FROM p JOIN c ON p.b = c.name
                                    WHERE c.k = w.k + 1 AND list_contains(w.kept, p.a) AND abs(p.r) > 0.8)
                       THEN w.kept ELSE list_append(w.kept, (SELECT name FROM c WHERE c.k = w.k + 1)) END
  FROM walk w WHERE w.k < (SELECT count(*) FROM c))
SELECT c.pos::BIGINT AS position, c.name AS "column",
  list_contains((SELECT kept FROM walk ORDER BY k DESC LIMIT 1), c.name) AS kept FROM c"""


@query("corr_filter_greedy", _greedy_sql())
def corr_filter_greedy(spark, d):
    """SEL-03: greedy correlation filter (|r| > 0.8, scanned in name order: a
    kept column evicts every later one correlated above the threshold)."""
    from kiln.catalog.core import SEL_COLS, selection_frame
    from kiln.operators.select import corr_filter
    kept = set(corr_filter(selection_frame(spark, d), SEL_COLS, 0.8, greedy=True, order="name"))
    return spark.createDataFrame([(i, c, c in kept) for i, c in enumerate(SEL_COLS)],
                                 "position long, column string, kept boolean")


@query("segment_customers")
def segment_customers(spark, d):
    """The whole clustering path in one call on customer joined with its order
    aggregates: profile, policy, contract, silver, gold, k sweep + knee, personas."""
    from kiln.plans.clustering import segment
    c = table(spark, d, "customer")
    o = table(spark, d, "orders").groupBy("o_custkey").agg(
        F.count("o_orderkey").alias("n_orders"), F.sum("o_totalprice").alias("total_spent"))
    df = c.join(o, c.c_custkey == o.o_custkey, "left").drop("o_custkey").fillna(0, subset=["n_orders", "total_spent"])
    res = segment(df, strategy={"interaction_priorities": [
        {"pair": ["total_spent", "n_orders"], "logic": "ratio", "name": "spend_per_order",
         "error_handling": "zero_fill"}]}, algo="KMeans")
    p = res["personas"]
    return rounded(p.select("cluster", F.explode("dominant_traits").alias("feature", "trait"), "sample_size",
                            "mean_certainty"))
