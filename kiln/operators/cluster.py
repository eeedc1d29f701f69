"""Dimensionality reduction, clustering and personas (DIM-01/02, CLU-01..12).

k-means (sweep and final fit) runs on the multi-model engine in
``kiln.operators.multikmeans`` (every model advances in the same pass), Gaussian
mixtures likewise on ``kiln.operators.mixtures``; the Spark ML paths stay available
as :func:`kmeans` and :func:`gmm`.  Bisecting k-means and PCA use Spark ML.  Everything around the
models -- k choice, BIC, certainty, personas, Calinski-Harabasz -- is
DataFrame aggregation over (cluster, feature) groups with map-side combine.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.clustering import BisectingKMeans, GaussianMixture, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.functions.stats import qcol
from kiln.operators.base import ColumnRules, register
from kiln.operators.features import trait

K_RANGE = range(2, 11)   # fixed value: the reference sweeps k = 2..10
DEFAULT_K = 3            # fixed value: k when no knee is found
N_INIT = 10              # fixed value: k-means restarts
SEED = 42                # fixed value: random state


def assemble(df: DataFrame, cols, out: str = "features") -> DataFrame:
    """Numeric columns (or one array column) -> ML vector; rows with nulls skipped (FLT-01)."""
    cols = list(cols)
    if len(cols) == 1 and dict(df.dtypes)[cols[0]].startswith("array"):
        return df.withColumn(out, array_to_vector(qcol(cols[0]).cast("array<double>")))
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="skip").transform(df)


# ---------------------------------------------------------------- k-means / GMM
def parallelism(spark) -> int:
    """Concurrent model fits (Spark runs jobs from several driver threads)."""
    return int(spark.conf.get("kiln.ml.parallelism", "8"))


def _run_all(fn, items, workers: int):
    if workers <= 1 or len(items) <= 1:
        return [fn(x) for x in items]
    with ThreadPoolExecutor(max_workers=min(workers, len(items))) as ex:
        return list(ex.map(fn, items))


def _fit_kmeans(vec, k, seed, max_iter, features):
    return KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol=features, tol=1e-4).fit(vec)


def kmeans(vec: DataFrame, k: int, seed: int = SEED, n_init: int = N_INIT, max_iter: int = 300,
           features: str = "features"):
    """CLU-01 with Spark ML: best (lowest inertia, then lowest seed) of
    ``n_init`` k-means|| runs, fitted as concurrent Spark jobs over cached
    vectors.  :func:`fit_clusters` uses the multi-model engine instead."""
    models = _run_all(lambda s: _fit_kmeans(vec, k, seed + s, max_iter, features), list(range(n_init)),
                      parallelism(vec.sparkSession))
    return min(zip(models, range(n_init)), key=lambda t: (t[0].summary.trainingCost, t[1]))[0]


def gmm(vec: DataFrame, k: int, seed: int = SEED, features: str = "features", max_iter: int = 100):
    """CLU-04 with Spark ML: Gaussian mixture, full covariance.  :func:`fit_clusters`
    uses the multi-model engine instead."""
    return GaussianMixture(k=k, seed=seed, featuresCol=features, maxIter=max_iter, tol=1e-3).fit(vec)


def bic(model, n: int, d: int) -> float:
    """CLU-05: -2 log L + p ln n, p = (k-1) + k d + k d (d+1) / 2."""
    k = model.getK()
    p = (k - 1) + k * d + k * d * (d + 1) / 2
    return -2.0 * model.summary.logLikelihood + p * math.log(n)


def kneedle(xs, ys, sensitivity: float = 1.0, default: int | None = DEFAULT_K):
    """CLU-03: knee of a convex, decreasing curve (Kneedle, online=False)."""
    x, y = np.asarray(xs, float), np.asarray(ys, float)
    if len(x) < 3 or np.ptp(x) == 0 or np.ptp(y) == 0:
        return default
    xn = (x - x.min()) / np.ptp(x)
    yn = (y - y.min()) / np.ptp(y)
    yn = yn.max() - yn            # convex decreasing -> flip
    diff = yn - xn
    lmx = [i for i in range(1, len(diff) - 1) if diff[i] >= diff[i - 1] and diff[i] >= diff[i + 1]]
    lmn = set(i for i in range(1, len(diff) - 1) if diff[i] <= diff[i - 1] and diff[i] <= diff[i + 1])
    if not lmx:
        return default
    step = sensitivity * np.abs(np.diff(xn)).mean()
    thresholds = {i: diff[i] - step for i in lmx}
    knee = None
    current_max, thr = None, None
    for j in range(len(diff)):
        if j in thresholds:
            current_max, thr = j, thresholds[j]
            continue
        if j in lmn:
            thr = 0.0
        if current_max is not None and diff[j] < thr:
            knee = current_max
            break
    return int(x[knee]) if knee is not None else default


def k_sweep(vec: DataFrame, algo: str = "KMeans", ks=K_RANGE, seed: int = SEED, n_init: int = N_INIT,
            features: str = "features", return_models: bool = False):
    """CLU-02: (k, inertia) for KMeans or (k, BIC) for GMM over ``ks``.

    All models advance together, one pass per iteration (kiln.operators.multikmeans,
    kiln.operators.mixtures); ``return_models`` also gives the best centres or the
    mixture per k so the chosen model needs no refit."""
    ks = list(ks)
    if algo == "GMM":
        from kiln.operators.mixtures import multi_gmm
        models = multi_gmm(vec, ks, seed, features)
        curve = [(k, models[k].bic) for k in ks]
        return (curve, models) if return_models else curve
    from kiln.operators.multikmeans import best_models, multi_kmeans
    fits = multi_kmeans(vec, [(k, seed + s) for k in ks for s in range(n_init)], features)
    best = best_models(fits, ks)
    curve = [(k, best[k][1]) for k in ks]
    return (curve, best) if return_models else curve


def choose_k(curve, algo: str = "KMeans", sizes: dict | None = None, min_cluster_size: int = 0):
    """Knee of the inertia curve (KMeans) or minimum BIC (GMM).  With
    ``min_cluster_size``, a k whose smallest cluster (``sizes``: {k: rows a cluster})
    has fewer rows is left out; if that leaves none, the smallest k stands.  A BIC
    minimum at the largest k tried usually means the sweep was too short: warn."""
    if algo == "GMM":
        fit = [(k, v) for k, v in curve if not sizes or min(sizes[k]) >= min_cluster_size] or [min(curve)]
        k = min(fit, key=lambda t: t[1])[0]
        if len(curve) > 1 and k == max(kk for kk, _ in curve):
            import warnings
            warnings.warn(f"BIC is lowest at the sweep boundary k={k}; consider a wider k range "
                          "or a minimum cluster size", stacklevel=2)
        return k
    return kneedle([k for k, _ in curve], [v for _, v in curve])


def relabel_by_size(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Arbitrary model ids -> 0..k-1 by size desc, then old id (k rows collected)."""
    sizes = df.groupBy(cluster).count().collect()
    order = sorted(sizes, key=lambda r: (-r["count"], r[cluster]))
    mapping = F.create_map(*[x for new, r in enumerate(order) for x in (F.lit(r[cluster]), F.lit(new))])
    return df.withColumn(cluster, mapping[F.col(cluster)])


def fit_clusters(df: DataFrame, cols, algo: str = "KMeans", k: int | None = None,
                 seed: int = SEED, n_init: int = N_INIT, ks=K_RANGE, min_cluster_size: int = 0):
    """CLU-01..06: sweep (unless k given), choose k, fit; returns (model, labeled, curve).

    ``labeled`` has ``cluster`` (int) and ``certainty`` (max membership
    probability; 1.0 for k-means) next to the input columns.  The model is a
    persistable transformer of column expressions (kiln ColumnRules).
    ``min_cluster_size`` bars mixtures with a smaller cluster from the sweep's choice."""
    from kiln.operators.multikmeans import best_models, centroid_model, multi_kmeans
    if algo == "Agglomerative":     # one tree for the whole sweep; the model is the tree
        from kiln.operators.agglomerative import fit_ward
        tree = fit_ward(df, cols)
        curve = [(kk, within) for kk, within, _ in tree.ladder(ks)] if k is None else []
        k = choose_k(curve, "KMeans") if k is None else k
        return tree, tree.assign(df, cols, k).withColumn("certainty", F.lit(1.0)), curve
    vec = assemble(df, cols).persist(StorageLevel.MEMORY_AND_DISK)
    curve = []
    if algo == "GMM":
        curve, fitted = k_sweep(vec, "GMM", ks=ks if k is None else [k], seed=seed, return_models=True)
        if k is None:
            k = choose_k(curve, "GMM", {kk: m.sizes for kk, m in fitted.items()}, min_cluster_size)
        else:
            curve = []
        model = fitted[k].model("features", "cluster")
        vec.unpersist()
        out = model.transform(vec).withColumn("certainty", F.array_max("probability")).drop("features", "probability")
        return model, out, curve
    if k is None:
        curve, best = k_sweep(vec, "KMeans", ks=ks, seed=seed, n_init=n_init, return_models=True)
        k = choose_k(curve, "KMeans")
    else:
        fits = multi_kmeans(vec, [(k, seed + s) for s in range(n_init)])
        best = best_models(fits, [k])
    centres, inertia = best[k]
    model = centroid_model(centres, "features", "cluster", inertia)
    vec.unpersist()  # the labeled frame below is lazy and recomputes vectors deterministically
    out = model.transform(vec).withColumn("certainty", F.lit(1.0)).drop("features")
    return model, out, curve


def predict(model, df: DataFrame, features: str, prediction: str) -> DataFrame:
    """Apply a fitted cluster model (kiln centroid model or Spark ML model)."""
    from kiln.operators.base import ColumnRules
    if isinstance(model, ColumnRules):
        spec = dict(model.params_dict, inputCol=features, predictionCol=prediction)
        return ColumnRules.of(model.getOrDefault(model.kind), spec).transform(df)
    return model.setFeaturesCol(features).setPredictionCol(prediction).transform(df)


def bisecting_kmeans(df: DataFrame, cols, k: int, seed: int = SEED):
    """CLU-11: hierarchical (divisive) alternative to agglomerative clustering."""
    vec = assemble(df, cols)
    model = BisectingKMeans(k=k, seed=seed).fit(vec)
    return model, model.transform(vec).withColumnRenamed("prediction", "cluster").drop("features")


# ---------------------------------------------------------------- long form helpers
def long_features(df: DataFrame, cols, cluster: str = "cluster", extra=()) -> DataFrame:
    """(cluster, extra..., feature, x): numeric columns or one array column unpivoted."""
    cols = list(cols)
    keep = [qcol(cluster).alias("cluster")] + [qcol(e) for e in extra]
    if len(cols) == 1 and dict(df.dtypes)[cols[0]].startswith("array"):
        return df.select(*keep, F.posexplode(qcol(cols[0]))).select(
            "cluster", *extra, F.format_string("d%02d", F.col("pos")).alias("feature"),
            F.col("col").cast("double").alias("x"))
    parts = [F.struct(F.lit(c).alias("feature"), qcol(c).cast("double").alias("x")) for c in cols]
    return df.select(*keep, F.explode(F.array(*parts)).alias("p")).select("cluster", *extra, "p.*")


def persona_traits(df: DataFrame, cols, cluster: str = "cluster") -> DataFrame:
    """CLU-07 long form: (cluster, feature, mean_z, trait).

    z uses the mean and population std over all rows (std 0 -> 1); mean z of a
    cluster = (cluster mean - mean) / std, so one groupBy(cluster, feature)
    and one groupBy(feature) are enough -- no per-row z column is shuffled."""
    lf = long_features(df, cols, cluster).where(F.col("x").isNotNull())
    glob = lf.groupBy("feature").agg(F.avg("x").alias("mu"), F.stddev_pop("x").alias("sd"))
    per = lf.groupBy("cluster", "feature").agg(F.avg("x").alias("m"))
    z = per.join(F.broadcast(glob), "feature").select(
        "cluster", "feature",
        ((F.col("m") - F.col("mu")) / F.when(F.col("sd") > 0, F.col("sd")).otherwise(F.lit(1.0))).alias("mean_z"))
    return z.withColumn("trait", trait(F.col("mean_z")))


def personas(df: DataFrame, cols, cluster: str = "cluster", certainty: str | None = "certainty") -> DataFrame:
    """CLU-07: (cluster, dominant_traits map<feature, High/Low/Average>, sample_size, mean_certainty)."""
    traits = persona_traits(df, cols, cluster).groupBy("cluster").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("feature", "trait")))).alias("dominant_traits"))
    sizes = df.groupBy(qcol(cluster).alias("cluster")).agg(
        F.count(F.lit(1)).alias("sample_size"),
        (F.avg(qcol(certainty)) if certainty and certainty in df.columns else F.lit(1.0)).alias("mean_certainty"))
    return sizes.join(traits, "cluster").select("cluster", "dominant_traits", "sample_size", "mean_certainty")


def calinski_harabasz(df: DataFrame, cols, cluster: str = "cluster") -> DataFrame:
    """CLU-10: one-row (k, n, between, within, score) from per-(cluster, feature) moments."""
    lf = long_features(df, cols, cluster)
    per = lf.groupBy("cluster", "feature").agg(F.count("x").alias("n"), F.avg("x").alias("m"),
                                               F.var_pop("x").alias("v"))
    glob = lf.groupBy("feature").agg(F.avg("x").alias("mu"))
    return per.join(F.broadcast(glob), "feature").agg(
        F.count_distinct("cluster").alias("k"),
        (F.sum("n") / F.count_distinct("feature")).cast("long").alias("n"),
        F.sum(F.col("n") * F.pow(F.col("m") - F.col("mu"), 2)).alias("between"),
        F.sum(F.col("n") * F.col("v")).alias("within")).select(
        "k", "n", "between", "within",
        F.try_divide(F.col("between") / (F.col("k") - 1), F.col("within") / (F.col("n") - F.col("k"))).alias("score"))


def silhouette(labeled: DataFrame, cols, cluster: str = "cluster", metric: str = "squaredEuclidean") -> float:
    """CLU-09: Spark's O(n k) silhouette (squared Euclidean or cosine); ``euclidean`` is
    that of :func:`kiln.operators.silhouette.euclidean_silhouette`, within its bound."""
    if metric == "euclidean":
        from kiln.operators.silhouette import euclidean_silhouette
        return euclidean_silhouette(labeled, cols, cluster)["silhouette"]
    vec = assemble(labeled, cols)
    return ClusteringEvaluator(predictionCol=cluster, featuresCol="features",
                               distanceMeasure=metric).evaluate(vec)


# ---------------------------------------------------------------- PCA
@register("pca")
def _apply_pca(spec: dict, df: DataFrame) -> DataFrame:
    cols, mean = spec["cols"], spec["mean"]
    x = qcol(cols[0]).cast("array<double>") if spec["array"] else F.array(*[qcol(c).cast("double") for c in cols])
    out = {}
    for i, w in enumerate(spec["components"]):
        shift = sum(a * b for a, b in zip(w, mean))
        out[f"PC{i + 1}"] = F.aggregate(F.zip_with(x, F.lit(w), lambda a, b: a * b), F.lit(-float(shift)), lambda acc, y: acc + y)
    return df.withColumns(out)


def fit_pca(df: DataFrame, cols, retain: float = 0.95, components: int | None = None):
    """DIM-01 as a fitted step (columns PC1..PCm): centre, fit PCA on all dims, keep the
    fewest components whose cumulative explained-variance ratio exceeds ``retain``;
    each component's largest-magnitude loading made positive.  Returns (step, ratios)."""
    cols = list(cols)
    is_array = len(cols) == 1 and dict(df.dtypes)[cols[0]].startswith("array")
    vec = assemble(df, cols, "__raw").select("__raw")
    d = len(vec.first()["__raw"]) if is_array else len(cols)
    mean = np.array(vec.select(vector_to_array("__raw").alias("a")).agg(
        F.array(*[F.avg(F.col("a")[i]) for i in range(d)]).alias("m")).first()["m"], dtype=float)
    centred = vec.withColumn("__c", array_to_vector(F.transform(vector_to_array("__raw"),
                                                                 lambda x, i: x - F.lit(mean.tolist())[i])))
    model = PCA(k=d, inputCol="__c", outputCol="__pc").fit(centred)
    ratios = np.array(model.explainedVariance.toArray())
    m = components if components is not None else min(d, int(np.searchsorted(np.cumsum(ratios), retain, side="right") + 1))
    pcs = model.pc.toArray()[:, :m]
    signs = np.sign(pcs[np.argmax(np.abs(pcs), axis=0), range(m)])
    signs[signs == 0] = 1.0
    step = ColumnRules.of("pca", {"cols": cols, "array": is_array, "mean": mean.tolist(), "components": (pcs * signs).T.tolist()})
    return step, ratios[:m].tolist()


def pca(df: DataFrame, cols, retain: float = 0.95, keep=(), components: int | None = None):
    """DIM-01: the components and ``keep`` columns of :func:`fit_pca`, and the explained ratios."""
    step, ratios = fit_pca(df, cols, retain, components)
    return step.transform(df).select(*[qcol(c) for c in keep], *[f"PC{i + 1}" for i in range(len(ratios))]), ratios
