"""Model-based feature selection (SEL-05/06/07/09).

* permutation importance: the fitted forest scores the table with one column
  permuted.  Rows are put in a random order inside hash buckets (one shuffle) and
  every column is rotated along it: a row takes a column's value from the row a few
  places on, and a halo of copied rows closes each bucket's circle.  One rotation a
  repeat serves all features, and one job scores them all.  No row is sampled or dropped.
* predictive power score: a tree per feature (``max_depth`` is a parameter), 4 folds
  by a hash of the row (every row is in exactly one fold, or in that of a given
  column), all grown from one histogram pass (:mod:`kiln.operators.histogram`).
* Features of any type take part: numbers, booleans and times as numbers, text by
  the rank of its level's frequency, at any number of levels.  Labels of a
  classification are indexed, whatever their values.
* SULOV: mutual information from (bin, label) counts; of each pair with
  |r| > limit the lower-MI feature goes; then boosted-tree importances, for more than
  two classes by softmax boosting.
* RFE: forest importances, drop the weakest until ``n`` remain.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.functions.names import semantic_type
from kiln.functions.stats import qcol, quantiles, without_nan
from kiln.operators.histogram import feature_power, softmax_boost
from kiln.session import held, materialize

SEED = 42
SUBSETS = 5


def is_classification(df: DataFrame, target: str) -> bool:
    """Silver rule: classifier iff < 20 distinct targets or a string target."""
    if semantic_type(df.schema[target].dataType) != "Numeric":
        return True
    return df.agg(F.count_distinct(qcol(target)).alias("n")).first()["n"] < 20


MOST_LEVELS = 256


def level_ranks(df: DataFrame, c: str) -> DataFrame:
    """``df`` with a text column as the rank of its level, 1 for the most frequent (ties by the level); nulls stay.
    Up to ``MOST_LEVELS`` levels are an expression, more are a ranked table joined back."""
    from kiln.operators.encode import _dense_codes
    v = qcol(c).cast("string")
    counts = df.where(v.isNotNull()).groupBy(v.alias("__lvl")).agg((-F.count(F.lit(1))).alias("__first"))
    most = counts.orderBy("__first", "__lvl").limit(MOST_LEVELS + 1).collect()
    if len(most) <= MOST_LEVELS:
        at = F.array_position(F.array(*[F.lit(r["__lvl"]) for r in most]), v) if most else F.lit(None)
        return df.withColumn(c, F.when(v.isNotNull(), at.cast("double")))
    ranks = _dense_codes(counts)
    return df.join(ranks, v == F.col("__lvl"), "left").withColumn(c, F.col("__code").cast("double") + 1.0).drop("__lvl", "__code")


def encoded(df: DataFrame, features) -> DataFrame:
    """``df`` with the features as doubles (missing values null), by their type; see the module doc."""
    kinds = {c: semantic_type(df.schema[c].dataType) for c in features}
    text = [c for c in features if kinds[c] not in ("Numeric", "Boolean", "DateTime")]
    out = {}
    for c in features:
        if kinds[c] == "DateTime":
            out[c] = F.unix_micros(qcol(c).cast("timestamp")).cast("double")
        elif c not in text:
            out[c] = qcol(c).cast("double")
    df = without_nan(df.withColumns(out) if out else df, list(out))
    for c in text:
        df = level_ranks(df, c)
    return df


def _prepare(df: DataFrame, features, target: str, clf: bool, fold: str | None = None) -> DataFrame:
    """Median-filled numeric features, label, a number that tells rows apart (``__rid``) and the given ``fold``; checkpointed."""
    src = df.where(qcol(target).isNotNull())
    if clf:  # labels -> 0..k-1 (StringIndexer: one distributed count, k labels)
        from pyspark.ml.feature import StringIndexer
        src = src.withColumn("__yt", qcol(target).cast("string"))
        src = StringIndexer(inputCol="__yt", outputCol="__y", stringOrderType="alphabetAsc").fit(src).transform(src)
    else:
        src = src.withColumn("__y", qcol(target).cast("double"))
    # equal rows differ by their place; the table is written once, so the number stays
    src = src.withColumn("__rid", F.xxhash64(F.monotonically_increasing_id(), *[qcol(c) for c in df.columns]))
    src = src.withColumn("__fold", (qcol(fold).cast("int") if fold else F.lit(None).cast("int")))
    src = encoded(src, features)
    med = quantiles(src, features, [0.5])
    cols = [F.coalesce(qcol(c), F.lit(med[c][0] if med[c][0] is not None else 0.0)).alias(c) for c in features]
    return materialize(src.select(*cols, "__y", "__rid", "__fold"))


def _forest(clf: bool, trees: int, seed: int = SEED):
    return (RandomForestClassifier(numTrees=trees, seed=seed, labelCol="__y", featuresCol="__x") if clf
            else RandomForestRegressor(numTrees=trees, seed=seed, labelCol="__y", featuresCol="__x"))


ROWS_PER_BUCKET = 200_000


def _places(df: DataFrame, order) -> DataFrame:
    """``df`` with ``__i``, its row's place from 1 in its ``__bk`` by ``order``, and ``__n``, the rows of that.  A bucket
    may hold any number of rows: they are range-sorted (equal keys by arrival, so that they part too) and written once;
    a place is the part's offset and the row's number in the part."""
    parts = max(1, -(-df.count() // ROWS_PER_BUCKET))
    sort = ["__bk", *order, "__tie"]
    laid = materialize(df.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(parts, *sort).sortWithinPartitions(*sort)
                       .drop("__tie").withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", 33)                # see monotonically_increasing_id: the part's number, then the row's
    sizes = laid.groupBy("__bk", part.alias("__pid")).agg(F.count(F.lit(1)).alias("__c"), F.min("__at").alias("__lo"))
    whole = Window.partitionBy("__bk")
    sizes = sizes.select("__bk", "__pid", (F.sum("__c").over(whole.orderBy("__pid")) - F.col("__c") - F.col("__lo") + 1).alias("__off"),
                       F.sum("__c").over(whole).alias("__n"))
    return laid.withColumn("__pid", part).join(F.broadcast(sizes), ["__bk", "__pid"]).withColumn("__i", F.col("__at") + F.col("__off")) \
        .drop("__at", "__off", "__pid")


def rotated(base: DataFrame, cols, shifts, seed: int = SEED, order_by: str | None = None, buckets: int | None = None) -> DataFrame:
    """``base`` with ``__x`` (array of the columns) and ``__r``: for every shift the same array of the row so many places
    on.  Places are a random order of the rows in each hash bucket of ``__rid`` (or that of ``order_by``), closed to a
    circle.  Whatever a bucket's size, its places are cut into blocks, and the rows behind a block's last (or the first
    again) are copied to its end, so that one window over each block gives every shift."""
    row = F.col("__rid") if order_by is None else qcol(order_by)
    n = buckets or max(1, -(-base.count() // ROWS_PER_BUCKET))
    placed = base.withColumn("__x", F.array(*[qcol(c).cast("double") for c in cols])).withColumn("__bk", F.pmod(F.xxhash64(row, F.lit(seed)), F.lit(n)))
    if order_by is None and buckets is None:       # dealt by size, so that no bucket outgrows a task
        in_bucket = Window.partitionBy("__bk")
        placed = placed.withColumn("__i", F.row_number().over(in_bucket.orderBy(F.xxhash64(row, F.lit(seed + 1)), row))).withColumn("__n", F.count(F.lit(1)).over(in_bucket))
    elif order_by is None:
        placed = _places(placed.withColumn("__key", F.xxhash64(row, F.lit(seed + 1))), ["__key", "__rid"]).drop("__key")
    else:
        placed = _places(placed.withColumn("__key", row), ["__key"]).drop("__key")
    far = max(shifts)
    block = max(2 * ROWS_PER_BUCKET, far)          # a row is copied to no more than the block before its own
    laps = F.floor((F.lit(far) + F.col("__n") - F.col("__i")) / F.col("__n")).cast("int")
    halo = placed.withColumn("__lap", F.explode(F.sequence(F.lit(0), laps)))
    place = F.col("__i") - 1 + F.col("__lap") * F.col("__n")
    home, last = F.floor(place / block), F.floor((F.col("__n") - 1) / block)
    halo = halo.withColumn("__blk", F.explode(F.sequence(F.greatest(F.lit(0).cast("long"), F.floor((place - far) / block)), F.least(home, last))))
    around = Window.partitionBy("__bk", "__blk").orderBy(place)
    out = halo.withColumn("__r", F.array(*[F.lead("__x", s).over(around) for s in shifts]))
    return out.filter((F.col("__lap") == 0) & (F.col("__blk") == home)).drop("__bk", "__i", "__n", "__lap", "__blk")


def permutation_importance(df: DataFrame, features, target: str, repeats: int = 3, trees: int = 50,
                           seed: int = SEED) -> list[tuple[str, float]]:
    """SEL-05 mean score drop per feature (accuracy or R^2); one job scores every feature and repeat."""
    clf, features = is_classification(df, target), list(features)
    base = _prepare(df, features, target, clf)
    if base.isEmpty():
        return [(c, 0.0) for c in features]
    asm = VectorAssembler(inputCols=features, outputCol="__x")
    model = _forest(clf, trees, seed).fit(asm.transform(base))
    turned = rotated(base, features, list(range(1, repeats + 1)), seed)
    # variant -1 is the row as it is, variant j * repeats + r has feature j rotated by the r-th shift
    variants = turned.select("__y", "__x", "__r", F.explode(F.sequence(F.lit(-1), F.lit(len(features) * repeats - 1))).alias("__v"))
    j, r = F.floor(F.col("__v") / repeats).cast("int"), F.pmod(F.col("__v"), F.lit(repeats)).cast("int")
    swapped = F.transform("__x", lambda x, i: F.when((F.col("__v") >= 0) & (i == j), F.col("__r")[r][i]).otherwise(x))
    pred = model.transform(variants.select("__y", "__v", array_to_vector(swapped).alias("__x")))
    y, p = F.col("__y"), F.col("prediction")
    score = F.avg((y == p).cast("double")) if clf else 1 - F.try_divide(F.sum((y - p) ** 2), F.var_pop(y) * F.count(y))
    got = {row["__v"]: row["s"] for row in pred.groupBy("__v").agg(score.alias("s")).collect()}
    drop = [(got[-1] or 0.0) - (got[v] or 0.0) for v in range(len(features) * repeats)]
    return [(c, sum(drop[i * repeats:(i + 1) * repeats]) / repeats) for i, c in enumerate(features)]


def importance_filter(df: DataFrame, features, target: str, threshold: float = 0.02, **kw):
    """Weak features (importance < threshold); the best feature always survives."""
    imp = permutation_importance(df, features, target, **kw)
    best = max(imp, key=lambda t: t[1])[0]
    weak = [c for c, v in imp if v < threshold and c != best]
    return imp, weak


def predictive_power(df: DataFrame, features, target: str, folds: int = 4, max_depth: int = 5,
                     seed: int = SEED, fold: str | None = None) -> list[tuple[str, float]]:
    """SEL-06 PPS per feature: regression 1 - MAE/MAE(median baseline);
    classification (F1w - F1w_base) / (1 - F1w_base) with the most common
    class as baseline; both floored at 0, and 0 for a table without rows.
    ``fold``: a column that holds each row's fold (0 to folds - 1), else a hash deals them."""
    clf, features = is_classification(df, target), list(features)
    base = _prepare(df, features, target, clf, fold)
    if not features or base.isEmpty():
        return [(c, 0.0) for c in features]
    if fold is None:
        base = base.withColumn("__fold", F.pmod(F.xxhash64("__rid", F.lit(seed)), F.lit(folds)).cast("int"))
    median = None if clf else quantiles(base, ["__y"], [0.5])["__y"][0]
    return list(zip(features, feature_power(base, features, clf, folds, max_depth, median)))


def mutual_information(df: DataFrame, features, target: str, bins: int = 10) -> list[tuple[str, float]]:
    """MI(feature; target) in nats from equal-width bins: one (feature, bin,
    label) count aggregate for all features."""
    mm = df.agg(*[e for i, c in enumerate(features) for e in
                  (F.min(qcol(c)).alias(f"lo{i}"), F.max(qcol(c)).alias(f"hi{i}"))]).first()
    parts = []
    for i, c in enumerate(features):
        lo, hi = mm[f"lo{i}"], mm[f"hi{i}"]
        if lo is None:
            continue
        w = (hi - lo) / bins if hi > lo else 1.0
        b = F.least(F.floor((qcol(c) - F.lit(lo)) / F.lit(w)), F.lit(bins - 1))
        parts.append(F.struct(F.lit(c).alias("f"), b.cast("long").alias("b")))
    y = qcol(target)
    if semantic_type(df.schema[target].dataType) == "Numeric" and \
            df.agg(F.count_distinct(y)).first()[0] > 20:  # continuous target: equal-width bins too
        ylo, yhi = df.agg(F.min(y), F.max(y)).first()
        yw = (yhi - ylo) / bins if yhi > ylo else 1.0
        y = F.least(F.floor((y - F.lit(ylo)) / F.lit(yw)), F.lit(bins - 1))
    long = df.where(qcol(target).isNotNull()).select(y.cast("string").alias("y"),
                                                     F.explode(F.array(*parts)).alias("p")) \
        .select("y", "p.f", "p.b").where(F.col("b").isNotNull())
    joint = long.groupBy("f", "b", "y").count()
    # sum over cells of c/n log(c n / (b y)) = (sum c log c - sum b log b - sum y log y) / n + log n: three partial aggregates
    def entropy(counts: DataFrame) -> dict:
        return {r["f"]: (r["s"], r["n"]) for r in counts.groupBy("f").agg(F.sum(F.col("count") * F.log("count")).alias("s"), F.sum("count").alias("n")).collect()}

    cells = entropy(joint)
    by_bin, by_label = (entropy(joint.groupBy("f", k).agg(F.sum("count").alias("count"))) for k in ("b", "y"))
    got = {f: (s - by_bin[f][0] - by_label[f][0]) / n + math.log(n) for f, (s, n) in cells.items()}
    return [(c, max(0.0, float(got.get(c, 0.0)))) for c in features]


def sulov_select(df: DataFrame, features, target: str, limit: float = 0.70, trees: int = 20,
                 seed: int = SEED) -> tuple[list[str], list[tuple[str, float]]]:
    """SEL-07: SULOV (drop the lower-MI feature of each |r| > limit pair), then
    boosted trees on ``SUBSETS`` ever shorter tails of the list; a feature with
    importance in any of them stays.  More than two classes take softmax boosting, the
    tails together.  Returns (selected, [(feature, mi)])."""
    from kiln.operators.select import correlation_matrix
    features = list(features)
    with held(df.select(qcol(target), *[qcol(c) for c in features])) as df:    # every step below is a pass over these columns
        clf = is_classification(df, target)
        as_numbers = encoded(df.withColumn("__t", qcol(target)), features)
        mi = dict(mutual_information(as_numbers, features, "__t"))
        m = correlation_matrix(as_numbers, features)
        dropped = set()
        for i, j in combinations(range(len(features)), 2):
            if abs(m[i, j]) > limit:
                a, b = features[i], features[j]
                dropped.add(a if mi[a] < mi[b] else b)
        keep = [c for c in features if c not in dropped]
        if len(keep) > 1:
            base = _prepare(df, keep, target, clf)
            n_classes = base.select("__y").distinct().count() if clf else 0
            tails = [keep[at:] for at in range(0, len(keep), max(1, -(-len(keep) // SUBSETS)))]  # ever shorter tails of the list
            found = set()
            if clf and n_classes > 2:
                found = {c for gains in softmax_boost(base, keep, n_classes, tails, rounds=trees) for c in gains}
            else:
                for part in tails:
                    asm = VectorAssembler(inputCols=part, outputCol="__x").transform(base)
                    est = (GBTClassifier if clf else GBTRegressor)(maxIter=trees, seed=seed, labelCol="__y", featuresCol="__x")
                    imp = est.fit(asm).featureImportances.toArray()
                    found |= {c for c, v in zip(part, imp) if v > 0}
            keep = [c for c in keep if c in found] or keep[:1]
        return keep, sorted(mi.items(), key=lambda t: -t[1])


def rfe(df: DataFrame, features, target: str, n: int = 30, trees: int = 30,
        seed: int = SEED) -> list[str]:
    """SEL-09 recursive feature elimination to ``n`` features (no-op when <= n)."""
    feats = list(features)
    if len(feats) <= n:
        return feats
    clf = is_classification(df, target)
    base = _prepare(df, feats, target, clf)
    while len(feats) > n:
        asm = VectorAssembler(inputCols=feats, outputCol="__x").transform(base)
        imp = _forest(clf, trees, seed).fit(asm).featureImportances.toArray()
        weakest = min(range(len(feats)), key=lambda i: (imp[i], -i))
        feats.pop(weakest)
    return feats
