"""One key holding a third of all rows: results stay exact and the hot key is
split across segments (no single task owns it)."""
import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from kiln.operators.aggregate import entity_aggregate, entity_mode
from kiln.operators.dedup import dedup_signal, drop_conflicting_labels
from kiln.operators.timeseries import _segment, fill_forward


def _hot(spark, n=3000, seed=11):
    rng = np.random.default_rng(seed)
    key = np.where(rng.random(n) < 1 / 3, 0, rng.integers(1, 50, n))
    t = rng.permutation(n)
    v = rng.normal(size=n).round(4)
    v[rng.random(n) < 0.4] = np.nan
    cat = rng.integers(0, 4, n)
    pdf = pd.DataFrame({"k": key, "t": t, "v": v, "c": cat})
    rows = [(int(a), int(b), None if np.isnan(x) else float(x), int(c)) for a, b, x, c in zip(key, t, v, cat)]
    return spark.createDataFrame(rows, "k long, t long, v double, c long"), pdf


def test_hot_key_fill_forward_exact_and_split(spark):
    df, pdf = _hot(spark)
    seg = _segment(df, ["t"], ["k"], 16)
    counts = {(r["k"] == 0, r["__b"]): r["count"] for r in seg.groupBy((F.col("k") == 0).alias("k"), "__b").count().collect()}
    hot = [n for (is_hot, _), n in counts.items() if is_hot]
    assert len(hot) >= 16 * sum(hot) / len(pdf) and max(hot) <= 2 * len(pdf) / 16    # its share of the segments, none above twice the mean
    got = {r["t"]: r["v"] for r in fill_forward(df, "t", "k", ["v"], buckets=16).collect()}
    s = pdf.sort_values(["k", "t"])
    exp = dict(zip(s["t"], s.groupby("k", group_keys=False)["v"].apply(lambda x: x.ffill().bfill())))
    assert all((got[t] is None and np.isnan(exp[t])) or np.isclose(got[t], exp[t]) for t in got)


def test_hot_key_aggregates_dedup_conflicts(spark):
    df, pdf = _hot(spark)
    agg = {r["k"]: r for r in entity_aggregate(df, "k", sum_cols=["v"], mean_cols=["v"]).collect()}
    assert np.isclose(agg[0]["v"], pdf[pdf.k == 0]["v"].sum())
    m = {r["k"]: r["c"] for r in entity_mode(df, "k", "c").collect()}
    vc = pdf[pdf.k == 0]["c"].value_counts()
    assert m[0] == min(vc[vc == vc.max()].index)
    first = dedup_signal(df.select("t", "k", "c"), ["t"], "t").where("k = 0").count()
    assert first == pdf[pdf.k == 0]["c"].nunique()
    kept = drop_conflicting_labels(df.select("k", "c"), "c").where("k = 0").count()
    assert kept == 0  # the hot key has several labels: all its rows go
    assert drop_conflicting_labels(df.select("k", "c"), "c").where(F.col("k") != 0).count() \
        == sum(len(g) for _k, g in pdf[pdf.k != 0].groupby("k") if g["c"].nunique() == 1)
