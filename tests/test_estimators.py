import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel

from kiln.operators.encode import factorize, fit_one_hot, fit_rare_label
from kiln.operators.impute import fit_impute, null_cells
from kiln.operators.outliers import fit_clip_iqr, fit_clip_percentile
from kiln.operators.scale import fit_power_transform, fit_robust_scale, fit_standard_scale
from kiln.operators.transform import fit_log, fit_yeo_johnson


def test_impute(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, None), (3.0, "b"), (10.0, "b")], "x double, s string")
    assert fit_impute(df, ["x"], "median").params_dict["fill"]["x"] == 3.0
    assert math.isclose(fit_impute(df, ["x"], "mean").params_dict["fill"]["x"], 14 / 3)
    out = fit_impute(df, ["s"], "constant").transform(df)
    assert sorted(r["s"] for r in out.collect()) == ["Missing", "a", "b", "b"]
    assert null_cells(df) == 2


@pytest.mark.parametrize("ncat,encoded", [(10, False), (11, True)])
def test_rare_label_needs_more_than_10_categories(spark, ncat, encoded):
    rows = [(f"c{i}",) for i in range(ncat)] + [("c0",)] * 100
    df = spark.createDataFrame(rows, "s string")
    out = {r["s"] for r in fit_rare_label(df, ["s"]).transform(df).collect()}
    assert ("Rare" in out) == encoded


def test_one_hot_and_factorize(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "b")], "k int, s string")
    oh = fit_one_hot(df, ["s"]).transform(df)
    assert oh.columns == ["k", "s_a", "s_b"]
    assert [tuple(r) for r in oh.orderBy("k").collect()] == [(1, 0, 1), (2, 1, 0), (3, 0, 0), (4, 0, 1)]
    f = factorize(df, ["s"], "k", "_code").orderBy("k").select("s_code").collect()
    assert [r[0] for r in f] == [0, 1, -1, 0]


def test_clip_and_log(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 100]] + [(None,)], "x double")
    hi = fit_clip_iqr(df, ["x"]).params_dict["bounds"]["x"][1]
    assert hi == 4 + 1.5 * 2
    assert fit_clip_percentile(df, ["x"], 99).params_dict["bounds"]["x"][1] == pytest.approx(96.16)
    assert fit_clip_iqr(df, ["x"]).transform(df).where("x is null").count() == 1
    with pytest.raises(ValueError):
        fit_log(spark.createDataFrame([(0.0,), (1.0,)], "x double"), ["x"])


def test_log_keeps_the_rows_of_values_without_a_logarithm(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 1.0), (3, -2.0), (4, None)], "i int, x double")
    step = fit_log(df, ["x"], outside="limit")
    assert step.params_dict["n_outside"] == {"x": 2}
    got = {r.i: r.x for r in step.transform(df).collect()}
    assert math.isnan(got.pop(3)) and got == {1: float("-inf"), 2: 0.0, 4: None}


def test_log_query_runs_over_a_zero(spark, tmp_path):
    from kiln.catalog import all_queries
    spark.createDataFrame([(1, 0.0), (2, 2.0)], "event_id long, value double").write.parquet(f"{tmp_path}/events.parquet")
    got = {r.event_id: r.value for r in all_queries()["log_transform"](spark, str(tmp_path)).collect()}
    assert got == {1: float("-inf"), 2: 0.693147}


def _yj(x, lam):
    x = np.asarray(x, float)
    out = np.empty_like(x)
    p = x >= 0
    out[p] = np.log1p(x[p]) if abs(lam) < 1e-12 else ((x[p] + 1) ** lam - 1) / lam
    out[~p] = -np.log1p(-x[~p]) if abs(lam - 2) < 1e-12 else -((1 - x[~p]) ** (2 - lam) - 1) / (2 - lam)
    return out


def _llf(x, lam):
    x = np.asarray(x, float)
    return -len(x) / 2 * np.log(_yj(x, lam).var()) + (lam - 1) * np.sum(np.sign(x) * np.log1p(np.abs(x)))


def test_yeo_johnson_lambda_is_mle(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.lognormal(size=400), -rng.exponential(size=100)])
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    lam = fit_yeo_johnson(df, ["x"]).params_dict["lambdas"]["x"]
    # golden-section search on the same likelihood
    a, b = -5.0, 5.0
    g = (math.sqrt(5) - 1) / 2
    for _ in range(200):
        c, d = b - g * (b - a), a + g * (b - a)
        if _llf(x, c) > _llf(x, d):
            b = d
        else:
            a = c
    assert abs(lam - (a + b) / 2) < 1e-4


def test_yeo_johnson_passes_read_held_columns_and_merge_parts(spark, monkeypatch):
    from kiln.operators import transform as T
    from kiln.session import reads_cache
    seen, real = [], T._yj_pass
    monkeypatch.setattr(T, "CHUNK", 7)
    monkeypatch.setattr(T, "_yj_pass", lambda df, *a: seen.append(reads_cache(df)) or real(df, *a))
    x = [1e6 + float(v) for v in np.random.default_rng(5).lognormal(size=90)] + [None, float("nan"), float("inf")]
    df = spark.createDataFrame([(v, 3.0) for v in x], "x double, c double").repartition(3)
    assert fit_yeo_johnson(df, ["x", "c"]).params_dict["lambdas"]["c"] == 1.0
    assert seen and all(seen)          # no pass repeats the steps before the fit
    src = spark.createDataFrame([(float(v),) for v in range(-20, 40)], "x double").repartition(4)
    for lam, ll in real(src, {"x": [-1.0, 0.0, 0.5, 2.0]})["x"]:
        assert ll == pytest.approx(_llf(range(-20, 40), lam), rel=1e-12)


def test_scalers_and_persistence(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (10.0, 5.0)], "x double, k double")
    rs = fit_robust_scale(df, ["x", "k"])
    assert rs.params_dict["params"]["k"] == [5.0, 1.0]       # zero IQR -> divide by 1
    ss = fit_standard_scale(df, ["x", "k"])
    assert ss.params_dict["params"]["k"] == [5.0, 1.0]       # zero std -> 1
    assert ss.params_dict["params"]["x"][1] == pytest.approx(np.std([1, 2, 3, 10]))
    pm = PipelineModel([rs, ss] + fit_power_transform(df, ["x"]))
    p = str(tmp_path / "m")
    pm.write().overwrite().save(p)
    back = PipelineModel.load(p)
    a = [tuple(r) for r in pm.transform(df).collect()]
    b = [tuple(r) for r in back.transform(df).collect()]
    assert a == b


def test_factorize_distributed_rank_matches_window(spark, monkeypatch):
    import kiln.operators.encode as E
    rows = [(i, f"l{(i * 7) % 23}") for i in range(200)]
    df = spark.createDataFrame(rows, "k int, s string")
    a = {r["k"]: r["s_code"] for r in E.factorize(df, ["s"], "k", "_code").collect()}
    monkeypatch.setattr(E, "LEVELS_PER_TASK", 5)
    monkeypatch.setattr(E, "LEVELS_PER_TASK", 4)
    b = {r["k"]: r["s_code"] for r in E.factorize(df, ["s"], "k", "_code").collect()}
    assert a == b and max(a.values()) == 22
