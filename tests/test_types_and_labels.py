"""Features of any type, labels of any value, k-means on large offsets, CSV records and types."""
import datetime
import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from kiln.operators.model_select import mutual_information, predictive_power, sulov_select
from kiln.operators.multikmeans import multi_kmeans
from kiln.operators.profile import profile
from kiln.operators.transform import fit_yeo_johnson
from kiln.plans.supervised import clean, plan_gold_supervised
from kiln.sources.io import load_model, load_plan, read_table, save_model, save_plan, write_layer


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(1)
    rows = []
    for i in range(240):
        y = rng.choice([-1, 1])
        rows.append((f"user-{i}", "red" if y > 0 else "blue", rng.random(), y + rng.random() / 4, None if i % 9 == 0 else datetime.datetime(2024, 1, 1 + i % 20), i % 7 == 0 if i % 5 else None, y))
    return spark.createDataFrame(rows, "id_text string, colour string, noise double, close double, seen timestamp, flag boolean, y int")


def test_predictive_power_of_text_and_negative_labels(table):
    got = dict(predictive_power(table, ["id_text", "colour", "noise", "seen", "flag"], "y", folds=2))
    assert got["colour"] == pytest.approx(1.0) and max(got[c] for c in got if c != "colour") < 0.5


def test_sulov_keeps_the_text_column_that_tells(table):
    kept, mi = sulov_select(table.withColumn("y", F.when(F.col("y") > 0, 2).otherwise(1)), ["colour", "noise", "flag"], "y", trees=3)
    assert "colour" in kept and dict(mi)["colour"] == max(dict(mi).values())


def test_gold_audit_over_all_types(table):
    plan = plan_gold_supervised(table.withColumnRenamed("colour", " colour "), "Y", max_features=2)
    assert "colour" in plan["selected_features"] and "id_text" not in plan["base_columns"]
    assert plan_gold_supervised(table.where("y > 0"), "y")["selected_features"]


def test_clean_leaves_times_and_booleans_alone(table):
    out = clean(table, "y", {"config": {"pps_threshold": 0.01, "vif_threshold": 10.0}, "id_cols": []}, with_importance=False)
    assert dict(out.dtypes)["seen"] == "timestamp" and out.where("seen is null").count() > 0


def test_kmeans_on_a_large_offset(spark):
    rng = np.random.default_rng(3)
    pts = np.concatenate([rng.normal(size=(60, 2)) + c for c in ([0, 0], [20, 0], [0, 20])]) + 1e9
    df = spark.createDataFrame([(p.tolist(),) for p in pts], "p array<double>").select(array_to_vector("p").alias("features"))
    centres, inertia = multi_kmeans(df, [(3, 1)])[(3, 1)]
    direct = ((pts[:, None] - centres[None]) ** 2).sum(2).min(1).sum()
    assert inertia == pytest.approx(direct, rel=1e-5) and inertia < 1000
    again = multi_kmeans(df.repartition(7), [(3, 1)])[(3, 1)]
    assert np.allclose(sorted(map(tuple, centres)), sorted(map(tuple, again[0])))
    with pytest.raises(ValueError):
        multi_kmeans(df.limit(0), [(3, 1)])


def test_yeo_johnson_beyond_five(spark):
    rng = np.random.default_rng(4)
    x = np.expm1(np.log1p(9 * rng.normal(10, 2.5, 4000).clip(0.1)) / 9)      # psi with lambda 9 is about normal
    lam = fit_yeo_johnson(spark.createDataFrame([(float(v),) for v in x], "x double"), ["x"]).params_dict["lambdas"]["x"]

    def likelihood(at):
        return -len(x) / 2 * np.log(np.var((np.power(x + 1, at) - 1) / at)) + (at - 1) * np.log1p(x).sum()
    grid = np.arange(5, 15, 0.01)
    assert lam == pytest.approx(grid[np.argmax([likelihood(a) for a in grid])], abs=0.02) and lam > 5


def test_large_ids_are_distinct(spark):
    df = spark.range(1000).select((F.col("id") + F.lit(2 ** 60)).alias("id"), (F.col("id") % 10).alias("k"))
    got = {r["column"]: r for r in profile(df, with_mad=False).collect()}
    assert got["id"]["n_distinct"] == 1000 and got["id"]["is_unique"] and got["k"]["n_distinct"] == 10


def test_mutual_information_of_a_copy(spark):
    df = spark.createDataFrame([(float(i % 4), i % 4) for i in range(80)], "x double, y int")
    assert dict(mutual_information(df, ["x"], "y"))["x"] == pytest.approx(np.log(4))


def test_csv_round_trip_types_and_records(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,yn,flag,note\n1,Y,true,"two\nlines, ""quoted"""\n2,N,FALSE,x\n3,Y,,NA\n')
    df = read_table(spark, str(tmp_path / "a.csv"))
    assert dict(df.dtypes) == {"id": "bigint", "yn": "string", "flag": "boolean", "note": "string"}
    assert [tuple(r) for r in df.orderBy("id").collect()] == [(1, "Y", True, 'two\nlines, "quoted"'), (2, "N", False, "x"), (3, "Y", None, None)]
    write_layer(df, str(tmp_path / "out"), fmt="parquet")
    assert read_table(spark, str(tmp_path / "out"), fmt="parquet").count() == 3
    save_plan(spark, {"drop": ["a"], "n": 1}, str(tmp_path / "plan"))
    assert load_plan(spark, str(tmp_path / "plan")) == {"drop": ["a"], "n": 1}


def test_model_round_trip(spark, tmp_path):
    from pyspark.ml import PipelineModel

    from kiln.operators.impute import fit_impute, null_cells
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "x double")
    model = PipelineModel([fit_impute(df, ["x"])])
    save_model(model, str(tmp_path / "m"))
    assert null_cells(df) == 1 and null_cells(load_model(str(tmp_path / "m")).transform(df)) == 0
