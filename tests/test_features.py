import datetime as dt

from pyspark.sql import functions as F

from kiln.operators.features import (build_interactions, date_diffs, date_parts, pairwise,
                                     segment_name, trait)


def test_ratio_zero_fill_and_chain(spark):
    df = spark.createDataFrame([(1.0, 0.0), (2.0, -1e-6), (3.0, 1.0), (4.0, 2.0)], "a double, b double")
    specs = [{"pair": ["a", "b"], "logic": "ratio", "name": "r", "error_handling": "zero_fill"},
             {"pair": ["r", "a"], "logic": "multiplication", "name": "m"},
             {"pair": ["a", "zzz"], "logic": "ratio", "name": "skip"}]
    out = build_interactions(df, specs, clip=False).orderBy("a").collect()
    assert out[0]["r"] == 0.0                 # b == 0 -> null -> 0
    assert out[1]["r"] == 0.0                 # b + 1e-6 == 0 -> null -> 0
    assert out[2]["r"] == 3.0 / (1.0 + 1e-6)
    assert out[3]["m"] == out[3]["r"] * 4.0
    assert "skip" not in out[0].asDict()


def test_pairwise_and_dates(spark):
    df = spark.createDataFrame([(1.0, 2.0, "2024-01-01 23:00:00", "2024-01-03 01:00:00"),
                                (5.0, 0.0, "bad", "2024-03-04")], "a double, b double, d1 string, d2 string")
    p = pairwise(df, ["a", "b"]).orderBy("a").collect()
    assert p[0]["a_minus_b"] == -1.0 and p[1]["a_ratio_b"] == 5.0 / 1e-5
    d = date_parts(df, ["d1"]).orderBy("a").collect()
    assert (d[0]["d1_year"], d[0]["d1_month"], d[0]["d1_dow"]) == (2024, 1, 0)   # Monday = 0
    assert d[1]["d1_year"] is None
    dd = date_diffs(df, ["d1", "d2"]).orderBy("a").collect()
    assert dd[0]["d2_minus_d1_days"] == 1     # 26 h -> 1 whole day
    assert dd[1]["d2_minus_d1_days"] is None


def test_segment_names_of_the_scoring_rows(spark):
    rows = [(22, 15, 81), (55, 120, 15), (30, 90, 95), (45, 50, 50), (40, 75, 55)]
    df = spark.createDataFrame(rows, "age int, inc int, spd int")
    got = [r[0] for r in df.select(segment_name(F.col("inc"), F.col("spd"), F.col("age"))).collect()]
    assert got == ["Young Young / Trend-Setters", "Senior High-Income / Frugal", "VIP / Top Spenders",
                   "Middle-Class / Average", ""]
    t = spark.createDataFrame([(0.6,), (-0.6,), (0.5,), (None,)], "z double").select(trait(F.col("z"))).collect()
    assert [r[0] for r in t] == ["High", "Low", "Average", "Average"]


def test_dates_from_timestamps(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 5, 5, 12, 0),)], "t timestamp_ntz")
    r = date_parts(df, ["t"]).first()
    assert r["t_dow"] == 6
