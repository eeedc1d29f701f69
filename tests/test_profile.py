import math

from kiln.operators.profile import profile


def test_profile_edge_frame(spark):
    rows = [(1, None, 2.0, "a", float("nan")), (2, None, 2.0, "a", None), (3, None, 2.0, "b", 4.0),
            (4, None, 2.0, None, 5.0)]
    df = spark.createDataFrame(rows, "`Annual Income (k$)` int, allnull double, const double, `c.d` string, nanx double")
    p = {r["column"]: r for r in profile(df).collect()}
    inc = p["Annual Income (k$)"]
    assert inc["type"] == "Numeric" and inc["is_unique"] and inc["n_distinct"] == 4
    assert inc["q25"] == 1.75 and inc["iqr"] == 1.5 and inc["mad"] == 1.0
    assert math.isclose(inc["skewness"], 0.0, abs_tol=1e-12)
    assert p["allnull"]["n_missing"] == 4 and p["allnull"]["n_distinct"] == 0 and p["allnull"]["q50"] is None
    assert p["const"]["n_distinct"] == 1 and p["const"]["iqr"] == 0.0 and p["const"]["std"] == 0.0
    assert p["c.d"]["type"] == "Text" and p["c.d"]["n_missing"] == 1 and p["c.d"]["n_unique"] == 1
    # NaN beside NULL: both missing
    assert p["nanx"]["n_missing"] == 2 and p["nanx"]["mean"] == 4.5


def test_profile_empty_and_one_row(spark):
    empty = spark.createDataFrame([], "x double, s string")
    p = {r["column"]: r for r in profile(empty).collect()}
    assert p["x"]["n"] == 0 and p["x"]["q50"] is None
    one = spark.createDataFrame([(1.5, "z")], "x double, s string")
    p = {r["column"]: r for r in profile(one).collect()}
    assert p["x"]["q50"] == 1.5 and p["x"]["std"] is None and p["s"]["is_unique"]


def test_skew_kurtosis_bias_corrected(spark):
    import numpy as np
    v = [1.0, 2.0, 2.0, 3.0, 9.0, 4.0, 4.5]
    p = profile(spark.createDataFrame([(x,) for x in v], "x double")).first()
    a = np.array(v)
    n = len(a)
    m2, m3, m4 = (((a - a.mean()) ** k).mean() for k in (2, 3, 4))
    g1, g2 = m3 / m2 ** 1.5, m4 / m2 ** 2 - 3
    assert math.isclose(p["skewness"], g1 * math.sqrt(n * (n - 1)) / (n - 2), rel_tol=1e-9)
    assert math.isclose(p["kurtosis"], ((n + 1) * g2 + 6) * (n - 1) / ((n - 2) * (n - 3)), rel_tol=1e-9)


def test_profile_approx_distinct(spark):
    rows = [(i, i % 10, f"s{i % 3}") for i in range(5000)]
    df = spark.createDataFrame(rows, "id long, m long, s string")
    p = {r["column"]: r for r in profile(df, exact_distinct=False).collect()}
    assert abs(p["id"]["n_distinct"] - 5000) <= 150 and p["id"]["is_unique"]
    assert p["m"]["n_distinct"] == 10 and not p["m"]["is_unique"] and p["m"]["n_unique"] is None


def test_sequence_and_range_beyond_doubles(spark):
    big = 2 ** 60
    rows = [(big + i, big + i + (i == 9), float("inf") if i == 3 else float(i), None if i == 0 else i) for i in range(10)]
    p = {r["column"]: r for r in profile(spark.createDataFrame(rows, "s long, gap long, v double, some int"), with_mad=False).collect()}
    assert p["s"]["is_sequence"] and p["s"]["range"] == 9 and p["s"]["highest"] == str(big + 9)
    assert not p["gap"]["is_sequence"] and not p["some"]["is_sequence"] and not p["v"]["is_sequence"]
    assert p["v"]["range"] == float("inf") and p["v"]["n_infinite"] == 1 and p["some"]["range"] == 8
    empty = profile(spark.createDataFrame([], "a long, t timestamp"), with_mad=False).collect()
    assert all(not r["is_sequence"] and r["range"] is None and r["lowest"] is None for r in empty)
