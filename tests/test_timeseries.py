import numpy as np
import pandas as pd

from kiln.operators.timeseries import (_segment, detect_gaps, fill_forward, interpolate_linear, is_ordered,
                                       stationarity)


def _series(spark, n=400, seed=5):
    rng = np.random.default_rng(seed)
    key = rng.integers(0, 3, n)
    t = np.arange(n) * 10 + rng.integers(0, 5, n)
    v = rng.normal(size=n).round(3)
    v[rng.random(n) < 0.3] = np.nan
    v[:4] = np.nan
    pdf = pd.DataFrame({"k": key, "t": t, "v": v})
    rows = [(int(a), int(b), None if np.isnan(c) else float(c)) for a, b, c in zip(key, t, v)]
    return spark.createDataFrame(rows, "k long, t long, v double"), pdf


def test_fill_forward_matches_pandas_across_segments(spark):
    df, pdf = _series(spark)
    exp = pdf.sort_values(["k", "t"]).groupby("k", group_keys=False)["v"].apply(lambda s: s.ffill().bfill())
    exp = dict(zip(pdf.sort_values(["k", "t"])["t"], exp))
    for buckets in (1, 7):
        got = {r["t"]: r["v"] for r in fill_forward(df, "t", "k", ["v"], buckets=buckets).collect()}
        assert all(np.isclose(got[t], exp[t]) for t in got)
    glob = pdf.sort_values("t")["v"].ffill().bfill().tolist()
    got = [r["v"] for r in fill_forward(df.drop("k"), "t", None, ["v"], buckets=5).orderBy("t").collect()]
    assert np.allclose(got, glob)


def test_interpolate_linear_interior_only(spark):
    rows = [(1, 0, 0.0), (1, 10, None), (1, 30, 3.0), (1, 40, None), (2, 5, None), (2, 6, 1.0)]
    df = spark.createDataFrame(rows, "k long, t long, v double")
    got = {(r["k"], r["t"]): r["v"] for r in interpolate_linear(df, "t", "k", ["v"], buckets=3).collect()}
    assert got[(1, 10)] == 1.0 and got[(1, 40)] is None and got[(2, 5)] is None


def test_gaps_order_and_stationarity(spark):
    rows = [(t,) for t in [0, 1, 2, 3, 7, 8, 12]]
    g = detect_gaps(spark.createDataFrame(rows, "t long"), "t").orderBy("cur").collect()
    assert [(r["prev"], r["cur"], r["missing_steps"]) for r in g] == [(3, 7, 3), (8, 12, 3)]
    df = spark.createDataFrame([(1, 5.0), (2, 6.0), (3, 4.0)], "pos long, v double")
    assert not is_ordered(df, "v", "pos")
    assert not is_ordered(df, "pos", "v")
    rng = np.random.default_rng(0)
    y = np.cumsum(rng.normal(size=200)) * 0.1 + rng.normal(size=200)
    sdf = spark.createDataFrame([(i, float(v)) for i, v in enumerate(y)], "t long, y double")
    r = stationarity(sdf, "t", "y", buckets=4).first()
    dy, y0 = np.diff(y), y[:-1]
    b, a = np.polyfit(y0, dy, 1)
    resid = dy - (a + b * y0)
    se = np.sqrt(resid @ resid / (len(dy) - 2) / ((y0 - y0.mean()) @ (y0 - y0.mean())))
    assert np.isclose(r["slope"], b) and np.isclose(r["t_stat"], b / se)


def test_null_keys_carry_like_any_key(spark):
    rows = [(None if i % 2 else "a", i, float(i) if i % 5 == 0 else None) for i in range(40)]
    df = spark.createDataFrame(rows, "k string, t long, v double")
    got = {r["t"]: r["v"] for r in fill_forward(df, "t", "k", ["v"], buckets=8).collect()}
    last, first = {}, {"a": 0.0, None: 5.0}
    for k, t, v in rows:
        last[k] = v if v is not None else last.get(k, first[k])
        assert got[t] == last[k]


def shares(df, order, keys, buckets=16):
    counts = [r["count"] for r in _segment(df, order, keys, buckets).groupBy("__b").count().collect()]
    return len(counts), max(counts) / (df.count() / buckets)


def test_segments_hold_equal_shares_for_any_order(spark):
    outlier = spark.createDataFrame([(i, i % 3) for i in range(4000)] + [(10 ** 12, 0)], "t long, k long")
    assert shares(outlier, ["t"], ["k"])[1] <= 2
    n = 20_000
    base = spark.range(n)
    text = base.selectExpr("date_format(timestamp_seconds(1700000000 + id), 'yyyy-MM-dd HH:mm:ss') AS at", "id")
    tied = base.selectExpr("'same' AS a", "1 AS b", "id AS c")
    dates = base.selectExpr("date_add(date'2020-01-01', cast(id % 9 AS int)) AS day", "id AS v")     # nine days only
    equal = base.selectExpr("'same' AS a", "0 AS v")                                               # rows alike in everything
    for df, order in ((text, ["at"]), (tied, ["a", "b", "c"]), (dates, ["day"]), (equal, ["a"])):
        found, largest = shares(df, order, [])
        assert found == 16 and largest <= 2, (order, found, largest)


def test_text_dates_and_ties_fill_as_pandas(spark):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"day": pd.to_datetime("2024-01-01") + pd.to_timedelta(rng.integers(0, 40, 300), "D"), "seq": rng.permutation(300)})
    pdf["v"] = np.where(rng.random(300) < 0.6, np.nan, rng.normal(size=300))
    df = spark.createDataFrame([(r.day.date(), f"{r.day:%Y-%m-%d}", int(r.seq), None if np.isnan(r.v) else float(r.v)) for r in pdf.itertuples()],
                               "day date, txt string, seq long, v double")
    want = pdf.sort_values(["day", "seq"])["v"].ffill().bfill().tolist()
    for first in ("day", "txt"):
        got = fill_forward(df, [first, "seq"], None, ["v"], buckets=7).orderBy(first, "seq").collect()
        assert np.allclose([r["v"] for r in got], want)


def test_daily_gaps_and_interpolation(spark):
    days = ["2024-02-27", "2024-02-28", "2024-02-29", "2024-03-03", "2024-03-04"]
    df = spark.createDataFrame([(d, None if i in (1, 3) else float(i)) for i, d in enumerate(days)], "d string, v double").selectExpr("to_date(d) AS d", "v")
    got = [(str(r["prev"]), str(r["cur"]), r["delta"], r["step"], r["missing_steps"]) for r in detect_gaps(df, "d").collect()]
    assert got == [("2024-02-29", "2024-03-03", 3, 1, 2)]
    assert detect_gaps(df, "d", step=3).count() == 0
    assert [r["v"] for r in interpolate_linear(df, "d", None, ["v"], buckets=3).orderBy("d").collect()] == [0.0, 1.0, 2.0, 3.5, 4.0]


def test_clean_sorts_a_series_out_of_order(spark):
    from kiln.plans import timeseries as TS
    df = spark.createDataFrame([(3, "c", 1.0), (1, "a", None), (2, "b", 5.0)], "t long, id string, v double").repartition(3)
    plan = {"id_cols": ["id"], "temporal_consistency": {"is_sorted": False}}
    assert [tuple(r) for r in TS.clean(df, plan, "t").collect()] == [(1, 5.0), (2, 5.0), (3, 1.0)]


def test_subsecond_gaps(spark):
    import datetime
    t0 = datetime.datetime(2024, 1, 1)
    rows = [(t0 + datetime.timedelta(milliseconds=100 * i),) for i in range(100) if not 40 <= i < 61]
    g = detect_gaps(spark.createDataFrame(rows, "t timestamp"), "t").collect()
    assert [(round(r["delta"], 6), r["step"], r["missing_steps"]) for r in g] == [(2.2, 0.1, 21)]
    assert [r["missing_steps"] for r in detect_gaps(spark.createDataFrame(rows, "t timestamp"), "t", step=0.1).collect()] == [21]


def test_stationarity_uses_the_row_before(spark):
    vals = [1.0, 2.0, None, 4.0, 3.0, 5.0, 4.5, None, 2.0, 2.5]
    r = stationarity(spark.createDataFrame(list(enumerate(vals)), "t long, y double"), "t", "y", buckets=3).first()
    pairs = [(a, b - a) for a, b in zip(vals, vals[1:]) if a is not None and b is not None]
    assert r["n"] == len(pairs) and np.isclose(r["slope"], np.polyfit(*zip(*pairs), 1)[0])


def test_string_order_and_default_columns(spark):
    rows = [("2024-01-%02d" % d, float(d) if d % 3 else None) for d in range(1, 20)]
    got = fill_forward(spark.createDataFrame(rows, "day string, v double"), "day", buckets=4).orderBy("day").collect()
    assert [r["v"] for r in got][2:5] == [2.0, 4.0, 5.0]
    df = spark.createDataFrame([(0, 0.0, "x"), (10, None, "y"), (20, 4.0, "z")], "t long, v double, s string")
    assert [r["v"] for r in interpolate_linear(df, "t").orderBy("t").collect()] == [0.0, 2.0, 4.0]
