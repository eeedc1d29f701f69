from kiln.operators.aggregate import duplicate_ratio, entity_aggregate, entity_mode
from kiln.operators.dedup import dedup_signal, drop_conflicting_labels
from kiln.operators.validate import validate


def test_dedup_keeps_first_and_nulls_equal(spark):
    rows = [(3, "a", None), (1, "a", None), (2, "b", 1.0), (5, "b", 1.0), (4, "c", 2.0)]
    df = spark.createDataFrame(rows, "id int, s string, v double")
    out = sorted(r["id"] for r in dedup_signal(df, ["id"], "id").collect())
    assert out == [1, 2, 4]


def test_conflicting_labels_null_keys_survive(spark):
    rows = [("x", 1, 0), ("x", 1, 1), ("y", 2, 1), (None, 3, 0), (None, 3, 1)]
    df = spark.createDataFrame(rows, "f string, g int, y int")
    out = drop_conflicting_labels(df, "y").collect()
    assert sorted((r["f"] or "-", r["y"]) for r in out) == [("-", 0), ("-", 1), ("y", 1)]


def test_duplicate_ratio_and_mode(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "b"), (5, "c")], "id int, s string")
    assert duplicate_ratio(df, exclude=["id"]) == 1 - 3 / 5
    k = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, "a"), (2, "z")], "k int, v string")
    m = {r["k"]: r["v"] for r in entity_mode(k, "k", "v").collect()}
    assert m == {1: "a", 2: "z"}                           # tie -> smallest
    e = {r["k"]: r["v"] for r in entity_aggregate(k, "k", mode_cols=["v"]).collect()}
    assert e == {1: "a", 2: "z"}


def test_validate_suite(spark):
    rows = [(1, "ok", 1.0), (2, "ok", 2.0), (3, "!!", 3.0), (4, "NULL", 1000.0), (5, None, 4.0)]
    df = spark.createDataFrame(rows, "k int, s string, x double")
    res = {(r["check"], r["column"]): r for r in validate(df).collect()}
    assert res[("special_characters", "s")]["value"] == 0.25
    assert res[("mixed_nulls", "s")]["value"] == 2.0 and not res[("mixed_nulls", "s")]["passed"]
    assert res[("outliers", "x")]["value"] == 0.2
