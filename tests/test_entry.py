import __spark_entry__ as E


def test_entry_and_registry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and len(df.columns) > 1
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q) and len(q) >= 60


def test_io_roundtrip(spark, tmp_path):
    from kiln.sources.io import load_plan, read_table, save_plan, write_layer
    p = tmp_path / "t.csv"
    p.write_text("id,name,score,when\n1,a,1.5,2024-01-01\n2,NA,,2024-01-02\n3,c,3,bad\n")
    df = read_table(spark, str(p))
    types = dict(df.dtypes)
    assert types["id"] == "bigint" and types["score"] == "double" and types["name"] == "string"
    assert df.where("name is null").count() == 1
    write_layer(df, str(tmp_path / "layer"))
    assert spark.read.parquet(str(tmp_path / "layer")).count() == 3
    save_plan(spark, {"a": [1, 2]}, str(tmp_path / "plan"))
    assert load_plan(spark, str(tmp_path / "plan")) == {"a": [1, 2]}
