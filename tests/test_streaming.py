from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from kiln.operators.cluster import fit_clusters
from kiln.operators.scale import fit_standard_scale
from kiln.operators.score import score
from kiln.streaming.scoring import score_stream


def test_stream_scoring_equals_batch(spark, tmp_path):
    rows = [(i, float(i % 7), float((i * 3) % 11)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    prep = PipelineModel([fit_standard_scale(df, ["a", "b"])])
    model, _lab, _ = fit_clusters(prep.transform(df), ["a", "b"], "KMeans", k=3, n_init=2)
    personas = spark.createDataFrame([(0, "zero"), (1, "one")], "cluster int, persona string")
    batch = {r["id"]: (r["cluster"], r["persona"]) for r in score(df, prep, model, ["a", "b"], personas).collect()}
    src = str(tmp_path / "in")
    df.write.parquet(src)
    stream = spark.readStream.schema(df.schema).parquet(src)
    q = (score_stream(stream, prep, model, ["a", "b"], personas).writeStream.format("memory")
         .queryName("scored").outputMode("append").start())
    q.processAllAvailable()
    q.stop()
    got = {r["id"]: (r["cluster"], r["persona"]) for r in spark.table("scored").collect()}
    assert got == batch
    assert {p for _c, p in got.values()} <= {"zero", "one", "Unknown"}
    assert spark.table("scored").where(F.col("a").isNull()).count() == 0


def test_centroid_model_persists(spark, tmp_path):
    from kiln.operators.multikmeans import centroid_model
    m = centroid_model([[0.0, 0.0], [10.0, 10.0]], "f", "c")
    pm = PipelineModel([m])
    pm.write().overwrite().save(str(tmp_path / "m"))
    back = PipelineModel.load(str(tmp_path / "m"))
    from pyspark.ml.linalg import Vectors
    d = spark.createDataFrame([(Vectors.dense([1.0, 2.0]),), (Vectors.dense([9.0, 8.0]),)], ["f"])
    assert [r["c"] for r in back.transform(d).collect()] == [0, 1]
