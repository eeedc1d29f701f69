"""Scoring new rows (SCO-01, JOIN-02, JOIN-03).

``score`` applies the fitted preprocessing and the cluster model as one
``PipelineModel.transform`` -- pure column expressions plus the model's
predict UDF -- so it runs unchanged on a batch or a streaming DataFrame.
The persona lookup is a broadcast left join: the persona table has one row
per cluster (k rows, bounded by the model).
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.operators.cluster import assemble, predict


def attach_persona(scored: DataFrame, personas: DataFrame, cluster: str = "cluster",
                   name: str = "persona", default: str = "Unknown") -> DataFrame:
    """JOIN-02: cluster -> persona name, default ``Unknown``."""
    p = personas.select(F.col(cluster).alias("__cl"), F.col(name).alias("__pn"))
    return (scored.join(F.broadcast(p), F.col(cluster) == F.col("__cl"), "left")
            .withColumn(name, F.coalesce(F.col("__pn"), F.lit(default))).drop("__cl", "__pn"))


def score(df: DataFrame, prep: PipelineModel, model, feature_cols, personas: DataFrame | None = None,
          cluster: str = "cluster") -> DataFrame:
    """SCO-01: preprocessing -> predict -> persona; raw input columns kept."""
    raw = {c: f"__raw{i}" for i, c in enumerate(df.columns)}
    carried = df.select("*", *[F.col(f"`{c}`").alias(r) for c, r in raw.items()])
    vec = assemble(prep.transform(carried), feature_cols, "__features")
    pred = predict(model, vec, "__features", cluster)
    out = pred.select(*[F.col(r).alias(c) for c, r in raw.items()], F.col(cluster).cast("int").alias(cluster))
    if personas is not None:
        out = attach_persona(out, personas, cluster)
    return out
