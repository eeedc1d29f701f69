"""Scoring a stream with fitted steps (SCO-01 on Structured Streaming).

Fitted kiln steps are column expressions and Spark ML cluster models are
row-wise, so the batch ``score`` function applies unchanged to a streaming
DataFrame; the persona table is a static broadcast side of a stream-static
left join.  Nothing here keeps state across micro-batches.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from kiln.operators.score import score


def score_stream(stream: DataFrame, prep: PipelineModel, model, feature_cols,
                 personas: DataFrame | None = None, cluster: str = "cluster") -> DataFrame:
    if not stream.isStreaming:
        raise ValueError("expected a streaming DataFrame (spark.readStream)")
    return score(stream, prep, model, feature_cols, personas, cluster)


def start_scoring(stream: DataFrame, prep: PipelineModel, model, feature_cols, path: str,
                  checkpoint: str, personas: DataFrame | None = None, fmt: str = "parquet",
                  trigger_once: bool = False):
    """Append scored rows to ``path``; ``checkpoint`` must be a shared folder."""
    out = score_stream(stream, prep, model, feature_cols, personas)
    w = out.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint) \
        .outputMode("append")
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()
