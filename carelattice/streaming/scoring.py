"""Scoring as a stream: files of requests in, log rows out.

Scoring is stateless, so there is no watermark and no state store. Each micro-batch is appended to the log under its number: after a
lost executor or a restart it comes again under the same one, and the log's ledger lets it in once.
"""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans import scoring
from ..session import shared_folder
from ..sources.prediction_log import PredictionLog


def stream_log(
    log: DataFrame, path: str, checkpoint: str | None = None, name: str = "predictions", once: bool = False
) -> StreamingQuery:
    """Append a streaming log to the prediction log at `path`. `once` processes what is there and stops.

    Progress is kept in `checkpoint`, or below the folder named in `spark.checkpoint.dir`. Another checkpoint counts its
    batches anew, so it needs another `name`. A log has one writer at a time.
    """
    checkpoint = checkpoint or shared_folder(log.sparkSession, f"stream-{name}")

    def append(rows: DataFrame, number: int) -> None:
        PredictionLog(rows.sparkSession, path).append(rows, f"{name}-{number}")

    writer = log.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.queryName(name).start()


def stream_pair_scores(
    spark: SparkSession, requests: str, model: Model | Column, log: str, checkpoint: str | None = None, once: bool = False
) -> StreamingQuery:
    """Score arriving pair requests into the log."""
    arriving = scoring.read_pair_requests(spark, requests, stream=True)
    scored = scoring.score_pairs(arriving, model)
    return stream_log(scoring.as_log(scored, "match", scoring.pair_summary()), log, checkpoint, "match", once)


def stream_risk_scores(
    spark: SparkSession, requests: str, model: Model, log: str, checkpoint: str | None = None, once: bool = False
) -> StreamingQuery:
    """Score arriving risk requests into the log."""
    arriving = scoring.read_risk_requests(spark, requests, stream=True)
    scored = scoring.score_risk(arriving, model)
    return stream_log(scoring.as_log(scored, "risk", scoring.risk_summary()), log, checkpoint, "risk", once)
