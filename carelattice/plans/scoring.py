"""Scoring records and keeping a prediction log. All functions take batch or streaming frames, apart
from the two log reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.linkage import DEFAULT_FEATURES, Feature
from ..schemas import MATCH_THRESHOLD, PAIR_REQUEST, RISK_REQUEST
from .modelling import with_score

REQUIRED_PERSON_FIELDS = ("first", "last", "dob", "zip")


def read_requests(spark: SparkSession, path: str, schema: str, stream: bool = False) -> DataFrame:
    """JSON records of a fixed schema, as a batch or as a stream of arriving files."""
    reader = spark.readStream if stream else spark.read
    return reader.schema(schema).json(path)


def read_pair_requests(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    return read_requests(spark, path, PAIR_REQUEST, stream)


def read_risk_requests(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    return read_requests(spark, path, RISK_REQUEST, stream)


def is_complete_pair() -> Column:
    """Whether both records have all required fields; others cannot be scored."""
    complete = F.lit(True)
    for side in ("record_a", "record_b"):
        for name in REQUIRED_PERSON_FIELDS:
            complete = complete & F.col(f"{side}.{name}").isNotNull()
    return complete


def pair_summary() -> Column:
    name = lambda side: F.concat_ws(" ", f"{side}.first", f"{side}.last")
    return F.concat(name("record_a"), F.lit(" <-> "), name("record_b"))


def risk_summary() -> Column:
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("None"))
    return F.concat(
        F.lit("age="), shown("age_at_encounter"), F.lit(", prior_inpatient="), shown("prior_inpatient_count")
    )


def with_pair_features(requests: DataFrame, features: Mapping[str, Feature] = DEFAULT_FEATURES) -> DataFrame:
    a, b = F.col("record_a"), F.col("record_b")
    return requests.select("*", *[f(a, b).alias(name) for name, f in features.items()])


def score_pairs(
    requests: DataFrame,
    model: Model | Column,
    features: Mapping[str, Feature] = DEFAULT_FEATURES,
    threshold: float = MATCH_THRESHOLD,
) -> DataFrame:
    """Complete pairs with features, score and `is_match`. `model` is fitted, or a score column."""
    ready = with_pair_features(requests.where(is_complete_pair()), features)
    scored = ready.withColumn("score", model) if isinstance(model, Column) else with_score(model, ready)
    return scored.withColumn("is_match", F.col("score") >= threshold)


def rejected_pairs(requests: DataFrame) -> DataFrame:
    """The requests that `score_pairs` leaves out, with `reason`: the sides' missing fields."""
    missing = [
        F.when(F.col(f"{side}.{c}").isNull(), F.lit(f"{side}.{c}")) for side in ("record_a", "record_b") for c in REQUIRED_PERSON_FIELDS
    ]
    return requests.where(~is_complete_pair()).withColumn("reason", F.concat_ws(", ", *missing))


def score_risk(requests: DataFrame, model: Model) -> DataFrame:
    """Stays with their readmission score; missing fields are filled as in training."""
    return with_score(model, requests)


def as_log(scored: DataFrame, kind: str, summary: Column, created_at: Column | None = None) -> DataFrame:
    """Rows for the prediction log; `PredictionLog.append` gives them their ids."""
    return scored.select(
        F.lit(kind).alias("kind"),
        summary.alias("input_summary"),
        F.col("score"),
        (F.current_timestamp() if created_at is None else created_at).alias("created_at"),
    )


def shown(scored: DataFrame, digits: int = 4) -> DataFrame:
    """Scores rounded as they are reported."""
    return scored.withColumn("score", F.bround("score", digits))


def log_summary(log: DataFrame) -> DataFrame:
    """Per kind: number, mean, lowest and highest score."""
    return log.groupBy("kind").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("score").alias("avg_score"),
        F.min("score").alias("min_score"),
        F.max("score").alias("max_score"),
    )


def recent_predictions(log: DataFrame, limit: int = 25) -> DataFrame:
    """The latest predictions of a log with ids, newest first; planned as a top-k per task and a merge. A
    `PredictionLog` finds them without reading the rest."""
    return log.orderBy(F.desc("id")).limit(limit)
