"""Classification of requests, batch or streaming with the same code."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tagloom.functions.matching import confidence, match_labels
from tagloom.functions.prompts import prompt_for
from tagloom.labels import LabelSpace
from tagloom.operators.predict import BATCH_SIZE, Predictor, predict_batch
from tagloom.operators.validate import validate_requests


def classify(
    requests: DataFrame,
    factory: Callable[[], Predictor],
    key: str,
    labels: LabelSpace,
    bank: Column | None = None,
    batch_size: int = BATCH_SIZE,
) -> DataFrame:
    """One record per request with ``outcome`` ``response``, ``rejected`` or ``failed``.

    Rejected requests are not sent to the predictor; a failing call gives a ``failed``
    record and does not stop the job.
    """
    checked = validate_requests(requests)
    prompt = F.when(
        F.col("error").isNull(), prompt_for(F.col("approach"), F.col("text"), bank, labels)
    )
    prompted = checked.select(
        "request_id", "approach", F.col("error").alias("rejection"), prompt.alias("prompt")
    )
    answered = predict_batch(
        prompted, factory, key, batch_size=batch_size, record_errors=True
    )
    matched = match_labels(answered, labels)
    ok = F.col("rejection").isNull() & F.col("error").isNull()
    return matched.select(
        "request_id",
        F.when(F.col("rejection").isNotNull(), "rejected")
        .when(F.col("error").isNotNull(), "failed")
        .otherwise("response")
        .alias("outcome"),
        F.when(ok, F.col("prediction")).alias("intent"),
        F.when(ok, confidence(F.col("strategy"))).alias("confidence"),
        F.col("approach").alias("approach_used"),
        F.when(ok, F.col("latency_ms")).alias("latency_ms"),
        F.coalesce("rejection", F.concat(F.lit("Inference failed: "), F.col("error"))).alias(
            "detail"
        ),
    )


def unique_requests(requests: DataFrame, time_col: str, delay: str) -> DataFrame:
    """Each request id once, for senders that repeat a request until it is answered.

    An id is remembered until the watermark has passed it by ``delay``.  Rows behind the watermark, which starts at
    the epoch, are dropped.
    """
    return requests.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(["request_id"])


def start_replay_stream(
    spark: SparkSession,
    failed_path: str,
    requests: DataFrame,
    factory: Callable[[], Predictor],
    key: str,
    labels: LabelSpace,
    out_path: str,
    checkpoint_path: str,
    bank: Column | None = None,
    batch_size: int = BATCH_SIZE,
    **trigger,
) -> StreamingQuery:
    """Classify again what a classification stream recorded as failed.

    ``failed_path`` is that stream's output, of which the replay reads each finished file once; ``requests`` is the
    table of all requests.  Its own failures are recorded in its own output, from which a further replay can start.
    """
    records = spark.readStream.schema("request_id bigint, outcome string").parquet(failed_path)
    again = records.where("outcome = 'failed'").select("request_id").join(requests, "request_id")
    return start_classify_stream(
        again, factory, key, labels, out_path, checkpoint_path, bank, batch_size, **trigger
    )


def start_classify_stream(
    requests: DataFrame,
    factory: Callable[[], Predictor],
    key: str,
    labels: LabelSpace,
    out_path: str,
    checkpoint_path: str,
    bank: Column | None = None,
    batch_size: int = BATCH_SIZE,
    **trigger,
) -> StreamingQuery:
    """Classify a stream of requests into Parquet, one folder per outcome.

    A single exactly-once file sink holds responses and quarantine, so nothing is computed
    twice.
    """
    records = classify(requests, factory, key, labels, bank, batch_size)
    return (
        records.writeStream.format("parquet")
        .partitionBy("outcome")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint_path)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
