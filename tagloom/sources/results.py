"""Storing evaluation results as tidy tables, and the run log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.fixed_values import LOGGED_METRICS
from tagloom.labels import LabelSpace
from tagloom.operators.metrics import benchmark_summary, confusion_matrix, per_class_prf
from tagloom.operators.runlog import flatten_params, run_metrics
from tagloom.schema import RESULT_RECORD, SUMMARY_DOCUMENT
from tagloom.sources.corpus import is_absent, read_table

_HINT = "Run the evaluate job first."


def write_results(predictions: DataFrame, labels: LabelSpace, path: str, **summary_options) -> None:
    """Write ``samples``, ``summary``, ``per_class`` and ``confusion`` tables below ``path``.

    Samples are partitioned by approach and read back, so the metrics never run the
    predictors again.
    """
    spark = predictions.sparkSession
    predictions.write.mode("overwrite").partitionBy("approach").parquet(f"{path}/samples")
    stored = spark.read.schema(predictions.schema).parquet(f"{path}/samples")
    tables = {
        "summary": benchmark_summary(stored, labels, **summary_options),
        "per_class": per_class_prf(stored, labels),
        "confusion": confusion_matrix(stored, labels),
    }
    for name, table in tables.items():
        # A few rows per approach: one file is enough.
        table.coalesce(1).write.mode("overwrite").parquet(f"{path}/{name}")


def read_results(spark: SparkSession, path: str, table: str) -> DataFrame:
    """One of the tables written by :func:`write_results`."""
    return read_table(spark, f"{path}/{table}", f"Results table {table}", _HINT)


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    return read_results(spark, path, "summary")


def summary_document(summary: DataFrame, base_model_id: str) -> DataFrame:
    """The whole summary as one row, with the approaches in a map, ready for ``to_json``.

    One entry per approach, so the single row is small.
    """
    metrics = [*LOGGED_METRICS, "correct_samples", "total_samples"]
    entry = F.struct("approach", F.struct(*metrics))
    return summary.agg(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("generated_at"),
        F.lit(base_model_id).alias("base_model_id"),
        F.max("total_samples").alias("test_set_size"),
        F.max("intent_count").alias("intent_count"),
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("approaches"),
    )


def write_summary_json(summary: DataFrame, base_model_id: str, path: str) -> None:
    document = summary_document(summary, base_model_id)
    document.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def _read_document(spark: SparkSession, path: str, schema: str, what: str) -> DataFrame:
    try:
        reader = spark.read.schema(schema).option("multiLine", "true").option("mode", "FAILFAST")
        return reader.json(path)
    except AnalysisException as failure:
        if is_absent(failure):
            raise FileNotFoundError(f"{what} not found at {path}. {_HINT}") from failure
        raise


def read_summary_json(spark: SparkSession, path: str) -> DataFrame:
    """A summary document as tidy rows, one per approach, for all reporting queries."""
    document = _read_document(spark, path, SUMMARY_DOCUMENT, "Benchmark summary")
    rows = document.select("intent_count", F.explode("approaches").alias("approach", "_metrics"))
    return rows.select("approach", "_metrics.*", "intent_count")


def read_result_records(spark: SparkSession, path: str) -> DataFrame:
    """Per-approach records of parallel lists, as :func:`align_parallel_arrays` takes them.

    Also reads a folder of such documents; each is one row.
    """
    records = _read_document(spark, path, RESULT_RECORD, "Results")
    return records.withColumnRenamed("approach_name", "approach")


def write_run_metrics(
    summary: DataFrame,
    path: str,
    run_id: str,
    step: int = 0,
    tags: dict[str, str] | None = None,
    metrics: Sequence[str] = LOGGED_METRICS,
) -> None:
    """One row per approach and metric of a run's step, with the tags as constant columns.

    A run's step has a folder of its own, so writing it again replaces it.
    """
    rows = run_metrics(summary, metrics)
    for name, value in (tags or {}).items():
        rows = rows.withColumn(name, F.lit(value))
    rows.write.mode("overwrite").parquet(f"{path}/metrics/run_id={run_id}/step={step}")


def write_epoch_metrics(epochs: DataFrame, path: str, run_id: str) -> None:
    """Losses of a run's epochs next to its other metrics, the epoch being the step."""
    losses = epochs.select("epoch", "train_loss", "val_loss").unpivot(
        "epoch", ["train_loss", "val_loss"], "metric", "value"
    )
    rows = losses.select(F.col("epoch").cast("bigint").alias("epoch"), "metric", "value")
    rows.write.mode("overwrite").parquet(f"{path}/epochs/run_id={run_id}")


def write_run_params(params: DataFrame, path: str, run_id: str) -> None:
    """Parameters of a run as key and value text; ``params`` is one row, possibly nested."""
    flatten_params(params).write.mode("overwrite").parquet(f"{path}/params/run_id={run_id}")


def read_run_log(spark: SparkSession, path: str, part: str) -> DataFrame:
    """``metrics``, ``epochs`` or ``params`` of all runs, with their ``run_id``."""
    return read_table(spark, f"{path}/{part}", f"Run log {part}", _HINT)


def write_latency_sketches(
    df: DataFrame, path: str, run_id: str, k: int = 1024, latency_col: str = "latency_ms"
) -> None:
    """A quantile sketch of a run's latencies per approach, next to its metrics; NaN and nulls are left out.

    A sketch of size ``k`` takes a few kilobytes whatever the number of samples.
    """
    values = F.col(latency_col).cast("double")
    kept = df.where(values.isNotNull() & ~F.isnan(values))
    sketches = kept.groupBy("approach").agg(F.kll_sketch_agg_double(values, k).alias("sketch"))
    sketches.write.mode("overwrite").parquet(f"{path}/sketches/run_id={run_id}")


def merged_latencies(spark: SparkSession, path: str, fraction: float = 0.95) -> DataFrame:
    """``(approach, n, percentile)`` over all runs, from their sketches alone."""
    stored = read_table(spark, f"{path}/sketches", "Latency sketches", _HINT)
    merged = stored.groupBy("approach").agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    return merged.select(
        "approach",
        F.kll_sketch_get_n_double("sketch").alias("n"),
        F.kll_sketch_get_quantile_double("sketch", F.lit(fraction)).alias("percentile"),
    )
