"""Reporting queries over predictions and benchmark summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.fixed_values import APPROACHES
from tagloom.functions.text import title

# Table columns in display order and whether a lower value is better.
TABLE_METRICS = {
    "accuracy": False,
    "macro_precision": False,
    "macro_recall": False,
    "macro_f1": False,
    "mean_latency_ms": True,
    "p95_latency_ms": True,
    "token_cost_per_1k": True,
}


def union_approaches(
    results: dict[str, DataFrame], enabled: Sequence[str] = APPROACHES
) -> DataFrame:
    """Rows of the enabled approaches with an ``approach`` column."""
    chosen = [name for name in results if name in enabled]
    if not chosen:
        raise ValueError(f"None of {sorted(results)} is enabled in {list(enabled)}.")
    frames = [results[name].withColumn("approach", F.lit(name)) for name in chosen]
    union = frames[0]
    for frame in frames[1:]:
        union = union.unionByName(frame)
    return union


def _metric(summary: DataFrame, name: str) -> Column:
    if name not in summary.columns:
        return F.lit(0.0)
    return F.coalesce(F.col(name), F.lit(0.0))


def benchmark_table(summary: DataFrame) -> DataFrame:
    """Display table: title-cased names, missing metrics as 0, formatted values."""
    percent = ("accuracy", "macro_precision", "macro_recall", "macro_f1")
    latency = ("mean_latency_ms", "p95_latency_ms")
    return summary.select(
        title(F.col("approach")).alias("approach"),
        *[F.format_string("%.1f%%", _metric(summary, c).cast("double") * 100).alias(c) for c in percent],
        # Printf rounds halves up; rint rounds them to even first.
        *[F.format_string("%.0fms", F.rint(_metric(summary, c).cast("double"))).alias(c) for c in latency],
        F.format_string("$%.4f", _metric(summary, "token_cost_per_1k").cast("double")).alias(
            "token_cost_per_1k"
        ),
    )


def benchmark_text(summary: DataFrame) -> DataFrame:
    """One aligned text line per approach for printing."""
    layout = "%-15s %10.3f %10.3f %8.3f %10.3f %8.3f %12.1f"
    columns = (
        "accuracy",
        "macro_precision",
        "macro_recall",
        "macro_f1",
        "weighted_f1",
        "mean_latency_ms",
    )
    values = [_metric(summary, c).cast("double") for c in columns]
    return summary.select("approach", F.format_string(layout, F.col("approach"), *values).alias("line"))


def best_flags(summary: DataFrame, metrics: dict[str, bool] | None = None) -> DataFrame:
    """``(approach, metric, value, is_best)``; every approach that ties for best is marked."""
    metrics = metrics or TABLE_METRICS
    filled = summary.select(
        "approach", *[_metric(summary, m).cast("double").alias(m) for m in metrics]
    )
    tidy = filled.unpivot("approach", list(metrics), "metric", "value")
    lower_is_better = F.col("metric").isin([m for m, lower in metrics.items() if lower])
    of_metric = Window.partitionBy("metric")
    best = F.when(lower_is_better, F.min("value").over(of_metric)).otherwise(
        F.max("value").over(of_metric)
    )
    return tidy.withColumn("is_best", F.col("value") == best)


def first_last_delta(summary: DataFrame, order: Sequence[str] = APPROACHES) -> DataFrame:
    """Last approach against the first: accuracy points, latency ratio and direction.

    Approaches rank by their place in ``order``; others follow by name.  With fewer than
    two approaches the result is empty.
    """
    place = F.array_position(F.array(*[F.lit(a) for a in order]), F.col("approach"))
    rank = F.struct(F.when(place == 0, len(order) + 1).otherwise(place), F.col("approach"))
    row = F.struct(
        "approach",
        _metric(summary, "accuracy").alias("accuracy"),
        _metric(summary, "mean_latency_ms").alias("latency"),
    )
    ends = summary.agg(
        F.min_by(row, rank).alias("first"),
        F.max_by(row, rank).alias("last"),
        F.count("*").alias("_approaches"),
    ).where("_approaches >= 2")
    delta = (F.col("last.accuracy") - F.col("first.accuracy")) * 100
    return ends.select(
        F.col("first.approach").alias("first_approach"),
        F.col("last.approach").alias("last_approach"),
        delta.alias("accuracy_delta_pp"),
        (F.col("last.latency") / F.greatest(F.col("first.latency"), F.lit(1e-6))).alias(
            "latency_ratio"
        ),
        F.when(delta > 0, "improves").otherwise("reduces").alias("direction"),
    )


def headline(delta: DataFrame) -> DataFrame:
    """One caption line from :func:`first_last_delta`."""
    return delta.select(
        F.format_string(
            "%s %s accuracy by %.1f%% over %s at %.1f× the latency.",
            title(F.col("last_approach")),
            F.col("direction"),
            F.abs("accuracy_delta_pp"),
            title(F.col("first_approach")),
            F.col("latency_ratio"),
        ).alias("headline")
    )


def latency_tradeoff(summary: DataFrame) -> DataFrame:
    """Points of the accuracy-against-latency chart."""
    return summary.select(
        title(F.col("approach")).alias("approach"),
        _metric(summary, "mean_latency_ms").alias("mean_latency_ms"),
        (_metric(summary, "accuracy") * 100).alias("accuracy_pct"),
        _metric(summary, "macro_f1").alias("macro_f1"),
        _metric(summary, "token_cost_per_1k").alias("token_cost_per_1k"),
    )


def explore_samples_filter(
    df: DataFrame, outcome: str = "all", truth: str | None = None
) -> DataFrame:
    """Samples by outcome (``all``, ``correct``, ``incorrect``) and true label."""
    same = F.col("prediction").eqNullSafe(F.col("truth"))
    outcomes = {"all": None, "correct": same, "incorrect": ~same}
    if outcome not in outcomes:
        raise ValueError(f"Unknown outcome {outcome!r}; use one of {sorted(outcomes)}.")
    kept = df if outcomes[outcome] is None else df.where(outcomes[outcome])
    return kept if truth is None else kept.where(F.col("truth") == truth)


def explore_samples_summary(df: DataFrame, outcome: str = "all", truth: str | None = None) -> DataFrame:
    """Correct, total and ratio of the filtered samples; ratio is null without samples."""
    same = F.col("prediction").eqNullSafe(F.col("truth"))
    return explore_samples_filter(df, outcome, truth).agg(
        F.count_if(same).alias("correct"),
        F.count("*").alias("total"),
        F.try_divide(F.count_if(same), F.count("*")).alias("ratio"),
    )


def true_labels(df: DataFrame) -> DataFrame:
    """Distinct true labels: the choices of the label filter."""
    return df.select("truth").distinct()


# Parallel lists of a results record, and the column each becomes.
PARALLEL_LISTS = {
    "input_texts": "input_text",
    "raw_outputs": "raw_output",
    "predictions": "prediction",
    "ground_truth": "truth",
    "latencies_ms": "latency_ms",
}


def to_parallel_arrays(
    df: DataFrame, shard_rows: int = 1000, order_by: str = "sample_id"
) -> DataFrame:
    """Results as parallel lists, one record per approach and shard of ``order_by`` values.

    Shards keep the lists bounded whatever the number of samples; ``order_by`` must be a
    unique integer.
    """
    shard = F.call_function("div", F.col(order_by), F.lit(shard_rows)).alias("shard")
    row = F.struct(order_by, *PARALLEL_LISTS.values())
    packed = df.groupBy("approach", shard).agg(F.array_sort(F.collect_list(row)).alias("_rows"))
    # A field of an array of structs is the array of that field.
    lists = [F.col("_rows")[column].alias(name) for name, column in PARALLEL_LISTS.items()]
    return packed.select("approach", "shard", *lists)


def align_parallel_arrays(records: DataFrame) -> DataFrame:
    """One row per prediction from parallel lists.

    Short and missing lists are padded: texts with the empty string, latency with null.  Adds
    ``correct`` and rounds the latency to one decimal.
    """
    keys = [c for c in records.columns if c not in PARALLEL_LISTS]
    # A null list would make the whole zip null.
    lists = {
        c: F.coalesce(c, F.array().cast(records.schema[c].dataType)).alias(c) for c in PARALLEL_LISTS
    }
    rows = records.select(*keys, *lists.values()).select(
        *keys,
        F.size("predictions").alias("_length"),
        F.posexplode(F.arrays_zip(*PARALLEL_LISTS)).alias("position", "_row"),
    ).where(F.col("position") < F.col("_length"))
    texts = [c for c in PARALLEL_LISTS if c != "latencies_ms"]
    padded = rows.select(
        *keys,
        "position",
        *[F.coalesce(f"_row.{c}", F.lit("")).alias(PARALLEL_LISTS[c]) for c in texts],
        F.round("_row.latencies_ms", 1).alias("latency_ms"),
    )
    return padded.withColumn("correct", F.col("prediction") == F.col("truth"))
