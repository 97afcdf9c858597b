"""The evaluate job: test samples through several approaches to one comparison."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.fixed_values import APPROACHES
from tagloom.functions.matching import match_labels
from tagloom.labels import LabelSpace
from tagloom.operators.classifier import load_classifier, predict_with, read_metadata
from tagloom.operators.metrics import benchmark_summary
from tagloom.operators.naive_bayes import NaiveBayes, predict_naive_bayes
from tagloom.operators.bank import example_rows
from tagloom.operators.predict import LexicalPredictor, NearestPredictor, predict_batch
from tagloom.operators.report import union_approaches
from tagloom.operators.softmax import Softmax, load_softmax, predict_softmax
from tagloom.session import stage
from tagloom.sources.jsonl import read_example_bank
from tagloom.sources.results import read_summary, write_results, write_run_metrics, write_summary_json

# Takes samples with an ``instruction`` column and adds ``raw_output``, and ``latency_ms``
# if it measures one.
Approach = Callable[[DataFrame], DataFrame]


def default_approaches(
    labels: LabelSpace, bank: DataFrame, model: Callable[[], PipelineModel | NaiveBayes | Softmax]
) -> dict[str, Approach]:
    """Label-name overlap, nearest bank example, and the trained classifier (loaded on use).

    The first two and a softmax model are called like any model, batch by batch, and have a latency for each call;
    the joins of naive Bayes and the pipelines of Spark ML make no calls.  The bank is one of a few examples a label.
    """
    names = tuple(labels)

    def zero_shot(samples: DataFrame) -> DataFrame:
        return predict_batch(samples, lambda: LexicalPredictor(names), "lexical", "instruction")

    def few_shot(samples: DataFrame) -> DataFrame:
        shown = tuple((r.intent, r.example) for r in example_rows(bank).orderBy("intent", "place").collect())
        return predict_batch(samples, lambda: NearestPredictor(shown), f"nearest:{hash(shown)}", "instruction")

    def fine_tuned(samples: DataFrame) -> DataFrame:
        trained = model()
        if isinstance(trained, Softmax):
            return predict_softmax(samples, trained)
        if isinstance(trained, NaiveBayes):
            return samples.join(predict_naive_bayes(samples, trained, "sample_id"), "sample_id")
        return predict_with(trained, samples)

    return {
        "zero_shot": zero_shot,
        "few_shot": few_shot,
        "fine_tuned": fine_tuned,
    }


def run_approach(samples: DataFrame, approach: Approach, name: str) -> DataFrame:
    """Stored raw outputs of one approach over ``(sample_id, instruction, intent)``.

    One job per approach.  Latencies are those that the approach measured for its calls; one
    that measures none has only the job's wall time divided by its rows.
    """
    began = time.perf_counter()
    answered = stage(approach(samples), f"raw-{name}")
    elapsed_ms = (time.perf_counter() - began) * 1000.0
    if "latency_ms" not in answered.columns:
        answered = answered.withColumn("latency_ms", F.lit(elapsed_ms / max(answered.count(), 1)))
    return answered.select(
        "sample_id",
        F.col("instruction").alias("input_text"),
        "raw_output",
        F.col("intent").alias("truth"),
        "latency_ms",
    )


def compare_approaches(
    samples: DataFrame,
    approaches: dict[str, Approach],
    labels: LabelSpace,
    enabled: Sequence[str] = APPROACHES,
) -> DataFrame:
    """Matched predictions of all enabled approaches; only those are run."""
    results = {
        name: run_approach(samples, approach, name)
        for name, approach in approaches.items()
        if name in enabled
    }
    return match_labels(union_approaches(results, enabled), labels)


def three_way_benchmark(
    samples: DataFrame,
    approaches: dict[str, Approach],
    labels: LabelSpace,
    enabled: Sequence[str] = APPROACHES,
) -> DataFrame:
    """Benchmark summary of the enabled approaches over the same samples."""
    predictions = stage(compare_approaches(samples, approaches, labels, enabled), "predictions")
    return benchmark_summary(predictions, labels)


def load_trained(spark: SparkSession, path: str) -> PipelineModel | Softmax:
    """The classifier that the train job stored."""
    if read_metadata(spark, path).first().framework == "softmax":
        return load_softmax(spark, f"{path}/model")
    return load_classifier(spark, path)[0]


def evaluate(
    spark: SparkSession,
    prepared_path: str,
    classifier_path: str,
    results_path: str,
    labels: LabelSpace,
    enabled: Sequence[str] = APPROACHES,
    max_samples: int | None = None,
    base_model_id: str = "spark-ml",
    run_id: str = "evaluate",
) -> DataFrame:
    """Evaluate the test split of a prepare job and publish all result tables.

    All test samples, or the first ``max_samples`` of them.
    """
    test = spark.read.parquet(f"{prepared_path}/splits").where(F.col("split") == "test")
    samples = test.select(F.col("row_id").alias("sample_id"), "instruction", "intent")
    if max_samples is not None:
        samples = stage(samples.orderBy("sample_id").limit(max_samples), "samples")
    bank = read_example_bank(spark, f"{prepared_path}/prompts/example_bank")
    approaches = default_approaches(labels, bank, lambda: load_trained(spark, classifier_path))
    write_results(compare_approaches(samples, approaches, labels, enabled), labels, results_path)
    summary = read_summary(spark, results_path)
    write_summary_json(summary, base_model_id, f"{results_path}/summary_json")
    write_run_metrics(summary, f"{results_path}/run_log", run_id, tags={"base_model_id": base_model_id})
    return summary
