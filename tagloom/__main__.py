"""Command line: ``python -m tagloom ingest|prepare|train|evaluate ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tagloom.fixed_values import APPROACHES
from tagloom.labels import DEFAULT_SPACE, LabelSpace
from tagloom.operators.classifier import save_classifier, save_metadata, train_text_classifier
from tagloom.operators.report import benchmark_text
from tagloom.operators.runlog import epoch_rollup
from tagloom.operators.softmax import save_softmax, train_softmax, training_log
from tagloom.plans.evaluate import evaluate
from tagloom.plans.prepare import ingest, prepare
from tagloom.session import remove_staged, ship_package
from tagloom.sources.results import write_epoch_metrics


def _labels(value: str) -> LabelSpace:
    return LabelSpace(part.strip() for part in value.split(","))


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tagloom", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("ingest", help="store a raw corpus once, with row ids")
    job.add_argument("source")
    job.add_argument("target")
    job.add_argument("--force", action="store_true")

    job = jobs.add_parser("prepare", help="clean, split, build prompts and chat records")
    job.add_argument("raw")
    job.add_argument("out")
    job.add_argument("--labels", type=_labels, default=DEFAULT_SPACE)

    job = jobs.add_parser("train", help="train the classifier on the train split")
    job.add_argument("prepared")
    job.add_argument("out")
    job.add_argument("--labels", type=_labels, default=DEFAULT_SPACE)
    job.add_argument("--algorithm", choices=("naive_bayes", "logistic", "softmax"), default="naive_bayes")

    job = jobs.add_parser("evaluate", help="compare the approaches on the test split")
    job.add_argument("prepared")
    job.add_argument("classifier")
    job.add_argument("results")
    job.add_argument("--labels", type=_labels, default=DEFAULT_SPACE)
    job.add_argument("--approaches", default=",".join(APPROACHES))
    job.add_argument("--max-samples", type=int, help="the first so many samples only; all by default")

    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName(f"tagloom-{args.job}").getOrCreate()
    ship_package(spark)
    if args.job == "ingest":
        ingest(spark, args.source, args.target, args.force)
    elif args.job == "prepare":
        prepare(spark, args.raw, args.out, args.labels)
    elif args.job == "train":
        splits = spark.read.parquet(f"{args.prepared}/splits")
        train = splits.where(F.col("split") == "train")
        if args.algorithm == "softmax":
            trained = train_softmax(train, args.labels, splits.where(F.col("split") == "val"))
            save_softmax(trained, spark, save_metadata(spark, args.out, "softmax", "softmax", args.labels))
            write_epoch_metrics(epoch_rollup(training_log(spark, trained, 0)), f"{args.out}/run_log", "train")
        else:
            model = train_text_classifier(train, args.labels, algorithm=args.algorithm)
            save_classifier(model, spark, args.out, args.algorithm, args.labels)
    else:
        enabled = [name.strip() for name in args.approaches.split(",")]
        summary = evaluate(
            spark,
            args.prepared,
            args.classifier,
            args.results,
            args.labels,
            enabled,
            args.max_samples,
        )
        for row in benchmark_text(summary).collect():
            print(row.line)
    remove_staged(spark)


if __name__ == "__main__":
    main()
