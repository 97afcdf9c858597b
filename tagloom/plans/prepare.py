"""The prepare job: raw corpus to cleaned table, splits, prompts and training records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.fixed_values import DEFAULT_SEED, MAX_TEXT_LENGTH, MIN_TEXT_LENGTH, SPLIT_RATIOS
from tagloom.functions.prompts import zero_shot_template
from tagloom.labels import DEFAULT_SPACE, LabelSpace
from tagloom.operators.audit import verify_no_leakage
from tagloom.operators.bank import few_shot_bank
from tagloom.operators.clean import clean_dataset
from tagloom.operators.split import Ratios, stratified_split
from tagloom.sources.corpus import materialize_once, read_corpus, write_sample_head
from tagloom.sources.jsonl import write_chat_jsonl, write_example_bank, write_split_jsonl


def ingest(spark: SparkSession, source: str, target: str, force: bool = False) -> DataFrame:
    """Store the raw corpus once, with a ``row_id`` that fixes its order from then on."""
    raw = read_corpus(spark, source, "instruction", "intent")
    if "row_id" not in raw.columns:
        raw = raw.withColumn("row_id", F.monotonically_increasing_id())
    stored = materialize_once(raw, target, force)
    write_sample_head(stored, f"{target.rstrip('/')}_sample")
    return stored


def prepare(
    spark: SparkSession,
    raw_path: str,
    out_path: str,
    labels: LabelSpace = DEFAULT_SPACE,
    low: int = MIN_TEXT_LENGTH,
    high: int = MAX_TEXT_LENGTH,
    ratios: Ratios = SPLIT_RATIOS,
    seed: int = DEFAULT_SEED,
) -> None:
    """Write ``cleaned``, ``splits`` (Parquet and JSON lines), template, bank and chat records."""
    raw = read_corpus(spark, raw_path, "row_id", "instruction", "intent")
    clean_dataset(raw, labels, low, high).write.mode("overwrite").parquet(f"{out_path}/cleaned")
    cleaned = spark.read.parquet(f"{out_path}/cleaned")

    split = stratified_split(cleaned, ratios, seed, labels=labels)
    split.write.mode("overwrite").partitionBy("split").parquet(f"{out_path}/splits")
    splits = spark.read.parquet(f"{out_path}/splits")
    verify_no_leakage(splits, splits=[name for name, _ in ratios])

    write_split_jsonl(splits, f"{out_path}/splits_jsonl")
    template = spark.createDataFrame([(zero_shot_template(labels),)], "value string")
    template.coalesce(1).write.mode("overwrite").text(f"{out_path}/prompts/zero_shot_template")
    train = splits.where(F.col("split") == "train")
    write_example_bank(few_shot_bank(train, labels, seed=seed), f"{out_path}/prompts/example_bank")
    write_chat_jsonl(splits, f"{out_path}/chat_jsonl")
