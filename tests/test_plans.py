"""Properties of physical plans that the design rests on."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import functions as F

from tagloom.functions.matching import match_labels
from tagloom.functions.prompts import bank_literal, few_shot_prompt
from tagloom.labels import DEFAULT_SPACE, LabelSpace
from tagloom.operators import audit, clean, metrics, split
from tagloom.operators.bank import few_shot_bank
from tagloom.plans.prepare import prepare


def plan(df) -> str:
    with contextlib.redirect_stdout(io.StringIO()) as printed:
        df.explain()
    return printed.getvalue()


def stored(spark, tmp_path, df, name="t"):
    df.write.parquet(str(tmp_path / name))
    return spark.read.parquet(str(tmp_path / name))


def test_dedup_limits_groups_before_its_only_shuffle(spark, tmp_path, corpus):
    text = plan(clean.clean_dataset(stored(spark, tmp_path, corpus)))
    partial = text.index("row_number(), 1, Partial")
    assert text.count("Exchange hashpartitioning") == 1
    # Plans print from the result down, so the partial limit comes after the shuffle.
    assert text.index("Exchange hashpartitioning") < partial
    assert "BroadcastHashJoin" in text
    # Neither sort nor shuffle is by the text.
    for keys in re.findall(r"(?:Sort|Exchange hashpartitioning|WindowGroupLimit)\s*[\[(]([^\])]*)[\])]", text):
        assert "instruction" not in keys and ("_low" in keys or "_high" in keys)
    assert text.index("length(") > 0 and "Filter" in text[partial:]


def test_scan_reads_only_needed_columns(spark, tmp_path, corpus):
    text = plan(audit.label_distribution(stored(spark, tmp_path, corpus).select("row_id", "intent", "instruction")))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert schema == "intent:string"


def test_known_labels_are_pushed_into_the_scan(spark, tmp_path, corpus):
    few = LabelSpace(["review", "complaint"])
    text = plan(clean.filter_known_labels(stored(spark, tmp_path, corpus), few))
    assert "PushedFilters: [In(intent, [complaint,review])]" in text


def test_split_does_not_shuffle_rows(spark, tmp_path, corpus):
    text = plan(split.stratified_split(stored(spark, tmp_path, corpus)))
    # The side that carries the rows: from the top join straight to the scan.
    rows_side = text[text.index("BroadcastHashJoin") : text.index("BroadcastExchange")]
    assert "Exchange" not in rows_side and "category" in rows_side
    # What is shuffled is aggregated before.
    for line in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text):
        assert "instruction" not in line


def test_hash_split_and_prompts_are_map_only(spark, tmp_path, corpus):
    df = split.hash_split(stored(spark, tmp_path, corpus))
    bank = bank_literal({"review": ["one", "two"], "complaint": ["three"]})
    prompted = df.select(few_shot_prompt(F.col("instruction"), F.col("row_id"), bank, DEFAULT_SPACE))
    assert "Exchange" not in plan(prompted) and "Join" not in plan(prompted)


def test_bank_is_limited_before_the_shuffle(spark, tmp_path, corpus):
    text = plan(few_shot_bank(stored(spark, tmp_path, corpus)))
    assert "row_number(), 5, Partial" in text


def test_leakage_is_combined_before_the_shuffle(spark, tmp_path, corpus):
    df = stored(spark, tmp_path, corpus.withColumn("split", F.lit("train")))
    text = plan(audit.split_leakage(df))
    assert "partial_bit_or" in text


def test_matching_needs_no_shuffle_and_sends_residue_only(spark, tmp_path):
    df = stored(spark, tmp_path, spark.createDataFrame([("x",)], "raw_output string"))
    text = plan(match_labels(df, DEFAULT_SPACE))
    assert "Exchange" not in text and "Join" not in text
    assert re.search(r"ArrowEvalPython \[closest\(CASE WHEN", text)


def test_matrix_and_scores_shuffle_cells_once(spark, tmp_path):
    schema = "approach string, truth string, prediction string, latency_ms double"
    df = stored(spark, tmp_path, spark.createDataFrame([("a", "x", "y", 1.0)], schema))
    labels = LabelSpace(["x", "y"])
    for operator in (metrics.per_class_prf, metrics.confusion_matrix, metrics.macro_weighted):
        text = plan(operator(df, labels))
        assert text.count("FileScan") == 1
        assert "partial_count(1)" in text and "latency_ms" not in text.split("FileScan")[1]


def test_percentile_does_not_need_predictions(spark, tmp_path):
    df = stored(
        spark,
        tmp_path,
        spark.createDataFrame(
            [("a", "x", "x", 1.0)], "approach string, truth string, raw_output string, latency_ms double"
        ),
    )
    matched = match_labels(df, LabelSpace(["x"]))
    text = plan(metrics.exact_percentile(matched, "latency_ms"))
    assert "ArrowEvalPython" not in text
    assert re.search(r"ReadSchema: struct<approach:string,latency_ms:double>", text)


def test_prepare_job_writes_everything(spark, tmp_path, corpus):
    raw = str(tmp_path / "raw")
    corpus.write.parquet(raw)
    out = str(tmp_path / "out")
    prepare(spark, raw, out)
    splits = spark.read.parquet(f"{out}/splits")
    assert splits.count() == spark.read.parquet(f"{out}/cleaned").count() == 270
    assert spark.read.text(f"{out}/prompts/zero_shot_template", wholetext=True).count() == 1
    assert spark.read.json(f"{out}/chat_jsonl").count() == 230
