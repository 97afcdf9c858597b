from __future__ import annotations

import json
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tagloom.labels import DEFAULT_SPACE, LabelSpace
from tagloom.operators import runlog
from tagloom.operators.bank import few_shot_bank
from tagloom.operators.report import align_parallel_arrays
from tagloom.operators.split import stratified_split
from tagloom.session import stage, staging_path, staging_root
from tagloom.sources import corpus as corpus_source
from tagloom.sources import jsonl, results

LABELS = LabelSpace(["a", "b"])

def bank_of(bank):
    return {r.intent: list(r.examples) for r in bank.collect()}



def lines(path):
    return [
        json.loads(line)
        for part in sorted(Path(path).rglob("part-*.json"))
        for line in part.read_text().splitlines()
    ]


def test_missing_inputs_are_explained(spark, tmp_path):
    gone = str(tmp_path / "gone")
    with pytest.raises(FileNotFoundError, match="Raw corpus not found"):
        corpus_source.read_corpus(spark, gone)
    with pytest.raises(FileNotFoundError, match="Test data not found"):
        jsonl.read_jsonl_capped(spark, gone, "x string")
    with pytest.raises(FileNotFoundError, match="Example bank not found"):
        jsonl.read_example_bank(spark, gone)
    with pytest.raises(FileNotFoundError, match="summary not found"):
        results.read_summary(spark, gone)


def test_required_columns_are_checked(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "t"))
    with pytest.raises(ValueError, match="intent"):
        corpus_source.read_corpus(spark, str(tmp_path / "t"), "intent")


def test_materialize_once(spark, tmp_path):
    path = str(tmp_path / "once")
    assert corpus_source.materialize_once(spark.range(5), path).count() == 5
    assert corpus_source.materialize_once(spark.range(9), path).count() == 5
    assert corpus_source.materialize_once(spark.range(9), path, force=True).count() == 9
    (tmp_path / "failed" / "_temporary").mkdir(parents=True)
    assert corpus_source.materialize_once(spark.range(3), str(tmp_path / "failed")).count() == 3


def test_sample_head_keeps_null_fields(spark, tmp_path):
    df = spark.range(300).select(F.col("id").alias("row_id"), F.lit(None).cast("string").alias("c"))
    corpus_source.write_sample_head(df.repartition(4), str(tmp_path / "head"))
    rows = lines(tmp_path / "head")
    assert sorted(r["row_id"] for r in rows) == list(range(100))
    assert all("c" in r for r in rows)


def test_split_files_have_the_columns_there_are(spark, tmp_path, corpus):
    split = stratified_split(corpus).drop("category")
    jsonl.write_split_jsonl(split, str(tmp_path / "s"))
    rows = lines(tmp_path / "s")
    assert len(rows) == 270 and set(rows[0]) == {"row_id", "instruction", "intent"}
    back = jsonl.read_split_jsonl(spark, str(tmp_path / "s"))
    assert {r.split: r.n for r in back.groupBy("split").agg(F.count("*").alias("n")).collect()} == {
        "train": 189,
        "val": 41,
        "test": 40,
    }


def test_capped_read_skips_blank_lines_and_takes_the_first(spark, tmp_path):
    path = tmp_path / "t.jsonl"
    path.write_text("\n".join(json.dumps({"row_id": i, "t": f"x{i}"}) + "\n" for i in reversed(range(50))))
    rows = jsonl.read_jsonl_capped(spark, str(path), "row_id bigint, t string", cap=7).collect()
    assert sorted(r.row_id for r in rows) == list(range(7))
    assert jsonl.read_jsonl_capped(spark, str(path), "row_id bigint, t string").count() == 50


def test_broken_line_fails(spark, tmp_path):
    path = tmp_path / "t.jsonl"
    path.write_text('{"row_id": 1}\n{"row_id": \n')
    with pytest.raises(Exception, match="(?i)malformed|bad record"):
        jsonl.read_jsonl_capped(spark, str(path), "row_id bigint").collect()


def test_chat_files_hold_train_and_val(spark, tmp_path, corpus):
    jsonl.write_chat_jsonl(stratified_split(corpus), str(tmp_path / "c"))
    back = jsonl.read_chat_jsonl(spark, str(tmp_path / "c"))
    assert back.count() == 230
    assert {r.split for r in back.select("split").distinct().collect()} == {"train", "val"}


def test_bank_roundtrip_keeps_empty_lists(spark, tmp_path, corpus):
    bank = few_shot_bank(corpus.where("intent <> 'review'"))
    jsonl.write_example_bank(bank, str(tmp_path / "b"))
    assert [r["intent"] for r in lines(tmp_path / "b")] == list(DEFAULT_SPACE)
    back = bank_of(jsonl.read_example_bank(spark, str(tmp_path / "b")))
    assert back == bank_of(bank) and back["review"] == []


def predictions(spark):
    return spark.createDataFrame(
        [
            ("zero_shot", "a", "b", "one two", 5.0),
            ("zero_shot", "a", "a", "x", 7.0),
            ("few_shot", "b", "b", "y", 1.0),
        ],
        "approach string, truth string, prediction string, input_text string, latency_ms double",
    )


def test_results_tables_and_summary_document(spark, tmp_path):
    path = str(tmp_path / "r")
    results.write_results(predictions(spark), LABELS, path)
    summary = results.read_summary(spark, path)
    assert {r.approach: r.accuracy for r in summary.collect()} == {"zero_shot": 0.5, "few_shot": 1.0}
    assert results.read_results(spark, path, "confusion").count() == 8
    assert results.read_results(spark, path, "samples").count() == 3
    results.write_summary_json(summary, "base", f"{path}/json")
    back = results.read_summary_json(spark, f"{path}/json")
    assert sorted(map(tuple, back.select(*summary.columns).collect())) == sorted(
        map(tuple, summary.collect())
    )
    (document,) = lines(tmp_path / "r" / "json")
    assert document["base_model_id"] == "base" and document["intent_count"] == 2
    assert set(document["approaches"]) == {"zero_shot", "few_shot"}
    assert document["approaches"]["zero_shot"]["correct_samples"] == 1
    assert len(document["approaches"]["zero_shot"]) == 12
    assert document["generated_at"].startswith("20")


def test_indented_documents_are_read(spark, tmp_path):
    record = {
        "approach_name": "few_shot",
        "accuracy": 0.5,
        "confusion_matrix": [[1, 0], [1, 0]],
        "predictions": ["a", "a"],
        "ground_truth": ["a", "b"],
        "input_texts": ["x", "y"],
        "raw_outputs": ["A", "a."],
        "latencies_ms": [1.26, 2.0],
    }
    (tmp_path / "few_shot.json").write_text(json.dumps(record, indent=2))
    rows = align_parallel_arrays(results.read_result_records(spark, str(tmp_path / "few_shot.json")))
    assert [(r.prediction, r.truth, r.latency_ms, r.correct) for r in rows.orderBy("position").collect()] == [
        ("a", "a", 1.3, True),
        ("a", "b", 2.0, False),
    ]
    with pytest.raises(FileNotFoundError, match="Benchmark summary not found"):
        results.read_summary_json(spark, str(tmp_path / "gone.json"))


def test_run_log_keeps_runs_apart_and_replaces_repeats(spark, tmp_path):
    path = str(tmp_path / "m")
    results.write_results(predictions(spark), LABELS, f"{path}/r")
    summary = results.read_summary(spark, f"{path}/r")
    for run, step in (("one", 0), ("one", 1), ("two", 0), ("one", 0)):
        results.write_run_metrics(summary, f"{path}/log", run, step, {"framework": "spark-ml"})
    log = results.read_run_log(spark, f"{path}/log", "metrics")
    assert log.groupBy("run_id", "step").count().count() == 3 and log.count() == 60
    assert log.where("metric = 'accuracy' AND approach = 'zero_shot' AND run_id = 'two'").first().value == 0.5
    epochs = spark.createDataFrame([(1, 2.0, 1.5), (2, 1.0, 0.5)], "epoch long, train_loss double, val_loss double")
    for _ in range(2):
        results.write_epoch_metrics(epochs, f"{path}/log", "one")
    assert results.read_run_log(spark, f"{path}/log", "epochs").where("metric = 'val_loss'").count() == 2
    with pytest.raises(FileNotFoundError):
        results.read_run_log(spark, f"{path}/nowhere", "metrics")


def test_staged_table_keeps_its_schema(spark):
    staged = stage(spark.range(10).withColumn("x", F.lit(None).cast("string")), "t")
    assert staged.schema.fieldNames() == ["id", "x"] and staged.count() == 10
    assert staging_path(spark, "x") != staging_path(spark, "x")


class Settings(dict):
    set = dict.__setitem__


def session_like(conf, master):
    conf = Settings(conf)
    context = SimpleNamespace(master=master, applicationId="app-1")
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_staging_uses_the_shared_folder():
    conf = {"spark.checkpoint.dir": "hdfs://shared/stage/"}
    assert staging_root(session_like(conf, "yarn")) == "hdfs://shared/stage"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging_root(session_like({}, "yarn"))
    local = session_like({}, "local[2]")
    assert staging_root(local) == staging_root(local)


def test_lines_are_numbered_over_byte_ranges(spark, tmp_path):
    """Two files in many ranges, with blank and broken lines."""
    folder = tmp_path / "lines"
    folder.mkdir()
    expected = []
    for name in ("a", "b"):
        lines = []
        for n in range(1, 301):
            line = json.dumps({"messages": [{"role": "user", "content": "x" * (n % 50)}]})
            if n % 17 == 0:
                line = '{"messages": ['
            elif n % 13 == 0:
                line = "  " if n % 2 else ""
            elif n % 11 == 0:
                line = '{"other": 1}'
            lines.append(line)
            if n % 17 == 0 or (n % 11 == 0 and n % 13):
                expected.append((name, n, "broken" if n % 17 == 0 else "no messages"))
        (folder / f"{name}.jsonl").write_text("\n".join(lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        numbered = jsonl.numbered_lines(spark, str(folder))
        assert spark.read.text(str(folder)).rdd.getNumPartitions() > 4
        assert numbered.groupBy("file").agg({"line": "max"}).collect()[0][1] == 300 and numbered.select("file", "line").distinct().count() == 600
        found = jsonl.chat_offenders(spark, str(folder)).collect()
        assert sorted((r.file[-7], r.line, r.reason) for r in found) == expected
        with pytest.raises(ValueError, match=r"Row 10 in .*a.jsonl: no messages"):
            jsonl.require_chat_jsonl(spark, str(folder))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert jsonl.read_jsonl_located(spark, str(folder), "messages array<string>").where("is_broken AND record IS NOT NULL").count() == 0


def test_parameters_of_any_shape(spark):
    rows = [
        (1, '{"a": {"b": {"c": [1, "x", null, {"d": 2}], "e": {}}}, "f": null}'), (2, '{"a": 1.50, "g": -0.00002}'), (3, "[1, 2]"),
        (4, "no json"), (5, None), (6, '{"big": 12345678901, "t": true, "s": "é, \\"q\\"", "k.l": {"m": "n"}}'), (7, "{}"),
    ]
    df = spark.createDataFrame(rows, "key bigint, params string")
    found = {tuple(r) for r in runlog.flatten_json_params(df, "params", ["key"]).toDF("id", "name", "value").collect()}
    assert found == {
        (1, "a.b.c", '1,x,{"d":2}'), (1, "f", None), (2, "a", "1.5"), (2, "g", "-2e-05"), (6, "big", "12345678901"),
        (6, "t", "True"), (6, "s", 'é, "q"'), (6, "k.l.m", "n"),
    }
    assert runlog.flatten_json_params(df.where("key = 4"), "params", ["key"]).count() == 0


def test_sketches_merge_without_the_samples(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = [("a", float(n)) for n in range(3000)] + [("b", 1.0), ("b", None), ("b", float("nan"))]
    df = spark.createDataFrame(rows, "approach string, latency_ms double")
    for run in range(3):
        results.write_latency_sketches(df.where(F.pmod(F.hash("latency_ms"), F.lit(3)) == run), path, f"r{run}")
    found = {r.approach: (r.n, r.percentile) for r in results.merged_latencies(spark, path).collect()}
    assert found["b"] == (1, 1.0) and found["a"][0] == 3000
    assert abs(found["a"][1] - 0.95 * 3000) <= 30
