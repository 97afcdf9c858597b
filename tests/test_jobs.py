"""The command line jobs from raw corpus to published results."""

from __future__ import annotations

from tagloom.__main__ import main
from tagloom.sources.jsonl import write_example_bank
from tagloom.sources.results import read_run_log, read_summary, read_summary_json


def test_jobs_end_to_end(spark, tmp_path, corpus, capsys):
    raw, stored, prepared, model, out = (
        str(tmp_path / name) for name in ("raw", "corpus", "prepared", "model", "results")
    )
    corpus.drop("row_id").write.parquet(raw)
    main(["ingest", raw, stored])
    main(["ingest", raw, stored])
    assert spark.read.parquet(stored).select("row_id").distinct().count() == 270
    assert spark.read.json(f"{stored}_sample").count() == 100

    main(["prepare", stored, prepared])
    assert spark.read.parquet(f"{prepared}/splits").count() == 270
    assert spark.read.json(f"{prepared}/prompts/example_bank").count() == 27

    main(["train", prepared, model])
    main(["evaluate", prepared, model, out, "--approaches", "zero_shot, fine_tuned", "--max-samples", "30"])
    summary = {r.approach: r for r in read_summary(spark, out).collect()}
    assert set(summary) == {"zero_shot", "fine_tuned"}
    assert all(r.total_samples == 30 for r in summary.values())
    assert read_summary_json(spark, f"{out}/summary_json").count() == 2
    assert read_run_log(spark, f"{out}/run_log", "metrics").count() == 20
    printed = capsys.readouterr().out
    assert "zero_shot" in printed and "fine_tuned" in printed


def test_evaluate_takes_all_samples_by_default(spark, tmp_path):
    prepared, out = str(tmp_path / "prepared"), str(tmp_path / "out")
    rows = spark.range(1500).selectExpr("id AS row_id", "concat('review ', id) AS instruction", "'review' AS intent", "'test' AS split")
    rows.write.parquet(f"{prepared}/splits")
    bank = spark.createDataFrame([("review", ["a review"])], "intent string, examples array<string>")
    write_example_bank(bank, f"{prepared}/prompts/example_bank")
    main(["evaluate", prepared, "none", out, "--approaches", "zero_shot"])
    assert read_summary(spark, out).first().total_samples == 1500
