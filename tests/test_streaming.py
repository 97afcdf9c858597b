from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tagloom.functions.prompts import bank_literal
from tagloom.labels import LabelSpace
from tagloom.operators.predict import LexicalPredictor
from tagloom.operators.runlog import epoch_rollup
from tagloom.plans.queries import QUERIES
from tagloom.schema import REQUEST, RUN_LOG
from tagloom.streaming.classify import classify, start_classify_stream
from tagloom.streaming.rollup import late_rows, read_epochs, start_epoch_rollup
from tagloom.streaming.state_rollup import read_rolled, start_state_rollup

LABELS = LabelSpace(["get_refund", "track_order"])
BANK = {"get_refund": ["money back"], "track_order": ["where is it"]}


def predictor():
    inner = LexicalPredictor(tuple(LABELS), marker="Customer message: ")

    def call(prompts):
        if any("boom" in prompt for prompt in prompts):
            raise RuntimeError("no answer")
        return inner(prompts)

    return call


def requests(spark):
    return spark.createDataFrame(
        [
            (1, "track my order", None),
            (2, "a refund", "zero_shot"),
            (3, "the order", "few_shot"),
            (4, "", "zero_shot"),
            (5, "x" * 1001, None),
            (6, "boom", None),
            (7, "hello", None),
        ],
        REQUEST,
    )


def check(rows):
    by_id = {r.request_id: r for r in rows}
    assert len(by_id) == 7
    assert (by_id[1].outcome, by_id[1].intent, by_id[1].confidence) == ("response", "track_order", 1.0)
    assert by_id[1].approach_used == "fine_tuned"
    assert (by_id[2].intent, by_id[3].intent) == ("get_refund", "track_order")
    assert {by_id[i].outcome for i in (4, 5)} == {"rejected"}
    assert by_id[4].intent is None and "shorter" in by_id[4].detail
    assert by_id[6].outcome == "failed" and by_id[6].detail == "Inference failed: RuntimeError: no answer"
    assert (by_id[7].intent, by_id[7].confidence) == ("unknown", 0.0)


def test_classify_batch(spark):
    check(classify(requests(spark), predictor, "p", LABELS, bank_literal(BANK)).collect())


def test_classify_stream_over_several_batches(spark, tmp_path):
    source = str(tmp_path / "in")
    requests(spark).repartition(4).write.parquet(source)
    stream = spark.readStream.schema(REQUEST).option("maxFilesPerTrigger", 1).parquet(source)
    out = str(tmp_path / "out")
    query = start_classify_stream(
        stream, predictor, "p", LABELS, out, str(tmp_path / "progress"), bank_literal(BANK)
    )
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) > 1
    check(spark.read.parquet(out).collect())


def rolled(df):
    return sorted((r.run_id, r.epoch, r.n_steps, round(r.train_loss, 9), r.val_loss) for r in df.collect())


@pytest.mark.parametrize("lateness", [None, 0, 200])
@pytest.mark.parametrize("in_order", [True, False])
def test_rollup_stream_equals_batch(spark, tmp_path, lateness, in_order):
    rows = [
        (run, step, "val" if (step * 7 + run) % 5 == 0 else "train", float((step * run) % 11))
        for run in range(1, 4)
        for step in range(120)
    ]
    log = spark.createDataFrame(rows, RUN_LOG)
    source = tmp_path / "in"
    # Four files, each of which becomes one micro-batch: a range of steps, or every fourth step.
    for part in (0, 1, 2, 3) if in_order else (2, 0, 3, 1):
        piece = log.where(F.col("step").between(part * 30, part * 30 + 29) if in_order else F.col("step") % 4 == part)
        piece.coalesce(1).write.mode("append").parquet(str(source))
    stream = spark.readStream.schema(RUN_LOG).option("maxFilesPerTrigger", 1).parquet(str(source))
    out = str(tmp_path / "out")
    query = start_epoch_rollup(stream, out, str(tmp_path / "progress"), lateness)
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 4
    late = late_rows(spark, out).count()
    if in_order or lateness != 0:
        assert late == 0
        assert rolled(read_epochs(spark, out)) == rolled(epoch_rollup(log))
        assert set(rolled(read_epochs(spark, out, provisional=False))) <= set(rolled(epoch_rollup(log)))
    else:
        # What came late is kept apart, and the rest is what the batch gives without it.
        assert late > 0
        in_time = log.exceptAll(late_rows(spark, out))
        assert rolled(read_epochs(spark, out)) == rolled(epoch_rollup(in_time))


def test_rollup_stream_resumes_from_its_checkpoint(spark, tmp_path):
    source, out, progress = (str(tmp_path / name) for name in ("in", "out", "progress"))

    def feed(rows):
        spark.createDataFrame(rows, RUN_LOG).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(RUN_LOG).parquet(source)
        start_epoch_rollup(stream, out, progress).awaitTermination()

    feed([(1, 0, "train", 2.0), (1, 1, "train", 4.0), (2, 0, "val", 3.0)])
    feed([(1, 2, "train", 6.0), (1, 3, "val", 1.0), (1, 4, "train", 8.0)])
    feed([(1, 5, "val", 0.5), (1, 6, "val", 0.25)])
    rows = sorted(tuple(r) for r in read_epochs(spark, out).collect())
    assert rows == [(1, 1, 3, 4.0, 1.0), (1, 2, 1, 8.0, 0.5), (1, 3, 0, 0.0, 0.25), (2, 1, 0, 0.0, 3.0)]


def test_watermark_query_covers_logs_of_any_width(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    wide = events.withColumn("event_id", F.col("event_id") * 10_001 - 500_000)
    wide.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    found = QUERIES["epoch_rollup_watermark"](spark, str(tmp_path)).collect()
    expected = QUERIES["epoch_rollup"](spark, str(tmp_path)).collect()
    assert [r.n_steps for r in found if r.part == "late"] == [0]
    assert sorted(tuple(r)[1:] for r in found if r.part == "rolled") == sorted(tuple(r) for r in expected)


STATE_LOG = "run_id bigint, step bigint, kind string, value double"


def feed(spark, folder, rows):
    spark.createDataFrame(rows, STATE_LOG).coalesce(1).write.mode("append").parquet(folder)


def test_state_rollup_closes_epochs_in_the_stream_and_counts_late_rows(spark, tmp_path):
    """Four restarts on one checkpoint; the state stays as small as the lateness."""
    folder, out, progress = (str(tmp_path / n) for n in ("log", "out", "progress"))
    log = [(run, step, "val" if step % 7 == 6 else "train", float(step % 5)) for run in (1, 2) for step in range(400)]
    held = []
    for part in range(4):
        rows = [r for r in log if r[1] // 100 == part and r[1] != 42]
        # Out of order inside a part; one row comes two parts late, one within the lateness.
        rows = rows[::-1] + ([(1, 42, "train", 9.0), (3, 5, "val", 1.0), (1, 295, "other", 1.0), (None, 1, "val", 1.0)] if part == 2 else [])
        feed(spark, folder, rows)
        stream = spark.readStream.schema(STATE_LOG).parquet(folder)
        query = start_state_rollup(stream, out, progress, 20)
        query.awaitTermination()
        held.append(sum(o["numRowsTotal"] for p in query.recentProgress[-1:] for o in p["stateOperators"]))
    epochs, late = read_rolled(spark, out)
    assert [tuple(r) for r in late.collect()] == [(1, 42)]
    kept = spark.createDataFrame([r for r in log if r[1] != 42 and r[1] <= 379], STATE_LOG)
    expected = {tuple(r) for r in epoch_rollup(kept).collect()}
    assert {tuple(r) for r in epochs.select("run_id", "epoch", "n_steps", "train_loss", "val_loss").collect()} == expected
    assert len(expected) == 2 * 54
    # Two runs of twenty waiting rows, run 3 with its one, and a row for each run.
    assert max(held) <= 2 * 20 + 1 + 3 and held[-1] <= held[1] + 2


def test_folded_rollup_keeps_no_old_folders(spark, tmp_path):
    folder, out, progress = (str(tmp_path / n) for n in ("log", "out", "progress"))
    log = [(1, step, "val" if step % 7 == 6 else "train", float(step % 5)) for step in range(600)]
    for part in range(6):
        feed(spark, folder, log[100 * part : 100 * part + 100])
        stream = spark.readStream.schema(STATE_LOG).parquet(folder)
        start_epoch_rollup(stream, out, progress, 30).awaitTermination()
    assert {tuple(r) for r in read_epochs(spark, out).collect()} == {tuple(r) for r in epoch_rollup(spark.createDataFrame(log, STATE_LOG)).collect()}
    waiting = spark.read.parquet(f"{out}/waiting")
    assert waiting.count() <= 200 and {r[0] for r in waiting.select("batch_id").distinct().collect()} == {4, 5}
    assert {r[0] for r in spark.read.parquet(f"{out}/carry").select("batch_id").distinct().collect()} == {4, 5}
