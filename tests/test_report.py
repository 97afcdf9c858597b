from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.functions.text import as_text
from tagloom.operators import report, runlog

SUMMARY = (
    "approach string, accuracy double, macro_precision double, macro_recall double, macro_f1 double, "
    "weighted_f1 double, mean_latency_ms double, p95_latency_ms double, token_cost_per_1k double"
)


@pytest.fixture(scope="module")
def summary(spark):
    return spark.createDataFrame(
        [
            ("zero_shot", 0.697, 0.7467, 0.7062, 0.6713, 0.6683, 2953.8, 3669.5, 0.02026),
            ("few_shot", 0.704, 0.7574, 0.7130, 0.6935, 0.6967, 3314.3, 3542.6, 0.02026),
            ("fine_tuned", 0.994, 0.9934, 0.9937, 0.9935, 0.9940, 924.5, 1231.3, 0.02026),
        ],
        SUMMARY,
    )


def test_best_flags_mark_all_ties(summary):
    best = {(r.approach, r.metric) for r in report.best_flags(summary).where("is_best").collect()}
    assert ("fine_tuned", "accuracy") in best and ("zero_shot", "accuracy") not in best
    assert ("fine_tuned", "mean_latency_ms") in best
    assert {a for a, m in best if m == "token_cost_per_1k"} == {"zero_shot", "few_shot", "fine_tuned"}


def test_delta_and_headline(spark, summary):
    delta = report.first_last_delta(summary)
    row = delta.first()
    assert (row.first_approach, row.last_approach, row.direction) == ("zero_shot", "fine_tuned", "improves")
    assert row.accuracy_delta_pp == pytest.approx(29.7)
    assert row.latency_ratio == pytest.approx(924.5 / 2953.8)
    assert "Fine Tuned improves accuracy by 29.7% over Zero Shot" in report.headline(delta).first().headline
    assert report.first_last_delta(summary.limit(1)).count() == 0


def test_benchmark_table_formats_and_fills(spark, summary):
    rows = {r.approach: r for r in report.benchmark_table(summary).collect()}
    assert rows["Zero Shot"].accuracy == "69.7%"
    assert rows["Fine Tuned"].mean_latency_ms == "924ms"
    assert rows["Few Shot"].token_cost_per_1k == "$0.0203"
    sparse = spark.createDataFrame([("a_b", None)], "approach string, accuracy double")
    row = report.benchmark_table(sparse).first()
    assert (row.approach, row.accuracy, row.p95_latency_ms) == ("A B", "0.0%", "0ms")


def test_text_lines_are_aligned(summary):
    lines = {r.approach: r.line for r in report.benchmark_text(summary).collect()}
    assert lines["zero_shot"].startswith("zero_shot            0.697")
    assert len({len(line) for line in lines.values()}) == 1


def test_tradeoff_points(summary):
    points = {r.approach: r.accuracy_pct for r in report.latency_tradeoff(summary).collect()}
    assert points["Few Shot"] == pytest.approx(70.4)


def test_sample_filters(spark):
    df = spark.createDataFrame(
        [("a", "a"), ("b", "a"), ("b", "b"), ("x", None)], "prediction string, truth string"
    )
    assert report.explore_samples_filter(df, "correct").count() == 2
    assert report.explore_samples_filter(df, "incorrect").count() == 2
    assert report.explore_samples_filter(df, truth="a").count() == 2
    row = report.explore_samples_summary(df, truth="a").first()
    assert (row.correct, row.total, row.ratio) == (1, 2, 0.5)
    assert report.explore_samples_summary(df, truth="none").first().ratio is None
    with pytest.raises(ValueError, match="outcome"):
        report.explore_samples_filter(df, "wrong")


def test_short_lists_are_padded(spark):
    records = spark.createDataFrame(
        [("a", ["t1"], [], ["p1", "p2"], ["p1"], [1.26])],
        "approach string, input_texts array<string>, raw_outputs array<string>, "
        "predictions array<string>, ground_truth array<string>, latencies_ms array<double>",
    )
    rows = [tuple(r) for r in report.align_parallel_arrays(records).orderBy("position").collect()]
    assert rows == [
        ("a", 0, "t1", "", "p1", "p1", 1.3, True),
        ("a", 1, "", "", "p2", "", None, False),
    ]


def test_longer_lists_do_not_add_rows(spark):
    records = spark.createDataFrame(
        [("a", ["t1", "t2"], ["r"], ["p"], ["p", "q", "r"], [1.0])],
        "approach string, input_texts array<string>, raw_outputs array<string>, "
        "predictions array<string>, ground_truth array<string>, latencies_ms array<double>",
    )
    assert report.align_parallel_arrays(records).count() == 1


def test_parallel_lists_are_bounded_and_ordered(spark):
    df = spark.range(2500).select(
        F.col("id").alias("sample_id"),
        F.lit("a").alias("approach"),
        *[F.concat(F.lit(c), "id").alias(c) for c in ("input_text", "raw_output", "prediction", "truth")],
        F.col("id").cast("double").alias("latency_ms"),
    )
    records = report.to_parallel_arrays(df.repartition(5), shard_rows=1000)
    sizes = {r.shard: len(r.predictions) for r in records.collect()}
    assert sizes == {0: 1000, 1: 1000, 2: 500}
    aligned = report.align_parallel_arrays(records).where("shard = 1 AND position = 3").first()
    assert aligned.prediction == "prediction1003" and aligned.latency_ms == 1003.0


def test_union_runs_enabled_approaches_only(spark):
    parts = {name: spark.range(2) for name in ("zero_shot", "few_shot", "fine_tuned")}
    found = report.union_approaches(parts, ("few_shot",)).collect()
    assert {r.approach for r in found} == {"few_shot"} and len(found) == 2
    with pytest.raises(ValueError):
        report.union_approaches(parts, ())


def test_params_are_flattened_like_python_text(spark):
    df = spark.sql(
        """SELECT 1 AS id, named_struct('name', 'base', 'rate', 2.0e-4D, 'on', true,
           'parts', array('q', 'k'), 'deep', named_struct('rank', 16)) AS model"""
    )
    found = {r.key: r.value for r in runlog.flatten_params(df, ["id"]).collect()}
    assert found == {
        "model.name": "base",
        "model.rate": "0.0002",
        "model.on": "True",
        "model.parts": "q,k",
        "model.deep.rank": "16",
    }


@settings(max_examples=10, deadline=None)
@given(st.lists(st.one_of(
    st.sampled_from([0.0, 1.0, 0.1, 1e-4, 9.99e-5, 1e16, 123456789.125, 1e15, -2.5e-7, 1e22, 0.05]),
    st.floats(min_value=-1e6, max_value=1e6, allow_nan=False).map(lambda x: round(x, 4)),
), min_size=1, max_size=20))
def test_float_text_matches_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for value, text in df.select("x", as_text(F.col("x"), T.DoubleType())).collect():
        assert text == str(abs(value) if value == 0 else value)


def plain_epochs(rows):
    """Epochs of one run by walking its events in order."""
    epochs, losses = [], []
    for _, kind, value in sorted(rows, key=lambda r: (r[0], r[1] != "val")):
        if kind == "train":
            losses.append(value)
        else:
            mean = sum(losses) / len(losses) if losses else 0.0
            epochs.append((len(epochs) + 1, len(losses), mean, value))
            losses = []
    return epochs


@settings(max_examples=8, deadline=None)
@given(st.lists(st.sampled_from(["train", "train", "val"]), min_size=1, max_size=60), st.integers(1, 20))
def test_epochs_match_a_plain_walk_for_any_piece_width(spark, kinds, width):
    rows = [(7, step, kind, float(step % 5)) for step, kind in enumerate(kinds)]
    df = spark.createDataFrame(rows, "run_id bigint, step bigint, kind string, value double")
    found = [
        (r.epoch, r.n_steps, r.train_loss, r.val_loss)
        for r in runlog.epoch_rollup(df.repartition(3), steps_per_piece=width).orderBy("epoch").collect()
    ]
    expected = plain_epochs([(s, k, v) for _, s, k, v in rows])
    assert [f[:2] for f in found] == [e[:2] for e in expected]
    assert [f[2] for f in found] == pytest.approx([e[2] for e in expected])
    assert [f[3] for f in found] == [e[3] for e in expected]


def test_report_at_the_same_step_closes_the_epoch_first(spark):
    df = spark.createDataFrame(
        [(1, 1, "train", 4.0), (1, 1, "val", 9.0), (1, 2, "val", 8.0)],
        "run_id bigint, step bigint, kind string, value double",
    )
    found = [tuple(r) for r in runlog.epoch_rollup(df).orderBy("epoch").collect()]
    assert found == [(1, 1, 0, 0.0, 9.0), (1, 2, 1, 4.0, 8.0)]


def test_training_plan(spark):
    splits = spark.createDataFrame([("train",)] * 11 + [("val",)] * 2, "split string")
    row = runlog.training_plan(splits, batch_size=4, epochs=3).first()
    assert (row.steps_per_epoch, row.total_steps, row.val_batches) == (2, 6, 1)
