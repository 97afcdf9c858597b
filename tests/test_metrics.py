from __future__ import annotations

import difflib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tagloom.fixed_values import DEFAULT_LABELS
from tagloom.functions.matching import confidence, match_labels
from tagloom.functions.text import encoder_token_count
from tagloom.labels import DEFAULT_SPACE, LabelSpace
from tagloom.operators import metrics
from pyspark.sql import functions as F

SCHEMA = "approach string, truth string, prediction string, input_text string, latency_ms double"
ABC = LabelSpace(["a", "b", "c"])


def frame(spark, predictions, truth, latencies=None, approach="test"):
    latencies = latencies or [10.0] * len(truth)
    rows = [
        (approach, t, p, f"help with {t}", lat)
        for p, t, lat in zip(predictions, truth, latencies, strict=True)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def plain_scores(pairs, labels):
    scores = {}
    for label in labels:
        tp = sum(t == p == label for t, p in pairs)
        support = sum(t == label for t, _ in pairs)
        predicted = sum(p == label for _, p in pairs)
        scores[label] = (
            tp / predicted if predicted else 0.0,
            tp / support if support else 0.0,
            2 * tp / (support + predicted) if support + predicted else 0.0,
            support,
        )
    return scores


def test_perfect_predictions(spark):
    row = metrics.benchmark_summary(
        frame(spark, DEFAULT_LABELS, DEFAULT_LABELS), DEFAULT_SPACE
    ).first()
    for name in ("accuracy", "macro_f1", "weighted_f1", "macro_precision", "weighted_recall"):
        assert row[name] == pytest.approx(1.0)
    assert row.total_samples == row.correct_samples == 27
    assert row.intent_count == 27
    assert row.token_cost_per_1k > 0


def test_half_wrong_predictions(spark):
    predictions = list(DEFAULT_LABELS[:13]) + [DEFAULT_LABELS[0]] * 14
    row = metrics.benchmark_summary(frame(spark, predictions, DEFAULT_LABELS), DEFAULT_SPACE).first()
    assert row.correct_samples == 13
    assert row.accuracy == pytest.approx(13 / 27)
    assert row.macro_f1 < 1.0


def test_latency_statistics(spark):
    latencies = [float(i + 1) for i in range(27)]
    df = frame(spark, DEFAULT_LABELS, DEFAULT_LABELS, latencies)
    row = metrics.latency_stats(df).first()
    assert row.mean_latency_ms == pytest.approx(14.0)
    assert row.p95_latency_ms == pytest.approx(25.7)
    approximate = metrics.latency_stats(df, approximate=True).first()
    assert 25.0 <= approximate.p95_latency_ms <= 27.0


def test_confusion_matrix_is_dense_and_drops_unlisted_labels(spark):
    df = frame(spark, ["a", "unknown", "b", "a"], ["a", "a", "b", "zzz"])
    cells = {(r.truth, r.prediction): r.n for r in metrics.confusion_matrix(df, ABC).collect()}
    assert len(cells) == 9
    assert {k: v for k, v in cells.items() if v} == {("a", "a"): 1, ("b", "b"): 1}
    shares = {
        (r.truth, r.prediction): r.share
        for r in metrics.confusion_matrix_norm(metrics.confusion_matrix(df, ABC)).collect()
    }
    assert shares["a", "a"] == 1.0 and shares["c", "c"] == 0.0


def test_matrix_of_an_approach_without_listed_pairs_is_all_zero(spark):
    cells = metrics.confusion_matrix(frame(spark, ["x"], ["y"]), ABC).collect()
    assert len(cells) == 9 and not any(r.n for r in cells)
    scores = metrics.per_class_prf(frame(spark, ["x"], ["y"]), ABC).collect()
    assert len(scores) == 3 and not any(r.f1 for r in scores)


@settings(max_examples=12, deadline=None)
@given(
    st.lists(
        st.tuples(st.sampled_from("abcz"), st.sampled_from(["a", "b", "unknown", "z"])),
        min_size=1,
        max_size=40,
    )
)
def test_scores_match_plain_python(spark, pairs):
    df = frame(spark, [p for _, p in pairs], [t for t, _ in pairs])
    expected = plain_scores(pairs, ABC)
    found = {
        r.label: (r.precision, r.recall, r.f1, r.support)
        for r in metrics.per_class_prf(df, ABC).collect()
    }
    assert found.keys() == expected.keys()
    for label, values in expected.items():
        assert found[label] == pytest.approx(values)
    row = metrics.benchmark_summary(df, ABC).first()
    support = sum(s for *_, s in expected.values())
    for i, name in enumerate(("precision", "recall", "f1")):
        assert row[f"macro_{name}"] == pytest.approx(np.mean([v[i] for v in expected.values()]))
        weighted = sum(v[i] * v[3] for v in expected.values()) / support if support else 0.0
        assert row[f"weighted_{name}"] == pytest.approx(weighted)
    assert row.accuracy == pytest.approx(np.mean([t == p for t, p in pairs]))


def test_exact_percentile_matches_numpy(spark):
    rng = random.Random(3)
    groups = {
        "small": [rng.gauss(5, 20) for _ in range(77)],
        "single": [4.0],
        "large": [rng.expovariate(0.01) for _ in range(30_000)],
        "constant": [7.0] * 5_000,
        "tiny": [rng.random() * 1e-300 for _ in range(50)] + [0.0, -0.0, 5e-324],
        "huge": [rng.choice([-1, 1]) * 10.0 ** rng.uniform(200, 308) for _ in range(200)],
        # All values fall into one logarithmic bucket.
        "close": [1000.0 + rng.random() / 100 for _ in range(4_000)],
        # A third of the values are equal and sit near the wanted rank.
        "heavy": [rng.random() for _ in range(19_000)] + [2.0] * 10_000 + [3.0] * 1_000,
    }
    rows = [(name, float(v)) for name, values in groups.items() for v in values]
    df = spark.createDataFrame(rows, "approach string, x double").repartition(7)
    for fraction in (0.0, 0.5, 0.95, 1.0):
        found = {r.approach: r.percentile for r in metrics.exact_percentile(df, "x", fraction).collect()}
        for name, values in groups.items():
            expected = np.percentile(values, fraction * 100)
            assert found[name] == pytest.approx(expected, rel=1e-12), (name, fraction)


def test_exact_percentile_of_special_values_is_that_of_spark(spark):
    rng = random.Random(8)
    special = [float("nan"), float("inf"), float("-inf"), 0.0, -0.0]
    rows = [
        (f"g{g}", rng.choice(special) if rng.random() < g / 8 else rng.gauss(0, 1)) for g in range(8) for _ in range(40 + g)
    ]
    df = spark.createDataFrame(rows + [("none", None)], "approach string, x double")
    for fraction in (0.0, 0.05, 0.5, 0.95, 1.0):
        found = {r.approach: r.percentile for r in metrics.exact_percentile(df, "x", fraction).collect()}
        expected = {r.approach: r.p for r in df.where("x IS NOT NULL").groupBy("approach").agg(F.percentile("x", fraction).alias("p")).collect()}
        assert found == {k: pytest.approx(v, nan_ok=True) for k, v in expected.items()}, fraction


def test_approximate_latencies_are_near(spark):
    df = spark.range(20_000).selectExpr("'a' AS approach", "cast(id AS double) AS latency_ms")
    row = metrics.latency_stats(df, approximate=True).first()
    assert (row.mean_latency_ms, row.p95_latency_ms) == (pytest.approx(9999.5), pytest.approx(18_999, abs=5))


def test_sparse_cells_of_a_large_label_space(spark):
    df = spark.createDataFrame([("m", "l1", "l2"), ("m", "l1", "l2"), ("m", "l3", "zzz")], "approach string, truth string, prediction string")
    labels = LabelSpace(f"l{n}" for n in range(12_000))
    found = metrics.confusion_cells(metrics.cells(df), labels).collect()
    assert [tuple(r) for r in found] == [("m", "l1", "l2", 2)]


def test_token_cost(spark):
    df = frame(spark, ["a", "a"], ["a", "b"])
    row = metrics.token_cost(df).first()
    assert (row.words, row.texts) == (6, 2)
    assert row.token_cost_per_1k == pytest.approx(7 / 2 * 0.002)
    assert metrics.token_cost(df.where("false")).count() == 0


def test_token_cost_with_an_encoder(spark):
    def factory():
        import tiktoken

        ranks = {bytes([b]): b for b in range(256)} | {b"he": 256, b"lp": 257, b"help": 258}
        return tiktoken.Encoding("tiny", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})

    df = frame(spark, ["a", "a"], ["a", "b"])
    counted = df.withColumn("tokens", encoder_token_count(factory)(F.col("input_text")))
    row = metrics.counted_token_cost(counted, "tokens").first()
    # "help with a": one token for "help", one per remaining byte.
    assert (row.tokens, row.texts) == (16, 2)
    assert row.token_cost_per_1k == pytest.approx(8 * 0.002)


MATCHES = [
    ("cancel_order", "cancel_order", "exact"),
    ("CANCEL_ORDER", "cancel_order", "exact"),
    ("  track_order \n", "track_order", "exact"),
    ("Intent: cancel_order", "cancel_order", "substring"),
    ("The intent is place_order here", "place_order", "substring"),
    ("track_order not cancel_order", "cancel_order", "substring"),
    ("cansel_order", "cancel_order", "fuzzy"),
    ("xyzzy", "unknown", "unknown"),
    ("", "unknown", "unknown"),
    (None, "unknown", "unknown"),
    ("the customer wants to cancel their order", "unknown", "unknown"),
]


def test_matching_cascade(spark):
    df = spark.createDataFrame([(m[0],) for m in MATCHES], "raw_output string")
    found = [(r.raw_output, r.prediction, r.strategy) for r in match_labels(df, DEFAULT_SPACE).collect()]
    assert sorted(found, key=repr) == sorted(MATCHES, key=repr)


def test_fuzzy_ties_go_to_the_last_label(spark):
    df = spark.createDataFrame([("ab",)], "raw_output string")
    assert match_labels(df, LabelSpace(["abx", "abz", "aba"])).first().prediction == "abz"


def test_many_labels_use_the_array_form(spark):
    labels = LabelSpace(f"label_{i:04d}x" for i in range(300))
    df = spark.createDataFrame([("say label_0007x and label_0003x",)], "raw_output string")
    row = match_labels(df, labels).first()
    assert (row.prediction, row.strategy) == ("label_0003x", "substring")


@settings(max_examples=15, deadline=None)
@given(
    st.lists(
        st.one_of(
            st.sampled_from(DEFAULT_LABELS).flatmap(
                lambda label: st.tuples(st.integers(0, len(label) - 1), st.sampled_from("xyz ")).map(
                    lambda edit: label[: edit[0]] + edit[1] + label[edit[0] + 1 :]
                )
            ),
            st.text(alphabet="abcdeorint_ ", max_size=20),
        ),
        min_size=1,
        max_size=25,
    )
)
def test_matching_agrees_with_plain_python(spark, outputs):
    def plain(raw):
        text = raw.strip().lower()
        if text in DEFAULT_LABELS:
            return text
        inside = [label for label in DEFAULT_LABELS if label in text]
        near = difflib.get_close_matches(text, DEFAULT_LABELS, n=1, cutoff=0.6)
        return (inside or near or ["unknown"])[0]

    df = spark.createDataFrame([(o,) for o in outputs], "raw_output string")
    for row in match_labels(df, DEFAULT_SPACE).collect():
        assert row.prediction == plain(row.raw_output)


def test_confidence_and_strategy_counts(spark):
    df = spark.createDataFrame(
        [("t", "exact"), ("t", "fuzzy"), ("t", "fuzzy"), ("t", "odd")], "approach string, strategy string"
    )
    scores = [r[0] for r in df.select(confidence(F.col("strategy"))).collect()]
    assert scores == [1.0, 0.7, 0.7, 0.0]
    row = metrics.strategy_counts(df).first()
    assert (row.n_exact, row.n_substring, row.n_fuzzy, row.n_unknown) == (1, 0, 2, 0)
