from __future__ import annotations

import difflib
import random
import time
from functools import partial

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tagloom.functions.matching import LabelMatcher, match_labels, match_many_labels
from tagloom.functions.prompts import few_shot_prompt
from tagloom.labels import DEFAULT_SPACE, LabelSpace
from tagloom.operators import predict
from tagloom.operators.bank import few_shot_bank, with_bank
from tagloom.operators.classifier import (
    load_classifier,
    predict_with,
    save_classifier,
    train_text_classifier,
)
from tagloom.operators.naive_bayes import predict_naive_bayes, train_naive_bayes
from tagloom.operators.split import stratified_split
from tagloom.plans import evaluate
from tagloom.session import stage


class Upper:
    def __call__(self, prompts):
        if any("boom" in p for p in prompts):
            raise RuntimeError("no answer")
        return [p.upper() for p in prompts]


def test_predict_batch_measures_and_skips_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id int, prompt string")
    rows = {r.id: r for r in predict.predict_batch(df, Upper, "upper").collect()}
    assert (rows[1].raw_output, rows[2].raw_output, rows[3].raw_output) == ("A", None, "C")
    assert rows[1].latency_ms >= 0


@pytest.mark.parametrize("batch_size", [1, 2, 100])
def test_batches_cover_all_rows(spark, batch_size):
    df = spark.range(50).select(F.col("id"), F.concat(F.lit("p"), "id").alias("prompt"))
    rows = predict.predict_batch(df, Upper, "upper", batch_size=batch_size).collect()
    assert {r.raw_output for r in rows} == {f"P{i}" for i in range(50)}


def test_failing_rows_are_recorded_or_raised(spark):
    df = spark.createDataFrame([(1, "a"), (2, "boom")], "id int, prompt string")
    rows = {r.id: r for r in predict.predict_batch(df, Upper, "upper", record_errors=True).collect()}
    assert rows[1].error is None and rows[2].error == "RuntimeError: no answer"
    with pytest.raises(Exception, match="no answer"):
        predict.predict_batch(df, Upper, "upper").collect()


def test_rows_of_a_failed_call_are_sent_again(spark):
    df = spark.range(20).select("id", F.when(F.col("id") == 7, "boom").otherwise(F.concat(F.lit("p"), "id")).alias("prompt"))
    rows = predict.predict_batch(df.coalesce(1), Upper, "upper", batch_size=20, record_errors=True).collect()
    assert [r.id for r in rows if r.error] == [7]
    assert {r.raw_output for r in rows if not r.error} == {f"P{n}" for n in range(20) if n != 7}


class Sleepy:
    def __init__(self, answer):
        self.answer = answer

    def __call__(self, prompts):
        time.sleep(0.05 if "slow" in prompts[0] else 0.0)
        return [self.answer] * len(prompts)


def test_two_factories_of_one_name_are_kept_apart(spark):
    df = spark.createDataFrame([("a",)], "prompt string")
    found = [predict.predict_batch(df, partial(Sleepy, x), "same").first().raw_output for x in ("one", "two")]
    assert found == ["one", "two"]


def test_latencies_are_those_of_the_calls(spark):
    samples = spark.range(40).select(
        F.col("id").alias("sample_id"), F.when(F.col("id") < 4, "slow").otherwise("quick").alias("instruction"), F.lit("review").alias("intent")
    )
    one = {"zero_shot": lambda df: predict.predict_batch(df, partial(Sleepy, "review"), "s", "instruction", batch_size=1)}
    row = evaluate.three_way_benchmark(samples, one, DEFAULT_SPACE, ["zero_shot"]).first()
    assert row.total_samples == 40 and row.accuracy == 1.0
    assert row.p95_latency_ms > 2 * row.mean_latency_ms


def test_nearest_example_in_blocks(spark, monkeypatch):
    bank = spark.createDataFrame(
        [("b", ["red cat", "big dog"]), ("a", ["red cat sat", "dog"]), ("c", [])], "intent string, examples array<string>"
    )
    rows = spark.createDataFrame([(1, "the red cat"), (2, "dog"), (3, "none here"), (4, None), (5, "red cat")], "id int, instruction string")
    expected = {1: ("b", 2 / 3), 2: ("a", 1.0), 3: ("a", 0.0), 4: ("a", 0.0), 5: ("b", 1.0)}
    for words in (2_000_000, 2):
        monkeypatch.setattr(predict, "BLOCK_WORDS", words)
        found = {r.id: (r.raw_output, r.similarity) for r in predict.few_shot_nearest(rows, bank).collect()}
        assert found == {k: (a, pytest.approx(b)) for k, (a, b) in expected.items()}
    empty = predict.few_shot_nearest(rows, bank.where("intent = 'c'")).first()
    assert (empty.raw_output, empty.similarity) == ("unknown", 0.0)


def test_naive_bayes(spark):
    train = spark.createDataFrame(
        [("a", "red red cat"), ("a", "cat"), ("b", "dog big"), ("b", None), ("x", "dog")], "intent string, instruction string"
    )
    labels = LabelSpace(["a", "b", "c"])
    model = train_naive_bayes(train, labels)
    rows = spark.createDataFrame([(1, "a red cat"), (2, "big dog"), (3, "words unseen"), (4, None)], "row_id int, instruction string")
    found = {r.row_id: r.raw_output for r in predict_naive_bayes(rows, model, "row_id").collect()}
    assert found == {1: "a", 2: "b", 3: "a", 4: "a"}


def test_large_bank_is_built_into_prompts(spark):
    bank = spark.createDataFrame([("a", ["x" * 17_000_000])], "intent string, examples array<string>")
    rows = with_bank(spark.createDataFrame([(1, "hello")], "row_id int, instruction string"), bank)
    prompt = few_shot_prompt(F.col("instruction"), F.col("row_id"), F.col("_bank"), LabelSpace(["a"]))
    assert rows.select(F.length(prompt).alias("n")).first().n > 17_000_000


def test_lexical_prediction_in_both_forms(spark):
    texts = [
        "I want to track my order",
        "track",
        "nothing shared",
        "Refund? get the REFUND, track it",
        "",
    ]
    expected = ["track_order", "track_order", "unknown", "get_refund", "unknown"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, instruction string")
    native = {r.id: r.raw_output for r in predict.zero_shot_lexical(df, DEFAULT_SPACE).collect()}
    assert [native[i] for i in range(5)] == expected
    assert predict.LexicalPredictor(DEFAULT_SPACE)(texts) == expected
    marked = predict.LexicalPredictor(DEFAULT_SPACE, marker="message: ")
    assert marked(["track_order, get_refund message: Switch my account"]) == ["switch_account"]


def test_nearest_example(spark):
    kind = "intent string, examples array<string>"
    bank = spark.createDataFrame([("a", ["red green blue", "x"]), ("b", ["red green"]), ("c", [])], kind)
    df = spark.createDataFrame(
        [(1, "green red"), (2, "blue"), (3, "nothing"), (4, None)], "id int, instruction string"
    )
    rows = {r.id: r for r in predict.few_shot_nearest(df, bank).collect()}
    assert (rows[1].raw_output, rows[1].similarity) == ("b", 1.0)
    assert (rows[2].raw_output, rows[2].similarity) == ("a", pytest.approx(1 / 3))
    assert (rows[3].raw_output, rows[3].similarity) == ("a", 0.0)
    assert (rows[4].raw_output, rows[4].similarity) == ("a", 0.0)
    none = spark.createDataFrame([("a", [])], kind)
    assert predict.few_shot_nearest(df, none).first().raw_output == "unknown"


@pytest.mark.parametrize("algorithm", ["naive_bayes", "logistic"])
def test_classifier_roundtrip(spark, tmp_path, corpus, algorithm):
    labels = LabelSpace(["review", "track_order", "get_refund"])
    rows = corpus.where(labels.holds(F.col("intent")))
    model = train_text_classifier(rows, labels, algorithm=algorithm, features=1 << 12)
    save_classifier(model, spark, str(tmp_path / "m"), algorithm, labels)
    loaded, metadata = load_classifier(spark, str(tmp_path / "m"))
    record = metadata.first()
    assert (record.framework, record.base_model_id) == ("spark-ml", algorithm)
    predicted = predict_with(loaded, rows)
    assert predicted.columns == [*rows.columns, "raw_output"]
    assert predicted.where("raw_output = intent").count() == 30


def test_missing_classifier_is_explained(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="No classifier"):
        load_classifier(spark, str(tmp_path / "none"))
    with pytest.raises(ValueError, match="algorithm"):
        train_text_classifier(spark.createDataFrame([], "instruction string, intent string"), algorithm="x")


def test_three_approaches_end_to_end(spark, corpus):
    splits = stage(stratified_split(corpus), "t")
    train = splits.where("split = 'train'")
    samples = splits.where("split = 'test'").select(
        F.col("row_id").alias("sample_id"), "instruction", "intent"
    )
    approaches = evaluate.default_approaches(
        DEFAULT_SPACE, few_shot_bank(train), lambda: train_text_classifier(train)
    )
    rows = {r.approach: r for r in evaluate.three_way_benchmark(samples, approaches, DEFAULT_SPACE).collect()}
    assert set(rows) == {"zero_shot", "few_shot", "fine_tuned"}
    assert all(r.total_samples == 40 and r.mean_latency_ms > 0 for r in rows.values())
    assert rows["zero_shot"].accuracy == rows["fine_tuned"].accuracy == 1.0
    assert rows["few_shot"].accuracy > 0.7


def test_only_enabled_approaches_run(spark, corpus):
    samples = corpus.select(F.col("row_id").alias("sample_id"), "instruction", "intent")

    def forbidden(_):
        raise AssertionError("must not run")

    approaches = {
        "zero_shot": lambda df: predict.zero_shot_lexical(df, DEFAULT_SPACE),
        "few_shot": forbidden,
    }
    rows = evaluate.compare_approaches(samples, approaches, DEFAULT_SPACE, ["zero_shot"])
    assert rows.count() == 270


def test_nearest_among_many_examples_by_prefix(spark, monkeypatch):
    """Blocks and chunks in one pass against all pairs; ties go to the first label."""
    draw = random.Random(8)
    common, rare = [f"c{n}" for n in range(8)], [f"r{n}" for n in range(400)]
    texts = [" ".join(draw.choices(common, k=3) + draw.choices(rare, k=draw.randrange(4))) for _ in range(600)]
    bank = [(f"l{n:03}", [" ".join(draw.sample(texts[draw.randrange(600)].split(), 3)), draw.choice(texts), ""]) for n in range(150)]
    rows = spark.createDataFrame([(n, t) for n, t in enumerate([*texts, "", None, "nothing known"])], "id long, instruction string")
    shown = spark.createDataFrame(bank, "intent string, examples array<string>")
    expected = {}
    for r in rows.collect():
        words = set((r.instruction or "").split())
        pairs = [(-len(words & set(e.split())) / max(1, len(words | set(e.split()))), label) for label, es in bank for e in es]
        expected[r.id] = min(pairs)
    for block, chunk in ((2_000_000, 8_000_000), (400, 700)):
        monkeypatch.setattr(predict, "BLOCK_WORDS", block)
        monkeypatch.setattr(predict, "CHUNK_WORDS", chunk)
        found = predict.few_shot_nearest(rows, shown)
        assert found.columns == ["id", "instruction", "raw_output", "similarity"]
        assert {r.id: (-r.similarity, r.raw_output) for r in found.collect()} == expected
    index = predict.NearestIndex(["a", "b", "c"], [["x", "rare"], ["x", "y"], ["x"] * 1])
    reads = []
    original = index._postings
    index._postings = lambda word: reads.append(int(index._lengths[word])) or original(word)
    assert index._one(np.array([0, 1])) == (1.0, 0)
    # The rare word decides; the common one is not traversed for new examples.
    assert reads[0] == 1


def plain_match(text, names):
    """One label at a time."""
    if text in names:
        return text, "exact"
    inside = [name for name in names if name in text]
    if inside:
        return inside[0], "substring"
    near = difflib.get_close_matches(text, names, n=1, cutoff=0.6)
    return (near[0], "fuzzy") if near else ("unknown", "unknown")


@given(
    st.lists(st.text("abcd_", max_size=8), min_size=1, max_size=30, unique=True),
    st.lists(st.text("abcdé_ ", max_size=14), min_size=1, max_size=10),
)
@settings(max_examples=150, deadline=None)
def test_matcher_is_plain_matching(names, texts):
    matcher = LabelMatcher(sorted(names))
    for text in texts:
        assert matcher.match(text) == plain_match(text, sorted(names))
        near = difflib.get_close_matches(text, sorted(names), n=1, cutoff=0.6)
        assert matcher.closest(text) == (near[0] if near else None)


def test_matcher_among_twenty_thousand_labels():
    draw = random.Random(7)
    names = sorted({"".join(draw.choices("abcdefghij", k=draw.randrange(6, 20))) for _ in range(20_000)})
    texts = ["".join(c if draw.random() > 0.25 else draw.choice("abcxyz") for c in draw.choice(names)) for _ in range(6)]
    texts += ["", "zzz", "a" * 300, names[3] * 40, draw.choice(names)]
    matcher = LabelMatcher(names)
    began = time.perf_counter()
    found = [matcher.closest(text) for text in texts]
    quick = time.perf_counter() - began
    began = time.perf_counter()
    expected = [(difflib.get_close_matches(text, names, n=1, cutoff=0.6) or [None])[0] for text in texts]
    assert found == expected and quick < (time.perf_counter() - began) / 5
    assert [matcher.match(t) for t in texts[-3:]] == [plain_match(t, names) for t in texts[-3:]]


def test_many_labels_match_like_few(spark):
    texts = [" Get Refund ", "please get_refund now", "get refud", "zzz", "", None, "track_ordr"]
    df = spark.createDataFrame([(t,) for t in texts], "raw_output string")
    space = LabelSpace(["get_refund", "track_order", "refund"])
    assert match_many_labels(df, space).collect() == match_labels(df, space).collect()
