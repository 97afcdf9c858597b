from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from fractions import Fraction
from math import floor

import pytest
from pyspark.sql import functions as F

from tagloom.labels import DEFAULT_SPACE, LabelSpace, label_table
from tagloom.operators import audit
from tagloom.operators.bank import few_shot_bank
from tagloom.operators.split import cut_points, hash_split, stratified_split

SCHEMA = "row_id bigint, instruction string, intent string"

def bank_of(bank):
    return {r.intent: list(r.examples) for r in bank.collect()}



def brute_force(rows, seed=42):
    """Split of each row by sorting every label's rows."""
    by_label = defaultdict(list)
    for row_id, text, label in rows:
        by_label[label].append((hashlib.md5(f"{seed}:{text}".encode()).hexdigest(), row_id))
    split, total = {}, 0
    for _, members in sorted(by_label.items()):
        ends = [
            floor(Fraction(r * (total + len(members)), 100) + Fraction(1, 2))
            - floor(Fraction(r * total, 100) + Fraction(1, 2))
            for r in (70, 85)
        ]
        total += len(members)
        for place, (_, row_id) in enumerate(sorted(members)):
            split[row_id] = "train" if place < ends[0] else "val" if place < ends[1] else "test"
    return split


def test_ratios_must_sum_to_one():
    with pytest.raises(ValueError, match="sum to 1"):
        cut_points([("train", 0.7), ("test", 0.2)])


def test_split_matches_brute_force_with_a_hot_label(spark):
    # One label holds nearly all rows, others one to nine.
    rows = [(i, f"text {i}", "hot") for i in range(5000)]
    rows += [(10_000 + 10 * k + i, f"other {k} {i}", f"rare_{k}") for k in range(1, 10) for i in range(k)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    found = {r.row_id: r.split for r in stratified_split(df).collect()}
    assert found == brute_force(rows)


def test_result_does_not_depend_on_the_bucket_size(spark, monkeypatch):
    rows = [(i, f"text {i}", "hot") for i in range(3000)] + [(9000 + i, f"o {i}", "rare") for i in range(7)]
    df = spark.createDataFrame(rows, SCHEMA)
    for digits in (1, 2, 5):
        monkeypatch.setattr("tagloom.operators.split._BUCKET_DIGITS", digits)
        assert {r.row_id: r.split for r in stratified_split(df).collect()} == brute_force(rows)


def test_split_keeps_equal_texts_together(spark):
    # A third of the rows are copies of one text.
    rows = [(i, "copied text" if i % 3 == 0 else f"text {i}", "label") for i in range(900)]
    split = stratified_split(spark.createDataFrame(rows, SCHEMA))
    audit.verify_no_leakage(split)
    assert split.count() == 900


def test_split_is_a_deterministic_partition(spark, corpus):
    one = {r.row_id: r.split for r in stratified_split(corpus.coalesce(1)).collect()}
    two = {r.row_id: r.split for r in stratified_split(corpus.repartition(9)).collect()}
    assert one == two and len(one) == 270
    other_seed = {r.row_id: r.split for r in stratified_split(corpus, seed=7).collect()}
    assert other_seed != one
    assert Counter(one.values()) == {"train": 189, "val": 41, "test": 40}


def test_rows_outside_the_label_space_get_no_split(spark):
    df = spark.createDataFrame([(0, "a text", "a"), (1, "b text", "b")], SCHEMA)
    found = {r.row_id: r.split for r in stratified_split(df, labels=LabelSpace(["a"])).collect()}
    assert found == {0: "train", 1: None}


def test_every_label_is_in_every_split(spark, corpus):
    assert audit.split_completeness(stratified_split(corpus)).count() == 0


def test_missing_label_is_reported(spark, corpus):
    split = stratified_split(corpus.where("intent <> 'review'"))
    missing = {(r.split, r.intent) for r in audit.split_completeness(split).collect()}
    assert missing == {(s, "review") for s in ("train", "val", "test")}


def test_hash_split_is_stable_when_rows_are_added(spark):
    few = spark.range(1000).select("id", F.concat(F.lit("t"), "id").alias("instruction"))
    more = spark.range(4000).select("id", F.concat(F.lit("t"), "id").alias("instruction"))
    small = {r.id: r.split for r in hash_split(few).collect()}
    large = {r.id: r.split for r in hash_split(more).collect()}
    assert all(large[k] == v for k, v in small.items())
    assert abs(Counter(large.values())["train"] / 4000 - 0.70) < 0.05


def test_leakage_is_counted_per_pair_and_raised(spark):
    df = spark.createDataFrame(
        [("shared", "train"), ("shared", "val"), ("shared", "val"), ("own", "train"), ("x", "test")],
        "instruction string, split string",
    )
    counts = {(r.split_a, r.split_b): r.n_shared for r in audit.split_leakage(df).collect()}
    assert counts == {("train", "val"): 1, ("train", "test"): 0, ("val", "test"): 0}
    with pytest.raises(AssertionError, match="train/val: 1"):
        audit.verify_no_leakage(df)


def test_coverage_and_anomalies(spark):
    df = spark.createDataFrame(
        [("a", "train"), (" a ", "val"), ("B", "train"), ("", "test"), (None, "test")],
        "intent string, split string",
    )
    status = {
        r.intent: (r.status, r.n_splits)
        for r in audit.label_coverage(df, LabelSpace(["a", "c"])).collect()
    }
    assert status == {
        "a": ("matched", 2),
        "B": ("in_data_not_known", 1),
        "c": ("in_known_not_data", 0),
    }
    assert {r.intent for r in audit.label_anomalies(df).collect()} == {" a ", "B"}
    assert {r.split: r.n_labels for r in audit.labels_per_split(df).collect()} == {"train": 2, "val": 1}
    with pytest.raises(AssertionError, match="c \\(in_known_not_data\\)"):
        audit.verify_label_coverage(df, LabelSpace(["a", "c"]))


def test_profile_counts_ignore_nulls(spark):
    df = spark.createDataFrame(
        [("a", "x"), ("a", None), ("b", "y"), (None, "y")], "intent string, category string"
    )
    profile = audit.profile_dataset(df).first()
    assert (profile.n_rows, profile.n_columns) == (4, 2)
    assert (profile.intent_unique, profile.category_unique) == (2, 2)
    assert (profile.intent_filled, profile.category_filled) == (3, 3)
    counts = {(r.column_name, r.value): r.n for r in audit.label_distribution(df).collect()}
    assert counts == {("intent", "a"): 2, ("intent", "b"): 1, ("category", "x"): 1, ("category", "y"): 2}
    only = audit.profile_dataset(df.select("intent")).first()
    assert only.n_rows == 4 and "category_unique" not in only.asDict()


def test_bank_has_five_examples_per_label_and_none_without_rows(spark, corpus):
    bank = bank_of(few_shot_bank(corpus.where("intent <> 'review'")))
    assert sorted(bank) == list(DEFAULT_SPACE)
    assert bank["review"] == []
    assert all(len(set(v)) == 5 for k, v in bank.items() if k != "review")
    assert bank == bank_of(few_shot_bank(corpus.where("intent <> 'review'").repartition(5)))


def test_bank_takes_what_there_is(spark, corpus):
    small = corpus.where("row_id % 10 < 2")
    bank = bank_of(few_shot_bank(small))
    assert {len(v) for v in bank.values()} == {2}


def test_many_labels_need_no_bound(spark):
    rows = spark.range(60_000).selectExpr(
        "concat('l', lpad(cast(id % 20000 AS string), 5, '0')) AS intent", "concat('text ', id) AS instruction", "id AS row_id"
    )
    found = {r.split: r["count"] for r in stratified_split(rows).groupBy("split").count().collect()}
    # With three rows a label, some have none to spare for the last split.
    assert found["train"] == 42_000
    assert found["val"] + found["test"] == 18_000 and min(found.values()) >= 8_000
    ids = label_table(rows, "intent")
    assert ids.count() == 20_000
    assert ids.where("intent = 'l00777'").first().label_id == 777
    labels = LabelSpace.from_column(rows, "intent")
    bank = few_shot_bank(rows, labels, n=2)
    assert bank.where("size(examples) = 2").count() == 20_000


def test_bank_ranks_without_texts_and_keeps_copies(spark):
    rows = spark.createDataFrame([("a", "same")] * 4 + [("a", "other"), ("b", "x")], "intent string, instruction string")
    bank = bank_of(few_shot_bank(rows, LabelSpace(["a", "b", "c"]), n=5))
    assert sorted(bank["a"]) == ["other", "same", "same", "same", "same"]
    assert (bank["b"], bank["c"]) == (["x"], [])


def test_empty_input_gives_empty_split(spark):
    assert stratified_split(spark.createDataFrame([], SCHEMA)).collect() == []
