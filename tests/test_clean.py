from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tagloom.fixed_values import DEFAULT_LABELS, WHITESPACE
from tagloom.functions.text import is_blank, strip, word_count
from tagloom.labels import DEFAULT_SPACE, LabelSpace
from tagloom.operators import clean
from pyspark.sql import functions as F

RAW = "row_id bigint, instruction string, intent string, category string"


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_label_space_is_sorted_and_numbered():
    assert list(DEFAULT_SPACE) == sorted(DEFAULT_LABELS)
    assert len(DEFAULT_SPACE) == 27
    assert DEFAULT_SPACE.to_ids()["cancel_order"] == 0
    assert DEFAULT_SPACE.to_ids()["track_refund"] == 26


def test_label_space_has_any_size_but_none():
    assert len(LabelSpace(f"label_{i}" for i in range(20_000))) == 20_000
    with pytest.raises(ValueError):
        LabelSpace([])


def test_label_space_from_column(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "x string")
    assert LabelSpace.from_column(df, "x").labels == ("a", "b")


def test_missing_column_is_named(spark):
    with pytest.raises(ValueError, match="intent"):
        clean.drop_missing(spark.createDataFrame([("x",)], "instruction string"))


def test_nulls_and_blanks_are_dropped(spark):
    df = spark.createDataFrame(
        [
            (0, "cancel my order", "cancel_order", "c"),
            (1, None, "cancel_order", "c"),
            (2, "where is it", None, "c"),
            (3, " \t ", "track_order", "c"),
            (4, "where is it", "  ", "c"),
            (5, "", "track_order", "c"),
        ],
        RAW,
    )
    assert rows(clean.drop_missing(df), "row_id") == [(0,)]


def test_short_and_long_texts_are_dropped(spark):
    texts = ["abcd", "abcde", "x" * 500, "x" * 501, "éèêëē"]
    df = spark.createDataFrame([(i, t, "review", None) for i, t in enumerate(texts)], RAW)
    assert rows(clean.length_filter(df), "row_id") == [(1,), (2,), (4,)]


def test_first_duplicate_is_kept_whatever_the_partitioning(spark):
    data = [(i, f"text number {i % 3}", "review", str(i)) for i in range(30)]
    for parts in (1, 5):
        df = spark.createDataFrame(data[::-1], RAW).repartition(parts)
        assert rows(clean.dedup_keep_first(df), "row_id") == [(0,), (1,), (2,)]


def test_unknown_first_copy_takes_later_copies_with_it(spark):
    df = spark.createDataFrame(
        [(0, "same text", "no_such_label", "c"), (1, "same text", "review", "c"), (2, "other text", "review", "c")],
        RAW,
    )
    assert rows(clean.clean_dataset(df), "row_id") == [(2,)]


def test_label_is_not_stripped(spark):
    df = spark.createDataFrame(
        [(0, "first text", " cancel order", "c"), (1, "second text", "Cancel Order", "c")], RAW
    )
    assert rows(clean.clean_dataset(df), "row_id", "intent") == [(1, "cancel_order")]


def test_clean_adds_length_and_id(spark, corpus):
    cleaned = clean.clean_dataset(corpus)
    assert cleaned.count() == 270
    ids = DEFAULT_SPACE.to_ids()
    for row in cleaned.collect():
        assert row.text_length == len(row.instruction)
        assert row.intent_id == ids[row.intent]


def test_clean_does_not_depend_on_partitioning(spark, corpus):
    doubled = corpus.unionByName(corpus.withColumn("row_id", F.col("row_id") + 1000))
    one = rows(clean.clean_dataset(doubled.coalesce(1)), "row_id", "instruction")
    many = rows(clean.clean_dataset(doubled.repartition(7)), "row_id", "instruction")
    assert one == many and len(one) == 270


def test_unknown_labels_are_reported(spark):
    df = spark.createDataFrame(
        [(0, "text one", "unknown_label_xyz", "c"), (1, "text two", "review", "c")], RAW
    )
    known, unknown = clean.validate_labels(df)
    assert rows(known, "row_id") == [(1,)]
    assert rows(unknown, "intent") == [("unknown_label_xyz",)]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet=list(WHITESPACE) + ["a", "é", "​", "Z"], max_size=8), min_size=1, max_size=20))
def test_whitespace_rules_match_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = df.select(
        "t", strip(F.col("t")), is_blank(F.col("t")), word_count(F.col("t"))
    ).collect()
    for text, stripped, blank, words in found:
        assert stripped == text.strip()
        assert blank == (text.strip() == "")
        assert words == len(text.split())
