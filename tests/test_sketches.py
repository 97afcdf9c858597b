"""Profiles from stored sketches, against exact counts."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tagloom.operators import sketches
from tagloom.sources.profile import read_profile, write_profile


def test_small_parts_are_exact_and_batches_merge(spark, tmp_path):
    rows = [("train", "a", "x"), ("train", "b", None), ("val", "b", "x"), ("val", None, None), ("test", "c", ""), (None, "c", "y")]
    df = spark.createDataFrame(rows, "split string, intent string, category string")
    path = str(tmp_path / "profile")
    write_profile(df.where("split <> 'test' OR split IS NULL"), path, "first", "split", ["intent", "category"])
    write_profile(df.where("split = 'test'"), path, "second", "split", ["intent", "category"])
    write_profile(df.where("split = 'test'"), path, "second", "split", ["intent", "category"])
    stored = read_profile(spark, path)
    assert {tuple(r) for r in sketches.distinct_counts(stored).collect()} == {("intent", 6, 5, 3), ("category", 6, 4, 3)}
    some = sketches.distinct_counts(stored, ["train", "val"])
    assert {tuple(r) for r in some.collect()} == {("intent", 4, 3, 2), ("category", 4, 2, 1)}
    shared = {tuple(r) for r in sketches.shared_counts(stored).collect()}
    assert shared == {
        ("train", "val", "intent", 2, 1), ("train", "val", "category", 1, 1), ("test", "train", "intent", 3, 0),
        ("test", "train", "category", 2, 0), ("test", "val", "intent", 2, 0), ("test", "val", "category", 2, 0),
    }
    top = sketches.exact_top_values(df, stored, ["intent", "category"], 2)
    assert {tuple(r) for r in top.collect()} == {
        ("intent", 1, "b", 2, True), ("intent", 2, "c", 2, True), ("category", 1, "x", 2, True), ("category", 2, "", 1, True),
    }


def test_no_rows_and_no_store(spark, tmp_path):
    df = spark.createDataFrame([], "split string, intent string")
    empty = sketches.profile_sketches(df, "split", ["intent"])
    assert empty.count() == 0
    assert sketches.distinct_counts(empty).count() == sketches.top_values(empty).count() == 0
    assert sketches.exact_top_values(df, empty, ["intent"]).count() == 0
    with pytest.raises(FileNotFoundError, match="Profile sketches"):
        read_profile(spark, str(tmp_path / "none"))


def test_large_parts_stay_within_the_bounds(spark):
    """A hundred thousand distinct values in small sketches; one part and one value hold most rows."""
    number = F.col("id")
    df = spark.range(200_000).select(
        F.when(number % 10 == 0, "a").otherwise("b").alias("part"),
        F.when(number % 2 == 0, F.pmod(F.xxhash64("id"), F.lit(40)) + 1_000_000).otherwise(number % 150_000).alias("value"),
        F.lit("clash").alias("n_rows"),
    )
    lg, tracked = 12, 2_000
    made = sketches.profile_sketches(df, "part", ["value"], lg, tracked).cache()
    values: dict[str, Counter] = {"a": Counter(), "b": Counter()}
    for r in df.collect():
        values[r.part][str(r.value)] += 1
    everything = values["a"] + values["b"]
    found = sketches.distinct_counts(made, lg_entries=lg).first()
    assert (found.n_rows, found.n_filled) == (200_000, 200_000)
    error = 4 / 2 ** (lg / 2)
    assert abs(found.n_distinct - len(everything)) <= error * len(everything)
    pair = sketches.shared_counts(made, lg).first()
    assert abs(pair.n_either - len(everything)) <= error * len(everything)
    assert abs(pair.n_shared - len(set(values["a"]) & set(values["b"]))) <= error * len(everything)

    listed = sketches.top_values(made, 40, None, lg, tracked).collect()
    bound = sketches.error_share(tracked) * 200_000
    assert all(0 <= r.estimate - everything[r.value] <= bound for r in listed)
    names = {r.value for r in listed}
    assert max(n for v, n in everything.items() if v not in names) <= listed[0].unseen
    best = sorted(everything.items(), key=lambda item: (-item[1], item[0]))[:20]
    top = sketches.exact_top_values(df, made, ["value"], 20, lg, tracked).orderBy("rank").collect()
    assert [(r.value, r.n) for r in top] == best and all(r.proven for r in top)


def test_a_rank_that_the_summary_cannot_prove_is_marked(spark):
    df = spark.range(100_000).select(F.lit("p").alias("part"), "id")
    made = sketches.profile_sketches(df, "part", ["id"], 12, 100)
    assert not any(r.proven for r in sketches.exact_top_values(df, made, ["id"], 5, 12, 100).collect())
