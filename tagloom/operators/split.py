"""Stratified and hash splits that are deterministic in (data, seed)."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.fixed_values import DEFAULT_SEED, SPLIT_RATIOS
from tagloom.functions.text import hash_number, seeded_hash
from tagloom.labels import LabelSpace
from tagloom.operators.ordering import running_total
from tagloom.session import stage

Ratios = Sequence[tuple[str, float]]

# Ratios are applied as integers of this resolution, so no float error moves a row.
_RESOLUTION = 10_000
# Hex digits of the draw that make a bucket: a million buckets a label.
_BUCKET_DIGITS = 5


def cut_points(ratios: Ratios) -> list[tuple[str, int]]:
    """Cumulative integer cut points ``(split, upper bound)``; the last is the resolution."""
    total = sum(share for _, share in ratios)
    if abs(total - 1.0) >= 1e-9:
        raise ValueError(f"Ratios must sum to 1.0, got {total}.")
    bounds = accumulate(share for _, share in ratios)
    return [(name, round(b * _RESOLUTION)) for (name, _), b in zip(ratios, bounds, strict=True)]


def stratified_split(
    df: DataFrame,
    ratios: Ratios = SPLIT_RATIOS,
    seed: int = DEFAULT_SEED,
    label_col: str = "intent",
    key_col: str = "instruction",
    labels: LabelSpace | None = None,
) -> DataFrame:
    """Add ``split`` so that every label is cut at the given ratios.

    Rows of a label are ordered by a seeded hash of the key; the first ones go to the first
    split, and so on.  Every label gets its share to within a row, and the totals over all
    labels are the rounded shares of all rows.  The order itself is never built:

    1. store label and draw of every row, a narrow table that all counting reads;
    2. count rows per label and per (label, hash bucket);
    3. find the bucket each cut falls into and rank only the keys of those buckets;
    4. compare every row with its label's cut keys, a table with one row per label.

    So the texts are not shuffled, a label that holds most rows is no hot task, and there may
    be any number of labels.  Equal keys of a label always land in the same split.  Reads
    ``df`` twice.  Rows with a label outside ``labels`` (if given) get a null split.
    """
    cuts = cut_points(ratios)
    known = labels.holds(F.col(label_col)) if labels else F.col(label_col).isNotNull()
    keyed = df.withColumn("_draw", seeded_hash(seed, F.col(key_col)))
    draws = stage(keyed.where(known).select(F.col(label_col).alias("_label"), "_draw"), "draws")
    # Stored, so that the planner knows its size and need not shuffle the rows to join it.
    bounds = stage(_cut_keys(draws, _targets(draws, [point for _, point in cuts[:-1]])), "cuts")
    joined = keyed.join(bounds, F.col(label_col) == F.col("_label"), "left")
    return joined.select(*df.columns, F.when(known, _split_of_draw(cuts)).alias("split"))


def _targets(draws: DataFrame, points: list[int]) -> DataFrame:
    """``(label, cut point, rows before the cut)``.

    Shares are rounded on the running total over the labels, so that roundings of the
    labels cancel out instead of adding up.
    """
    counts = draws.groupBy("_label").agg(F.count("*").alias("_n"))
    totals = running_total(counts, [F.col("_label")], "_n", "_total")
    befores: list[Column] = []
    for point in points:
        share = _rounded(F.col("_total"), point) - _rounded(F.col("_total") - F.col("_n"), point)
        befores.append(F.greatest(share, *befores[-1:], F.lit(0)))
    entries = [
        F.struct(F.lit(point).alias("_point"), before.cast("bigint").alias("_target"))
        for point, before in zip(points, befores, strict=True)
    ]
    return totals.select("_label", F.explode(F.array(*entries)).alias("_cut")).select("_label", "_cut.*")


def _rounded(n: Column, point: int) -> Column:
    return F.call_function("div", n * point + F.lit(_RESOLUTION // 2), F.lit(_RESOLUTION))


def _split_of_draw(cuts: list[tuple[str, int]]) -> Column:
    case = F.lit(cuts[-1][0])
    for name, point in reversed(cuts[:-1]):
        before_cut = F.col("_draw") <= F.try_element_at("_cuts", F.lit(point))
        case = F.when(before_cut, name).otherwise(case)
    return case


def _cut_keys(draws: DataFrame, targets: DataFrame) -> DataFrame:
    """Per label a map from cut point to the draw of the last row before the cut.

    One row per label.  A cut that falls before the label's first row has no entry.
    """
    # Never null, so that no null filter computes the hash once more.
    bucket = F.coalesce(F.substring("_draw", 1, _BUCKET_DIGITS), F.lit(""))
    counts = draws.groupBy("_label", bucket.alias("_bucket")).agg(F.count("*").alias("_rows"))
    in_order = Window.partitionBy("_label").orderBy("_bucket")
    placed = counts.withColumn("_upto", F.sum("_rows").over(in_order))
    wanted = (
        placed.join(targets, "_label")
        .where(
            (F.col("_upto") >= F.col("_target"))
            & (F.col("_upto") - F.col("_rows") < F.col("_target"))
        )
        .select(
            "_label",
            "_bucket",
            "_point",
            (F.col("_target") - (F.col("_upto") - F.col("_rows"))).alias("_place"),
        )
    )
    # At most one row per (label, cut point); adaptive execution broadcasts them while few.
    at_cut = draws.withColumn("_bucket", bucket).join(wanted, ["_label", "_bucket"])
    per_key = at_cut.groupBy("_label", "_point", "_place", "_draw").agg(
        F.count("*").alias("_copies")
    )
    by_draw = Window.partitionBy("_label", "_point").orderBy("_draw")
    ranked = per_key.withColumn("_seen", F.sum("_copies").over(by_draw))
    last_key = (
        ranked.where(F.col("_seen") - F.col("_copies") < F.col("_place"))
        .groupBy("_label", "_point")
        .agg(F.max("_draw").alias("_cut"))
    )
    return last_key.groupBy("_label").agg(
        F.map_from_entries(F.collect_list(F.struct("_point", "_cut"))).alias("_cuts")
    )


def hash_split(
    df: DataFrame,
    ratios: Ratios = SPLIT_RATIOS,
    seed: int = DEFAULT_SEED,
    key_col: str = "instruction",
) -> DataFrame:
    """Add ``split`` from the hash of the key alone: map-only, ratios hold on average.

    The same key always lands in the same split, also when rows are added later.
    """
    cuts = cut_points(ratios)
    bucket = hash_number(seeded_hash(seed, F.col(key_col))) % F.lit(_RESOLUTION)
    case = F.lit(cuts[-1][0])
    for name, point in reversed(cuts[:-1]):
        case = F.when(bucket < point, name).otherwise(case)
    return df.withColumn("split", case)
