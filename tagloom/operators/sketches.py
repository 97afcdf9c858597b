"""Profiles from mergeable sketches: distinct counts over any set of parts, and the most frequent values.

One pass makes a row per part (a split, a day, a source) and column: counts, a theta sketch of the column's
distinct values and a summary of its heavy hitters.  Such rows are stored (``sources.profile``), and later
questions read these alone.  Both sketches are built on the map side, so a part or a value may hold most rows, and their
size does not depend on the rows.

A theta sketch of ``2^lg_entries`` entries is exact up to that many distinct values; beyond, a union's standard error is
``1 / sqrt(2^lg_entries)`` of itself, and that of what two parts share the same share of their union at most.
A heavy-hitter summary of ``tracked`` values misses none that occurs more often than ``error_share(tracked)`` of all.

Values are taken as text; nulls are counted as rows and are no value.  A null part is a part like others, and shares
nothing with any.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LG_ENTRIES = 16
TRACKED = 10_000


def error_share(tracked: int = TRACKED) -> float:
    """Largest error of an estimated count, as a share of all values: 3.5 by the size of the summary's map.

    >>> error_share(10_000) == 3.5 / 16384
    True
    """
    # The map's size is a power of two that is filled to three quarters.
    return 3.5 / (1 << (-(-4 * tracked // 3) - 1).bit_length())


def profile_sketches(
    df: DataFrame,
    part_col: str,
    columns: Sequence[str],
    lg_entries: int = LG_ENTRIES,
    tracked: int = TRACKED,
) -> DataFrame:
    """``(part, column_name, n_rows, n_filled, distinct, frequent)`` per part and column, in one pass."""
    texts = df.select(
        F.col(part_col).cast("string").alias("part"),
        *[F.col(c).cast("string").alias(f"v{n}") for n, c in enumerate(columns)],
    )
    each = texts.groupBy("part").agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[
            F.struct(
                F.count(f"v{n}").alias("n_filled"),
                # These sketches skip empty texts, hence the mark in front.
                F.theta_sketch_agg(F.concat(F.lit("="), f"v{n}"), lg_entries).alias("distinct"),
                F.expr(f"approx_top_k_accumulate(v{n}, {tracked})").alias("frequent"),
            ).alias(f"s{n}")
            for n in range(len(columns))
        ],
    )
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), "n_rows", f"s{n}.*") for n, c in enumerate(columns)])
    return each.select("part", F.inline(rows))


def _of(sketches: DataFrame, parts: Sequence[str] | None) -> DataFrame:
    return sketches if parts is None else sketches.where(F.col("part").isin(list(parts)))


def distinct_counts(
    sketches: DataFrame, parts: Sequence[str] | None = None, lg_entries: int = LG_ENTRIES
) -> DataFrame:
    """``(column_name, n_rows, n_filled, n_distinct)`` over some parts, or all."""
    return _of(sketches, parts).groupBy("column_name").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_filled").alias("n_filled"),
        F.theta_sketch_estimate(F.theta_union_agg("distinct", lg_entries)).alias("n_distinct"),
    )


def shared_counts(sketches: DataFrame, lg_entries: int = LG_ENTRIES) -> DataFrame:
    """``(part_a, part_b, column_name, n_either, n_shared)``: distinct values of each pair of parts."""
    merged = sketches.groupBy("part", "column_name").agg(F.theta_union_agg("distinct", lg_entries).alias("distinct"))
    a = merged.select(F.col("part").alias("part_a"), "column_name", F.col("distinct").alias("_a"))
    b = merged.select(F.col("part").alias("part_b"), "column_name", F.col("distinct").alias("_b"))
    # One row per part and column on either side.
    return a.join(b, "column_name").where("part_a < part_b").select(
        "part_a",
        "part_b",
        "column_name",
        F.theta_sketch_estimate(F.theta_union("_a", "_b", lg_entries)).alias("n_either"),
        F.theta_sketch_estimate(F.theta_intersection("_a", "_b")).alias("n_shared"),
    )


def top_values(
    sketches: DataFrame,
    k: int = 20,
    parts: Sequence[str] | None = None,
    lg_entries: int = LG_ENTRIES,
    tracked: int = TRACKED,
) -> DataFrame:
    """``(column_name, value, estimate, unseen)``: up to ``k`` values with the highest estimated counts.

    An estimate lies at or above the count, by ``error_share`` of all values at most.  No value outside the list occurs
    more than ``unseen`` times.
    """
    merged = _of(sketches, parts).groupBy("column_name").agg(
        F.sum("n_filled").alias("_filled"),
        F.theta_sketch_estimate(F.theta_union_agg("distinct", lg_entries)).alias("_distinct"),
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(frequent, {tracked}), {k})").alias("_top"),
    )
    # A value below the error may be left out of the list at twice the error.
    error = 2 * F.ceil(F.col("_filled") * F.lit(error_share(tracked)))
    last = F.when(F.size("_top") == k, F.array_min("_top.count"))
    # So few distinct values are counted exactly: then the list has all.
    unseen = F.when(F.col("_distinct") <= F.size("_top"), F.lit(0)).otherwise(F.greatest(error, last))
    listed = merged.select("column_name", unseen.cast("long").alias("unseen"), F.inline("_top").alias("value", "estimate"))
    return listed.select("column_name", "value", "estimate", "unseen")


def exact_top_values(
    df: DataFrame,
    sketches: DataFrame,
    columns: Sequence[str],
    k: int = 20,
    lg_entries: int = LG_ENTRIES,
    tracked: int = TRACKED,
) -> DataFrame:
    """``(column_name, rank, value, n, proven)``: the best ``k`` values, ties to the smaller, counted in ``df``.

    The summary names twice as many candidates, and only these are counted.  ``proven`` says that no other
    value can occur as often.
    """
    # At most 2 * k rows a column, so they can be broadcast.
    candidates = F.broadcast(top_values(sketches, 2 * k, None, lg_entries, tracked).select("column_name", "value", "unseen"))
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
    counts = (
        df.select(F.inline(cells))
        .join(candidates, ["column_name", "value"])
        .groupBy("column_name", "value", "unseen")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = Window.partitionBy("column_name").orderBy(F.desc("n"), "value")
    ranked = counts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("column_name", "rank", "value", "n", (F.col("n") > F.col("unseen")).alias("proven"))
