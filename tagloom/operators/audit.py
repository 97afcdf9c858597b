"""Audits of a labelled corpus and its splits: profile, leakage, coverage, anomalies."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.fixed_values import SPLIT_RATIOS
from tagloom.functions.text import strip
from tagloom.labels import DEFAULT_SPACE, LabelSpace
from tagloom.session import stage

SPLITS = tuple(name for name, _ in SPLIT_RATIOS)
# Gaps an error message names; the stored table has all.
_SHOWN_GAPS = 20


def label_distribution(
    df: DataFrame, columns: Sequence[str] = ("intent", "category")
) -> DataFrame:
    """Value counts ``(column_name, value, n)`` of the columns that exist, nulls left out.

    One scan: combinations of values are counted first and then taken apart.
    """
    present = [c for c in columns if c in df.columns]
    cells = df.groupBy(*present).agg(F.count("*").alias("_n"))
    return (
        cells.unpivot("_n", present, "column_name", "value")
        .where(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.sum("_n").alias("n"))
    )


def profile_dataset(
    df: DataFrame, columns: Sequence[str] = ("intent", "category")
) -> DataFrame:
    """One row: row count, number of columns, and distinct and filled counts per column.

    The combinations of values are counted first, so the distinct counts run on that
    small table and not on the rows.
    """
    present = [c for c in columns if c in df.columns]
    cells = df.groupBy(*present).agg(F.count("*").alias("_n"))
    return cells.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        *[F.count_distinct(F.col(c)).alias(f"{c}_unique") for c in present],
        *[
            F.coalesce(F.sum(F.when(F.col(c).isNotNull(), F.col("_n"))), F.lit(0))
            .cast("bigint")
            .alias(f"{c}_filled")
            for c in present
        ],
    )


def split_leakage(
    df: DataFrame, key_col: str = "instruction", splits: Sequence[str] = SPLITS
) -> DataFrame:
    """Distinct texts shared by each pair of splits: ``(split_a, split_b, n_shared)``.

    Each text becomes one bit per split, combined on the map side, so a heavily copied
    text costs one row per task.
    """
    bits = {name: 1 << position for position, name in enumerate(splits)}
    bit = F.lit(0)
    for name, value in bits.items():
        bit = F.when(F.col("split") == name, value).otherwise(bit)
    seen = df.groupBy(key_col).agg(F.bit_or(bit).alias("_seen"))
    pairs = list(combinations(splits, 2))
    counts = seen.agg(
        *[
            F.count_if(F.col("_seen").bitwiseAND(bits[a] | bits[b]) == (bits[a] | bits[b])).alias(
                f"{a}/{b}"
            )
            for a, b in pairs
        ]
    )
    return counts.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(a).alias("split_a"),
                        F.lit(b).alias("split_b"),
                        F.col(f"{a}/{b}").alias("n_shared"),
                    )
                    for a, b in pairs
                ]
            )
        ).alias("pair")
    ).select("pair.*")


def verify_no_leakage(
    df: DataFrame, key_col: str = "instruction", splits: Sequence[str] = SPLITS
) -> None:
    """Raise ``AssertionError`` naming every pair of splits that shares texts."""
    leaks = split_leakage(df, key_col, splits).where("n_shared > 0").collect()
    if leaks:
        parts = ", ".join(f"{r.split_a}/{r.split_b}: {r.n_shared} texts" for r in leaks)
        raise AssertionError(f"Splits share texts: {parts}.")


def split_stats(df: DataFrame, label_col: str = "intent") -> DataFrame:
    """Rows per split and label, with the split's total and the label's share of it."""
    counts = df.groupBy("split", F.col(label_col).alias("intent")).agg(F.count("*").alias("n"))
    split_rows = F.sum("n").over(Window.partitionBy("split"))
    return counts.withColumn("split_rows", split_rows).withColumn(
        "share", F.col("n") / F.col("split_rows")
    )


def split_completeness(
    df: DataFrame,
    labels: LabelSpace = DEFAULT_SPACE,
    splits: Sequence[str] = SPLITS,
    label_col: str = "intent",
) -> DataFrame:
    """Labels missing from a split: ``(split, intent)``; empty when every split is complete."""
    expected = labels.table(df.sparkSession, "intent").select(
        F.explode(F.array(*[F.lit(s) for s in splits])).alias("split"), "intent"
    )
    found = df.select("split", F.col(label_col).alias("intent")).distinct()
    return expected.join(found, ["split", "intent"], "left_anti")


def label_coverage(
    df: DataFrame, labels: LabelSpace = DEFAULT_SPACE, label_col: str = "intent"
) -> DataFrame:
    """Every data or known label with ``status`` and the number of splits it occurs in.

    Labels are compared after stripping; blank ones are ignored.
    """
    name = strip(F.col(label_col))
    # (label, split) pairs first: a frequent label then counts once per split.
    pairs = df.where(name != "").select(name.alias("intent"), "split").distinct()
    found = pairs.groupBy("intent").agg(F.count("*").alias("_splits"))
    known = labels.table(df.sparkSession, "intent")
    return found.join(known, "intent", "full_outer").select(
        "intent",
        F.when(F.col("label_id").isNull(), "in_data_not_known")
        .when(F.col("_splits").isNull(), "in_known_not_data")
        .otherwise("matched")
        .alias("status"),
        F.coalesce("_splits", F.lit(0)).cast("bigint").alias("n_splits"),
    )


def labels_per_split(df: DataFrame, label_col: str = "intent") -> DataFrame:
    """Distinct stripped non-blank labels per split."""
    name = strip(F.col(label_col))
    pairs = df.where(name != "").select("split", name.alias("intent")).distinct()
    return pairs.groupBy("split").agg(F.count("*").alias("n_labels"))


def verify_label_coverage(
    df: DataFrame, labels: LabelSpace = DEFAULT_SPACE, label_col: str = "intent"
) -> None:
    """Raise ``AssertionError`` unless data labels and known labels are the same set.

    The message has the full count, a few examples and the stored table of all gaps.
    """
    gaps = stage(label_coverage(df, labels, label_col).where("status <> 'matched'"), "label-gaps")
    count = gaps.count()
    if count:
        examples = gaps.orderBy("status", "intent").limit(_SHOWN_GAPS).collect()
        parts = ", ".join(f"{r.intent} ({r.status})" for r in examples)
        raise AssertionError(
            f"Labels and data disagree in {count} labels, such as {parts}; all in {gaps.inputFiles()[0].rpartition('/')[0]}."
        )


def label_anomalies(df: DataFrame, label_col: str = "intent") -> DataFrame:
    """Raw labels that change under strip and lower-case, with their row counts."""
    raw = F.col(label_col)
    counts = df.where(raw.isNotNull()).groupBy(raw.alias("intent")).agg(F.count("*").alias("n"))
    return counts.where(F.col("intent") != F.lower(strip(F.col("intent"))))
