"""Corpus cleaning: missing values, stripping, label keys, dedup, bounds, known labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.fixed_values import MAX_TEXT_LENGTH, MIN_TEXT_LENGTH
from tagloom.functions.text import is_blank, label_key, strip
from tagloom.labels import DEFAULT_SPACE, LabelSpace
from tagloom.schema import CORPUS_COLUMNS, require_columns


def drop_missing(df: DataFrame, columns: tuple[str, ...] = CORPUS_COLUMNS) -> DataFrame:
    """Drop rows where any of the columns is null or blank."""
    require_columns(df, *columns)
    kept = df.dropna(subset=list(columns))
    for column in columns:
        kept = kept.where(~is_blank(F.col(column)))
    return kept


def strip_text(df: DataFrame, column: str = "instruction") -> DataFrame:
    return df.withColumn(column, strip(F.col(column)))


def normalise_label(df: DataFrame, column: str = "intent") -> DataFrame:
    return df.withColumn(column, label_key(F.col(column)))


def dedup_keep_first(
    df: DataFrame, key: str = "instruction", order_by: str = "row_id"
) -> DataFrame:
    """One row per key: the one with the smallest ``order_by``.

    Keys are compared as 128-bit digests, two hashes with seeds of their own, so no sort or shuffle is by a whole
    text.  Catalyst keeps one row per digest in every map task before the shuffle (``WindowGroupLimit``), so a
    text copied a billion times sends one row per task.
    """
    # The text comes last, as each value is hashed with the hash so far as its seed.
    halves = {"_low": F.xxhash64(F.lit("low"), key), "_high": F.xxhash64(F.lit("high"), key)}
    rank = F.row_number().over(Window.partitionBy(*halves).orderBy(order_by))
    ranked = df.withColumns(halves).withColumn("_rank", rank)
    return ranked.where(F.col("_rank") == 1).drop("_rank", *halves)


def length_filter(
    df: DataFrame,
    column: str = "instruction",
    low: int = MIN_TEXT_LENGTH,
    high: int = MAX_TEXT_LENGTH,
) -> DataFrame:
    """Keep texts of ``low`` to ``high`` characters, both inclusive."""
    return df.where(F.length(column).between(low, high))


def filter_known_labels(
    df: DataFrame, labels: LabelSpace = DEFAULT_SPACE, column: str = "intent"
) -> DataFrame:
    return df.where(labels.holds(F.col(column)))


def unknown_labels(
    df: DataFrame, labels: LabelSpace = DEFAULT_SPACE, column: str = "intent"
) -> DataFrame:
    """Distinct labels outside the label space, in the column ``intent``."""
    outside = df.where(F.col(column).isNotNull() & ~labels.holds(F.col(column)))
    return outside.select(F.col(column).alias("intent")).distinct()


def validate_labels(
    df: DataFrame, labels: LabelSpace = DEFAULT_SPACE, column: str = "intent"
) -> tuple[DataFrame, DataFrame]:
    """Rows with a known label, and the distinct labels that are not known."""
    return filter_known_labels(df, labels, column), unknown_labels(df, labels, column)


def label_ids(
    df: DataFrame,
    labels: LabelSpace = DEFAULT_SPACE,
    column: str = "intent",
    id_column: str = "intent_id",
    how: str = "left",
) -> DataFrame:
    """Add the label's position in the label space (``inner`` also filters).

    The label table is a local one, which the planner broadcasts while it is small.
    """
    dim = labels.table(df.sparkSession, column).withColumnRenamed("label_id", id_column)
    return df.join(dim, column, how).select(*df.columns, id_column)


def derive_columns(df: DataFrame, labels: LabelSpace = DEFAULT_SPACE) -> DataFrame:
    """Add ``text_length`` and ``intent_id``."""
    return label_ids(df.withColumn("text_length", F.length("instruction")), labels)


def clean_dataset(
    df: DataFrame,
    labels: LabelSpace = DEFAULT_SPACE,
    low: int = MIN_TEXT_LENGTH,
    high: int = MAX_TEXT_LENGTH,
    order_by: str = "row_id",
) -> DataFrame:
    """The whole cleaning job as one lazy plan with a single shuffle.

    Dedup comes before the label filter on purpose: a first copy with an unknown label
    takes its later copies with it.  The length filter reads only the dedup key, so it
    commutes with dedup and is applied before the shuffle.
    """
    prepared = normalise_label(strip_text(drop_missing(df)))
    first = dedup_keep_first(length_filter(prepared, low=low, high=high), order_by=order_by)
    sized = first.withColumn("text_length", F.length("instruction"))
    return label_ids(sized, labels, how="inner")
