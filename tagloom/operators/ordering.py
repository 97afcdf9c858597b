"""Positions and running sums along an order over all rows, without one task for all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.session import stage

_PARTS = 64
_ROWS_PER_PART = 33


def _ranged(df: DataFrame, order: list[Column], parts: int) -> DataFrame:
    """Stored rows with ``_place``: range partition and row inside it."""
    placed = (
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    # Stored, as a range partitioning need not come out alike twice.
    return stage(placed, "ranged").withColumn("_part", F.shiftright("_place", _ROWS_PER_PART))


def _with_offsets(placed: DataFrame, measure: Column) -> DataFrame:
    """Add ``_offset``: the sum of a measure over the earlier partitions."""
    # One row a partition, so as many rows as there are parts.
    sums = placed.groupBy("_part").agg(measure.alias("_sum"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    return placed.join(F.broadcast(offsets), "_part")


def numbered(df: DataFrame, order: list[Column], to: str, parts: int = _PARTS) -> DataFrame:
    """Number the rows from 0 along ``order``."""
    placed = _with_offsets(_ranged(df, order, parts), F.count(F.lit(1)))
    inside = F.col("_place").bitwiseAND(F.lit((1 << _ROWS_PER_PART) - 1))
    return placed.withColumn(to, F.col("_offset") + inside).drop("_part", "_place", "_offset")


def running_total(
    df: DataFrame, order: list[Column], value: str, to: str, parts: int = _PARTS
) -> DataFrame:
    """Add the sum of ``value`` up to and including each row along ``order``."""
    placed = _with_offsets(_ranged(df, order, parts), F.sum(value))
    inside = F.sum(value).over(Window.partitionBy("_part").orderBy("_place"))
    return placed.withColumn(to, F.col("_offset") + inside).drop("_part", "_place", "_offset")
