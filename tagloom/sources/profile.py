"""Stored profile sketches, a folder a batch of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tagloom.operators.sketches import profile_sketches
from tagloom.sources.corpus import read_table


def write_profile(df: DataFrame, path: str, batch: str, part_col: str, columns: Sequence[str], **sizes: int) -> None:
    """Sketches of a batch of rows next to those of others; writing a batch again replaces it."""
    profile_sketches(df, part_col, columns, **sizes).write.mode("overwrite").parquet(f"{path}/batch={batch}")


def read_profile(spark: SparkSession, path: str) -> DataFrame:
    """Sketches of all batches, as ``operators.sketches`` takes them."""
    return read_table(spark, path, "Profile sketches", "Write a batch first.")
