"""Reading the raw corpus and writing tables once."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tagloom.fixed_values import SAMPLE_HEAD_ROWS
from tagloom.schema import require_columns


# Conditions under which there is no complete table at a path.
_ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def is_absent(failure: AnalysisException) -> bool:
    return failure.getCondition() in _ABSENT


def read_table(spark: SparkSession, path: str, what: str, hint: str) -> DataFrame:
    """Parquet table at ``path``; a missing one raises ``FileNotFoundError`` with the hint."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as failure:
        if is_absent(failure):
            raise FileNotFoundError(f"{what} not found at {path}. {hint}") from failure
        raise


def read_corpus(spark: SparkSession, path: str, *required: str) -> DataFrame:
    """Raw corpus with its required columns checked."""
    hint = "Write it first, for example with 'python -m tagloom ingest'."
    return require_columns(read_table(spark, path, "Raw corpus", hint), *required)


def materialize_once(df: DataFrame, path: str, force: bool = False) -> DataFrame:
    """Write ``df`` unless a table exists at ``path`` or ``force`` is set; read it back.

    A folder left by a failed write holds no table and is written again.
    """
    spark = df.sparkSession
    if not force:
        try:
            return spark.read.parquet(path)
        except AnalysisException as failure:
            if not is_absent(failure):
                raise
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def write_sample_head(
    df: DataFrame, path: str, n: int = SAMPLE_HEAD_ROWS, order_by: str = "row_id"
) -> None:
    """First ``n`` rows as one JSON lines file for inspection."""
    head = df.orderBy(order_by).limit(n)
    head.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
