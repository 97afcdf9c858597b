"""JSON lines sources and sinks: splits, chat records, example bank, test samples."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagloom.functions.prompts import chat_record
from tagloom.functions.text import is_blank
from tagloom.schema import CHAT_RECORD, EXAMPLE_BANK, SPLIT_COLUMNS, SPLIT_RECORD
from tagloom.sources.corpus import is_absent


def read_jsonl(spark: SparkSession, path: str, schema: str, what: str, hint: str) -> DataFrame:
    """JSON lines with a declared schema; blank lines are skipped, broken ones fail the job."""
    try:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    except AnalysisException as failure:
        if is_absent(failure):
            raise FileNotFoundError(f"{what} not found at {path}. {hint}") from failure
        raise


def _write_jsonl(df: DataFrame, path: str, *partition_by: str) -> None:
    writer = df.write.mode("overwrite").option("ignoreNullFields", "false")
    (writer.partitionBy(*partition_by) if partition_by else writer).json(path)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, line, value)`` of every line of text files, blank ones too; lines count from 1.

    Files are read in byte ranges by as many tasks as they fill.  Lines are counted per range first; a line's
    number is its place in its range plus the lines of the ranges before it in its file.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_at"),
        "value",
    )
    ranges = lines.groupBy("file", "_start").agg(F.min("_at").alias("_first"), F.count("*").alias("_lines"))
    before = Window.partitionBy("file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.withColumn("_before", F.coalesce(F.sum("_lines").over(before), F.lit(0))).drop("_lines")
    number = F.col("_before") + F.col("_at") - F.col("_first") + 1
    return lines.join(offsets, ["file", "_start"]).select("file", number.alias("line"), "value")


def read_jsonl_located(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """``(file, line, value, record, is_broken)`` of every line that is not blank; a broken one has no record."""
    parsed = F.from_json("value", f"{schema}, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"})
    rows = numbered_lines(spark, path).where(~is_blank(F.col("value"))).withColumn("_parsed", parsed)
    broken = F.col("_parsed").isNull() | F.col("_parsed._corrupt").isNotNull()
    return rows.select(
        "file", "line", "value",
        F.when(~broken, F.col("_parsed").dropFields("_corrupt")).alias("record"),
        broken.alias("is_broken"),
    )


def chat_offenders(spark: SparkSession, path: str) -> DataFrame:
    """``(file, line, reason)`` of the lines of chat files that are broken or lack ``messages``."""
    rows = read_jsonl_located(spark, path, CHAT_RECORD)
    reason = F.when(F.col("is_broken"), "broken").when(F.col("record.messages").isNull(), "no messages")
    return rows.select("file", "line", reason.alias("reason")).where("reason IS NOT NULL")


def require_chat_jsonl(spark: SparkSession, path: str) -> None:
    """Raise ``ValueError`` that names the first offending line, counted from 0, and its file."""
    first = chat_offenders(spark, path).orderBy("file", "line").first()
    if first is not None:
        raise ValueError(f"Row {first.line - 1} in {first.file}: {first.reason}.")


def write_split_jsonl(df: DataFrame, path: str) -> None:
    """Splits as JSON lines, one folder per split, with those record columns that exist.

    ``row_id`` is kept when present, because files carry no row order.
    """
    columns = [c for c in ("row_id", *SPLIT_COLUMNS) if c in df.columns]
    if "split" in df.columns:
        _write_jsonl(df.select(*columns, "split"), path, "split")
    else:
        _write_jsonl(df.select(*columns), path)


def read_split_jsonl(
    spark: SparkSession, path: str, schema: str = f"{SPLIT_RECORD}, split string"
) -> DataFrame:
    return read_jsonl(spark, path, schema, "Splits", "Run the prepare job first.")


def read_jsonl_capped(
    spark: SparkSession,
    path: str,
    schema: str,
    cap: int | None = None,
    order_by: str = "row_id",
) -> DataFrame:
    """Test samples, cut to the first ``cap`` rows in ``order_by`` order when a cap is set."""
    rows = read_jsonl(spark, path, schema, "Test data", "Run the prepare job first.")
    return rows if cap is None else rows.orderBy(order_by).limit(cap)


def write_chat_jsonl(df: DataFrame, path: str, splits: tuple[str, ...] = ("train", "val")) -> None:
    """Chat training records of the train and validation splits, one folder per split."""
    records = df.where(F.col("split").isin(*splits)).select(
        "split", chat_record(F.col("instruction"), F.col("intent")).alias("messages")
    )
    _write_jsonl(records, path, "split")


def read_chat_jsonl(spark: SparkSession, path: str) -> DataFrame:
    schema = f"{CHAT_RECORD}, split string"
    return read_jsonl(spark, path, schema, "Chat records", "Run the prepare job first.")


def write_example_bank(bank: DataFrame, path: str) -> None:
    """The bank as one JSON lines file in label order (bounded by the label space)."""
    ordered = bank.select("intent", "examples").orderBy("intent").coalesce(1)
    _write_jsonl(ordered, path)


def read_example_bank(spark: SparkSession, path: str) -> DataFrame:
    return read_jsonl(spark, path, EXAMPLE_BANK, "Example bank", "Run the prepare job first.")
