"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagloom.session import ship_package, stage

# Runs of anything but ASCII white space are words.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
SPACE_PATTERN = r"[\x20\x09-\x0D]+"

# A key with at least one row in this many is hot: so many keys can be hot at most.
HOT_SHARE = 1_000


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def utf8(text: Column) -> Column:
    """The text's bytes; none for null."""
    return F.coalesce(text, F.lit("")).cast("binary")


def all_columns(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns]


def fresh_name(df: DataFrame, name: str) -> str:
    """A name that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered_rows(df: DataFrame, stored: bool = False) -> tuple[DataFrame, str]:
    """The rows with a number each, and the name of its column.

    Null and repeated ids name no row; the number does, in every later use of what is returned.  ``stored`` says
    that the rows come straight from files; then their places in these give the number, whatever the splits of a
    reading.  Other rows are written once.
    """
    row = fresh_name(df, "_row")
    if stored and _has_places(df):
        file, place = fresh_name(df, "_file"), fresh_name(df, "_place")
        rows = df.select(*all_columns(df), F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(place))
        # One row a file.
        before = Window.orderBy(file).rowsBetween(Window.unboundedPreceding, -1)
        counts = rows.groupBy(file).agg(F.count(F.lit(1)).alias("n"))
        offsets = stage(counts.select(file, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(row)), "files")
        numbered = rows.join(offsets, file).withColumn(row, F.col(row) + F.col(place))
        return numbered.select(*all_columns(df), row), row
    return stage(df.withColumn(row, F.monotonically_increasing_id()), "rows"), row


def _has_places(df: DataFrame) -> bool:
    """Whether rows know the file they were read from."""
    if not df.inputFiles():
        return False
    try:
        df.select(F.col("_metadata.file_path"), F.col("_metadata.row_index")).schema
    except AnalysisException:
        return False
    return True


def stored_order(df: DataFrame) -> tuple[Column, Column] | None:
    """File and row inside it of a stored table's rows: a table that was written sorted can be read in that order.

    None where the rows do not come straight from files.
    """
    if not _has_places(df):
        return None
    name = F.col("_metadata.file_name")
    # Writers number their files; the numbers may have any length.
    number = F.lpad(F.regexp_extract(name, r"^part-(\d+)", 1), 12, "0")
    return F.concat(number, name), F.col("_metadata.row_index")


def running_sum(
    df: DataFrame, group: list[str], bucket: str, order: list[str], value: str, to: str
) -> DataFrame:
    """Sum of ``value`` over the earlier rows of a group, without sorting a group in one task.

    ``bucket`` must not fall along ``order``; the rows of one bucket are sorted in one task and
    the buckets' sums are added up.  Group and bucket columns must not hold nulls.
    """
    keys = [*group, bucket]
    earlier = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy(*keys).agg(F.sum(value).alias("_sum"))
    offsets = sums.select(*keys, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    inside = df.withColumn("_inside", F.coalesce(F.sum(value).over(earlier), F.lit(0)))
    return (
        inside.join(offsets, keys)
        .withColumn(to, F.col("_inside") + F.col("_offset"))
        .drop("_inside", "_offset")
    )


def join_groups(
    rows: DataFrame, groups: DataFrame, key: str, size: str, row_id: str, total: int | None = None
) -> DataFrame:
    """Join each row with its group's one row; a group may hold a third of all rows.

    ``groups`` has every key once, with its number of rows in ``size``.  Hot groups, at most
    ``HOT_SHARE`` of them by construction, are broadcast.  Rows found there, and rows without a
    key, get a key of their own for the second join, which therefore spreads them evenly.  ``total`` is the
    sum of the sizes, where it is known.
    """
    if total is None:
        total = groups.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    attributes = [c for c in groups.columns if c != key]
    is_hot = F.col(size) >= max(2, -(-total // HOT_SHARE))
    hot = groups.where(is_hot).select(
        F.col(key).alias("_hot_key"), *[F.col(c).alias(f"_hot_{c}") for c in attributes]
    )
    cold = groups.where(~is_hot).select(
        F.concat(F.lit("k"), key).alias("_key"), *[F.col(c).alias(f"_cold_{c}") for c in attributes]
    )
    met = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left").withColumn(
        "_own",
        F.when(F.col("_hot_key").isNull() & F.col(key).isNotNull(), F.concat(F.lit("k"), key)).otherwise(
            F.concat(F.lit("r"), F.coalesce(F.col(row_id).cast("string"), F.lit("")))
        ),
    )
    return met.join(cold, F.col("_own") == F.col("_key"), "left").select(
        *rows.columns,
        *[F.coalesce(f"_hot_{c}", f"_cold_{c}").alias(c) for c in attributes],
    )
