"""Epoch roll-up of a loss stream, independent of how its rows are cut into files and batches.

Every micro-batch is folded into what the last one left: per run a watermark, the number of closed
epochs and the sums of the open one, and the rows behind the watermark's reach.  Rows are rolled up by the
batch operator, which cuts a run into pieces, once their step is at least ``lateness`` below the highest
seen of their run; until then they wait, so their order of arrival does not matter.  Rows that come later
than that are kept apart and counted.  Without a ``lateness`` all rows wait, and any order is right.

A batch writes its own rows once; those that wait are read again, not written again, and a batch's folder goes
when none of its rows waits any more.  So storage is in proportion to the log.
``state_rollup`` does the same in Spark's state store and emits epochs as they close.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tagloom.operators.runlog import add_epoch_sums, closed_epochs, epoch_sums

# Steps a row may come late by default.
LATENESS = 1_000_000
ROW = "run_id bigint, step bigint, kind string, value double"
CARRY = "run_id bigint, highest bigint, watermark bigint, closed bigint, n_steps bigint, total double"


def _read(spark: SparkSession, path: str, part: str, batch_id: int, schema: str) -> DataFrame:
    if batch_id < 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/{part}/batch_id={batch_id}")


def _write(df: DataFrame, path: str, part: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/{part}/batch_id={batch_id}")


def _waiting(spark: SparkSession, path: str, batch_id: int) -> DataFrame:
    """Rows that were not late, of all batches up to this one whose folders are left."""
    rows = spark.read.schema(f"{ROW}, batch_id bigint").parquet(f"{path}/waiting")
    return rows.where(F.col("batch_id") <= batch_id)


def _between(rows: DataFrame, before: DataFrame, now: DataFrame) -> DataFrame:
    """Rows above their run's watermark before and not above the present one."""
    low = F.coalesce("_low", F.lit(-(1 << 62)))
    marks = before.select("run_id", F.col("watermark").alias("_low")).join(
        now.select("run_id", F.col("watermark").alias("_high")), "run_id", "right"
    )
    return rows.join(marks, "run_id").where((F.col("step") > low) & (F.col("step") <= F.col("_high")))


def _still_waiting(spark: SparkSession, path: str, batch_id: int) -> DataFrame:
    """Rows above their run's watermark as of a batch."""
    marks = _read(spark, path, "carry", batch_id, CARRY).select("run_id", F.col("watermark").alias("_mark"))
    return _waiting(spark, path, batch_id).join(marks, "run_id").where(F.col("step") > F.coalesce("_mark", F.lit(-(1 << 62))))


def _forget(spark: SparkSession, path: str, batch_id: int) -> None:
    """Remove what not even a repetition of this batch reads: carried rows and folders in which nothing waited before it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())

    def remove(part: str, number: int) -> None:
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{part}/batch_id={number}"), True)

    remove("carry", batch_id - 2)
    if batch_id > 0:
        # One row a folder.
        kept = {r[0] for r in _still_waiting(spark, path, batch_id - 1).select("batch_id").distinct().collect()}
        stored = files.listStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/waiting"))
        numbers = [int(name.split("=")[1]) for s in stored if (name := s.getPath().getName()).startswith("batch_id=")]
        for number in numbers:
            if number < batch_id and number not in kept:
                remove("waiting", number)


def _rolled(rows: DataFrame, carry: DataFrame) -> DataFrame:
    """Epoch sums of rows that continue the runs in ``carry``, open epochs included."""
    found = epoch_sums(rows)
    starts = carry.select("run_id", "closed")
    shifted = found.join(starts, "run_id", "left").withColumn(
        "epoch", F.col("epoch") + F.coalesce("closed", F.lit(0))
    )
    # The epoch that each run had open, and the one it has open now.
    had = carry.select("run_id", (F.col("closed") + 1).alias("epoch"), "n_steps", "total")
    reports = found.groupBy("run_id").agg(F.sum("n_reports").alias("_reports"))
    has = reports.join(starts, "run_id", "left").select(
        "run_id", (F.col("_reports") + F.coalesce("closed", F.lit(0)) + 1).alias("epoch")
    )
    parts = shifted.drop("closed").unionByName(had, allowMissingColumns=True).unionByName(has, allowMissingColumns=True)
    return add_epoch_sums(parts).select(
        "run_id",
        "epoch",
        F.coalesce("n_steps", F.lit(0)).alias("n_steps"),
        "total",
        "val_loss",
        F.coalesce("n_reports", F.lit(0)).alias("n_reports"),
    )


def start_epoch_rollup(
    log: DataFrame, path: str, checkpoint_path: str, lateness: int | None = LATENESS, **trigger
) -> StreamingQuery:
    """Roll up a streaming ``(run_id, step, kind, value)`` log into ``path``.

    Read it with :func:`read_epochs` and :func:`late_rows`.  A repeated micro-batch overwrites its own
    folders, so results are exactly-once.
    """

    def fold(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fresh = batch.where(F.col("kind").isin("train", "val")).selectExpr(
            "cast(run_id AS bigint) AS run_id", "cast(step AS bigint) AS step", "kind", "cast(value AS double) AS value"
        )
        carry = _read(spark, path, "carry", batch_id - 1, CARRY)
        marks = carry.select("run_id", F.col("watermark").alias("_mark"))
        is_late = F.col("step") <= F.coalesce("_mark", F.lit(-(1 << 62)))
        marked = fresh.join(marks, "run_id", "left").withColumn("_late", is_late).drop("_mark")
        _write(marked.where("_late").drop("_late"), path, "late", batch_id)
        _write(marked.where("NOT _late").drop("_late"), path, "waiting", batch_id)
        tops = _read(spark, path, "waiting", batch_id, ROW).groupBy("run_id").agg(F.max("step").alias("_top"))
        highest = F.greatest("_top", "highest")
        reach = F.lit(None).cast("bigint") if lateness is None else highest - F.lit(lateness)
        now = tops.join(carry.select("run_id", "highest", "watermark"), "run_id", "full").select(
            "run_id", highest.alias("highest"), F.greatest("watermark", reach).alias("watermark")
        )
        ripe = spark.createDataFrame([], ROW)
        if lateness is not None:
            ripe = _between(_waiting(spark, path, batch_id), carry, now).select("run_id", "step", "kind", "value")
        _write(_rolled(ripe, carry), path, "sums", batch_id)
        sums = spark.read.parquet(f"{path}/sums/batch_id={batch_id}")
        still_open = sums.where("n_reports = 0").select(
            "run_id", (F.col("epoch") - 1).alias("closed"), "n_steps", "total"
        )
        _write(
            now.join(still_open, "run_id", "left").select(
                "run_id", "highest", "watermark", F.coalesce("closed", F.lit(0)).alias("closed"), F.coalesce("n_steps", F.lit(0)).alias("n_steps"), "total"
            ),
            path,
            "carry",
            batch_id,
        )
        _forget(spark, path, batch_id)

    return (
        log.writeStream.foreachBatch(fold)
        .option("checkpointLocation", checkpoint_path)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _last_batch(spark: SparkSession, path: str) -> int:
    # The carried rows, one a run and batch, know the batches.
    last = spark.read.parquet(f"{path}/carry").agg(F.max("batch_id")).first()[0]
    return -1 if last is None else int(last)


def read_epochs(spark: SparkSession, path: str, provisional: bool = True) -> DataFrame:
    """Closed epochs; ``provisional`` also rolls up the rows that still wait."""
    closed = closed_epochs(spark.read.parquet(f"{path}/sums"))
    if not provisional:
        return closed
    last = _last_batch(spark, path)
    carry = _read(spark, path, "carry", last, CARRY)
    rows = _still_waiting(spark, path, last).select("run_id", "step", "kind", "value")
    return closed.unionByName(closed_epochs(_rolled(rows, carry)))


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows that came too late to be counted."""
    return spark.read.schema(ROW).parquet(f"{path}/late").drop("batch_id")
