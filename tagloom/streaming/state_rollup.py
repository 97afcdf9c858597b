"""Epoch roll-up of a loss stream in Spark's state store, with epochs emitted as they close.

Each run is a key with its own watermark: the highest step seen before a micro-batch, less ``lateness``.
Rows above it wait in a map state by step; once the watermark passes them they are taken in step order,
added to the open epoch, and removed.  A validation report closes the epoch, which goes to the sink at once.  Rows at
or below the watermark are too late; they go to the sink as such and count for nothing.  So the state
holds what lies within ``lateness`` steps of each run's end, however long the log is, and nothing is ever rewritten.

The order of rows inside a micro-batch does not matter.  The sink is a Parquet folder with exactly-once files,
and a query that is started again on its checkpoint goes on where the last one ended.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

OUTPUT = "run_id bigint, part string, epoch bigint, step bigint, n_steps bigint, train_loss double, val_loss double"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_BEFORE_ALL = -(1 << 62)


class EpochProcessor(StatefulProcessor):
    """The state of one run: its mark, its open epoch and the rows that wait."""

    def __init__(self, lateness: int):
        self.lateness = lateness

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.run = handle.getValueState("run", "highest bigint, closed bigint, n_steps bigint, total double")
        self.waiting = handle.getMapState("waiting", "step bigint, is_train int", "amounts array<double>")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802
        run_id = key[0]
        highest, closed, n_steps, total = self.run.get() if self.run.exists() else (_BEFORE_ALL, 0, 0, 0.0)
        mark = highest - self.lateness
        fresh: defaultdict[tuple[int, int], list[float]] = defaultdict(list)
        for row in rows:
            if row.step <= mark:
                yield Row(run_id=run_id, part="late", epoch=None, step=row.step, n_steps=None, train_loss=None, val_loss=None)
            else:
                # At the same step a validation report comes first.
                fresh[row.step, int(row.kind == "train")].append(row.value)
                highest = max(highest, row.step)
        # No more than ``lateness`` steps, read in one go; rows that are ripe at once never get there.
        stored = {tuple(place): list(amounts[0]) for place, amounts in self.waiting.iterator()}
        mark = highest - self.lateness
        for place in sorted({*stored, *fresh}):
            amounts = stored.get(place, []) + fresh.get(place, [])
            step, is_train = place
            if step > mark:
                if place in fresh:
                    self.waiting.updateValue(place, (amounts,))
                continue
            if place in stored:
                self.waiting.removeKey(place)
            if is_train:
                n_steps, total = n_steps + len(amounts), total + sum(sorted(amounts))
                continue
            for loss in sorted(amounts):
                closed += 1
                mean = total / n_steps if n_steps else 0.0
                yield Row(run_id=run_id, part="epoch", epoch=closed, step=step, n_steps=n_steps, train_loss=mean, val_loss=loss)
                n_steps, total = 0, 0.0
        self.run.update((highest, closed, n_steps, total))

    def close(self) -> None:
        pass


def start_state_rollup(log: DataFrame, path: str, checkpoint_path: str, lateness: int, **trigger) -> StreamingQuery:
    """Roll up a streaming ``(run_id, step, kind, value)`` log into ``path``; read it with :func:`read_rolled`.

    Rows without run, step or value, and those of other kinds, are left out.
    """
    spark = log.sparkSession
    rows = log.where(F.col("kind").isin("train", "val")).selectExpr(
        "cast(run_id AS bigint) AS run_id", "cast(step AS bigint) AS step", "kind", "cast(value AS double) AS value"
    )
    rolled = rows.dropna().groupBy("run_id").transformWithState(
        statefulProcessor=EpochProcessor(lateness), outputStructType=OUTPUT, outputMode="Append", timeMode="None"
    )
    # The query keeps the provider that is set when it starts.
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        return (
            rolled.writeStream.format("parquet")
            .option("path", path)
            .option("checkpointLocation", checkpoint_path)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def read_rolled(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The closed epochs, and the run and step of every row that came too late."""
    found = spark.read.schema(OUTPUT).parquet(path)
    epochs = found.where("part = 'epoch'").select("run_id", "epoch", "n_steps", "train_loss", "val_loss")
    return epochs, found.where("part = 'late'").select("run_id", "step")
