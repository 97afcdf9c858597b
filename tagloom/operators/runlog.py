"""Run logs: parameters and metrics as tidy rows, epoch roll-up, step plan."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.fixed_values import LOGGED_METRICS
from tagloom.functions.text import as_text
from tagloom.session import stage

# Width in steps of the pieces a run is cut into; bounds the rows one task orders.
_STEPS_PER_PIECE = 1_000_000


def run_metrics(
    summary: DataFrame, metrics: Sequence[str] = LOGGED_METRICS
) -> DataFrame:
    """``(approach, metric, value)`` rows of a summary."""
    values = [F.col(m).cast("double").alias(m) for m in metrics]
    return summary.select("approach", *values).unpivot("approach", list(metrics), "metric", "value")


def _leaves(schema: T.StructType, prefix: str = "") -> Iterator[tuple[str, T.DataType]]:
    for field in schema.fields:
        path = f"{prefix}{field.name}"
        if isinstance(field.dataType, T.StructType):
            yield from _leaves(field.dataType, f"{path}.")
        else:
            yield path, field.dataType


def flatten_params(df: DataFrame, id_cols: Sequence[str] = ()) -> DataFrame:
    """Nested columns as ``(ids..., key, value)`` with dotted keys and text values."""
    nested = T.StructType([f for f in df.schema.fields if f.name not in id_cols])
    entries: list[Column] = [
        F.struct(F.lit(path).alias("key"), as_text(F.col(path), kind).alias("value"))
        for path, kind in _leaves(nested)
    ]
    rows = df.select(*id_cols, F.explode(F.array(*entries)).alias("_entry"))
    return rows.select(*id_cols, "_entry.key", "_entry.value")


def flatten_json_params(df: DataFrame, json_col: str = "params", id_cols: Sequence[str] = ()) -> DataFrame:
    """JSON objects of any shapes as ``(ids..., key, value)`` with dotted keys and text values.

    Each row may have a shape of its own.  Objects are opened level by level, as deep as the deepest goes; lists are
    joined by commas, their nested members kept as JSON.  Nulls have a null value, and empty objects, nulls
    and what is no JSON object give no row.
    """
    spark = df.sparkSession
    # In a struct, so that no id's name meets those of the opened members.
    ids = F.struct(F.lit(0).alias("_"), *id_cols).alias("_ids")
    parsed = df.select(ids, F.lit(None).cast("string").alias("_path"), F.try_parse_json(json_col).alias("_object"))
    level, found = stage(parsed.where(_is_object("_object")), "level"), []
    while not level.isEmpty():
        opened = level.lateralJoin(spark.tvf.variant_explode(F.col("_object").outer()))
        members = stage(opened.select("_ids", F.concat_ws(".", "_path", "key").alias("_path"), F.col("value").alias("_object")), "members")
        found.append(members.where(~_is_object("_object")).select("_ids", F.col("_path").alias("key"), _variant_text("_object").alias("value")))
        level = members.where(_is_object("_object"))
    rows = reduce(DataFrame.unionByName, found) if found else level.select("_ids", F.col("_path").alias("key"), F.col("_path").alias("value"))
    return rows.select(*[F.col("_ids")[c].alias(c) for c in id_cols], "key", "value")


def _is_object(column: str) -> Column:
    return F.coalesce(F.schema_of_variant(column).startswith("OBJECT"), F.lit(False))


def _variant_text(column: str) -> Column:
    """A member as parameter text, by its own type."""

    def scalar(value: Column) -> Column:
        kind = F.schema_of_variant(value)
        number = as_text(F.try_variant_get(value, "$", "double"), T.DoubleType())
        return (
            F.when(kind == "BOOLEAN", as_text(F.try_variant_get(value, "$", "boolean"), T.BooleanType()))
            .when(kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT"), number)
            .otherwise(F.try_variant_get(value, "$", "string"))
        )

    value = F.col(column)
    is_list = F.schema_of_variant(value).startswith("ARRAY")
    members = F.try_variant_get(value, "$", "array<variant>")
    return F.when(is_list, F.array_join(F.transform(members, scalar), ",")).otherwise(scalar(value))


def epoch_rollup(df: DataFrame, steps_per_piece: int = _STEPS_PER_PIECE) -> DataFrame:
    """Mean train loss since the previous validation report, with the validation loss.

    Input ``(run_id, step, kind, value)`` with kind ``train`` or ``val``; output one row
    per validation report ``(run_id, epoch, n_steps, train_loss, val_loss)``, where the
    mean of no steps is 0.  Train rows after the last report belong to no epoch.  At the
    same step a validation report comes first.
    """
    return closed_epochs(epoch_sums(df, steps_per_piece))


def closed_epochs(sums: DataFrame) -> DataFrame:
    """Epochs with a validation report, from :func:`epoch_sums`."""
    return sums.where("n_reports > 0").select(
        "run_id",
        "epoch",
        "n_steps",
        F.coalesce(F.try_divide("total", "n_steps"), F.lit(0.0)).alias("train_loss"),
        "val_loss",
    )


def epoch_sums(df: DataFrame, steps_per_piece: int = _STEPS_PER_PIECE) -> DataFrame:
    """``(run_id, epoch, n_steps, total, val_loss, n_reports)``, the open epoch included.

    A run is ordered in pieces of ``steps_per_piece`` steps, each piece is summed up per
    local epoch, and the number of reports before a piece is then added to its local
    epochs.  So a run with most of the rows is spread over many tasks; ``step`` should be
    about unique within a run.
    """
    is_val = F.col("kind") == "val"
    piece = F.call_function("div", F.col("step"), F.lit(steps_per_piece))
    in_piece = Window.partitionBy("run_id", "_piece").orderBy("step", F.col("kind").desc())
    earlier = in_piece.rowsBetween(Window.unboundedPreceding, -1)
    logged = df.where(F.col("kind").isin("train", "val")).withColumn("_piece", piece)
    numbered = logged.withColumn(
        "_local", F.coalesce(F.sum(is_val.cast("bigint")).over(earlier), F.lit(0))
    )
    parts = numbered.groupBy("run_id", "_piece", "_local").agg(
        F.count_if(~is_val).alias("n_steps"),
        F.sum(F.when(~is_val, F.col("value"))).alias("total"),
        F.max(F.when(is_val, F.col("value"))).alias("val_loss"),
        F.count_if(is_val).alias("n_reports"),
    )
    # Reports per piece need no order, so this is a second, cheaply pre-aggregated pass.
    before = Window.partitionBy("run_id").orderBy("_piece").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        logged.groupBy("run_id", "_piece")
        .agg(F.count_if(is_val).alias("_in_piece"))
        .select(
            "run_id",
            "_piece",
            F.coalesce(F.sum("_in_piece").over(before), F.lit(0)).alias("_before"),
        )
    )
    numbered_parts = parts.join(offsets, ["run_id", "_piece"]).withColumn(
        "epoch", F.col("_before") + F.col("_local") + 1
    )
    return add_epoch_sums(numbered_parts)


def add_epoch_sums(parts: DataFrame) -> DataFrame:
    """Parts of the same epoch added up."""
    return parts.groupBy("run_id", "epoch").agg(
        F.sum("n_steps").alias("n_steps"),
        F.sum("total").alias("total"),
        F.max("val_loss").alias("val_loss"),
        F.sum("n_reports").alias("n_reports"),
    )


def training_plan(
    splits: DataFrame, batch_size: int = 4, epochs: int = 3
) -> DataFrame:
    """Steps per epoch, total steps and validation batches from the split sizes."""
    sizes = splits.agg(
        F.count_if(F.col("split") == "train").alias("n_train"),
        F.count_if(F.col("split") == "val").alias("n_val"),
    )

    def batches(n: str) -> Column:
        return F.greatest(F.lit(1), F.call_function("div", F.col(n), F.lit(batch_size)))

    return sizes.select(
        "n_train",
        "n_val",
        batches("n_train").alias("steps_per_epoch"),
        (batches("n_train") * epochs).alias("total_steps"),
        batches("n_val").alias("val_batches"),
    )
