"""The example bank: a few training texts per label."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.fixed_values import DEFAULT_SEED, EXAMPLES_PER_LABEL
from tagloom.functions.text import seeded_hash
from tagloom.labels import DEFAULT_SPACE, LabelSpace


def few_shot_bank(
    train: DataFrame,
    labels: LabelSpace = DEFAULT_SPACE,
    n: int = EXAMPLES_PER_LABEL,
    seed: int = DEFAULT_SEED,
    label_col: str = "intent",
    text_col: str = "instruction",
) -> DataFrame:
    """``(intent, examples)`` with up to ``n`` texts per label, drawn by seeded hash.

    A label without rows gets an empty list.  Draws are ranked without the texts, inside
    every map task before the shuffle; only the texts that win are fetched then.
    """
    known = labels.holds(F.col(label_col))
    drawn = train.where(known).select(
        F.col(label_col).alias("intent"), F.col(text_col).alias("_text"), seeded_hash(seed, F.col(text_col)).alias("_draw")
    )
    # Hash ties exist only between equal texts, so the order is total up to equal rows.
    best = (
        drawn.select("intent", "_draw")
        .withColumn("_rank", F.row_number().over(Window.partitionBy("intent").orderBy("_draw")))
        .where(F.col("_rank") <= n)
    )
    winners = best.groupBy("intent", "_draw").agg(F.collect_list("_rank").alias("_ranks"))
    texts = drawn.join(winners, ["intent", "_draw"]).groupBy("intent", "_draw").agg(
        F.first("_text").alias("_text"), F.first("_ranks").alias("_ranks")
    )
    picked = texts.select("intent", "_text", F.explode("_ranks").alias("_rank")).groupBy("intent").agg(
        F.array_sort(F.collect_list(F.struct("_rank", "_text")))["_text"].alias("examples")
    )
    listed = labels.table(train.sparkSession, "intent").select("intent")
    return listed.join(picked, "intent", "left").select(
        "intent",
        F.coalesce("examples", F.array().cast("array<string>")).alias("examples"),
    )


def with_bank(df: DataFrame, bank: DataFrame, column: str = "_bank") -> DataFrame:
    """Add the bank to every row as a value to build prompts from, by label.

    Spark computes it once per query, before the prompts, and hands it to the tasks.  It grows
    with the number of labels times the examples of each, never with the rows.
    """
    entries = F.array_sort(F.collect_list(F.struct("intent", "examples")))
    return df.withColumn(column, bank.agg(entries.alias("bank")).scalar())


def first_examples(bank: DataFrame, n_entries: int) -> DataFrame:
    """The first ``n_entries`` labels with their first example alone."""
    first = bank.orderBy("intent").limit(n_entries)
    return first.select("intent", F.slice("examples", 1, 1).alias("examples"))


def example_rows(bank: DataFrame) -> DataFrame:
    """Every example as a row ``(intent, place, example)``."""
    return bank.select("intent", F.posexplode("examples").alias("place", "example"))
