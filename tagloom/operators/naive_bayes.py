"""Multinomial naive Bayes over distinct words, as aggregates and joins.

Log probabilities are whole numbers of a millionth, so sums do not depend on their order and ties are
ties.  The model is a table with one row a word; it is joined, so neither vocabulary nor training data
have a bound.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions.text import distinct_tokens
from tagloom.labels import LabelSpace
from tagloom.session import stage

SCALE = 1_000_000


@dataclass(frozen=True)
class NaiveBayes:
    """``words(word, excess)`` and, by label, the log prior and the log share of an unseen word.

    ``excess`` holds by label what a word scores above an unseen one.
    """

    labels: LabelSpace
    words: DataFrame
    priors: list[int | None]
    unseen: list[int]


def _scaled(value: Column) -> Column:
    return F.round(F.ln(value) * SCALE).cast("bigint")


def train_naive_bayes(
    train: DataFrame, labels: LabelSpace, text_col: str = "instruction", label_col: str = "intent"
) -> NaiveBayes:
    """Count words per label with add-one smoothing; rows without text or listed label are left out."""
    rows = train.where(labels.holds(F.col(label_col)) & F.col(text_col).isNotNull()).select(
        F.col(label_col).alias("label"), distinct_tokens(F.col(text_col)).alias("tokens")
    )
    by_word = (
        rows.select("label", F.explode("tokens").alias("word"))
        .groupBy("word")
        .agg(*[F.count_if(F.col("label") == label).alias(f"n{i}") for i, label in enumerate(labels)])
    )
    counts = stage(by_word, "word-counts")
    total = counts.agg(F.count("*").alias("words"), *[F.sum(f"n{i}").alias(f"n{i}") for i in range(len(labels))]).first()
    documents = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    places = [float((total[f"n{i}"] or 0) + total["words"]) for i in range(len(labels))]
    spark = train.sparkSession
    logs = [F.lit(sum(documents.values()) or 1)] + [F.lit(p or 1.0) for p in places]
    known = [F.lit(documents.get(label, 0)) for label in labels]
    constants = spark.range(1).select(
        F.array(*[F.when(n > 0, _scaled(n / logs[0])) for n in known]).alias("priors"),
        F.array(*[_scaled(1 / p) for p in logs[1:]]).alias("unseen"),
    ).first()
    excess = [
        (_scaled((F.col(f"n{i}") + 1) / F.lit(place or 1.0)) - F.lit(low)).alias(f"n{i}")
        for i, (place, low) in enumerate(zip(places, constants["unseen"], strict=True))
    ]
    words = counts.select("word", F.array(*excess).alias("excess"))
    return NaiveBayes(labels, words, list(constants["priors"]), list(constants["unseen"]))


def predict_naive_bayes(
    df: DataFrame, model: NaiveBayes, id_col: str, text_col: str = "instruction"
) -> DataFrame:
    """``(id, raw_output)`` of every row; words that training lacks are passed over.

    A label without training rows is never chosen; ties go to the first label.
    """
    tokens = distinct_tokens(F.coalesce(F.col(text_col), F.lit("")))
    words = df.select(F.col(id_col), F.explode_outer(tokens).alias("word"))
    met = words.join(model.words, "word", "left")
    sums = [F.coalesce(F.sum(F.get("excess", F.lit(i))), F.lit(0)).alias(f"_s{i}") for i in range(len(model.labels))]
    scored = met.groupBy(id_col).agg(F.count("excess").alias("_known"), *sums)
    scores = [
        F.struct((F.col(f"_s{i}") + F.col("_known") * F.lit(low) + F.lit(prior)).alias("score"), F.lit(-i).alias("order"), F.lit(label).alias("label"))
        for i, (label, prior, low) in enumerate(zip(model.labels, model.priors, model.unseen, strict=True))
        if prior is not None
    ]
    best = F.array_max(F.array(*scores))["label"] if scores else F.lit(None).cast("string")
    return scored.select(id_col, best.alias("raw_output"))
