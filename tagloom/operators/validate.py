"""Validation of requests and chat records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.fixed_values import (
    CHAT_ROLES,
    DEFAULT_APPROACH,
    MAX_REQUEST_LENGTH,
    MIN_REQUEST_LENGTH,
)


def validate_requests(
    df: DataFrame, low: int = MIN_REQUEST_LENGTH, high: int = MAX_REQUEST_LENGTH
) -> DataFrame:
    """Fill in the default approach and add ``error``, null for acceptable requests."""
    size = F.length("text")
    return df.withColumns(
        {
            "approach": F.coalesce("approach", F.lit(DEFAULT_APPROACH)),
            "error": F.when(F.col("text").isNull(), "text is missing")
            .when(size < low, f"text is shorter than {low}")
            .when(size > high, f"text is longer than {high}"),
        }
    )


def accepted(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("error").isNull()).drop("error")


def quarantined(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("error").isNotNull())


def validate_chat_rows(df: DataFrame) -> DataFrame:
    """Add ``is_valid``: the ``messages`` list exists and holds the three roles in order."""
    roles = F.transform("messages", lambda message: message["role"])
    expected = F.array(*[F.lit(role) for role in CHAT_ROLES])
    return df.withColumn("is_valid", F.coalesce(roles == expected, F.lit(False)))


def require_chat_rows(df: DataFrame, order_by: str = "row_id") -> DataFrame:
    """Return ``df``, or raise ``ValueError`` with the first row that lacks ``messages``."""
    first = df.where(F.col("messages").isNull()).agg(F.min(order_by).alias("row")).first()
    if first.row is not None:
        raise ValueError(f"Row {first.row} has no 'messages'.")
    return df


def validate_chat_turns(
    df: DataFrame, key_col: str = "conv_id", order_by: str = "turn"
) -> DataFrame:
    """``(key, n_messages, is_valid)`` of conversations stored as one row per turn.

    The shape is checked with plain aggregates, so no conversation is ever gathered.
    """
    first, middle, last = CHAT_ROLES
    return df.groupBy(key_col).agg(
        F.count("*").alias("n_messages"),
        (
            (F.count("*") == len(CHAT_ROLES))
            & (F.min_by("role", order_by) == first)
            & (F.count_if(F.col("role") == middle) == 1)
            & (F.max_by("role", order_by) == last)
        ).alias("is_valid"),
    )
