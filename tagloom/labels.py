"""The label space: a sorted list of label names that the caller gives, and label tables from data."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.fixed_values import DEFAULT_LABELS
from tagloom.operators.ordering import numbered


class LabelSpace:
    """Sorted distinct labels; a label's id is its position."""

    def __init__(self, labels: Iterable[str] = DEFAULT_LABELS):
        self.labels: tuple[str, ...] = tuple(sorted(set(labels)))
        if not self.labels:
            raise ValueError("A label space needs at least one label.")

    @classmethod
    def from_column(cls, df: DataFrame, column: str) -> LabelSpace:
        """Label space made of the distinct non-null values of a column.

        For label columns known to be small; :func:`label_table` has no such need.
        """
        return cls(row[0] for row in df.select(column).where(F.col(column).isNotNull()).distinct().collect())

    def __len__(self) -> int:
        return len(self.labels)

    def __iter__(self):
        return iter(self.labels)

    def __contains__(self, label: str) -> bool:
        return label in self.labels

    def to_ids(self) -> dict[str, int]:
        return {label: position for position, label in enumerate(self.labels)}

    def table(self, spark: SparkSession, column: str = "label") -> DataFrame:
        """The label dimension ``(label, label_id)``."""
        return spark.createDataFrame(
            list(self.to_ids().items()), f"{column} string, label_id int"
        )

    def as_array(self) -> Column:
        return F.array(*[F.lit(label) for label in self.labels])

    def holds(self, column: Column) -> Column:
        """True where the value is a known label (a pushable IN filter)."""
        return column.isin(*self.labels)


DEFAULT_SPACE = LabelSpace()


def label_table(df: DataFrame, column: str) -> DataFrame:
    """The label dimension ``(column, label_id)`` of the data, as a table of any size."""
    found = df.select(column).where(F.col(column).isNotNull()).distinct()
    return numbered(found, [F.col(column)], "label_id")
