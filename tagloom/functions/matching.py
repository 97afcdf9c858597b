"""Mapping free-form model output to a label: exact, substring, fuzzy, unknown."""

from __future__ import annotations

import difflib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.fixed_values import FUZZY_CUTOFF, STRATEGY_CONFIDENCE, UNKNOWN_LABEL
from tagloom.functions.text import strip
from tagloom.labels import LabelSpace

# Entries a task remembers before it starts over; bounds worker memory.
_MEMO_ENTRIES = 100_000


def first_contained_label(text: Column, labels: LabelSpace) -> Column:
    """First label in label order that occurs inside the text, else null."""
    return F.get(F.filter(labels.as_array(), lambda label: F.contains(text, label)), F.lit(0))


class LabelMatcher:
    """Matches texts to a label set of any size as one label at a time would, looking at few of them.

    A text contains labels that one automaton over all of them finds in a single scan.  The similarity of a text
    and a label is at most twice the characters they share over both lengths; that bound comes for all labels at
    once from their lengths and character counts, and only labels whose bound reaches the best so far are compared in sequence.
    """

    def __init__(self, labels: Sequence[str], cutoff: float = FUZZY_CUTOFF):
        self._names, self._cutoff = list(labels), cutoff
        self._exact = set(self._names)
        self._letters = {c: n for n, c in enumerate(sorted({c for name in self._names for c in name}))}
        self._lengths = np.array([len(name) for name in self._names])
        self._counts = np.zeros((len(self._names), len(self._letters)), dtype=np.int32)
        for row, name in enumerate(self._names):
            for c in name:
                self._counts[row, self._letters[c]] += 1
        self._scanner = None

    def inside(self, text: str) -> str | None:
        """The first label in label order that occurs inside the text."""
        if self._scanner is None:
            import ahocorasick

            self._scanner = ahocorasick.Automaton()
            for place, name in enumerate(self._names):
                if name:
                    self._scanner.add_word(name, place)
            self._scanner.make_automaton()
        first = min((place for _, place in self._scanner.iter(text)), default=len(self._names)) if len(self._scanner) else len(self._names)
        # An empty label is part of any text.
        first = min(first, self._names.index("")) if "" in self._exact else first
        return self._names[first] if first < len(self._names) else None

    def closest(self, text: str) -> str | None:
        """The label most similar by sequence matching, or None below the cutoff; ties go to the last label."""
        own = np.zeros(len(self._letters), dtype=np.int32)
        for c in text:
            if (n := self._letters.get(c)) is not None:
                own[n] += 1
        both = self._lengths + len(text)
        near = np.flatnonzero(2.0 * np.minimum(self._lengths, len(text)) >= self._cutoff * both)
        shared = np.minimum(self._counts[near], own).sum(axis=1)
        # Two empty texts are alike.
        bound = np.where(both[near] > 0, 2.0 * shared / both[near].clip(1), 1.0)
        kept = bound >= self._cutoff
        near, bound = near[kept], bound[kept]
        best: tuple[float, str] | None = None
        matcher = difflib.SequenceMatcher()
        matcher.set_seq2(text)
        for at in np.argsort(-bound, kind="stable"):
            if best is not None and bound[at] < best[0]:
                break
            name = self._names[near[at]]
            matcher.set_seq1(name)
            score = matcher.ratio()
            if score >= self._cutoff and (best is None or (score, name) > best):
                best = score, name
        return best[1] if best else None

    def match(self, text: str) -> tuple[str, str]:
        """Label and strategy of a text."""
        if text in self._exact:
            return text, "exact"
        if (found := self.inside(text)) is not None:
            return found, "substring"
        if (found := self.closest(text)) is not None:
            return found, "fuzzy"
        return UNKNOWN_LABEL, UNKNOWN_LABEL


def closest_label(labels: LabelSpace, cutoff: float = FUZZY_CUTOFF):
    """Arrow UDF: label most similar to the text by sequence matching, or null below the cutoff.

    Nulls pass through untouched and each distinct text is scored once per task.
    """
    names = list(labels.labels)

    @F.pandas_udf(T.StringType())
    def closest(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = LabelMatcher(names, cutoff)
        memo: dict[str, str | None] = {}
        for batch in batches:
            if len(memo) > _MEMO_ENTRIES:
                memo.clear()
            for text in batch.dropna().unique():
                if text not in memo:
                    memo[text] = matcher.closest(text)
            yield batch.map(memo.get, na_action="ignore").astype(object)

    return closest


def _matched(names: list[str], cutoff: float):
    @F.pandas_udf("prediction string, strategy string")
    def matched(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        matcher = LabelMatcher(names, cutoff)
        memo: dict[str, tuple[str, str]] = {}
        for batch in batches:
            if len(memo) > _MEMO_ENTRIES:
                memo.clear()
            for text in batch.dropna().unique():
                if text not in memo:
                    memo[text] = matcher.match(text)
            found = [(UNKNOWN_LABEL, UNKNOWN_LABEL) if text is None else memo[text] for text in batch]
            yield pd.DataFrame(found, columns=["prediction", "strategy"])

    return matched


def match_many_labels(
    df: DataFrame, labels: LabelSpace, raw_col: str = "raw_output", cutoff: float = FUZZY_CUTOFF
) -> DataFrame:
    """:func:`match_labels` for label spaces of thousands, whose labels would make too long an expression.

    All stages run in one Arrow function; each distinct text is matched once per task.
    """
    text = F.lower(strip(F.col(raw_col)))
    found = df.withColumn("_found", _matched(list(labels.labels), cutoff)(text))
    return found.select(*df.columns, "_found.prediction", "_found.strategy")


def match_labels(
    df: DataFrame,
    labels: LabelSpace,
    raw_col: str = "raw_output",
    cutoff: float = FUZZY_CUTOFF,
) -> DataFrame:
    """Add ``prediction`` and ``strategy`` for the raw model output.

    Exact and substring stages are native.  The UDF sees null for every row those
    stages settled, so only the residue crosses to Python as text.  No shuffle and no
    join, hence the same code serves batch and streaming input.
    """
    cleaned = df.withColumn("_text", F.lower(strip(F.col(raw_col))))
    native = cleaned.withColumn(
        "_exact", F.when(labels.holds(F.col("_text")), F.col("_text"))
    ).withColumn(
        "_inside", F.when(F.col("_exact").isNull(), first_contained_label(F.col("_text"), labels))
    )
    residue = F.when(F.col("_exact").isNull() & F.col("_inside").isNull(), F.col("_text"))
    scored = native.withColumn("_near", closest_label(labels, cutoff)(residue))
    return scored.select(
        *df.columns,
        F.coalesce("_exact", "_inside", "_near", F.lit(UNKNOWN_LABEL)).alias("prediction"),
        F.when(F.col("_exact").isNotNull(), "exact")
        .when(F.col("_inside").isNotNull(), "substring")
        .when(F.col("_near").isNotNull(), "fuzzy")
        .otherwise(UNKNOWN_LABEL)
        .alias("strategy"),
    )


def confidence(strategy: Column) -> Column:
    """Confidence of a matching strategy; anything unlisted scores 0."""
    case = F.lit(0.0)
    for name, value in STRATEGY_CONFIDENCE.items():
        case = F.when(strategy == name, value).otherwise(case)
    return case
