"""Predictors: a pluggable batch model call and the two training-free baselines."""

from __future__ import annotations

import hashlib
import re
import time
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.fixed_values import UNKNOWN_LABEL
from tagloom.functions.prompts import constant
from tagloom.functions.text import all_tokens, distinct_tokens
from tagloom.labels import LabelSpace
from tagloom.operators.bank import example_rows
from tagloom.session import stage


class Predictor(Protocol):
    """Maps a list of prompts to a list of raw outputs of the same length."""

    def __call__(self, prompts: list[str]) -> Sequence[str]: ...


# Prompts that go to a model at a time.
BATCH_SIZE = 32
# Words of the examples, and of the texts, that one task of the nearest-example predictor holds.
BLOCK_WORDS, CHUNK_WORDS = 2_000_000, 8_000_000

# One loaded predictor per Python worker, key and factory; workers are reused between tasks.
_loaded: dict[str, Predictor] = {}


def _load(key: str, factory: Callable[[], Predictor]) -> Predictor:
    if key not in _loaded:
        _loaded[key] = factory()
    return _loaded[key]


def _call(
    predictor: Predictor, prompts: list[str], record_errors: bool
) -> list[tuple[str | None, float | None, str | None]]:
    """Output, share of the wall time and error of each prompt of a call."""
    began = time.perf_counter()
    try:
        outputs = predictor(prompts)
        if len(outputs) != len(prompts):
            raise ValueError(f"{len(outputs)} outputs for {len(prompts)} prompts")
    except Exception as raised:
        if not record_errors:
            raise
        if len(prompts) > 1:
            return [answer for prompt in prompts for answer in _call(predictor, [prompt], True)]
        took = (time.perf_counter() - began) * 1000.0
        return [(None, took, f"{type(raised).__name__}: {raised}")]
    share = (time.perf_counter() - began) * 1000.0 / len(prompts)
    return [(output, share, None) for output in outputs]


def predict_batch(
    df: DataFrame,
    factory: Callable[[], Predictor],
    key: str,
    input_col: str = "prompt",
    batch_size: int = BATCH_SIZE,
    record_errors: bool = False,
) -> DataFrame:
    """Add ``raw_output`` and ``latency_ms`` (and ``error`` when errors are recorded).

    ``factory`` builds the predictor once per Python worker; ``key`` names it, and a digest of
    the factory keeps two of the same name apart.  Prompts go to it ``batch_size`` at a time; a
    call's wall time is shared evenly by its rows.  Null prompts are not sent.  Without
    ``record_errors`` a failing call fails the job; with it, the rows of a failed call are
    sent once more, one by one.  Map-only; works on batch and streaming input.  All columns
    cross to Python, so select what is needed first.
    """
    slot = f"{key}:{hashlib.sha256(cloudpickle.dumps(factory)).hexdigest()}"
    fields = [*df.schema.fields, T.StructField("raw_output", T.StringType())]
    fields.append(T.StructField("latency_ms", T.DoubleType()))
    if record_errors:
        fields.append(T.StructField("error", T.StringType()))

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predictor = _load(slot, factory)
        for frame in batches:
            prompts = frame[input_col].tolist()
            answers: list[tuple[str | None, float | None, str | None]] = [(None, None, None)] * len(prompts)
            filled = [row for row, prompt in enumerate(prompts) if prompt is not None]
            for start in range(0, len(filled), batch_size):
                rows = filled[start : start + batch_size]
                found = _call(predictor, [prompts[row] for row in rows], record_errors)
                for row, answer in zip(rows, found, strict=True):
                    answers[row] = answer
            raw, latency, errors = zip(*answers) if answers else ((), (), ())
            result = frame.assign(
                raw_output=pd.Series(raw, index=frame.index, dtype=object),
                latency_ms=pd.Series(latency, index=frame.index, dtype="float64"),
            )
            if record_errors:
                result["error"] = pd.Series(errors, index=frame.index, dtype=object)
            yield result

    return df.mapInPandas(run, T.StructType(fields))


def words_of(text: str) -> set[str]:
    """The distinct lower-case ASCII alphanumeric tokens."""
    return set(re.findall(r"[a-z0-9]+", text.lower()))


class LexicalPredictor:
    """Python counterpart of :func:`zero_shot_lexical`, for use with :func:`predict_batch`.

    With ``marker`` only the part of the prompt after its last occurrence is read.
    """

    def __init__(self, labels: Iterable[str], marker: str | None = None):
        self._marker = marker
        self._names = [(label, words_of(label)) for label in labels]

    def __call__(self, prompts: list[str]) -> list[str]:
        return [self._one(prompt) for prompt in prompts]

    def _one(self, prompt: str) -> str:
        text = prompt.rsplit(self._marker, 1)[-1] if self._marker else prompt
        words = words_of(text)
        label, overlap = max(
            ((label, len(words & name)) for label, name in self._names), key=lambda pair: pair[1]
        )
        return label if overlap else UNKNOWN_LABEL


class NearestPredictor:
    """Python counterpart of :func:`few_shot_nearest` over a bank of a few examples a label.

    ``examples`` are ``(label, text)`` in order; an inverted index leads from words to those that share one.
    """

    def __init__(self, examples: Sequence[tuple[str, str]]):
        self._labels = [label for label, _ in examples]
        sets = [words_of(text or "") for _, text in examples]
        self._sizes = [len(words) for words in sets]
        self._holders: dict[str, list[int]] = {}
        for place, words in enumerate(sets):
            for word in words:
                self._holders.setdefault(word, []).append(place)

    def __call__(self, prompts: list[str]) -> list[str]:
        return [self._one(words_of(prompt)) for prompt in prompts]

    def _one(self, words: set[str]) -> str:
        if not self._labels:
            return UNKNOWN_LABEL
        shared = Counter(place for word in words for place in self._holders.get(word, ()))
        # Examples that share nothing are all alike; the first stands for them.
        best = min(shared or [0], key=lambda place: (-shared[place] / max(1, len(words) + self._sizes[place] - shared[place]), self._labels[place]))
        return self._labels[best] if shared else min(self._labels)


def zero_shot_lexical(
    df: DataFrame, labels: LabelSpace, text_col: str = "instruction"
) -> DataFrame:
    """Add ``raw_output``: the label sharing most name tokens with the text.

    Needs no training.  Ties go to the first label; ``unknown`` when no label shares any
    token.  The text is cut down to label tokens once, so the per-label work does not
    depend on the length of the text.
    """
    names = [{"label": label, "words": sorted(words_of(label))} for label in labels]
    vocabulary = sorted({word for name in names for word in name["words"]})
    cut = df.withColumn(
        "_known",
        F.array_intersect(all_tokens(F.col(text_col)), constant(vocabulary, "array<string>")),
    )

    def scored(name: Column, position: Column) -> Column:
        return F.struct(
            F.size(F.array_intersect(F.col("_known"), name["words"])).alias("score"),
            (-position).alias("order"),
            name["label"].alias("label"),
        )

    entries = constant(names, "array<struct<label: string, words: array<string>>>")
    best = F.array_max(F.transform(entries, scored))["label"]
    # Using _known twice also keeps the optimizer from moving it into the per-label lambda.
    label = F.when(F.size("_known") > 0, best).otherwise(UNKNOWN_LABEL)
    return cut.select(*df.columns, label.alias("raw_output"))


class NearestIndex:
    """Nearest of many examples by token Jaccard: words from the rarest on, with bounds.

    An example that is first met at the i-th rarest of a text's k known words shares at most k - i of them, so its
    similarity is at most (k - i) / size of the text.  Once the best so far is above that, no new example is
    taken; those already met go on only while the words they share and those that are left can still reach the best.
    """

    def __init__(self, labels: Sequence[str], examples: Sequence[Sequence[str]]):
        self._labels = list(labels)
        self._sizes = np.array([len(words) for words in examples], dtype=np.int64)
        flat = pa.array([word for words in examples for word in words], pa.string())
        self._vocabulary = pc.unique(flat)
        number = pc.index_in(flat, value_set=self._vocabulary).to_numpy(zero_copy_only=False)
        # Holders of a word in ascending order.
        self._holders = np.repeat(np.arange(len(self._sizes)), self._sizes)[np.argsort(number, kind="stable")]
        self._lengths = np.bincount(number, minlength=len(self._vocabulary))
        self._ends = np.cumsum(self._lengths)

    def find(self, tokens: pa.ListArray) -> tuple[list[float], list[str]]:
        """Similarity and label for each list of distinct tokens; ties go to the first example."""
        found = pc.fill_null(pc.index_in(tokens.flatten(), value_set=self._vocabulary), -1).to_numpy(zero_copy_only=False)
        limits = tokens.offsets.to_numpy() - tokens.offsets[0].as_py()
        best = [self._one(found[low:high]) for low, high in zip(limits[:-1], limits[1:])]
        return [s for s, _ in best], [self._labels[at] for _, at in best]

    def _postings(self, word: int) -> np.ndarray:
        return self._holders[self._ends[word] - self._lengths[word] : self._ends[word]]

    def _one(self, found: np.ndarray) -> tuple[float, int]:
        size, known = len(found), found[found >= 0]
        known = known[np.argsort(self._lengths[known], kind="stable")]
        shared = np.zeros(len(self._sizes), dtype=np.int64)
        best, at, step = 0.0, 0, 1
        while at < len(known) and best <= (len(known) - at) / size:
            group = known[at : at + step]
            np.add.at(shared, np.concatenate([self._postings(word) for word in group]), 1)
            at, step = at + len(group), 2 * step
            best = float((shared / (size + self._sizes - shared).clip(1)).max())
        alive = np.flatnonzero(shared)
        if not len(alive):
            return 0.0, 0
        counts = shared[alive]
        for place in range(at, len(known)):
            most = counts + len(known) - place
            reach = most / (size + self._sizes[alive] - most).clip(1) >= best
            alive, counts = alive[reach], counts[reach]
            holders = self._postings(known[place])
            near = np.minimum(np.searchsorted(holders, alive), len(holders) - 1)
            counts = counts + (holders[near] == alive)
        similarity = counts / (size + self._sizes[alive] - counts)
        first = int(similarity.argmax())
        return float(similarity[first]), int(alive[first])


def _index_of(rows) -> NearestIndex:
    return NearestIndex([label for label, _ in rows], [words for _, words in rows])


def _nearest(index: NearestIndex):
    @F.arrow_udf("struct<similarity: double, raw_output: string>")
    def score(tokens: pa.Array) -> pa.Array:
        similarities, found = index.find(tokens)
        return pa.StructArray.from_arrays(
            [pa.array(similarities, pa.float64()), pa.array(found, pa.string())], names=["similarity", "raw_output"]
        )

    return score


def _nearest_of_block(texts: pa.Table, examples: pa.Table) -> pa.Table:
    """The nearest example of a block for each text of a chunk."""
    schema = pa.schema([("row", pa.int64()), ("similarity", pa.float64()), ("raw_output", pa.string())])
    if not texts.num_rows or not examples.num_rows:
        return schema.empty_table()
    ordered = examples.sort_by([("intent", "ascending"), ("place", "ascending")])
    index = NearestIndex(ordered.column("intent").to_pylist(), ordered.column("tokens").to_pylist())
    similarities, found = index.find(texts.column("tokens").combine_chunks())
    return pa.table([texts.column("row"), pa.array(similarities, pa.float64()), pa.array(found, pa.string())], schema=schema)


def few_shot_nearest(df: DataFrame, bank: DataFrame, text_col: str = "instruction") -> DataFrame:
    """Add ``raw_output`` and ``similarity``: label of the bank example nearest by token Jaccard.

    Ties go to the first label; without any example the label is ``unknown``.  A bank of up to ``BLOCK_WORDS`` words
    travels with the function, map-only.  A larger one is dealt to blocks of that size and the texts, as token
    lists, to chunks of ``CHUNK_WORDS``; every pair of them is a task's work, and what comes back is an id with the
    best of a block.  The rows themselves are stored once, however many blocks there are.
    """
    examples = example_rows(bank).select(
        "intent", "place", distinct_tokens(F.col("example")).alias("tokens")
    )
    words, count = examples.agg(F.sum(F.size("tokens")), F.count("*")).first()
    if not count:
        return df.withColumns({"raw_output": F.lit(UNKNOWN_LABEL), "similarity": F.lit(0.0)})
    tokens = distinct_tokens(F.coalesce(F.col(text_col), F.lit("")))
    blocks = max(1, -(-(words + count) // BLOCK_WORDS))
    if blocks == 1:
        # Bounded by BLOCK_WORDS.
        shown = [(r.intent, r.tokens) for r in examples.orderBy("intent", "place").collect()]
        found = df.withColumn("_found", _nearest(_index_of(shown))(tokens))
        return found.select(*df.columns, "_found.raw_output", "_found.similarity")
    rows = stage(df.withColumn("_row", F.monotonically_increasing_id()), "texts")
    listed = stage(rows.select(F.col("_row").alias("row"), tokens.alias("tokens")), "tokens")
    chunks = max(1, -(-(listed.agg(F.sum(F.size("tokens") + 1)).first()[0] or 1) // CHUNK_WORDS))

    def each(number: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(number - 1)))

    cell = ["chunk", "block"]
    asked = listed.withColumn("chunk", F.pmod(F.xxhash64("row"), F.lit(chunks)).cast("int")).withColumn("block", each(blocks))
    held = examples.withColumn("block", F.pmod(F.xxhash64("intent", "place"), F.lit(blocks)).cast("int")).withColumn("chunk", each(chunks))
    best = (
        asked.groupBy(*cell)
        .cogroup(held.groupBy(*cell))
        .applyInArrow(_nearest_of_block, "row long, similarity double, raw_output string")
        .groupBy("row")
        .agg(F.min(F.struct((-F.col("similarity")).alias("minus"), "raw_output")).alias("best"))
    )
    return rows.join(best, F.col("_row") == F.col("row")).select(
        *df.columns, F.col("best.raw_output").alias("raw_output"), (-F.col("best.minus")).alias("similarity")
    )
