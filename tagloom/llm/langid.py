"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point alone.  An n-gram's vector binds the
vectors of its letters, each rotated by its place, by multiplication; a text's vector bundles its n-grams by
addition, and so does a language's prototype over all its training texts.  A document gets the language whose
prototype has the largest cosine with its own vector.

Training counts n-grams per language inside every task and sends one vector per language and task; scoring
is map-only.  Prototypes go to the workers in groups of at most ``GROUP`` languages, so what is
broadcast is bounded; with more languages the groups are scored one after another.

Only letters count, lower-cased; whatever lies between two words is one space.  Null texts and texts without letters are ``und`` with score 0.  Ties go to the first language by code point.  Repeated rows are all
reported; without any training text all documents are ``und``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.session import stage

DIMENSIONS = 512
ORDER = 3
SEED = 9_176
UNKNOWN = "und"
GROUP = 1024
PIECE_CHARS = 1 << 20

# Distinct n-grams whose vectors are held at once.
BLOCK = 8192

_WORD = re.compile(r"[^\W\d_]+")
_vectors: dict[int, np.ndarray] = {}


def letter_vector(code: int) -> np.ndarray:
    """The random vector of a code point."""
    if code not in _vectors:
        draw = np.random.default_rng([SEED, code]).integers(0, 2, DIMENSIONS, dtype=np.int8)
        _vectors[code] = (2 * draw - 1).astype(np.int8)
    return _vectors[code]


def bound_vectors(grams: np.ndarray) -> np.ndarray:
    """Vectors of n-grams, given as rows of code points."""
    out = np.ones((len(grams), DIMENSIONS), dtype=np.int8)
    for place in range(grams.shape[1]):
        codes, at = np.unique(grams[:, place], return_inverse=True)
        rolled = np.stack([np.roll(letter_vector(int(c)), grams.shape[1] - 1 - place) for c in codes])
        out *= rolled[at]
    return out


def gram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams, and per document and n-gram: document, number of the n-gram, count.

    Words are framed by single spaces; a text without letters has no n-grams.
    """
    lines = [f" {' '.join(words)} " if (words := _WORD.findall(t.lower())) else "" for t in texts]
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    owner = np.repeat(np.arange(len(lines)), [len(line) for line in lines])
    ends = max(0, len(codes) - ORDER + 1)
    packed = np.zeros(ends, dtype=np.int64)
    for n in range(ORDER):
        packed = (packed << 21) | codes[n : n + ends]
    inside = owner[:ends] == owner[ORDER - 1 :][:ends]
    number, distinct = pd.factorize(packed[inside])
    width = max(1, len(distinct))
    pairs, counts = np.unique(owner[:ends][inside] * width + number, return_counts=True)
    grams = np.stack([(distinct >> (21 * (ORDER - 1 - n))) & 0x1FFFFF for n in range(ORDER)], axis=1)
    return grams, pairs // width, pairs % width, counts


def bundles(texts: list[str]) -> np.ndarray:
    """The vector of each text; zeros for one without letters."""
    grams, docs, numbers, counts = gram_counts(texts)
    out = np.zeros((len(texts), DIMENSIONS), dtype=np.float32)
    for low in range(0, len(grams), BLOCK):
        vectors = bound_vectors(grams[low : low + BLOCK]).astype(np.float32)
        inside = (numbers >= low) & (numbers < low + BLOCK)
        own, weight = numbers[inside] - low, counts[inside].astype(np.float32)
        limits = np.searchsorted(docs[inside], np.arange(len(texts) + 1)).tolist()
        for doc, (start, end) in enumerate(zip(limits[:-1], limits[1:])):
            if end > start:
                out[doc] += weight[start:end] @ vectors[own[start:end]]
    return out


def _pieces(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    start, held = 0, 0
    for n, text in enumerate(texts):
        if n > start and held + len(text) > PIECE_CHARS:
            yield start, texts[start:n]
            start, held = n, 0
        held += len(text)
    if start < len(texts):
        yield start, texts[start:]


_PROFILE = pa.schema([("lang", pa.string()), ("place", pa.int32()), ("weight", pa.float64())])


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column(0).to_pylist()
        for start, texts in _pieces([t or "" for t in batch.column(1).to_pylist()]):
            grams, docs, numbers, counts = gram_counts(texts)
            if not len(docs):
                continue
            names, code = np.unique(np.array(langs[start : start + len(texts)], dtype=object).astype(str), return_inverse=True)
            table = np.zeros((len(names), len(grams)), dtype=np.float32)
            np.add.at(table, (code[docs], numbers), counts)
            for low in range(0, len(grams), BLOCK):
                part = table[:, low : low + BLOCK] @ bound_vectors(grams[low : low + BLOCK]).astype(np.float32)
                for name, vector in zip(names, part):
                    sums[name] = sums.get(name, 0) + vector.astype(np.float64)
    if sums:
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([n for n in sums for _ in range(DIMENSIONS)], pa.string()),
                pa.array(np.tile(np.arange(DIMENSIONS, dtype=np.int32), len(sums))),
                pa.array(np.concatenate(list(sums.values()))),
            ],
            schema=_PROFILE,
        )


def prototypes(texts: DataFrame) -> DataFrame:
    """``(lang, rank, vector)`` over a table of language and text; ranks from 0 by code point."""
    parts = texts.mapInArrow(_profile, "lang string, place int, weight double")
    # Whole numbers, so the order of the sums does not matter.
    whole = parts.groupBy("lang", "place").agg(F.sum("weight").alias("weight"))
    vectors = whole.groupBy("lang").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("place", "weight"))), lambda s: s["weight"]).alias("vector")
    )
    # One short row a language.
    rank = F.row_number().over(Window.orderBy("lang")) - 1
    return stage(vectors.withColumn("rank", rank), "prototypes")


_SCORED = [("lang_pred", pa.string()), ("score", pa.float64())]


def _identify(names: list[str], profile: np.ndarray):
    """Best of the languages of one group for each text; the leading columns pass through."""
    unit = profile / np.maximum(np.linalg.norm(profile, axis=1, keepdims=True), 1e-12)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[str | None] = []
            scores: list[float] = []
            for _, texts in _pieces([t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]):
                bundled = bundles(texts)
                lengths = np.linalg.norm(bundled, axis=1)
                cosines = bundled @ unit.T / np.maximum(lengths, 1e-12)[:, None]
                for length, row in zip(lengths, cosines):
                    best = int(np.argmax(row)) if length and len(names) else None
                    found.append(UNKNOWN if best is None else names[best])
                    scores.append(0.0 if best is None else float(min(1.0, max(0.0, row[best]))))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in range(batch.num_columns - 1)], pa.array(found, pa.string()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names[:-1], *[n for n, _ in _SCORED]],
            )

    return run


def identify(docs: DataFrame, profiles: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Language and score of every text; only the text is looked at."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("_text"))
    schema = "doc_id long, text_key long, lang_pred string, score double"
    count = profiles.count()
    groups = []
    for low in range(0, max(1, count), GROUP):
        # At most GROUP rows of DIMENSIONS numbers.
        part = profiles.where((F.col("rank") >= low) & (F.col("rank") < low + GROUP)).orderBy("rank").collect()
        profile = np.array([r["vector"] for r in part]).reshape(-1, DIMENSIONS)
        groups.append(rows.mapInArrow(_identify([r["lang"] for r in part], profile), schema))
    if len(groups) == 1:
        return groups[0].drop("text_key")
    together = groups[0]
    for other in groups[1:]:
        together = together.unionByName(other)
    best = together.groupBy("doc_id", "text_key").agg(
        F.min(F.struct((-F.col("score")).alias("minus"), "lang_pred")).alias("best"),
        (F.count(F.lit(1)) / len(groups)).cast("int").alias("copies"),
    )
    return best.select(
        "doc_id", F.col("best.lang_pred").alias("lang_pred"), (-F.col("best.minus")).alias("score"),
        F.explode(F.sequence(F.lit(1), "copies")).alias("_copy"),
    ).drop("_copy")
