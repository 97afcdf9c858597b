"""How filters interact: survivors of every subset, counted over truth-table words.

Five filters have 32 subsets.  A document's survival word has a bit for each: it is set where the document fails
none of the subset's filters, so the word is the conjunction of the truth-table columns of the filters it fails.
Per part and label the words are added up position by position: three words make a sum and a carry word (a
carry-save adder), the carries go on to the next weight, and of the 32 counts that result one is the
number of survivors of each subset.  Tasks count their own rows first; Spark adds up 32 numbers per part and
label.  What any order of the filters keeps, removes or finds removed already follows from these counts.

Filters A to D look at a text alone.  E fails a text that some smaller id has too, anywhere in the table;
texts are compared by 128-bit digests, and each row is joined with its text's smallest id by digest and id
together, so copies of one text are spread over tasks.

Null texts are empty.  A null id is smaller than none and larger than none: such a row passes E, makes no other
fail and has no label.  Rows with one id are rows of their own; equal ones all pass E or all fail.  Several labels
of a document count as good where any says so, and as toxic likewise.  A null part is the empty string.  Further
columns do no harm; an empty table has no parts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.session import stage

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
# Truth-table column of each filter's absence: bit S is set where subset S lacks the filter.
COLUMNS = tuple(sum(1 << s for s in range(SUBSETS) if not s >> f & 1) for f in range(len(FILTERS)))
LEAST_WORDS = 50
COPY = FILTERS.index("E")

_UPPER = bytes(range(0x41, 0x5B))
_MARKED = re.compile(rb"[#$%&*|]")


def text_failures(text: bytes) -> int:
    """Bits of the filters A to D that a UTF-8 text fails.

    >>> text_failures(b"Too SHORT & loud")
    13
    """
    # Splits at ASCII white space.
    words = text.split()
    points = len(text.decode("utf-8", "replace"))
    fails = (
        len(words) < LEAST_WORDS,
        100 * len(set(words)) < 65 * len(words),
        100 * (len(text) - len(text.translate(None, _UPPER))) > 5 * points,
        _MARKED.search(text) is not None,
    )
    return sum(fail << f for f, fail in enumerate(fails))


def survival_words(fails: np.ndarray) -> np.ndarray:
    """The 32-bit word of surviving subsets for each set of failed filters."""
    words = np.full(len(fails), (1 << SUBSETS) - 1, dtype=np.uint32)
    for f, column in enumerate(COLUMNS):
        words &= np.where(fails >> f & 1, np.uint32(column), np.uint32((1 << SUBSETS) - 1))
    return words


def positional_popcounts(words: np.ndarray) -> np.ndarray:
    """How many words have each bit, by carry-save adders.

    >>> positional_popcounts(np.array([0b101, 0b100, 0b111, 0b001], dtype=np.uint32))[:4].tolist()
    [3, 1, 3, 0]
    """
    counts = np.zeros(SUBSETS, dtype=np.int64)
    places = np.arange(SUBSETS, dtype=np.uint32)
    weight = 0
    while len(words):
        carries = []
        while len(words) > 1:
            third = len(words) // 3
            if third:
                a, b, c = words[:third], words[third : 2 * third], words[2 * third : 3 * third]
                half = a ^ b
                carries.append((a & b) | (half & c))
                words = np.concatenate((half ^ c, words[3 * third :]))
            else:
                carries.append(words[:1] & words[1:])
                words = words[:1] ^ words[1:]
        counts += ((words[0] >> places) & np.uint32(1)).astype(np.int64) << weight
        words = np.concatenate(carries) if carries else words[:0]
        weight += 1
    return counts


_MEASURED = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("text_key", pa.binary()), ("fails", pa.int32())])


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, fails = [], []
        for text in batch.column(2):
            text = text.as_py() or b""
            keys.append(hashlib.blake2b(text, digest_size=16).digest())
            fails.append(text_failures(text))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.array(fails, pa.int32())], schema=_MEASURED
        )


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """Id, part, digest and failed filters of every row; the texts are read once."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.col(text_col).cast("binary").alias("_text"),
    )
    narrow = stage(rows.mapInArrow(_measure, "doc_id long, part string, text_key binary, fails int"), "measured")
    known, unknown = narrow.where("doc_id IS NOT NULL"), narrow.where("doc_id IS NULL")
    firsts = known.groupBy("text_key").agg(F.min("doc_id").alias("first_id")).withColumnRenamed("text_key", "first_key")
    met = known.join(firsts, (F.col("text_key") == F.col("first_key")) & (F.col("doc_id") == F.col("first_id")), "left")
    copied = F.when(F.col("first_id").isNull(), F.lit(1 << COPY)).otherwise(F.lit(0))
    failing = met.select("doc_id", "part", F.col("fails").bitwiseOR(copied).alias("fails"))
    return failing.unionByName(unknown.select("doc_id", "part", "fails"))


def _popcount(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch, part and label class the survivors of every subset."""
    for batch in batches:
        if not batch.num_rows:
            continue
        parts = batch.column(0).dictionary_encode()
        names, codes = parts.dictionary, parts.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        group = codes * 4 + batch.column(1).to_numpy(zero_copy_only=False)
        order = np.argsort(group, kind="stable")
        words = survival_words(batch.column(2).to_numpy(zero_copy_only=False)[order])
        keys, starts = np.unique(group[order], return_index=True)
        counts = [positional_popcounts(w) for w in np.split(words, starts[1:])]
        yield pa.RecordBatch.from_arrays(
            [
                names.take(pa.array(keys // 4)),
                pa.array(keys % 4, pa.int32()),
                pa.array([c.tolist() for c in counts], pa.list_(pa.int64())),
            ],
            names=["part", "label", "survivors"],
        )


def survivors(failing: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part the survivors of all 32 subsets: of all rows, of good and of toxic ones."""
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("_id")).agg(
        (F.max((F.coalesce("quality", F.lit(0)) == 1).cast("int")) + 2 * F.max((F.coalesce("toxic", F.lit(0)) == 1).cast("int"))).alias("label")
    )
    known = failing.where("doc_id IS NOT NULL").join(marks, F.col("doc_id") == F.col("_id"), "left")
    rows = known.select("part", F.coalesce("label", F.lit(0)).alias("label"), "fails").unionByName(
        failing.where("doc_id IS NULL").select("part", F.lit(0).alias("label"), "fails")
    )
    counted = rows.mapInArrow(_popcount, "part string, label int, survivors array<long>")

    def summed(of: Column) -> Column:
        return F.array(*[F.coalesce(F.sum(F.when(of, F.get("survivors", F.lit(s)))), F.lit(0)).cast("long") for s in range(SUBSETS)])

    return counted.groupBy("part").agg(
        summed(F.lit(True)).alias("all"),
        summed(F.col("label").bitwiseAND(1) != 0).alias("good"),
        summed(F.col("label").bitwiseAND(2) != 0).alias("toxic"),
    )


_STEP = pa.schema(
    [("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32())]
    + [(c, pa.int64()) for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")]
)


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every step of every order, from the survivors of the subsets before and after it."""
    orders = list(permutations(range(len(FILTERS))))
    chosen = np.array(orders)
    after = np.cumsum(1 << chosen, axis=1)
    before = after - (1 << chosen)
    named = ["".join(FILTERS[f] for f in order) for order in orders]
    everything = SUBSETS - 1
    for batch in batches:
        for part, *counts in zip(*[c.to_pylist() for c in batch.columns]):
            whole, good, toxic = (np.array(c, dtype=np.int64) for c in counts)
            removed = whole[before] - whole[after]
            failing = whole[0] - whole[1 << chosen]
            alone = whole[everything - (1 << chosen)] - whole[everything]
            shares = np.array([removed[chosen == f].sum() for f in range(len(FILTERS))])
            values = [
                whole[after], removed, failing - removed, alone,
                good[before] - good[after], toxic[before] - toxic[after], shares[chosen],
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * chosen.size, pa.string()),
                    pa.array(np.repeat(named, len(FILTERS)), pa.string()),
                    pa.array(np.tile(np.arange(1, len(FILTERS) + 1), len(orders)), pa.int32()),
                    *[pa.array(v.ravel()) for v in values],
                ],
                schema=_STEP,
            )


def audit(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """One row per part, order of the filters and step."""
    counts = survivors(measured(docs, **columns), labels)
    longs = ", ".join(f"{f.name} long" for f in list(_STEP)[3:])
    return counts.mapInArrow(_steps, f"part string, filter_order string, step int, {longs}")
