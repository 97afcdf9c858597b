"""Exact top-k search by inner product with MaxScore over an inverted index.

A vector is a document whose terms are its dimensions, one for positive and one for negative components; the
weight is the component's size.  The index is a table of blocks of about ``BLOCK_POSTINGS`` postings: per
term a list of places and weights, with the highest weight.  To a query a term of equal sign adds, at most its
own size times that highest weight; one of the other sign takes away, so its bound is 0.

In a block, a query first scores a few documents with the highest weights, which gives a score that the
best ``k`` surely reach.  Terms are ordered by bound.  The longest tail whose bounds together stay below that
score is non-essential: a document that occurs in no essential list cannot be among the best.  The essential
lists are traversed, the others are probed only for documents that are still competitive, that is, whose sum
so far and whose remaining bounds reach the score.  Documents that tie with it stay.

Queries come in chunks of about ``CHUNK_COMPONENTS`` components; each pair of chunk and block is a group of its
own, so memory is bounded whatever the number of rows or queries.  Blocks' best are merged by a ranking that
Spark limits in every task first.  Nothing is sampled: the result is exact.

Vectors that are null, or hold null or non-finite components (or some of 2^40 and more), take no part; those that
are shorter lack the further terms.  Ids name rows: rows with a query's id are its own and no candidates; each of
several rows with the same id that ask is a query.  A null id is a candidate, last among ties, and never asks
unless the caller makes it.  Further columns do no harm.  Scores beyond a long are ranked as they are and given
as the nearest long.  An empty table, or one without queries, gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.vectors import flat_of, integer_vectors
from tagloom.session import stage

BLOCK_POSTINGS = 1 << 19
CHUNK_COMPONENTS = 1 << 15
# Terms, and documents of each, that give the first score to beat.
CHAMPION_TERMS, CHAMPIONS = 4, 16
# A list is probed for candidates that are fewer than one in this many of its postings.
PROBE = 16
_WHOLE = 2.0**62

_BLOCK = "shard int, ids array<long>, terms array<long>, starts array<long>, places array<long>, weights array<long>"
_CHUNK = "chunk int, ids array<long>, lengths array<long>, x array<long>"
_FOUND = pa.schema([("chunk", pa.int32()), ("place", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("over", pa.string())])


class Block:
    """The inverted index of some vectors."""

    def __init__(self, ids: pa.Array, terms: np.ndarray, starts: np.ndarray, places: np.ndarray, weights: np.ndarray):
        self.known = ids.is_valid().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        self.starts, self.places, self.weights = starts, places, weights
        self.number = {int(t): n for n, t in enumerate(terms)}
        lists = starts[:-1]
        self.highest = np.maximum.reduceat(weights, lists) if len(weights) else np.zeros(0, dtype=np.int64)
        self._best: dict[int, np.ndarray] = {}

    def postings(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        low, high = self.starts[n], self.starts[n + 1]
        return self.places[low:high], self.weights[low:high]

    def champions(self, n: int) -> np.ndarray:
        if n not in self._best:
            places, weights = self.postings(n)
            top = np.argpartition(-weights, CHAMPIONS)[:CHAMPIONS] if len(weights) > CHAMPIONS else slice(None)
            self._best[n] = places[top]
        return self._best[n]

    @staticmethod
    def of(ids: pa.Array, lengths: np.ndarray, flat: np.ndarray) -> Block:
        return Block(ids, *inverted(lengths, flat))


def inverted(lengths: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, ...]:
    """Terms, starts of their lists, places and weights.

    >>> [a.tolist() for a in inverted(np.array([2, 2]), np.array([3, -1, 0, -2]))]
    [[0, 3], [0, 1, 3], [0, 0, 1], [3, 1, 2]]
    """
    owner = np.repeat(np.arange(len(lengths)), lengths)
    dims = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    filled = flat != 0
    term = (2 * dims + (flat < 0))[filled]
    order = np.argsort(term, kind="stable")
    terms, starts = np.unique(term[order], return_index=True)
    return terms, np.append(starts, len(term)), owner[filled][order], np.abs(flat[filled])[order]


def search(block: Block, x: np.ndarray, k: int, own: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of a query's best ``k`` in a block; ``own`` is the id that is left out."""
    dims = np.flatnonzero(x)
    adding, taking = [], []
    for d in dims.tolist():
        value = int(x[d])
        for term, group in ((2 * d + (value < 0), adding), (2 * d + (value > 0), taking)):
            if (n := block.number.get(term)) is not None:
                group.append((abs(value) * int(block.highest[n]), n, abs(value)))
    adding.sort(reverse=True)
    taking.sort(reverse=True)
    # Sums beyond a long are made of Python's integers.
    kind = np.int64 if sum(b for b, _, _ in adding + taking) < _WHOLE else object
    allowed = np.ones(len(block.ids), dtype=bool)
    if own is not None:
        allowed = ~(block.known & (block.ids == own))
    floor = _floor(block, adding, taking, k, allowed, kind)

    left = sum(b for b, _, _ in adding)
    total = np.zeros(len(block.ids), dtype=kind)
    essential = 0
    while essential < len(adding) and (floor is None or left >= floor):
        bound, n, size = adding[essential]
        places, weights = block.postings(n)
        total[places] += weights.astype(kind, copy=False) * size
        left -= bound
        essential += 1
    if floor is None:
        alive = np.flatnonzero(allowed)
    else:
        # What no essential list holds has a bound below the floor.
        alive = np.flatnonzero(allowed & (total + left >= floor))
    others = sorted([(*t, 1) for t in adding[essential:]] + [(*t, -1) for t in taking], reverse=True)
    for bound, n, size, sign in others:
        places, weights = block.postings(n)
        if len(alive) * PROBE > len(places):
            total[places] += weights.astype(kind, copy=False) * (sign * size)
        else:
            at = np.minimum(np.searchsorted(places, alive), len(places) - 1)
            met = places[at] == alive
            total[alive[met]] += weights[at[met]].astype(kind, copy=False) * (sign * size)
        if sign > 0:
            left -= bound
        if floor is not None:
            alive = alive[total[alive] + left >= floor]
    return _best(block, alive, total[alive], k)


def _floor(block: Block, adding: list, taking: list, k: int, allowed: np.ndarray, kind) -> int | None:
    """A positive score that ``k`` allowed documents reach, or None."""
    if not adding:
        return None
    some = np.unique(np.concatenate([block.champions(n) for _, n, _ in adding[:CHAMPION_TERMS]]))
    some = some[allowed[some]]
    if len(some) < k:
        return None
    scores = np.zeros(len(some), dtype=kind)
    for group, sign in ((adding, 1), (taking, -1)):
        for _, n, size in group:
            places, weights = block.postings(n)
            at = np.minimum(np.searchsorted(places, some), len(places) - 1)
            scores += np.where(places[at] == some, weights[at], 0).astype(kind, copy=False) * (sign * size)
    reached = int(np.sort(scores)[-k])
    return reached if reached > 0 else None


def _best(block: Block, places: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    if len(places) > 4 * k and scores.dtype != object:
        near = scores >= np.partition(scores, -k)[-k]
        places, scores = places[near], scores[near]
    order = sorted(range(len(places)), key=lambda i: (-scores[i], not block.known[places[i]], block.ids[places[i]]))[:k]
    return places[order], scores[order]


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a partition as one block."""
    held = [b for b in batches if b.num_rows]
    if held:
        table = pa.Table.from_batches(held)
        columns = inverted(*flat_of(table.column("x")))
        lists = [table.column("vec_id").combine_chunks(), *map(pa.array, columns)]
        yield _one_row("shard", table.column("shard")[0].as_py(), ["ids", "terms", "starts", "places", "weights"], lists)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The queries of a partition as one chunk."""
    held = [b for b in batches if b.num_rows]
    if held:
        table = pa.Table.from_batches(held)
        lengths, flat = flat_of(table.column("x"))
        lists = [table.column("vec_id").combine_chunks(), pa.array(lengths), pa.array(flat)]
        yield _one_row("chunk", table.column("chunk")[0].as_py(), ["ids", "lengths", "x"], lists)


def _one_row(key: str, number: int, names: list[str], lists: list[pa.Array]) -> pa.RecordBatch:
    columns = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v.cast(pa.int64())) for v in lists]
    return pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), *columns], names=[key, *names])


def _search_cell(k: int):
    def run(chunks: pa.Table, blocks: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if chunks.num_rows and blocks.num_rows:
            row = {c: blocks.column(c)[0].values for c in blocks.column_names if c not in ("shard", "chunk")}
            ids = row.pop("ids")
            block = Block(ids, *[row[c].to_numpy(zero_copy_only=False) for c in ("terms", "starts", "places", "weights")])
            number = chunks.column("chunk")[0].as_py()
            asked = chunks.column("ids")[0].as_py()
            ends = np.cumsum(chunks.column("lengths")[0].values.to_numpy(zero_copy_only=False))
            flat = chunks.column("x")[0].values.to_numpy(zero_copy_only=False)
            for place, query_id in enumerate(asked):
                x = flat[ends[place - 1] if place else 0 : ends[place]]
                places, scores = search(block, x, k, query_id)
                for at, score in zip(places.tolist(), scores.tolist()):
                    whole = max(-(1 << 63), min((1 << 63) - 1, score))
                    # Decimal digits beyond a long, for the merge.
                    over = str(score) if whole != score else None
                    out.append((number, place, query_id, int(block.ids[at]) if block.known[at] else None, whole, over))
        columns = list(zip(*out)) if out else [[]] * len(_FOUND)
        return pa.table([pa.array(c, t) for c, t in zip(columns, _FOUND.types)], schema=_FOUND)

    return run


def _parts(rows: DataFrame, size: int) -> int:
    """Number of parts of about ``size`` components."""
    total = rows.agg(F.coalesce(F.sum(F.greatest(F.size("x"), F.lit(1))), F.lit(0))).first()[0]
    return max(1, -(-total // size))


def index_blocks(vectors: DataFrame, postings: int = BLOCK_POSTINGS) -> tuple[DataFrame, int]:
    """The stored index of ``vectors(vec_id, x)`` and its number of blocks."""
    shards = _parts(vectors, postings)
    dealt = vectors.repartition(shards).withColumn("shard", F.spark_partition_id())
    return stage(dealt.mapInArrow(_index, _BLOCK), "postings"), shards


def top_k(
    rows: DataFrame,
    asking: Column,
    k: int = 5,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score`` of the best ``k`` of each row where ``asking`` holds.

    ``asking`` is a condition on ``vec_id``.
    """
    vectors = stage(integer_vectors(rows, scale, id_col=id_col, vector_col=vector_col), "vectors")
    index, shards = index_blocks(vectors)
    queries = vectors.where(asking)
    chunks = _parts(queries, CHUNK_COMPONENTS)
    dealt = queries.repartition(chunks).withColumn("chunk", F.spark_partition_id())
    packed = stage(dealt.mapInArrow(_pack, _CHUNK), "queries")

    def counted(number: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(number - 1)))

    cell = ["chunk", "shard"]
    found = (
        packed.withColumn("shard", counted(shards))
        .groupBy(*cell)
        .cogroup(index.withColumn("chunk", counted(chunks)).groupBy(*cell))
        .applyInArrow(_search_cell(k), "chunk int, place long, query_id long, vec_id long, score long, over string")
    )
    best = Window.partitionBy("chunk", "place").orderBy(
        F.coalesce(F.col("over").cast("decimal(38,0)"), F.col("score").cast("decimal(38,0)")).desc(), F.col("vec_id").asc_nulls_last()
    )
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score")
