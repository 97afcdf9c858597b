"""Near-dedup by b-bit MinHash.

A document's set are its distinct word shingles, hashed to 64 bits.  ``HASHES`` minima are taken; bands
of up to ``ROWS`` whole minima, as the threshold allows, give the candidates, and of each minimum the low ``BITS`` bits are kept, packed
into one short signature.  Two signatures are compared by counting equal lanes; as unequal minima
agree in their low bits by chance, the share of equal lanes is corrected for that.  A pair whose
estimate reaches ``threshold - SLACK`` is confirmed on the full sets.

Recall: a pair at the threshold shares no band less than once in a million (bands of 4 minima from 0.7 on,
2 at 0.6, 1 at 0.4), and at 0.8 the estimate falls by ``SLACK`` (six standard deviations) once in 1e9, at 0.5 (four)
once in 2e5.

Groups do not explode.  Documents with equal sets are one member throughout.  A bucket's members are
joined by walking from member to member over those not yet reached, which gives a spanning
forest, at most one edge a member, never all pairs.  Buckets larger than ``CHUNK`` members are dealt to
several tasks, each pair of chunks to one.  What is joined so far makes families; every link lies
inside a family, and each full set is sent once, to its family, to find the true links in the same way.

Null texts and texts without words have an empty set and are linked with nothing.  Repeated rows are
copies; rows with the same id count as one document.  Rows with a null id keep to themselves.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import all_columns, fresh_name, join_groups, numbered_rows
from tagloom.llm.components import connected_components
from tagloom.session import stage

HASHES, BITS = 128, 4
# Most minima of a band, and the share of pairs at the threshold that may meet in no band.
ROWS, MISSED = 4, 1e-6
SLACK = 0.2
CHUNK = 4096
# Shingles that the sets of one task of a family may hold.
CHUNK_SHINGLES = 2_000_000
# Bits of the bitmap that tells which texts may have a candidate.
MARKS = 1 << 25
# Bytes of text hashed at once; bounds the memory of a task.
PIECE_BYTES = 1 << 19
SEED = 20_240_501

_U = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class _Hashing:
    """Constants of the hash functions, drawn once from the seed."""

    def __init__(self) -> None:
        draw = np.random.default_rng(SEED)
        self.byte = draw.integers(1, 1 << 63, 256, dtype=_U)
        lower = np.arange(256)
        lower[65:91] += 32
        self.byte = self.byte[lower]
        self.base = int(draw.integers(1 << 62, 1 << 63)) | 1
        self.times = draw.integers(1, 1 << 63, HASHES, dtype=_U) * _U(2) + _U(1)
        self.plus = draw.integers(1, 1 << 63, HASHES, dtype=_U)
        self.powers = np.ones(1, dtype=_U)
        self.inverse = np.ones(1, dtype=_U)

    def reach(self, length: int) -> None:
        if len(self.powers) < length:
            for name, base in (("powers", self.base), ("inverse", pow(self.base, -1, 1 << 64))):
                steps = np.full(length, base, dtype=_U)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))


_hashing: list[_Hashing] = []


def _constants() -> _Hashing:
    if not _hashing:
        _hashing.append(_Hashing())
    return _hashing[0]


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingle_sets(texts: Iterable[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingles of each text, words lower-cased (A-Z only)."""
    sets: list[np.ndarray] = []
    piece: list[bytes] = []
    held = 0
    for text in texts:
        if piece and held + len(text) > PIECE_BYTES:
            sets += _piece_sets(piece, size)
            piece, held = [], 0
        piece.append(text)
        held += len(text) + 1
    return sets + (_piece_sets(piece, size) if piece else [])


def _piece_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    fixed = _constants()
    data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    fixed.reach(len(data) + 1)
    blank = _SPACE[data]
    edge = np.diff(np.concatenate(([True], blank)).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    # Hash of a word: its bytes' values by powers of the base, from a running sum over the piece.
    upto = np.concatenate((np.zeros(1, dtype=_U), np.cumsum(fixed.byte[data] * fixed.powers[: len(data)])))
    words = _mix((upto[ends] - upto[starts]) * fixed.inverse[starts])
    limits = np.cumsum([0] + [len(t) + 1 for t in texts])
    first = np.searchsorted(starts, limits)
    if len(words) >= size:
        rolled = np.zeros(len(words) - size + 1, dtype=_U)
        for n in range(size):
            rolled = rolled * _U(0x9E3779B97F4A7C15) + words[n : len(words) - size + 1 + n]
        rolled = _mix(rolled)
    sets = []
    for low, high in zip(first[:-1], first[1:]):
        if high - low >= size:
            sets.append(np.unique(rolled[low : high - size + 1]))
        elif high > low:
            whole = np.full(1, high - low, dtype=_U)
            for word in words[low:high]:
                whole = whole * _U(0x9E3779B97F4A7C15) + word
            sets.append(_mix(whole))
        else:
            sets.append(np.zeros(0, dtype=_U))
    return sets


def minima(shingles: np.ndarray) -> np.ndarray:
    fixed = _constants()
    lowest = np.full(HASHES, np.iinfo(_U).max, dtype=_U)
    for at in range(0, len(shingles), 4096):
        hashed = fixed.times[:, None] * shingles[None, at : at + 4096] + fixed.plus[:, None]
        lowest = np.minimum(lowest, hashed.min(axis=1))
    return lowest


def packed(lowest: np.ndarray) -> np.ndarray:
    """The low bits of minima, 64 / BITS lanes to a word."""
    lanes = (lowest & _U((1 << BITS) - 1)).reshape(-1, 64 // BITS)
    return (lanes << (np.arange(64 // BITS, dtype=_U) * _U(BITS))).sum(axis=1, dtype=_U)


_ONES = _U(sum(1 << (BITS * n) for n in range(64 // BITS)))


def estimate(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Similarity of one packed signature and each of many, corrected for chance agreement."""
    apart = one ^ many
    lanes = apart
    for n in range(1, BITS):
        lanes = lanes | (apart >> _U(n))
    unequal = np.bitwise_count(lanes & _ONES).sum(axis=-1, dtype=np.int64)
    chance = 1.0 / (1 << BITS)
    return ((1.0 - unequal / HASHES) - chance) / (1.0 - chance)


_SIGNATURE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_shingles", pa.int64()),
        ("set_key", pa.string()),
        ("bits", pa.binary()),
        ("bands", pa.list_(pa.int64())),
    ]
)


def band_rows(similarity: float) -> int:
    """The most minima of a band at which pairs of that similarity are found.

    >>> [band_rows(s) for s in (0.85, 0.8, 0.6, 0.4)]
    [4, 4, 2, 1]
    """
    for rows in range(ROWS, 1, -1):
        if (1 - similarity**rows) ** (HASHES // rows) <= MISSED:
            return rows
    return 1


def _sign(size: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = HASHES // rows
        band_of = np.arange(number, dtype=_U)
        for batch in batches:
            ids = batch.column(0)
            sets = shingle_sets((t.as_py() or b"" for t in batch.column(1)), size)
            keys, bits, bands = [], [], []
            for shingles in sets:
                lowest = minima(shingles)
                by_band = lowest[: number * rows].reshape(number, rows)
                rolled = band_of
                for n in range(rows):
                    rolled = _mix(rolled * _U(0x9E3779B97F4A7C15) + by_band[:, n])
                bits.append(packed(lowest).tobytes())
                bands.append(rolled.view(np.int64) if len(shingles) else np.zeros(0, dtype=np.int64))
                one, two = shingles.sum(dtype=_U), _mix(shingles).sum(dtype=_U)
                keys.append(f"{int(one):x}.{int(two):x}.{len(shingles)}")
            offsets = np.cumsum([0] + [len(b) for b in bands]).astype(np.int32)
            flat = np.concatenate(bands) if bands else np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(keys, pa.string()),
                    pa.array(bits, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                ],
                schema=_SIGNATURE,
            )

    return run


def signatures(
    docs: DataFrame, size: int, similarity: float, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Set size, digest of the set, packed low bits and band keys of every row."""
    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("binary"))
    return rows.mapInArrow(
        _sign(size, band_rows(similarity)), "doc_id long, n_shingles long, set_key string, bits binary, bands array<long>"
    )


def grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Whole groups of a partition sorted by its first ``keys`` columns, several at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        last = batch.num_rows
        same = np.ones(batch.num_rows, dtype=bool)
        for column in columns:
            same &= column == column[-1]
        # First row of the batch's last group, which may go on in the next batch.
        cut = last - int(np.argmin(same[::-1])) if not same.all() else 0
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        elif held and any(held[0].column(k)[0] != batch.column(k)[0] for k in range(keys)):
            yield pa.Table.from_batches(held)
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def _bounds(table: pa.Table, keys: int) -> list[int]:
    fresh = np.zeros(table.num_rows, dtype=bool)
    for k in range(keys):
        column = table.column(k).to_numpy()
        fresh[1:] |= column[1:] != column[:-1]
    return [0, *np.flatnonzero(fresh).tolist(), table.num_rows]


def _forest(count: int, near) -> Iterator[tuple[int, int]]:
    """Edges of a spanning forest; ``near(i, rest)`` says which of ``rest`` are linked with i."""
    rest = np.arange(count)
    while len(rest):
        root, rest = int(rest[0]), rest[1:]
        queue = [root]
        while queue and len(rest):
            hit = near(queue.pop(), rest)
            reached, rest = rest[hit], rest[~hit]
            for other in reached.tolist():
                yield root, other
            queue += reached.tolist()


_EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _edge_batch(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    pairs = np.array(sorted(set(edges)), dtype=np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=_EDGE)


def _estimated_links(cutoff: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, 3):
            ids = table.column(3).to_numpy()
            bits = np.frombuffer(b"".join(table.column(4).to_pylist()), dtype=_U).reshape(len(ids), -1)
            bounds = _bounds(table, 3)
            edges: list[tuple[int, int]] = []
            # Two members are the common case: compare all neighbours at once.
            next_to = estimate(bits[:-1], bits[1:]) >= cutoff
            for low, high in zip(bounds[:-1], bounds[1:]):
                if next_to[low : high - 1].all():
                    edges += [(int(ids[low]), int(i)) for i in ids[low + 1 : high]]
                elif high - low > 2:
                    own = bits[low:high]
                    forest = _forest(high - low, lambda i, rest: estimate(own[i], own[rest]) >= cutoff)
                    edges += [(int(ids[low + i]), int(ids[low + j])) for i, j in forest]
            if edges:
                yield _edge_batch(edges)

    return run


def _confirmed_links(size: int, parts: tuple[int, int]):
    over, under = parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, 3):
            ids = table.column(3).to_numpy()
            bounds = _bounds(table, 3)
            edges: list[tuple[int, int]] = []
            for low, high in zip(bounds[:-1], bounds[1:]):
                texts = table.column(4).slice(low, high - low).to_pylist()
                sets = shingle_sets([t or b"" for t in texts], size)
                forest = _forest(high - low, _exact(sets, over, under))
                edges += [(int(ids[low + i]), int(ids[low + j])) for i, j in forest]
            if edges:
                yield _edge_batch(edges)

    return run


def _exact(sets: list[np.ndarray], over: int, under: int):
    """Exact test of one set against others, by the members that each shingle has."""
    sizes = np.array([len(s) for s in sets])
    if len(sets) == 2:
        shared = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        linked = shared * under >= over * (sizes.sum() - shared)
        return lambda i, rest: np.full(len(rest), linked)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(flat, kind="stable")
    _, begin, number, count = np.unique(flat[order], return_index=True, return_inverse=True, return_counts=True)
    at = np.empty(len(flat), dtype=np.int64)
    at[order] = number
    holders = owner[order]
    limits = np.cumsum(np.concatenate(([0], sizes)))

    def near(i: int, rest: np.ndarray) -> np.ndarray:
        own = at[limits[i] : limits[i + 1]]
        lengths = count[own]
        ends = np.cumsum(lengths)
        places = np.repeat(begin[own] - ends + lengths, lengths) + np.arange(ends[-1])
        shared = np.bincount(holders[places], minlength=len(sets))[rest]
        return shared * under >= over * (sizes[i] + sizes[rest] - shared)

    return near


def _dealt(rows: DataFrame, group: str, member: str, chunks: str) -> DataFrame:
    """Deal a group's rows to pairs of chunks, so that every two members meet in some task."""
    mine = F.pmod(F.xxhash64(member), F.col(chunks))
    each = rows.withColumn("_mine", mine).withColumn(
        "_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col(chunks) - 1))
    )
    return each.withColumn("_low", F.least("_mine", "_other")).withColumn(
        "_high", F.greatest("_mine", "_other")
    ).select(group, "_low", "_high", *[c for c in rows.columns if c not in (group, chunks)])


def _likely(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rows whose ``node`` may be among ``nodes``, by a bitmap of hashed ids.

    Keeps most texts without a candidate out of the next shuffle.  The bitmap has ``MARKS`` bits at most,
    so it can be broadcast; when it fills up, more rows pass, and the join that follows is exact.
    """
    mark = F.pmod(F.xxhash64("node"), F.lit(MARKS))

    def placed(df: DataFrame) -> DataFrame:
        return df.withColumn("_mark", mark).selectExpr(
            "*", "_mark div 64 AS _word", "shiftleft(1L, cast(_mark % 64 AS int)) AS _bit"
        )

    words = placed(nodes.select("node")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    met = placed(rows).join(F.broadcast(words), "_word")
    return met.where(F.col("_bit").bitwiseAND(F.col("_bits")) != 0).select(*rows.columns)


def near_duplicates(
    docs: DataFrame,
    size: int = 5,
    threshold: tuple[int, int] = (4, 5),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Every row with its set size, the smallest id reachable over links, and whether it stays.

    Two documents are linked where shared * threshold[1] >= threshold[0] * united.
    """
    over, under = threshold
    signed = stage(signatures(docs, size, over / under, id_col, text_col), "signatures")
    filled = signed.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    sets = stage(
        filled.groupBy("set_key").agg(
            F.min("doc_id").alias("rep"),
            F.count(F.lit(1)).alias("copies"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("bits").alias("bits"),
            F.first("bands").alias("bands"),
        ),
        "sets",
    )
    keyed = sets.select("rep", F.explode("bands").alias("bucket"))
    shared = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    met = keyed.join(shared, "bucket").join(sets.select("rep", "bits"), "rep").select(
        "bucket", "rep", "bits", F.ceil(F.col("members") / CHUNK).alias("chunks")
    )
    dealt = _dealt(met, "bucket", "rep", "chunks")
    task = ["bucket", "_low", "_high"]
    candidates = (
        dealt.repartition(*task)
        .sortWithinPartitions(*task, "rep")
        .mapInArrow(_estimated_links(over / under - SLACK), "a long, b long")
    )
    families = stage(connected_components(candidates), "families")
    members = families.join(sets.select(F.col("rep").alias("node"), "n_shingles"), "node")
    loads = members.groupBy("root").agg(
        F.greatest(
            F.ceil(F.count(F.lit(1)) / CHUNK), F.ceil(F.sum("n_shingles") / CHUNK_SHINGLES)
        ).alias("chunks")
    )
    texts = docs.select(F.col(id_col).cast("long").alias("node"), F.col(text_col).cast("binary").alias("_text"))
    full = _likely(texts, families).join(families, "node").join(loads, "root").select("root", "node", "_text", "chunks")
    pieces = _dealt(full, "root", "node", "chunks")
    task = ["root", "_low", "_high"]
    links = (
        pieces.repartition(*task)
        .sortWithinPartitions(*task, "node")
        .mapInArrow(_confirmed_links(size, threshold), "a long, b long")
    )
    roots = connected_components(links)
    groups = sets.join(roots, F.col("rep") == F.col("node"), "left").select(
        "set_key", "copies", F.coalesce("root", "rep").alias("root")
    )
    rows = signed.select("doc_id", "n_shingles", "set_key")
    found = join_groups(rows, groups, "set_key", "copies", "doc_id")
    own = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    return found.select(
        "doc_id",
        "n_shingles",
        F.when(own, F.col("doc_id")).otherwise(F.col("root")).alias("component_id"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_first(
    docs: DataFrame,
    size: int = 5,
    threshold: tuple[int, int] = (4, 5),
    id_col: str = "doc_id",
    text_col: str = "text",
    stored: bool = False,
) -> DataFrame:
    """One row of each group: that with the smallest id, null last; of several rows with it any one.

    Every row is a document of its own, also those whose ids are null or repeated; ``stored`` as in
    ``common.numbered_rows``.
    """
    rows, row = numbered_rows(docs, stored)
    found = near_duplicates(rows, size, threshold, row, text_col)
    others = found.where(~F.col("kept")).select(F.col("doc_id").alias("member"), F.col("component_id").alias("root"))
    firsts = others.select("root").distinct().select(F.col("root").alias("member"), "root")
    names = rows.select(F.col(row).alias("named"), F.col(id_col).alias("name"))
    members = stage(
        others.unionByName(firsts).join(names, F.col("member") == F.col("named")).select("root", "member", "name"), "members"
    )
    first = members.groupBy("root").agg(F.min(F.struct(F.col("name").isNull().alias("none"), "name", "member")).alias("first"))
    gone = members.select("member").join(first.select(F.col("first.member").alias("member")), "member", "left_anti")
    other = fresh_name(rows, "_other")
    return rows.join(gone.select(F.col("member").alias(other)), F.col(row) == F.col(other), "left_anti").select(*all_columns(docs))
