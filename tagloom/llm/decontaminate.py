"""Benchmark decontamination with an Aho-Corasick automaton.

Texts are normalised byte by byte: A-Z to lower case, all other ASCII but letters and digits to spaces,
so offsets in the normalised text are offsets in the original.  Words are what lies between spaces.
The patterns are the windows of ``WINDOW`` words of the benchmark items (shorter items are one
window), spaces on both sides.  A text is scanned once; all windows that occur are found with their places.

The benchmark need not be small, and documents are read once whatever its size.  Windows of up to
``BLOCK_BYTES`` make one automaton, which is sent to the workers.  More are dealt to blocks of that size by hash.
Then the one scan keeps the stretches of a text whose window hashes may be a block's, by a bitmap of at
most ``MARKS`` bits; only these go on, to their blocks, each of which builds its automaton from the stored windows and
scans them.  A block with many stretches is dealt to several tasks.  Neither windows nor documents pass through
the driver, and documents are never shuffled.

Null texts have no words, windows or hits.  An item without words or with a null text has no window;
windows of an item with a null id hit but name no item.  Items with equal ids are one item.  Repeated rows
are all reported; an empty benchmark hits nothing.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import fresh_name
from tagloom.session import stage

WINDOW = 10
BLOCK_BYTES = 4 << 20
# Most bits of the bitmap of window hashes, and bits of it a window should have.
MARKS, MARKS_EACH = 1 << 28, 16
# Bytes of stretches that one task of a block scans.
STRETCH_BYTES = 64 << 20

_KEPT = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _KEPT else 0x20 for b in range(256))
_WORD = re.compile(rb"[^ ]+")


def words_of(text: bytes) -> list[bytes]:
    """The normalised words of UTF-8 bytes.

    >>> words_of("It's NOON, às 12".encode()) == [b"it", b"s", b"noon", "às".encode(), b"12"]
    True
    """
    return text.translate(_TABLE).split()


def windows_of(text: bytes, size: int = WINDOW) -> list[bytes]:
    words = words_of(text)
    if not words:
        return []
    return [b" ".join(words[n : n + size]) for n in range(max(1, len(words) - size + 1))]


_WINDOW = pa.schema([("item", pa.string()), ("pattern", pa.binary())])


def _cut(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [
                (item, w)
                for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for w in set(windows_of(text or b"", size))
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.binary())],
                schema=_WINDOW,
            )

    return run


def benchmark_windows(items: DataFrame, size: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Every distinct window once, with the ids of its items and its block."""
    rows = items.select(F.col(id_col).cast("string"), F.col(text_col).cast("binary"))
    cut = rows.mapInArrow(_cut(size), "item string, pattern binary")
    windows = stage(cut.groupBy("pattern").agg(F.collect_set("item").alias("items")), "windows")
    total = windows.agg(F.coalesce(F.sum(F.octet_length("pattern")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // BLOCK_BYTES))
    return windows.withColumn("block", F.pmod(F.xxhash64("pattern"), F.lit(blocks)))


_automata: dict[int, ahocorasick.Automaton] = {}


def _automaton(patterns) -> ahocorasick.Automaton:
    """The automaton of a broadcast block; a worker holds one at a time."""
    if patterns.id not in _automata:
        _automata.clear()
        _automata[patterns.id] = _built([pattern for pattern, _ in patterns.value])
    return _automata[patterns.id]


def _built(patterns: list[bytes]) -> ahocorasick.Automaton:
    built = ahocorasick.Automaton()
    for number, pattern in enumerate(patterns):
        # Bytes as Latin-1, one character each.
        built.add_word(f" {pattern.decode('latin-1')} ", (number, len(pattern)))
    built.make_automaton()
    return built


class _Patterns:
    """A broadcast block of windows with a number that names it."""

    def __init__(self, broadcast):
        self.id = broadcast._jbroadcast.id()
        self._broadcast = broadcast

    @property
    def value(self):
        return self._broadcast.value

    def __getstate__(self):
        return (self.id, self._broadcast)

    def __setstate__(self, state):
        self.id, self._broadcast = state


_SPAN = pa.struct([("from_word", pa.int64()), ("to_word", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])
_HITS = [("n_words", pa.int64()), ("spans", pa.list_(_SPAN)), ("items", pa.list_(pa.string()))]


def scan_text(text: bytes, automaton: ahocorasick.Automaton) -> tuple[int, list[tuple[int, int, int, int]], set[int]]:
    """Number of words, runs of hit words with their character offsets, patterns found."""
    flat = text.translate(_TABLE)
    words = flat.split()
    if not words or not len(automaton):
        return len(words), [], set()
    line = (b" " + b" ".join(words) + b" ").decode("latin-1")
    found: set[int] = set()
    runs: list[list[int]] = []
    hits = []
    for end, (number, length) in automaton.iter(line):
        found.add(number)
        hits.append((end - length, end))
    for begin, end in sorted(hits):
        if runs and begin < runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([begin, end])
    if not runs:
        return len(words), [], found
    places = [m.span() for m in _WORD.finditer(flat)]
    begins = np.cumsum([1] + [len(w) + 1 for w in words])
    spans = []
    for begin, end in runs:
        low, high = np.searchsorted(begins, [begin, end])
        start = len(text[: places[low][0]].decode())
        spans.append((int(low), int(high), start, start + len(text[places[low][0] : places[high - 1][1]].decode())))
    return len(words), spans, found


def _scan(patterns: _Patterns, kept: int):
    """``kept`` leading columns pass through; the last one is the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(patterns)
        items = [i for _, i in patterns.value]
        for batch in batches:
            counts, spans, named = [], [], []
            for text in batch.column(kept):
                n, runs, found = scan_text(text.as_py() or b"", automaton)
                counts.append(n)
                spans.append([dict(zip(("from_word", "to_word", "start", "end"), r)) for r in runs])
                named.append(sorted({i for number in found for i in items[number]}))
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(k) for k in range(kept)],
                    *[pa.array(v, t) for v, (_, t) in zip((counts, spans, named), _HITS)],
                ],
                names=[*batch.schema.names[:kept], *[n for n, _ in _HITS]],
            )

    return run


def contamination(
    docs: DataFrame,
    items: DataFrame,
    size: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: id, digest of the text, words, hit words, spans in the original and items found."""
    spark = docs.sparkSession
    windows = stage(benchmark_windows(items, size), "blocks")
    blocks = windows.agg(F.coalesce(F.max("block"), F.lit(0))).first()[0] + 1
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.xxhash64(text_col).alias("text_key"),
        F.col(text_col).cast("binary").alias("_text"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    if blocks == 1:
        # About BLOCK_BYTES of windows.
        part = windows.select("pattern", "items").collect()
        patterns = _Patterns(spark.sparkContext.broadcast([(bytes(r[0]), list(r[1])) for r in part]))
        schema = f"doc_id {kind}, text_key long, n_words long, spans {_SPANS}, items array<string>"
        return _with_hits(rows.mapInArrow(_scan(patterns, 2), schema))
    return _with_hits(_contamination_by_blocks(rows, windows, blocks, kind))


_SPANS = "array<struct<from_word:long,to_word:long,start:long,end:long>>"


def _window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every window of ``size`` hashed words, by its first word."""
    if len(words) < size:
        return np.zeros(0, dtype=np.uint64)
    rolled = np.full(len(words) - size + 1, size, dtype=np.uint64)
    for n in range(size):
        rolled = (rolled + words[n : len(words) - size + 1 + n]) * np.uint64(0x9E3779B97F4A7C15)
        rolled ^= rolled >> np.uint64(29)
    return rolled


def _hashed(words: list[bytes]) -> np.ndarray:
    return np.fromiter((zlib.crc32(w) for w in words), dtype=np.uint64, count=len(words))


def _probes(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two places of each hash in a bitmap whose size is a power of two."""
    mask = np.uint64(bits - 1)
    return hashes & mask, (hashes >> np.uint64(32)) & mask


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows with their hash and number of words."""
    for batch in batches:
        patterns = [p.as_py().split(b" ") for p in batch.column(0)]
        marks = [int(_window_hashes(_hashed(p), len(p)).view(np.int64)[0]) for p in patterns]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(marks, pa.int64()), pa.array([len(p) for p in patterns], pa.int32())],
            names=["pattern", "items", "mark", "size"],
        )


def _bits_of(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = np.concatenate(_probes(batch.column(0).to_numpy().view(np.uint64), bits))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((places >> np.uint64(6)).astype(np.int64)),
                    pa.array((np.uint64(1) << (places & np.uint64(63))).view(np.int64)),
                ],
                names=["word", "bit"],
            )

    return run


_STRETCH = [("block", pa.int64()), ("at", pa.int64()), ("line", pa.binary()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("n_words", pa.int64())]


def _stretches(bitmap, bits: int, sizes: list[int], blocks: int):
    """Per text a row with its number of words and, by block, the stretches that may hold windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = bitmap.value
        for batch in batches:
            owner, rows = [], []
            for number, text in enumerate(batch.column(3)):
                text = text.as_py() or b""
                flat = text.translate(_TABLE)
                words = flat.split()
                owner.append(number)
                rows.append((-1, 0, None, None, None, len(words)))
                for block, low, high, places in _likely_runs(words, flat, marks, bits, sizes, blocks):
                    starts = [len(text[:b].decode()) for b, _ in places]
                    ends = [s + len(text[b:e].decode()) for s, (b, e) in zip(starts, places)]
                    owner.append(number)
                    rows.append((block, low, b" ".join(words[low:high]), starts, ends, 0))
            kept = pa.array(owner, pa.int64())
            columns = zip(*rows) if rows else [[]] * len(_STRETCH)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k).take(kept) for k in range(3)], *[pa.array(c, t) for c, (_, t) in zip(columns, _STRETCH)]],
                names=["row", "doc_id", "text_key", *[n for n, _ in _STRETCH]],
            )

    return run


def _likely_runs(words: list[bytes], flat: bytes, marks: np.ndarray, bits: int, sizes: list[int], blocks: int):
    """Runs of words covered by windows that may be a block's, with the words' places in the text."""
    hashed = _hashed(words)
    found: dict[int, list[tuple[int, int]]] = {}
    for size in sizes:
        hashes = _window_hashes(hashed, size)
        one, two = _probes(hashes, bits)
        hit = (marks[one >> np.uint64(6)] >> (one & np.uint64(63))) & (marks[two >> np.uint64(6)] >> (two & np.uint64(63))) & np.uint64(1)
        at = np.flatnonzero(hit)
        for place, block in zip(at.tolist(), (hashes[at].view(np.int64) % blocks).tolist()):
            found.setdefault(block, []).append((place, place + size))
    if not found:
        return
    spans = [m.span() for m in _WORD.finditer(flat)]
    for block, windows in found.items():
        windows.sort()
        low, high = windows[0]
        for begin, end in [*windows[1:], (len(words) + 1, 0)]:
            if begin >= high:
                yield block, low, high, spans[low:high]
                low, high = begin, end
            high = max(high, end)


def _scan_block(stretches: pa.Table, windows: pa.Table) -> pa.Table:
    """Hits of a block's windows in its stretches, with their places in the whole texts."""
    rows = []
    if stretches.num_rows and windows.num_rows:
        automaton = _built(windows.column("pattern").to_pylist())
        items = windows.column("items").to_pylist()
        for row in stretches.select(["row", "at", "line", "starts", "ends"]).to_pylist():
            _, runs, found = scan_text(row["line"], automaton)
            if found:
                spans = [
                    {"from_word": row["at"] + low, "to_word": row["at"] + high, "start": row["starts"][low], "end": row["ends"][high - 1]}
                    for low, high, _, _ in runs
                ]
                rows.append((row["row"], spans, sorted({i for n in found for i in items[n]})))
    columns = zip(*rows) if rows else [[]] * 3
    types = [pa.int64(), *[t for _, t in _HITS[1:]]]
    return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=["row", "spans", "items"])


def _united(spans: str) -> Column:
    """Sorted spans, those that overlap as one."""

    def add(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        wider = F.struct(
            last["from_word"].alias("from_word"), F.greatest(last["to_word"], s["to_word"]).alias("to_word"),
            last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"),
        )
        overlap = (F.size(done) > 0) & (F.get(done, F.size(done) - 1)["to_word"] > s["from_word"])
        return F.when(overlap, F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(wider))).otherwise(F.concat(done, F.array(s)))

    return F.aggregate(spans, F.array().cast(_SPANS), add)


def _contamination_by_blocks(rows: DataFrame, windows: DataFrame, blocks: int, kind: str) -> DataFrame:
    """One scan of the rows; what may be hit goes on to the blocks' automata."""
    spark = rows.sparkSession
    marked = stage(
        windows.select("pattern", "items").mapInArrow(_mark, "pattern binary, items array<string>, mark long, size int"), "marked"
    ).withColumn("block", F.pmod("mark", F.lit(blocks)))
    bits = 1 << 10
    while bits < MARKS and bits < MARKS_EACH * marked.count():
        bits *= 2
    # At most MARKS / 64 rows, as columns of numbers.
    found = marked.select("mark").mapInArrow(_bits_of(bits), "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    bitmap = np.zeros(bits >> 6, dtype=np.uint64)
    bitmap[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    sizes = sorted(r[0] for r in marked.select("size").distinct().collect())
    scan = _stretches(spark.sparkContext.broadcast(bitmap), bits, sizes, blocks)
    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text_key", "_text")
    schema = f"row long, doc_id {kind}, text_key long, block long, at long, line binary, starts array<long>, ends array<long>, n_words long"
    scanned = stage(numbered.mapInArrow(scan, schema), "stretches")
    stretches = scanned.where("block >= 0")
    loads = stretches.groupBy("block").agg(F.ceil(F.sum(F.octet_length("line")) / STRETCH_BYTES).alias("salts"))
    dealt = stretches.join(loads, "block").withColumn("salt", F.pmod(F.xxhash64("row", "at"), F.col("salts")))
    held = marked.join(loads, "block").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)))
    cell = ["block", "salt"]
    hits = (
        dealt.groupBy(*cell)
        .cogroup(held.select(*cell, "pattern", "items").groupBy(*cell))
        .applyInArrow(_scan_block, f"row long, spans {_SPANS}, items array<string>")
    )
    merged = hits.groupBy("row").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
    )
    texts = scanned.where("block < 0").select("row", "doc_id", "text_key", "n_words")
    return texts.join(merged, "row", "left").select(
        "doc_id", "text_key", "n_words",
        F.coalesce(_united("spans"), F.array().cast(_SPANS)).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def _with_hits(rows: DataFrame) -> DataFrame:
    """Words in the union of the spans, which are sorted by their first word."""
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("long").alias("upto"), F.lit(0).cast("long").alias("hit")),
        lambda t, s: F.struct(
            F.greatest(t["upto"], s["to_word"]).alias("upto"),
            (t["hit"] + F.greatest(s["to_word"] - F.greatest(s["from_word"], t["upto"]), F.lit(0))).alias("hit"),
        ),
        lambda t: t["hit"],
    )
    return rows.withColumn("n_hit", covered).withColumn("items", F.array_sort("items"))


def drop_contaminated(docs: DataFrame, items: DataFrame, size: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without a hit word; equal rows share their verdict, null ids do not."""
    hit = contamination(docs, items, size, id_col, text_col).where("n_hit > 0")
    bad_id, bad_key = fresh_name(docs, "_bad_id"), fresh_name(docs, "_bad_key")
    bad = hit.select(F.col("doc_id").alias(bad_id), F.col("text_key").alias(bad_key)).distinct()
    same = F.col(id_col).eqNullSafe(F.col(bad_id)) & (F.xxhash64(text_col) == F.col(bad_key))
    return docs.join(bad, same, "left_anti")
