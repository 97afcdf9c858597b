"""Quality classifier: an interpolated modified Kneser-Ney model over characters.

The model counts the character n-grams of trusted documents.  Lower orders count the distinct characters
that precede an n-gram; each order takes one of three discounts, by count 1, 2 or more, off its
counts and gives what is saved to the next lower order.  A document's perplexity under the model
tells prose from noise; it is rejected above ``MARGIN`` times a quantile of the perplexity of
trusted documents of its language that were held out of training.  Text that repeats itself has a low
perplexity; a document is also rejected where the share of its characters that end a run of ``2 * ORDER``
characters seen at most ``REACH`` characters before lies over a quantile of the same documents' by more than
``LEEWAY`` of the rest.

The model is a table, as large as the training text makes it, and is joined, not broadcast.  Documents
are dealt to shards of about ``SHARD_BYTES`` by id and text; each shard names the n-grams it needs once, the
needs are joined with the model by n-gram, and the answers meet the shard's documents again.  So what
is shuffled are distinct n-grams a shard and compressed texts, never an n-gram for each place.

Short texts say little: a document's bits and repeats are taken together with ``PRIOR_CHARS`` characters at
the mean of its language.  Training reads every trusted document that is not held out; thresholds cover every
one that is, needs and scores all documents.  Ids say who is trusted, so the texts have to meet them: a bitmap of hashed
ids of bounded size, which is broadcast, keeps most other texts from being shuffled, and a join by id decides.

A document with a null or empty text has no perplexity and is rejected.  A null language is a language of
its own; languages with fewer than ``LEAST_CALIBRATION`` held-out documents take the threshold of
all.  Without any trusted document nothing but empty texts is rejected.  Repeated rows are all reported;
rows with a null id are never trusted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import all_columns, fresh_name, numbered_rows
from tagloom.session import stage

ORDER = 4
HOLD_OUT = 5
QUANTILE = 0.99
# Perplexity over the quantile's that is still accepted, so that clean text is not cut at a fixed rate.
MARGIN = 1.25
# Share of what lies between the quantile of repeats and a text of repeats alone that is still accepted.
LEEWAY = 0.25
# Characters back to where a run counts as repeated.
REACH = 256
PRIOR_CHARS = 64
LEAST_CALIBRATION = 20
SHARD_BYTES = 32 << 20
PIECE_CHARS = 1 << 18
# Distinct n-grams a training task holds before it hands them on.
HELD_GRAMS = 2_000_000
# Words of 64 bits in the bitmap of trusted ids; more ids than fit let more texts through to the join by id.
BITMAP_WORDS = 1_000_000
IDS_A_WORD = 4
# Scores are compared in steps of this many bits or repeats a character.
STEP = 0.001

_START = "\x02"


def _pieces(texts: pa.Array) -> Iterator[list[str]]:
    """Cut a column into runs of about ``PIECE_CHARS`` characters; a longer text is a run of its own."""
    piece: list[str] = []
    held = 0
    for scalar in texts:
        text = scalar.as_py() or ""
        if piece and held + len(text) > PIECE_CHARS:
            yield piece
            piece, held = [], 0
        piece.append(text.replace(_START, " ") if _START in text else text)
        held += len(text)
    if piece:
        yield piece


def grams_of(texts: list[str], order: int) -> tuple[list[str], np.ndarray]:
    """Distinct n-grams of the texts, and for each character the number of the n-gram ending there.

    >>> grams_of(["abab"], 2)
    (['\\x02a', 'ab', 'ba'], array([0, 1, 2, 1]))
    """
    pad = _START * (order - 1)
    line = np.frombuffer((pad + pad.join(texts)).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    seen = np.zeros(int(line.max(initial=0)) + 1, dtype=bool)
    seen[line] = True
    alphabet = np.flatnonzero(seen).astype(np.uint32)
    if len(alphabet) ** order >= 1 << 62:
        return _one_by_one(texts, order)
    rank = np.zeros(len(seen), dtype=np.int64)
    rank[alphabet] = np.arange(len(alphabet))
    ranks = rank[line]
    ends = len(line) - order + 1
    if ends <= 0:
        return [], np.zeros(0, dtype=np.int64)
    codes = ranks[:ends].copy()
    for n in range(1, order):
        codes *= len(alphabet)
        codes += ranks[n : ends + n]
    places, distinct = pd.factorize(codes[line[order - 1 :] != ord(_START)])
    digits = np.empty((len(distinct), order), dtype="<u4")
    for n in range(order - 1, -1, -1):
        distinct, digit = np.divmod(distinct, len(alphabet))
        digits[:, n] = alphabet[digit]
    text = digits.tobytes().decode("utf-32-le", "surrogatepass")
    return [text[n : n + order] for n in range(0, len(text), order)], places


def _one_by_one(texts: list[str], order: int) -> tuple[list[str], np.ndarray]:
    """The same for pieces with too large an alphabet for 64-bit codes."""
    number: dict[str, int] = {}
    places = []
    pad = _START * (order - 1)
    for text in texts:
        padded = pad + text
        places += [number.setdefault(padded[n : n + order], len(number)) for n in range(len(text))]
    return list(number), np.array(places, dtype=np.int64)


def repeats_of(places: np.ndarray, lengths: list[int], kinds: int, order: int, reach: int = REACH) -> np.ndarray:
    """For each text, the characters that end a run of ``2 * order`` characters seen shortly before in it.

    >>> grams, places = grams_of(["abababab", "abcdefgh"], 2)
    >>> repeats_of(places, [8, 8], len(grams), 2)
    array([3, 0])
    """
    owner = np.repeat(np.arange(len(lengths)), lengths)
    ends = np.flatnonzero(owner[order:] == owner[:-order]) + order
    codes = places[ends - order] * np.int64(kinds) + places[ends]
    rank = np.argsort(codes, kind="stable")
    codes, ends = codes[rank], ends[rank]
    again = (codes[1:] == codes[:-1]) & (ends[1:] - ends[:-1] <= reach) & (owner[ends[1:]] == owner[ends[:-1]])
    return np.bincount(owner[ends[1:][again]], minlength=len(lengths))


def _count(order: int):
    schema = pa.schema([("gram", pa.string()), ("n", pa.int64())])

    def batch_of(counts: dict[str, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], schema=schema
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        for batch in batches:
            for piece in _pieces(batch.column(0)):
                grams, places = grams_of(piece, order)
                for gram, n in zip(grams, np.bincount(places, minlength=len(grams)).tolist()):
                    counts[gram] = counts.get(gram, 0) + n
                if len(counts) > HELD_GRAMS:
                    yield batch_of(counts)
                    counts = {}
        if counts:
            yield batch_of(counts)

    return run


def train(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """The model over the texts of a one-column table: ``(gram, p, gamma)``.

    ``p`` is the interpolated probability of the last character after the others; ``gamma`` what a
    text that has the gram as context leaves to the lower order.  The empty gram has, as ``p``, the
    probability of an unseen character.
    """
    counted = stage(
        texts.mapInArrow(_count(order), "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n")),
        "grams",
    )
    suffixes = counted.select(
        F.explode(F.array(*[F.substring("gram", order - k + 1, k) for k in range(1, order + 1)])).alias("gram")
    ).distinct()
    length = F.length("gram")
    lower = suffixes.where(length > 1).groupBy(F.substring("gram", 2, order).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
    table = stage(
        counted.unionByName(lower).select(
            "gram", "n", length.alias("size"), F.col("gram").substr(F.lit(1), length - 1).alias("context")
        ),
        "counts",
    )
    # One row an order.
    tallies = table.groupBy("size").agg(*[F.sum((F.col("n") == k).cast("long")).alias(f"t{k}") for k in range(1, 5)])
    discounts = {r["size"]: _discounts(r["t1"], r["t2"], r["t3"], r["t4"]) for r in tallies.collect()}

    def by_size(k: int):
        chosen = F.lit(0.5)
        for size, values in discounts.items():
            chosen = F.when(F.col("size") == size, F.lit(values[k])).otherwise(chosen)
        return chosen

    spared = [F.sum((F.col("n") == 1).cast("long")), F.sum((F.col("n") == 2).cast("long")), F.sum((F.col("n") > 2).cast("long"))]
    contexts = (
        table.groupBy("size", "context")
        .agg(F.sum("n").alias("total"), *[s.alias(f"n{k}") for k, s in enumerate(spared)])
        .select(
            "size", "context", "total",
            (sum(F.col(f"n{k}") * by_size(k) for k in range(3)) / F.col("total")).alias("gamma"),
        )
    )
    discount = F.when(F.col("n") == 1, by_size(0)).when(F.col("n") == 2, by_size(1)).otherwise(by_size(2))
    shares = stage(
        table.join(contexts, ["size", "context"]).select(
            "size", "gram", F.greatest(F.col("n") - discount, F.lit(0.0)).alias("left"), "total", "gamma"
        ),
        "shares",
    )
    unseen = 1.0 / (shares.where("size = 1").count() + 1)
    own = F.col("left") / F.col("total")
    level = shares.where("size = 1").select("gram", (own + F.col("gamma") * unseen).alias("p"))
    levels = [level]
    for size in range(2, order + 1):
        below = level.select(F.col("gram").alias("shorter"), F.col("p").alias("below"))
        rows = shares.where(F.col("size") == size).withColumn("shorter", F.substring("gram", 2, order))
        level = rows.join(below, "shorter").select("gram", (own + F.col("gamma") * F.col("below")).alias("p"))
        levels.append(level)
    known = levels[0]
    for level in levels[1:]:
        known = known.unionByName(level)
    floor = texts.sparkSession.createDataFrame([("", unseen)], "gram string, p double")
    backing = contexts.select(F.col("context").alias("gram"), "gamma")
    return stage(known.unionByName(floor).join(backing, "gram", "full"), "model")


def _discounts(t1: int, t2: int, t3: int, t4: int) -> list[float]:
    """The three discounts from the numbers of n-grams counted once to four times."""
    if not t1 or not t2:
        return [0.5, 0.5, 0.5]
    share = t1 / (t1 + 2 * t2)
    return [
        min(max(1 - 2 * share * t2 / t1, 0.0), 1.0),
        min(max(2 - 3 * share * t3 / t2, 0.0), 2.0),
        min(max(3 - 4 * share * t4 / t3, 0.0), 3.0) if t3 else 1.0,
    ]


def _compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a batch that go to one shard, as one compressed block."""
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    for batch in batches:
        if not batch.num_rows:
            continue
        shards = batch.column(0).to_numpy()
        order = np.argsort(shards, kind="stable")
        cuts = [0, *(np.flatnonzero(np.diff(shards[order])) + 1).tolist(), len(order)]
        texts = batch.select(batch.schema.names[1:])
        names, blocks = [], []
        for low, high in zip(cuts[:-1], cuts[1:]):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, texts.schema, options=options) as writer:
                writer.write_batch(texts.take(pa.array(order[low:high])))
            names.append(int(shards[order[low]]))
            blocks.append(sink.getvalue().to_pybytes())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(blocks, pa.binary())], names=["shard", "block"])


def _blocks(table: pa.Table) -> Iterator[pa.Table]:
    for block in table.column("block"):
        yield pa.ipc.open_stream(block.as_buffer()).read_all()


def _needs(order: int):
    def run(table: pa.Table) -> pa.Table:
        full: set[str] = set()
        for block in _blocks(table):
            for piece in _pieces(block.column(2)):
                full.update(grams_of(piece, order)[0])
        wanted = {""}
        for k in range(order):
            wanted.update(g[k:] for g in full)
            wanted.update(g[k : order - 1] for g in full)
        names = sorted(wanted)
        shard = table.column("shard")[0].as_py()
        return pa.table({"shard": pa.array([shard] * len(names), pa.int64()), "gram": pa.array(names, pa.string())})

    return run


def _bits(order: int, types: pa.Schema):
    def run(documents: pa.Table, answers: pa.Table) -> pa.Table:
        known = dict(
            zip(
                answers.column("gram").to_pylist(),
                zip(answers.column("p").to_pylist(), answers.column("gamma").to_pylist()),
            )
        )
        nothing = (None, None)
        unseen = known.get("", nothing)[0] or 1.0

        def bits(gram: str) -> float:
            weight = 1.0
            for k in range(order):
                p = known.get(gram[k:], nothing)[0]
                if p is not None:
                    return -math.log2(weight * p)
                gamma = known.get(gram[k : order - 1], nothing)[1]
                weight *= 1.0 if gamma is None else gamma
            return -math.log2(weight * unseen)

        cost: dict[str, float] = {}
        parts = []
        for block in _blocks(documents):
            lengths: list[int] = []
            totals: list[float] = []
            repeats: list[int] = []
            for piece in _pieces(block.column(2)):
                grams, places = grams_of(piece, order)
                for gram in grams:
                    if gram not in cost:
                        cost[gram] = bits(gram)
                each = np.array([cost[g] for g in grams])[places] if grams else np.zeros(0)
                upto = np.concatenate(([0.0], np.cumsum(each)))
                own = [len(t) for t in piece]
                lengths += own
                repeats += repeats_of(places, own, len(grams), order).tolist()
                limits = np.cumsum([0] + own)
                totals += (upto[limits[1:]] - upto[limits[:-1]]).tolist()
            parts.append(
                pa.table(
                    [
                        block.column(0), block.column(1), pa.array(lengths, pa.int64()),
                        pa.array(totals, pa.float64()), pa.array(repeats, pa.int64()),
                    ],
                    names=types.names,
                )
            )
        return pa.concat_tables(parts) if parts else types.empty_table()

    return run


def perplexity(docs: DataFrame, model: DataFrame, order: int = ORDER, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Characters of every row, their bits under the model and their repeats."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()[0]
    shards = max(1, -(-size // SHARD_BYTES))
    # With the text, so that rows without an id are spread as well.
    key = F.xxhash64(F.col(id_col).cast("string"), F.col(text_col))
    rows = docs.select(
        F.pmod(key, F.lit(shards)).alias("shard"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(lang_col).alias("lang"),
        F.col(text_col).alias("_text"),
    )
    # The same exchange serves both uses.
    dealt = rows.mapInArrow(_compress, "shard long, block binary").repartition("shard")
    needs = dealt.groupBy("shard").applyInArrow(_needs(order), "shard long, gram string")
    answers = needs.join(model, "gram").select("shard", "gram", "p", "gamma")
    types = pa.schema(
        [("doc_id", pa.int64()), ("lang", pa.string()), ("chars", pa.int64()), ("bits", pa.float64()), ("repeats", pa.int64())]
    )
    return (
        dealt.groupBy("shard")
        .cogroup(answers.groupBy("shard"))
        .applyInArrow(_bits(order, types), "doc_id long, lang string, chars long, bits double, repeats long")
    )


def texts_of(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The texts of all rows whose id is in the one-column table ``ids``, however many these are."""
    slots = 64 * min(BITMAP_WORDS, ids.count() // IDS_A_WORD + 1)

    def slot(key: str):
        return F.pmod(F.xxhash64(key), F.lit(slots))

    named = ids.select(F.col(ids.columns[0]).alias("_id"))
    words = (
        named.select(slot("_id").alias("_slot"))
        .groupBy(F.floor(F.col("_slot") / 64).alias("_word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(_slot % 64 AS INT))")).alias("_bits"))
    )
    rows = docs.select(F.col(id_col).cast("long").alias("_key"), F.col(text_col).alias("_text")).where("_key IS NOT NULL")
    marked = (F.floor(slot("_key") / 64) == F.col("_word")) & (F.getbit("_bits", slot("_key") % 64) == 1)
    likely = rows.join(F.broadcast(words), marked, "left_semi")
    return likely.join(named, F.col("_key") == F.col("_id"), "left_semi").select(F.col("_text").alias(text_col))


def classify(
    docs: DataFrame,
    trusted: DataFrame,
    order: int = ORDER,
    quantile: float = QUANTILE,
    margin: float = MARGIN,
    leeway: float = LEEWAY,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """Every row with its perplexity, its share of repeats, its language's thresholds and whether it is accepted,
    by the one, the other and both.

    ``trusted`` holds the ids of trusted documents in its first column; draws go by its last.
    """
    named = trusted.select(F.col(trusted.columns[0]).cast("long").alias("trusted_id"), F.col(trusted.columns[-1]).cast("long").alias("draw"))
    ids = stage(named.where("trusted_id IS NOT NULL").distinct(), "trusted")
    held_out = F.pmod(F.xxhash64("draw"), F.lit(HOLD_OUT)) == 0
    model = train(texts_of(docs, ids.where(~held_out).select("trusted_id"), id_col, text_col), order)
    scored = stage(perplexity(docs, model, order, id_col, text_col, lang_col), "scores")

    calibration = stage(
        scored.where("chars > 0").join(ids.where(held_out), F.col("doc_id") == F.col("trusted_id"), "left_semi"),
        "calibration",
    )
    # Two rows for each language, and two, marked, for all.
    levels = (
        calibration.withColumn("pooled", F.explode(F.array(F.lit(False), F.lit(True))))
        .withColumn("measure", F.explode(F.array(F.lit("bits"), F.lit("repeats"))))
        .select(
            "measure", "pooled", F.when(~F.col("pooled"), F.col("lang")).alias("lang"), "chars",
            F.when(F.col("measure") == "bits", F.col("bits")).otherwise(F.col("repeats").cast("double")).alias("amount"),
        )
    )
    means = levels.groupBy("measure", "pooled", "lang").agg((F.sum("amount") / F.sum("chars")).alias("mean"), F.count(F.lit(1)).alias("documents"))
    same = (F.col("l.measure") == F.col("m.measure")) & (F.col("l.pooled") == F.col("m.pooled")) & F.col("l.lang").eqNullSafe(F.col("m.lang"))
    steps = levels.alias("l").join(means.alias("m"), same).select(
        "l.measure", "l.pooled", "l.lang", "documents", "mean",
        F.ceil(_score(F.col("amount"), F.col("chars"), F.col("mean")) / STEP).alias("step"),
    )
    counts = steps.groupBy("measure", "pooled", "lang", "documents", "mean", "step").agg(F.count(F.lit(1)).alias("n"))
    # At most a few ten thousand steps a language.
    upto = F.sum("n").over(Window.partitionBy("measure", "pooled", "lang").orderBy("step"))
    reached = (
        counts.withColumn("upto", upto)
        .where(F.col("upto") >= F.col("documents") * quantile)
        .groupBy("measure", "pooled", "lang", "documents", "mean")
        .agg((F.min("step") * STEP).alias("level"))
    )

    def of(measure: str, value):
        return F.max(F.when(F.col("measure") == measure, value))

    limits = stage(
        reached.groupBy("pooled", "lang", "documents").agg(
            of("bits", F.col("mean")).alias("mean"),
            of("bits", F.col("level") + math.log2(margin)).alias("threshold"),
            of("repeats", F.col("mean")).alias("mean_repeats"),
            of("repeats", F.col("level") + (1 - F.col("level")) * leeway).alias("most_repeats"),
        ),
        "limits",
    )
    names = ("mean", "threshold", "mean_repeats", "most_repeats")
    general = limits.where("pooled").first()
    own = limits.where(~F.col("pooled") & (F.col("documents") >= LEAST_CALIBRATION)).select(
        F.col("lang").alias("_lang"), *[F.col(n).alias(f"_{n}") for n in names]
    )
    pooled = {n: general[n] for n in names} if general else {"mean": 0.0, "threshold": None, "mean_repeats": 0.0, "most_repeats": None}
    found = scored.join(own, F.col("lang").eqNullSafe(F.col("_lang")), "left").select(
        "doc_id", "lang", "chars", "bits", "repeats",
        *[F.coalesce(f"_{n}", F.lit(pooled[n]).cast("double")).alias(n) for n in names],
    )
    score = F.when(F.col("chars") > 0, _score(F.col("bits"), F.col("chars"), F.col("mean")))
    repeated = F.when(F.col("chars") > 0, _score(F.col("repeats"), F.col("chars"), F.col("mean_repeats")))
    likely = (F.col("chars") > 0) & F.coalesce(score <= F.col("threshold"), F.lit(True))
    varied = (F.col("chars") > 0) & F.coalesce(repeated <= F.col("most_repeats"), F.lit(True))
    return found.select(
        "doc_id", "lang", "chars",
        F.pow(F.lit(2.0), score).alias("perplexity"),
        F.pow(F.lit(2.0), F.col("threshold")).alias("threshold"),
        repeated.alias("repeated"),
        F.col("most_repeats").alias("repeated_threshold"),
        likely.alias("accepted_by_perplexity"),
        varied.alias("accepted_by_repeats"),
        (likely & varied).alias("accepted"),
    )


def _score(amount, chars, mean):
    """Bits or repeats a character, drawn to the language's mean where there are few characters."""
    return (amount + mean * PRIOR_CHARS) / (chars + PRIOR_CHARS)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Documents that every label calls good and none calls toxic."""
    return (
        labels.groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic"))
        .where("quality = 1 AND toxic = 0")
        .select("doc_id")
    )


def keep_accepted(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", stored: bool = False, **columns: str
) -> DataFrame:
    """The rows that are accepted; trusted are those whose id :func:`trusted_ids` draws from the labels.

    Verdicts belong to rows, so null and repeated ids take no other row with them; ``stored`` as in
    ``common.numbered_rows``.
    """
    rows, row = numbered_rows(docs, stored)
    good = fresh_name(docs, "_good")
    ids = trusted_ids(labels).select(F.col("doc_id").alias(good))
    trusted = rows.join(ids, F.col(id_col).cast("long") == F.col(good)).select(row, good)
    verdicts = classify(rows, trusted, id_col=row, **columns)
    bad = fresh_name(rows, "_bad")
    rejected = verdicts.where(~F.col("accepted")).select(F.col("doc_id").alias(bad))
    return rows.join(rejected, F.col(row) == F.col(bad), "left_anti").select(*all_columns(docs))
