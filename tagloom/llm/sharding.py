"""Sharding as vector bin packing: bytes, tokens and rows of a shard are balanced jointly.

Rows with equal texts form a group and go together.  What is packed are units: a large group is a
unit of its own, the many small groups are bundled by digest.  A group is large from a fixed part
of a shard's load on, in any of the three; so there are at most ``3 * UNITS_PER_SHARD`` large
groups a shard and ``UNITS_PER_SHARD`` bundles, however large the corpus.  Only their sums
come to the driver, which places them from the largest down, each in the shard where the dot
product of the unit's load with the shard's residual capacity is highest.

A group that does not fit in a shard is cut by row digest into pieces that do, as one text may have a
third of all rows.  The law kept is ``bytes``: sizes of shards are near equal.

``shard`` gives narrow rows, ``shard_documents`` whole ones: there the texts are shuffled once, to their
shard.  Slots follow the rows' digests, or the order that the caller names.

Null texts count as empty.  Null ids and repeated rows are kept; an empty table gives an empty one.
``shard_documents`` keeps further columns, but for those named like the ones it adds.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import all_columns, running_sum, utf8, word_count
from tagloom.session import stage

UNITS_PER_SHARD = 128
# Bytes a row has besides its text.
ROW_BYTES = 8
# A group above this part of a shard's load is cut.
WHOLE_GROUP = 0.9
# Bytes are what the law promises; the others share the rest of the say.
IMPORTANCE = (16.0, 1.0, 1.0)
SLOT_BUCKETS = 1024


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Narrow rows: id, the three loads, checksum, digest of the text and of the row.

    Equal digests of different texts (64 bits) only put two groups into one.
    """
    return docs.select(*_measures(id_col, text_col))


def _measures(id_col: str, text_col: str) -> list[Column]:
    text = F.coalesce(text_col, F.lit(""))
    return [
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        word_count(F.col(text_col)).alias("words"),
        F.crc32(utf8(F.col(text_col))).alias("text_crc32"),
        F.xxhash64(text).alias("text_key"),
        F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit("row")).alias("row_key"),
    ]


def pack(loads: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unit.  ``loads``: units by dimensions, as parts of the whole.

    >>> pack(np.array([[0.5, 0.5, 0.5], [0.25, 0.25, 0.25], [0.25, 0.25, 0.25]]), 2).tolist()
    [0, 1, 1]
    """
    weight = np.asarray(IMPORTANCE)
    residual = np.full((shards, loads.shape[1]), 1.0 / shards)
    place = np.zeros(len(loads), dtype=np.int64)
    for unit in np.argsort(-(loads * weight).sum(axis=1), kind="stable"):
        best = int(np.argmax(residual @ (weight * loads[unit])))
        residual[best] -= loads[unit]
        place[unit] = best
    return place


def shard(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Shard and gapless slot of every row, with its loads and the unit it was packed in."""
    rows = stage(measure(docs, id_col, text_col), "measured")
    sharded = _placed(rows, rows, shards).withColumn("bucket", F.pmod("row_key", F.lit(SLOT_BUCKETS)))
    one = sharded.withColumn("one", F.lit(1))
    return running_sum(one, ["shard"], "bucket", ["row_key", "doc_id", "text_key"], "one", "slot").drop(
        "one", "bucket", "row_key"
    )


def shard_documents(
    docs: DataFrame,
    shards: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    order: tuple[Column, Column] | None = None,
) -> DataFrame:
    """The documents with ``size``, ``words``, ``shard`` and ``slot``.

    ``order`` names a part of the table and a place in it; slots then follow parts and places.  A part is
    sorted in one task, as a file of the table is.
    """
    narrow = stage(measure(docs, id_col, text_col), "measured")
    part, place = order or (F.lit(None), F.lit(None))
    whole = docs.select(F.struct(*all_columns(docs)).alias("doc"), part.alias("part"), place.alias("place"))
    text = whole.select("*", F.col("doc")[text_col].alias("_text"), F.col("doc")[id_col].alias("_id"))
    rows = text.select("doc", "part", "place", *_measures("_id", "_text"))
    bucket = F.pmod("row_key", F.lit(SLOT_BUCKETS)) if order is None else F.coalesce("part", F.lit(""))
    one = _placed(rows, narrow, shards).withColumn("bucket", bucket).withColumn("one", F.lit(1))
    # The text's running sum needs its partition anyway: the rows of a shard and bucket come to one task.
    slotted = running_sum(one, ["shard"], "bucket", ["place", "row_key", "doc_id", "text_key"], "one", "slot")
    own = ("size", "words", "shard", "slot")
    kept = [F.col("doc")[c].alias(c) for c in docs.columns if c.lower() not in own]
    return slotted.select(*kept, "size", "words", "shard", F.col("slot").cast("long"))


def _placed(rows: DataFrame, narrow: DataFrame, shards: int) -> DataFrame:
    """``rows`` with the unit that each is packed in and its shard, from the loads of the stored ``narrow`` ones."""
    spark = rows.sparkSession
    loads = ("size", "words", "rows")
    sums = [F.sum("size").alias("size"), F.sum("words").alias("words"), F.count(F.lit(1)).alias("rows")]
    total = narrow.agg(*sums).first()
    capacity = {c: max(1.0, (total[c] or 0) / shards) for c in loads}

    groups = stage(narrow.groupBy("text_key").agg(*sums), "groups")
    part = F.greatest(*[F.col(c) / capacity[c] for c in loads])
    large = groups.where(part > 1.0 / UNITS_PER_SHARD).select(
        "text_key",
        F.when(part > WHOLE_GROUP, F.ceil(part / WHOLE_GROUP * 2)).otherwise(F.lit(1)).alias("pieces"),
    )

    def united(df: DataFrame) -> DataFrame:
        # At most 3 * UNITS_PER_SHARD rows a shard, by the sums above.
        met = df.join(F.broadcast(large), "text_key", "left")
        piece = F.pmod("row_key", F.col("pieces"))
        bundle = F.pmod(F.xxhash64("text_key"), F.lit(UNITS_PER_SHARD * shards))
        return met.select(
            *df.columns,
            F.col("pieces").isNotNull().alias("is_large"),
            F.when(F.col("pieces").isNotNull(), F.col("text_key")).otherwise(bundle).alias("unit"),
            F.coalesce(piece, F.lit(0)).cast("long").alias("piece"),
        )

    key = ["is_large", "unit", "piece"]
    # Sorted, so that a repeated run places alike.
    units = united(narrow).groupBy(*key).agg(*sums).orderBy(*key).collect()
    matrix = np.array([[u[c] / (capacity[c] * shards) for c in loads] for u in units]).reshape(-1, 3)
    placed = spark.createDataFrame(
        [(u["is_large"], u["unit"], u["piece"], int(s)) for u, s in zip(units, pack(matrix, shards))],
        "is_large boolean, unit long, piece long, shard int",
    )
    return united(rows).join(F.broadcast(placed), key)
