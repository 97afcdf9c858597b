"""Exact dedup with a persistent digest index, bucketed and sorted by digest.

The index is a folder on shared storage.  It holds one generation of files, ``g<number>-b<buckets>``, which is a
bucketed table: a batch of documents is reduced to one row per digest, deduplicated against the index by a
sort-merge anti-join, for which only the batch is shuffled, and what is new is appended.  Each append adds one
sorted file to a bucket; as a bucket may hold several, its rows are sorted again in the task that joins them.
The texts themselves never move: everything after the scan works on digests.

The index is known by its path, not by a catalog: whatever the session's catalog has, the table is
declared anew over the folder when it is opened, so another application finds what earlier ones wrote.  Files
in the folder that are no complete generation make opening fail, and nothing is written over them.  The
number of buckets is part of the generation's name; ``reserve`` rewrites the index into at least twice as many
when the digests outgrow them, and removes the old generation when the new one is complete.  One application
writes at a time; an append that is cut off can be repeated.

Null texts count as empty.  Repeated rows are copies; null ids sort last.  An empty table gives an
empty one.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.common import SPACE_PATTERN, join_groups
from tagloom.session import stage, staging_path

# Least number of buckets, and digests of a bucket, which one task sorts.
BUCKETS = 64
BUCKET_ROWS = 4_000_000

_GENERATION = re.compile(r"g(\d+)-b(\d+)")


def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_PATTERN, " ")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and SHA-256 of the normalised text of every row."""
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.sha2(normalised(F.col(text_col)).cast("binary"), 256).alias("text_sha256"),
    )


class DigestIndex:
    """A persistent index ``(text_sha256, keep_id)`` with every digest once, known by its path.

    ``buckets`` counts for a new index only.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path = spark, path.rstrip("/")
        self._generation, self.buckets = 1, buckets
        complete = self._complete()
        if complete:
            self._generation, self.buckets = max(complete)
            self._declare()
        elif self._holds_files(self.path):
            raise ValueError(f"{self.path} holds files, but no complete digest index.")

    @classmethod
    def fresh(cls, spark: SparkSession, buckets: int = BUCKETS) -> DigestIndex:
        """A new, empty index in the shared folder."""
        return cls(spark, staging_path(spark, "digest_index"), buckets)

    def _hadoop(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def _children(self, path: str) -> list[str]:
        files, where = self._hadoop(path)
        return [s.getPath().getName() for s in files.listStatus(where)] if files.exists(where) else []

    def _holds_files(self, path: str) -> bool:
        """Whether data lies in a folder; what an unfinished write left below ``_temporary`` is none."""
        files, where = self._hadoop(path)
        if not files.exists(where):
            return False
        found = files.listFiles(where, True)
        while found.hasNext():
            if "/_temporary/" not in str(found.next().getPath()):
                return True
        return False

    def _complete(self) -> list[tuple[int, int]]:
        """Generations that were written to the end, with their numbers of buckets."""
        named = [(m, c) for c in self._children(self.path) if (m := _GENERATION.fullmatch(c))]
        return [(int(m[1]), int(m[2])) for m, c in named if "_SUCCESS" in self._children(f"{self.path}/{c}")]

    @property
    def _folder(self) -> str:
        return f"{self.path}/g{self._generation}-b{self.buckets}"

    @property
    def name(self) -> str:
        """Name of the table in the session's catalog."""
        return f"digest_index_{hashlib.sha256(self._folder.encode()).hexdigest()[:16]}"

    def _declare(self) -> None:
        """Declare the generation's files as a bucketed table, whatever an earlier session declared."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        self.spark.sql(
            f"CREATE TABLE {self.name} (text_sha256 STRING, keep_id BIGINT) USING parquet "
            f"CLUSTERED BY (text_sha256) SORTED BY (text_sha256) INTO {self.buckets} BUCKETS LOCATION '{self._folder}'"
        )

    def exists(self) -> bool:
        return bool(self._complete())

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def _write(self, rows: DataFrame) -> None:
        # Whole buckets to a task, however many partitions there are: one file a bucket.
        bucket = F.pmod(F.hash("text_sha256"), F.lit(self.buckets))
        (
            rows.select("text_sha256", F.col("keep_id").cast("long"))
            .repartition(self.buckets, bucket)
            .write.format("parquet")
            .bucketBy(self.buckets, "text_sha256")
            .sortBy("text_sha256")
            .option("path", self._folder)
            .mode("append")
            .saveAsTable(self.name)
        )

    def append(self, hashed: DataFrame) -> None:
        """Take in the digests that the index lacks, each with its smallest id."""
        # Partial aggregation leaves one row a task of the largest group of copies.
        new = hashed.groupBy("text_sha256").agg(F.min("doc_id").alias("keep_id"))
        if self.exists():
            known = self.read().select("text_sha256").hint("merge")
            new = new.join(known, "text_sha256", "left_anti")
        else:
            self._declare()
        self._write(new)

    def reserve(self, digests: int) -> None:
        """Make room for so many more digests: rewrite the index into more buckets if they outgrow these."""
        known = self.read().count() if self.exists() else 0
        buckets = self.buckets
        while known + digests > buckets * BUCKET_ROWS:
            buckets *= 2
        if buckets == self.buckets:
            return
        old = self.read() if self.exists() else None
        before, name = self._folder, self.name
        self._generation, self.buckets = self._generation + 1, buckets
        if old is not None:
            self._declare()
            self._write(old)
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            files, where = self._hadoop(before)
            files.delete(where, True)


def deduplicate(
    docs: DataFrame,
    index: DigestIndex | None = None,
    batches: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Every row with the id that stays, the size of its group and whether it stays.

    With an index that knows a text already, the id stored there stays.  ``batches`` above 1
    takes the documents in by ranges of ids from the smallest up, as they would arrive.
    """
    index = index or DigestIndex.fresh(docs.sparkSession)
    rows = stage(digests(docs, id_col, text_col), "digests")
    index.reserve(rows.count())
    bounds = [] if batches < 2 else _id_bounds(rows, batches)
    low = None
    for high in [*bounds, None]:
        batch = rows
        if low is not None:
            # Null ids come with the last batch.
            last = F.col("doc_id").isNull() & F.lit(high is None)
            batch = batch.where(last | (F.col("doc_id") >= low))
        if high is not None:
            batch = batch.where(F.col("doc_id") < high)
        index.append(batch)
        low = high
    sizes = rows.groupBy("text_sha256").agg(F.count(F.lit(1)).alias("group_size"))
    groups = index.read().join(sizes.hint("merge"), "text_sha256")
    met = join_groups(rows, groups, "text_sha256", "group_size", "doc_id")
    return met.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def _id_bounds(rows: DataFrame, batches: int) -> list[int]:
    row = rows.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    if row["low"] is None:
        return []
    width = (row["high"] - row["low"]) // batches + 1
    return [row["low"] + width * n for n in range(1, batches)]
