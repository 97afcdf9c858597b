"""Queries on splitting and on auditing splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagloom.operators import audit, split
from tagloom.operators.clean import clean_dataset, strip_text
from tagloom.operators.runlog import training_plan as plan_steps
from tagloom.labels import label_table as labels_of
from tagloom.plans.queries.registry import (
    MAX_LENGTH,
    MIN_LENGTH,
    SPLITS,
    UTTERANCE_LABELS,
    V1,
    registered,
    sql_values,
)
from tagloom.session import staging_path
from tagloom.sources.jsonl import read_split_jsonl, write_split_jsonl

_HASHED = """hashed AS (
  SELECT *, ('0x' || substr(md5('42:' || instruction), 1, 8))::BIGINT % 10000 AS bucket
  FROM {source}),
hash_splits AS (
  SELECT *, CASE WHEN bucket < 7000 THEN 'train' WHEN bucket < 8500 THEN 'val' ELSE 'test' END
         AS split FROM hashed)"""


@registered(f"WITH {SPLITS} SELECT row_id, intent, split FROM splits")
def stratified_split(t):
    return t.splits().select("row_id", "intent", "split")


@registered(f"""WITH {V1}, {_HASHED.format(source='v1')}
SELECT row_id, split FROM hash_splits WHERE instruction IS NOT NULL""")
def hash_split(t):
    present = t.utterances().where("instruction IS NOT NULL")
    return split.hash_split(present).select("row_id", "split")


@registered(f"""WITH {SPLITS}
SELECT s.split, s.intent, s.n, t.split_rows, round(s.n / t.split_rows, 6) AS share
FROM (SELECT split, intent, count(*) AS n FROM splits GROUP BY split, intent) s
JOIN (SELECT split, count(*) AS split_rows FROM splits GROUP BY split) t USING (split)""")
def split_stats(t):
    return audit.split_stats(t.splits()).withColumn("share", F.round("share", 6))


@registered(f"""WITH {SPLITS}, expected AS (
  SELECT s.split, k.intent FROM (VALUES ('train'), ('val'), ('test')) s(split),
         (VALUES {sql_values(UTTERANCE_LABELS)}, ('it_text')) k(intent))
SELECT split, intent FROM expected
WHERE NOT EXISTS (SELECT 1 FROM splits x WHERE x.split = expected.split AND x.intent = expected.intent)""")
def split_completeness(t):
    labels = type(UTTERANCE_LABELS)([*UTTERANCE_LABELS, "it_text"])
    return audit.split_completeness(t.splits(), labels)


@registered(f"""WITH {V1}, s AS (
  SELECT DISTINCT regexp_replace(instruction, '^\\s+|\\s+$', '', 'g') AS instruction,
         CASE WHEN row_id % 3 = 0 THEN 'train' WHEN row_id % 3 = 1 THEN 'val' ELSE 'test' END AS split
  FROM v1),
pairs(split_a, split_b) AS (VALUES ('train', 'val'), ('train', 'test'), ('val', 'test'))
SELECT split_a, split_b, count(b.instruction) AS n_shared
FROM pairs LEFT JOIN s a ON a.split = split_a
LEFT JOIN s b ON b.split = split_b AND b.instruction IS NOT DISTINCT FROM a.instruction
GROUP BY split_a, split_b""")
def split_leakage(t):
    # A deliberately careless split of the copied texts, so that there is leakage to count.
    careless = F.when(F.col("row_id") % 3 == 0, "train").when(F.col("row_id") % 3 == 1, "val")
    rows = t.utterances().where("instruction IS NOT NULL")
    rows = rows.withColumn("split", careless.otherwise("test"))
    return audit.split_leakage(strip_text(rows))


@registered(f"""WITH {SPLITS}
SELECT split, count(DISTINCT intent) AS n_labels FROM splits GROUP BY split""")
def labels_per_split(t):
    return audit.labels_per_split(t.splits())


@registered(f"""WITH {SPLITS}, n AS (
  SELECT count(*) FILTER (split = 'train') AS n_train, count(*) FILTER (split = 'val') AS n_val
  FROM splits)
SELECT n_train, n_val, greatest(1, n_train // 4) AS steps_per_epoch,
       greatest(1, n_train // 4) * 3 AS total_steps, greatest(1, n_val // 4) AS val_batches FROM n""")
def training_plan(t):
    return plan_steps(t.splits())


@registered(f"""WITH {SPLITS}
SELECT row_id, instruction, intent, category, intent_id, split FROM splits""")
def write_split_jsonl_query(t):
    path = staging_path(t.spark, "splits-jsonl")
    write_split_jsonl(t.splits(), path)
    return read_split_jsonl(t.spark, path)


@registered(f"""WITH {SPLITS}, {_HASHED.format(source='cleaned')}
SELECT split, intent, count(*) AS n FROM hash_splits GROUP BY split, intent""")
def hash_split_stats(t):
    # Map-only and read once, so the cleaned rows need not be stored.
    cleaned = clean_dataset(t.utterances(), UTTERANCE_LABELS, MIN_LENGTH, MAX_LENGTH)
    counts = audit.split_stats(split.hash_split(cleaned))
    return counts.select("split", "intent", "n")


@registered("""SELECT lang, (row_number() OVER (ORDER BY lang) - 1)::BIGINT AS label_id, n
FROM (SELECT lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang)""")
def label_table(t):
    """The label dimension of the data, joined to its row counts."""
    documents = t.read("documents")
    counts = documents.groupBy("lang").agg(F.count("*").alias("n"))
    return labels_of(documents, "lang").join(counts, "lang").select("lang", "label_id", "n")
