"""Queries on reading, cleaning and auditing the corpus."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagloom.operators import audit, clean, sketches
from tagloom.plans.queries.registry import (
    CLEANED,
    EVENT_LABELS,
    KEPT,
    MAX_LENGTH,
    MIN_LENGTH,
    UTTERANCE_LABELS,
    V1,
    V2,
    registered,
    sql_list,
    sql_strip,
    sql_values,
)
from tagloom.schema import require_columns
from tagloom.session import staging_path
from tagloom.sources.corpus import materialize_once, read_corpus, write_sample_head
from tagloom.sources.jsonl import read_jsonl_capped
from tagloom.sources.profile import read_profile, write_profile


@registered("SELECT doc_id, text, lang, source FROM documents")
def read_corpus_query(t):
    corpus = read_corpus(t.spark, t.path("documents"), "doc_id", "text", "lang", "source")
    return corpus.select("doc_id", "text", "lang", "source")


@registered(f"""WITH {V1}
SELECT count(*) AS n_rows, sum(row_id)::BIGINT AS sum_row_id, count(intent) AS n_labels FROM v1""")
def materialize_once_query(t):
    path = staging_path(t.spark, "once")
    materialize_once(t.utterances(), path)
    # The second write must leave the first one alone.
    stored = materialize_once(t.utterances().where("row_id < 0"), path)
    return stored.agg(
        F.count("*").alias("n_rows"),
        F.sum("row_id").alias("sum_row_id"),
        F.count("intent").alias("n_labels"),
    )


@registered(f"WITH {V1} SELECT * FROM v1 ORDER BY row_id LIMIT 100")
def sample_head_jsonl(t):
    path = staging_path(t.spark, "head")
    write_sample_head(t.utterances(), path)
    return t.spark.read.schema(t.utterances().schema).json(path)


@registered(f"""WITH {V2}
SELECT sample_id AS row_id, input_text AS instruction, truth AS intent
FROM v2 ORDER BY sample_id LIMIT 1000""")
def read_jsonl_capped_query(t):
    path = staging_path(t.spark, "samples")
    samples = t.raw_predictions().select(
        F.col("sample_id").alias("row_id"),
        F.col("input_text").alias("instruction"),
        F.col("truth").alias("intent"),
    )
    samples.write.json(path)
    return read_jsonl_capped(
        t.spark, path, "row_id bigint, instruction string, intent string", cap=1000
    )


@registered(f"WITH {KEPT} SELECT * FROM kept")
def drop_missing(t):
    return clean.drop_missing(t.utterances())


@registered(f"""WITH {V1}
SELECT row_id, {sql_strip('instruction')} AS instruction, intent, category FROM v1""")
def strip_text(t):
    return clean.strip_text(t.utterances())


@registered(f"""WITH {V1}
SELECT row_id, intent AS raw_intent, replace(lower(intent), ' ', '_') AS intent FROM v1""")
def normalise_label(t):
    rows = t.utterances().select("row_id", "intent", F.col("intent").alias("raw_intent"))
    return clean.normalise_label(rows)


@registered(f"""WITH {V1}
SELECT row_id, length(instruction)::INT AS n_chars FROM v1
WHERE length(instruction) BETWEEN {MIN_LENGTH} AND {MAX_LENGTH}""")
def length_filter(t):
    kept = clean.length_filter(t.utterances(), low=MIN_LENGTH, high=MAX_LENGTH)
    return kept.select("row_id", F.length("instruction").alias("n_chars"))


@registered(f"""WITH {V1}
SELECT row_id, replace(lower(intent), ' ', '_') AS intent, length(instruction)::INT AS text_length,
       CASE replace(lower(intent), ' ', '_') WHEN 'de_text' THEN 0 WHEN 'en_text' THEN 1
            WHEN 'es_text' THEN 2 END::INT AS intent_id
FROM v1""")
def derive_columns(t):
    derived = clean.derive_columns(clean.normalise_label(t.utterances()), UTTERANCE_LABELS)
    return derived.select("row_id", "intent", "text_length", "intent_id")


@registered(f"WITH {CLEANED} SELECT * FROM cleaned")
def clean_dataset(t):
    return clean.clean_dataset(t.utterances(), UTTERANCE_LABELS, MIN_LENGTH, MAX_LENGTH)


@registered(f"""WITH {V1} SELECT row_id, intent, category FROM (
  SELECT *, replace(lower(intent), ' ', '_') AS key FROM v1)
WHERE key IN ({sql_list(UTTERANCE_LABELS)})""")
def filter_known_labels(t):
    keyed = t.utterances().withColumn("key", F.expr("replace(lower(intent), ' ', '_')"))
    known = clean.filter_known_labels(keyed, UTTERANCE_LABELS, "key")
    return known.select("row_id", "intent", "category")


@registered(f"""WITH {V1} SELECT DISTINCT replace(lower(intent), ' ', '_') AS intent FROM v1
WHERE intent IS NOT NULL AND replace(lower(intent), ' ', '_') NOT IN ({sql_list(UTTERANCE_LABELS)})""")
def unknown_labels(t):
    return clean.unknown_labels(clean.normalise_label(t.utterances()), UTTERANCE_LABELS)


@registered(f"""WITH {V1} SELECT row_id, instruction, intent, category FROM v1
WHERE instruction IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY instruction ORDER BY row_id) = 1""")
def dedup_keep_first(t):
    present = t.utterances().where("instruction IS NOT NULL")
    return clean.dedup_keep_first(present)


@registered(f"""WITH {V2}, ids AS (
  SELECT truth, (row_number() OVER (ORDER BY truth) - 1)::INT AS label_id
  FROM (SELECT DISTINCT truth FROM v2))
SELECT sample_id, truth, label_id FROM v2 JOIN ids USING (truth)""")
def label_id_join(t):
    rows = t.raw_predictions().select("sample_id", "truth")
    return clean.label_ids(rows, EVENT_LABELS, "truth", "label_id")


@registered(f"""WITH {V1}
SELECT count(*) AS n_rows, 4::INT AS n_columns, count(DISTINCT intent) AS intent_unique,
       count(DISTINCT category) AS category_unique, count(intent) AS intent_filled,
       count(category) AS category_filled FROM v1""")
def profile_dataset(t):
    return audit.profile_dataset(require_columns(t.utterances(), "intent", "category"))


@registered(f"""WITH {V1}
SELECT 'intent' AS column_name, intent AS value, count(*) AS n FROM v1
WHERE intent IS NOT NULL GROUP BY intent
UNION ALL
SELECT 'category', category, count(*) FROM v1 WHERE category IS NOT NULL GROUP BY category""")
def label_distribution(t):
    return audit.label_distribution(t.utterances())


_KEYS = ("l_orderkey", "l_partkey", "l_suppkey")


@registered(f"""WITH cells AS (
  {" UNION ALL ".join(f"SELECT DISTINCT l_returnflag AS part, '{c}' AS column_name, {c} AS value FROM lineitem" for c in _KEYS)}),
sizes AS (SELECT part, column_name, count(*) AS n FROM cells GROUP BY part, column_name),
pairs AS (SELECT a.part AS part_a, b.part AS part_b, column_name, a.n AS n_a, b.n AS n_b
  FROM sizes a JOIN sizes b USING (column_name) WHERE a.part < b.part),
shared AS (SELECT a.part AS part_a, b.part AS part_b, column_name, count(*) AS n
  FROM cells a JOIN cells b USING (column_name, value) WHERE a.part < b.part GROUP BY ALL)
SELECT part_a, part_b, column_name, n_a + n_b - coalesce(n, 0) AS n_either, coalesce(n, 0) AS n_shared,
       true AS either_held, true AS shared_held
FROM pairs LEFT JOIN shared USING (part_a, part_b, column_name)""")
def profile_sketches(t):
    """Distinct keys of pairs of parts: exact, and whether those of four stored batches lie within 2 % of the union."""
    lines = t.read("lineitem")
    path = staging_path(t.spark, "profile")
    for batch in range(4):
        write_profile(lines.where(F.col("l_linenumber") % 4 == batch), path, f"b{batch}", "l_returnflag", _KEYS)
    found = sketches.shared_counts(read_profile(t.spark, path))
    # One bit a part, so the exact counts need no join of the keys.
    bits = {"A": 1, "N": 2, "R": 4}
    bit = F.coalesce(*[F.when(F.col("l_returnflag") == part, number) for part, number in bits.items()])
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in _KEYS])
    held = lines.select(bit.alias("bit"), F.inline(cells)).groupBy("column_name", "value").agg(F.bit_or("bit").alias("bits"))
    pair = F.explode(F.array(*[F.struct(F.lit(a).alias("part_a"), F.lit(b).alias("part_b"), F.lit(bits[a] | bits[b]).alias("pair"))
                               for a in bits for b in bits if a < b]))
    met = F.col("bits").bitwiseAND(F.col("pair"))
    exact = held.select("column_name", "bits", pair.alias("p")).select("column_name", "bits", "p.*").groupBy(
        "part_a", "part_b", "column_name"
    ).agg(F.count_if(met != 0).alias("x_either"), F.count_if(met == F.col("pair")).alias("x_shared"))
    both = found.join(exact, ["part_a", "part_b", "column_name"])
    within = 0.02 * F.col("x_either")
    return both.select(
        "part_a",
        "part_b",
        "column_name",
        F.col("x_either").alias("n_either"),
        F.col("x_shared").alias("n_shared"),
        (F.abs(F.col("n_either") - F.col("x_either")) <= within).alias("either_held"),
        (F.abs(F.col("n_shared") - F.col("x_shared")) <= within).alias("shared_held"),
    )


_WORD = r"[^\x20\x09-\x0D]+"


@registered(f"""WITH words AS (SELECT unnest(regexp_extract_all(text, '{_WORD}')) AS value FROM documents),
counts AS (SELECT value, count(*) AS n FROM words GROUP BY value)
SELECT 'word' AS column_name, row_number() OVER (ORDER BY n DESC, value)::INT AS rank, value, n, true AS proven
FROM counts QUALIFY rank <= 20""")
def top_values(t):
    """The twenty most frequent words of all documents, from summaries by language, each proven by their error bound."""
    words = t.read("documents").select("lang", F.explode(F.regexp_extract_all("text", F.lit(_WORD), F.lit(0))).alias("word"))
    path = staging_path(t.spark, "words")
    write_profile(words, path, "all", "lang", ["word"], tracked=100_000)
    return sketches.exact_top_values(words, read_profile(t.spark, path), ["word"], tracked=100_000)



@registered(f"""WITH {V1}
SELECT intent, count(*) AS n FROM v1
WHERE intent IS NOT NULL AND intent <> lower({sql_strip('intent')}) GROUP BY intent""")
def label_anomalies(t):
    return audit.label_anomalies(t.utterances())


@registered(f"""WITH {CLEANED}, known(intent) AS (VALUES {sql_values(UTTERANCE_LABELS)}, ('it_text')),
found AS (SELECT intent, count(DISTINCT category) AS n_splits FROM stripped GROUP BY intent)
SELECT coalesce(f.intent, k.intent) AS intent,
       CASE WHEN k.intent IS NULL THEN 'in_data_not_known'
            WHEN f.intent IS NULL THEN 'in_known_not_data' ELSE 'matched' END AS status,
       coalesce(f.n_splits, 0)::BIGINT AS n_splits
FROM found f FULL JOIN known k ON f.intent = k.intent""")
def label_coverage(t):
    # All labelled rows, with the source playing the part of the split; one known label is
    # absent from the data on purpose.
    rows = clean.normalise_label(clean.drop_missing(t.utterances()))
    known = type(UTTERANCE_LABELS)([*UTTERANCE_LABELS, "it_text"])
    return audit.label_coverage(rows.withColumn("split", F.col("category")), known)
