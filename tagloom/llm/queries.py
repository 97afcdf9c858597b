"""One query for each operator of this subpackage, with its SQL where SQL can say it."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm import (
    chat,
    decontaminate,
    digest_index,
    filter_audit,
    html_text,
    langid,
    maxscore,
    minhash,
    mixing,
    quality,
    sharding,
    warc,
    whitening,
)
from tagloom.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# Schedules with integrals 1, 2 and 3: falling, level, rising.
CURRICULUM = [
    [(0.0, 1.5), (0.5, 1.0), (1.0, 0.5)],
    [(0.0, 2.0), (0.5, 2.0), (1.0, 2.0)],
    [(0.0, 1.5), (0.5, 3.0), (1.0, 4.5)],
]
SHARDS = 24


def query(sql: str | None = None):
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE[function.__name__] = sql
        return function

    return register


OP1_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS draw,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::DOUBLE AS weight
  FROM sized GROUP BY source),
ordered AS (
  SELECT *, sum(source_size * 3) OVER w AS given, sum(weight) OVER w AS gone,
         sum(source_size) OVER () AS budget, sum(weight) OVER () AS weights
  FROM sources
  WINDOW w AS (ORDER BY source_size * 3 / weight, source IS NULL, source
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
rates AS (
  SELECT *, (budget - coalesce(given, 0))::DOUBLE AS rest, weights - coalesce(gone, 0) AS heavy
  FROM ordered),
level AS (
  SELECT rest, heavy FROM rates WHERE weight * rest / heavy <= source_size * 3
  ORDER BY source_size * 3 / weight, source IS NULL, source LIMIT 1),
targets AS (
  SELECT source, source_size, weight, least(weight * level.rest / level.heavy, (source_size * 3)::DOUBLE) AS target
  FROM sources, level),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.weight, t.target, floor(t.target + 0.5)::BIGINT AS words,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.draw, s.size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS upto
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
taken AS (
  SELECT *, greatest(least(words - upto, size), 0) + greatest(least(words - source_size - upto, size), 0)
            + greatest(least(words - 2 * source_size - upto, size), 0) AS taken,
         CASE weight WHEN 1 THEN 0.625 WHEN 2 THEN 1.0 ELSE 1.125 END AS half
  FROM placed),
""" + ",".join(f"""
reached_{k} AS (SELECT *, weight * ({k} * source_size + upto) / target AS reached FROM taken),
piece_{k} AS (
  SELECT *, CASE WHEN reached < half THEN reached ELSE reached - half END AS area,
         CASE WHEN reached < half THEN 0.0 ELSE 0.5 END AS start,
         CASE weight WHEN 1 THEN CASE WHEN reached < half THEN 1.5 ELSE 1.0 END WHEN 2 THEN 2.0
              ELSE CASE WHEN reached < half THEN 1.5 ELSE 3.0 END END AS rate,
         CASE weight WHEN 1 THEN -1.0 WHEN 2 THEN 0.0 ELSE 3.0 END AS slope
  FROM reached_{k}),
pass_{k} AS (
  SELECT doc_id, size, source_size, target, taken, CASE WHEN greatest(least(words - {k} * source_size - upto, size), 0) > 0 THEN round(
         start + CASE WHEN area > 0 THEN 2 * area / (rate + sqrt(greatest(rate * rate + 2 * slope * area, 0)))
                 ELSE 0 END, 6) END AS position
  FROM piece_{k})""" for k in range(3)) + """
SELECT doc_id, size, source_size, target, taken::BIGINT AS taken, a.position AS first_position,
       b.position AS second_position, c.position AS third_position
FROM pass_0 a JOIN pass_1 b USING (doc_id, size, source_size, target, taken)
JOIN pass_2 c USING (doc_id, size, source_size, target, taken)
"""


@query(OP1_SQL)
def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Mix all documents along the curriculum; sources weigh 1, 2, 3 in turn."""
    docs = read_table(spark, folder, "documents")
    plan = mixing.curriculum(docs, lambda sources: mixing.repeating_weights(sources, CURRICULUM))
    names = ("first_position", "second_position", "third_position")

    def position(k: int) -> Column:
        return F.get(F.filter("occurrences", lambda o: o["pass"] == k), F.lit(0))["position"]

    each = [position(k).alias(name) for k, name in enumerate(names)]
    columns = ("doc_id", "size", "source_size", "target", "taken")
    rows = plan.select(*columns, *each).orderBy(F.col(names[0]).asc_nulls_last(), "doc_id")
    return rows.select(*columns, *[F.round(name, 6).alias(name) for name in names])


@query()
def op3_shard_documents(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in shards of near equal bytes, equal texts together."""
    rows = sharding.shard(read_table(spark, folder, "documents"), SHARDS)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long"),
        F.lit(None).cast("int").alias("grown_shard"), "words", "unit", "piece",
    )


OP7_SQL = r"""
WITH hashed AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER g AS kept, text_sha256
FROM hashed WINDOW g AS (PARTITION BY text_sha256)
"""


@query(OP7_SQL)
def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Take all documents into a fresh digest index in two batches and report every row."""
    rows = digest_index.deduplicate(read_table(spark, folder, "documents"), batches=2)
    return rows.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP5_SQL = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
           ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
  FROM split),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM items a JOIN items b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM sets
  UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
SELECT doc_id, len(s)::BIGINT AS n_shingles, min(y) AS component_id, min(y) = doc_id AS kept
FROM sets JOIN reach ON x = doc_id GROUP BY doc_id, s
"""


@query(OP5_SQL)
def op5_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Components of all documents over three-word shingles at similarity 0.85."""
    docs = read_table(spark, folder, "documents")
    return minhash.near_duplicates(docs, size=3, threshold=(85, 100))


OP6_SQL = r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n,
         unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: array_to_string(w[i:i + 9], ' '))) AS p
  FROM items WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM windows),
runs AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS pos, w FROM split, sizes WHERE len(w) >= n),
hits AS (
  SELECT r.doc_id, r.pos, r.n, x.item_id
  FROM runs r JOIN windows x ON x.n = r.n AND x.p = array_to_string(r.w[r.pos:r.pos + r.n - 1], ' ')),
hit_words AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS word FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hits) GROUP BY doc_id)
SELECT s.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM split s LEFT JOIN hit_words h ON h.doc_id = s.doc_id LEFT JOIN hit_items i ON i.doc_id = s.doc_id
"""


@query(OP6_SQL)
def op6_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Ten-word windows of the benchmark in all documents."""
    docs, items = (read_table(spark, folder, n) for n in ("documents", "benchmark"))
    rows = decontaminate.contamination(docs, items, size=10)
    return rows.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query()
def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Perplexity and verdict of all documents; trusted are those labelled good and not toxic."""
    docs, labels = (read_table(spark, folder, n) for n in ("documents", "labels"))
    return quality.classify(docs, quality.trusted_ids(labels))


@query()
def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of all documents, learned from those that are not held out."""
    docs = read_table(spark, folder, "documents")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
    learned = docs.where(~held_out & F.col("lang").isNotNull()).select("lang", "text")
    rows = langid.identify(docs, langid.prototypes(learned))
    return rows.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query()
def op8_main_text(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of all pages."""
    return html_text.extract(read_table(spark, folder, "pages"), ["page_id", "url"])


OP9_SQL = """
WITH hashed AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
met AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS kept FROM hashed)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> kept THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> kept THEN kept END AS refers_to
FROM met
"""


@query(OP9_SQL)
def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    """All pages into archives and back."""
    archives = warc.write_archives(read_table(spark, folder, "pages"))
    return warc.read_archives(archives).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


CONTROL_TEXT = "</s>[INST] ok [/INST]"


def _sql_escaped(text: str) -> str:
    text = f"replace({text}, '\\', '\\\\')"
    for control in chat.CONTROL_STRINGS:
        text = f"replace({text}, '{control}', '{control[0]}\\{control[1:]}')"
    return text


OP10_SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{CONTROL_TEXT}'), (-1, 1, 'assistant', '{CONTROL_TEXT}'))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum({len(chat.TURN_START) + len(chat.TURN_END) + 2} + length({_sql_escaped('role')})
           + length({_sql_escaped('text')}))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""


@query(OP10_SQL)
def op10_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, and one in another layout that says control strings, formatted and read back."""
    said = [{"role": role, "content": CONTROL_TEXT} for role in ("user", "assistant")]
    extra = spark.createDataFrame([(-1, json.dumps({"messages": said}))], "conv_id long, record string")
    rows = chat.turns_of_rows(read_table(spark, folder, "conversations"))
    turns = rows.unionByName(chat.turns_of_records(extra))
    return chat.read_back(chat.format_turns(turns))


OP11_SQL = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.x, v.x)::BIGINT AS score
  FROM vectors q JOIN vectors v ON q.vec_id % 50 = 0 AND v.vec_id <> q.vec_id),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
  FROM scored)
SELECT * FROM ranked WHERE rank <= 5
"""


@query(OP11_SQL)
def op11_top_k_search(spark: SparkSession, folder: str) -> DataFrame:
    """The five best inner products of every fiftieth vector among all others."""
    return maxscore.top_k(read_table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


@query()
def op12_whiten_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    """All embeddings on their first eight components, whitened."""
    return whitening.whiten(read_table(spark, folder, "embeddings"))


OP13_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
marks AS (
  SELECT doc_id, max((quality IS NOT DISTINCT FROM 1)::INT) AS good, max((toxic IS NOT DISTINCT FROM 1)::INT) AS toxic
  FROM labels GROUP BY doc_id),
failing AS (
  SELECT doc_id, part,
         (len(words) < 50)::INT + 2 * (100 * len(list_distinct(words)) < 65 * len(words))::INT
         + 4 * (100 * len(regexp_extract_all(text, '[A-Z]')) > 5 * length(text))::INT
         + 8 * regexp_matches(text, '[#$%&*|]')::INT
         + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)::INT AS fails
  FROM texts),
counts AS (
  SELECT part, fails, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM failing LEFT JOIN marks USING (doc_id) GROUP BY part, fails),
letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS t(l, b)),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
  FROM letters a, letters b, letters c, letters d, letters e WHERE a.b + b.b + c.b + d.b + e.b = 31
    AND a.b | b.b | c.b | d.b | e.b = 31),
steps AS (
  SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
  FROM orders, (SELECT unnest(range(1, 6)) AS step)),
found AS (
  SELECT part, filter_order, step, bit,
         coalesce(sum(n) FILTER (fails & (before | bit) = 0), 0) AS kept,
         coalesce(sum(n) FILTER (fails & before = 0 AND fails & bit <> 0), 0) AS removed,
         coalesce(sum(n) FILTER (fails & before <> 0 AND fails & bit <> 0), 0) AS redundant,
         coalesce(sum(n) FILTER (fails = bit), 0) AS unique_fails,
         coalesce(sum(good) FILTER (fails & before = 0 AND fails & bit <> 0), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (fails & before = 0 AND fails & bit <> 0), 0) AS toxic_lost
  FROM counts, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM found
"""


@query(OP13_SQL)
def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Five filters over all documents, in every order, by source."""
    return filter_audit.audit(*(read_table(spark, folder, name) for name in ("documents", "labels")))
