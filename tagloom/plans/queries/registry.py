"""Registry of queries and the input views they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.functions.matching import match_labels
from tagloom.labels import LabelSpace
from tagloom.operators.clean import clean_dataset
from tagloom.operators.split import stratified_split
from tagloom.session import ship_package, stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

UTTERANCE_LABELS = LabelSpace(["de_text", "en_text", "es_text"])
EVENT_LABELS = LabelSpace(["click", "error", "purchase", "signup", "view"])
FLAG_LABELS = LabelSpace(["A", "N", "R", "Z"])
# Named after frequent words of the four languages, so that name overlap says something.
STOPWORD_LABELS = LabelSpace(["der_die_und", "el_los_que", "la_le_les", "of_the_and"])
MIN_LENGTH, MAX_LENGTH = 5, 2000


class Tables:
    """Input tables of one folder and the views on them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        ship_package(spark)

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def _view(self, sql: str, table: str) -> DataFrame:
        bound = sql.replace(f"FROM {table}", f"FROM {{{table}}}")
        return self.spark.sql(bound, **{table: self.read(table)})

    def utterances(self) -> DataFrame:
        return self._view(RAW_UTTERANCES, "documents")

    def cleaned(self) -> DataFrame:
        """Cleaned utterances, stored: what follows reads them several times."""
        rows = clean_dataset(self.utterances(), UTTERANCE_LABELS, MIN_LENGTH, MAX_LENGTH)
        return stage(rows, "cleaned")

    def splits(self, cleaned: DataFrame | None = None) -> DataFrame:
        rows = self.cleaned() if cleaned is None else cleaned
        return stratified_split(rows, labels=UTTERANCE_LABELS)

    def raw_predictions(self) -> DataFrame:
        return self._view(RAW_PREDICTIONS, "events")

    def predictions(self) -> DataFrame:
        return match_labels(self.raw_predictions(), EVENT_LABELS)

    def chat_turns(self) -> DataFrame:
        return self._view(CHAT_TURNS, "conversations")

    def run_log(self) -> DataFrame:
        return self._view(RUN_LOG, "events")

    def requests(self) -> DataFrame:
        return self._view(REQUESTS, "conversations")

    def bulk_predictions(self) -> DataFrame:
        return self._view(BULK_PREDICTIONS, "lineitem")


def registered(sql: str | None = None, name: str | None = None):
    """Register a function of :class:`Tables` as a query, with its SQL when there is one."""

    def register(query: Callable[[Tables], DataFrame]):
        key = name or query.__name__.removesuffix("_query")
        QUERIES[key] = lambda spark, folder: query(Tables(spark, folder))
        if sql is not None:
            ORACLE[key] = sql
        return query

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, as the order of a floating sum is not fixed."""
    doubles = {f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)}
    return df.select(*[F.round(c, digits).alias(c) if c in doubles else c for c in df.columns])


# ---- input views; each text runs unchanged on both engines -------------------------------

RAW_UTTERANCES = """
SELECT doc_id AS row_id,
       CASE WHEN doc_id % 97 = 0 THEN NULL
            WHEN doc_id % 89 = 0 THEN '   '
            WHEN doc_id % 4 = 0 THEN '  ' || text || chr(10)
            ELSE text END AS instruction,
       CASE WHEN doc_id % 101 = 0 THEN NULL
            WHEN doc_id % 7 = 0 THEN 'other_label'
            WHEN doc_id % 3 = 0 THEN upper(lang) || ' text'
            ELSE lang || '_text' END AS intent,
       source AS category
FROM documents
"""
RAW_PREDICTIONS = """
SELECT event_id AS sample_id,
       CASE event_id % 3 WHEN 0 THEN 'zero_shot' WHEN 1 THEN 'few_shot' ELSE 'fine_tuned' END AS approach,
       event_type || ' ' || props AS input_text,
       event_type AS truth,
       CASE event_id % 8
            WHEN 0 THEN event_type
            WHEN 1 THEN '  ' || upper(event_type) || ' '
            WHEN 2 THEN 'Intent: ' || event_type
            WHEN 3 THEN 'The intent is ' || event_type || ' here'
            WHEN 4 THEN 'click'
            WHEN 5 THEN substr(event_type, 1, 2) || 'z' || substr(event_type, 4)
            WHEN 6 THEN 'xyzzy'
            ELSE 'view or click' END AS raw_output,
       value AS latency_ms
FROM events
"""
CHAT_TURNS = "SELECT conv_id, turn, role, text AS content FROM conversations"
RUN_LOG = """
SELECT user_id AS run_id, event_id AS step,
       CASE WHEN event_type = 'purchase' THEN 'val' ELSE 'train' END AS kind,
       value
FROM events
"""
REQUESTS = """
SELECT conv_id * 1000 + turn AS request_id,
       CASE WHEN turn % 5 = 4 THEN '' ELSE text END AS text,
       CASE role WHEN 'user' THEN 'few_shot' WHEN 'system' THEN 'zero_shot' ELSE NULL END AS approach
FROM conversations
"""
BULK_PREDICTIONS = """
SELECT l_orderkey * 10 + l_linenumber AS sample_id,
       'bulk' AS approach,
       l_returnflag AS truth,
       CASE WHEN l_orderkey % 7 = 0 THEN 'unknown'
            WHEN l_partkey % 5 = 0 THEN 'A'
            ELSE l_returnflag END AS prediction,
       l_extendedprice AS latency_ms
FROM lineitem
"""

# ---- the same work in plain SQL, as WITH parts of the comparison queries ------------------


def sql_strip(text: str) -> str:
    return rf"regexp_replace({text}, '^\s+|\s+$', '', 'g')"


def sql_list(labels: LabelSpace) -> str:
    return ", ".join(f"'{label}'" for label in labels)


def sql_values(labels: LabelSpace) -> str:
    return ", ".join(f"('{label}')" for label in labels)


V1 = f"v1 AS ({RAW_UTTERANCES})"
KEPT = f"""{V1}, kept AS (
  SELECT * FROM v1
  WHERE instruction IS NOT NULL AND intent IS NOT NULL
    AND {sql_strip('instruction')} <> '' AND {sql_strip('intent')} <> '')"""
CLEANED = f"""{KEPT}, stripped AS (
  SELECT row_id, {sql_strip('instruction')} AS instruction,
         replace(lower(intent), ' ', '_') AS intent, category FROM kept),
firsts AS (
  SELECT * FROM stripped
  QUALIFY row_number() OVER (PARTITION BY instruction ORDER BY row_id) = 1),
cleaned AS (
  SELECT intent, row_id, instruction, category, length(instruction)::INT AS text_length,
         CASE intent WHEN 'de_text' THEN 0 WHEN 'en_text' THEN 1 ELSE 2 END::INT AS intent_id
  FROM firsts
  WHERE length(instruction) BETWEEN {MIN_LENGTH} AND {MAX_LENGTH}
    AND intent IN ({sql_list(UTTERANCE_LABELS)}))"""
SPLITS = f"""{CLEANED}, running AS (
  SELECT intent, n, sum(n) OVER (ORDER BY intent) AS upto
  FROM (SELECT intent, count(*) AS n FROM cleaned GROUP BY intent)),
cuts AS (
  SELECT intent,
         (upto * 7000 + 5000) // 10000 - ((upto - n) * 7000 + 5000) // 10000 AS train_rows,
         (upto * 8500 + 5000) // 10000 - ((upto - n) * 8500 + 5000) // 10000 AS train_val_rows
  FROM running),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY intent ORDER BY md5('42:' || instruction)) AS place
  FROM cleaned),
splits AS (
  SELECT row_id, instruction, intent, category, text_length, intent_id,
         CASE WHEN place <= train_rows THEN 'train'
              WHEN place <= train_val_rows THEN 'val'
              ELSE 'test' END AS split FROM placed JOIN cuts USING (intent))"""
BANK = f"""{SPLITS}, known(intent) AS (VALUES {sql_values(UTTERANCE_LABELS)}),
picked AS (
  SELECT intent, instruction, md5('42:' || instruction) AS draw FROM splits WHERE split = 'train'
  QUALIFY row_number() OVER (PARTITION BY intent ORDER BY md5('42:' || instruction)) <= 5),
bank AS (
  SELECT k.intent, coalesce(list(p.instruction ORDER BY p.draw)
         FILTER (p.instruction IS NOT NULL), []) AS examples
  FROM known k LEFT JOIN picked p ON p.intent = k.intent GROUP BY k.intent)"""
V2 = f"v2 AS ({RAW_PREDICTIONS})"
PREDICTIONS = f"""{V2}, lowered AS (
  SELECT *, lower({sql_strip('raw_output')}) AS s FROM v2),
predictions AS (
  SELECT sample_id, approach, input_text, truth, raw_output, latency_ms,
    CASE WHEN s IN ({sql_list(EVENT_LABELS)}) THEN s
         {' '.join(f"WHEN contains(s, '{label}') THEN '{label}'" for label in EVENT_LABELS)}
         WHEN s = 'clzck' THEN 'click' WHEN s = 'erzor' THEN 'error'
         WHEN s = 'puzchase' THEN 'purchase' WHEN s = 'siznup' THEN 'signup'
         WHEN s = 'vizw' THEN 'view' ELSE 'unknown' END AS prediction,
    CASE WHEN s IN ({sql_list(EVENT_LABELS)}) THEN 'exact'
         WHEN {' OR '.join(f"contains(s, '{label}')" for label in EVENT_LABELS)} THEN 'substring'
         WHEN s IN ('clzck', 'erzor', 'puzchase', 'siznup', 'vizw') THEN 'fuzzy'
         ELSE 'unknown' END AS strategy
  FROM lowered)"""
BULK = f"predictions AS ({BULK_PREDICTIONS})"


def sql_scores(labels: LabelSpace) -> str:
    """WITH part ``scores``: precision, recall, F1, support per approach and listed label."""
    return f"""listed(label) AS (VALUES {sql_values(labels)}),
counted AS (
  SELECT a.approach, l.label,
         count(*) FILTER (p.truth = l.label AND p.prediction = l.label) AS tp,
         count(*) FILTER (p.truth = l.label) AS support,
         count(*) FILTER (p.prediction = l.label) AS predicted
  FROM (SELECT DISTINCT approach FROM predictions) a CROSS JOIN listed l
  LEFT JOIN predictions p ON p.approach = a.approach
  GROUP BY a.approach, l.label),
scores AS (
  SELECT approach, label, support,
         CASE WHEN predicted = 0 THEN 0 ELSE tp / predicted END AS precision,
         CASE WHEN support = 0 THEN 0 ELSE tp / support END AS recall,
         CASE WHEN support + predicted = 0 THEN 0 ELSE 2 * tp / (support + predicted) END AS f1
  FROM counted)"""


AVERAGES = """averages AS (
  SELECT approach, avg(precision) AS macro_precision, avg(recall) AS macro_recall,
         avg(f1) AS macro_f1,
         sum(precision * support) / sum(support) AS weighted_precision,
         sum(recall * support) / sum(support) AS weighted_recall,
         sum(f1 * support) / sum(support) AS weighted_f1
  FROM scores GROUP BY approach)"""


def sql_summary(labels: LabelSpace, with_cost: bool = True) -> str:
    """WITH parts up to ``summary``; expects ``predictions``."""
    cost = (
        r"(sum(len(regexp_extract_all(input_text, '\S+'))) * 13 // 10) / count(*) * 0.002"
        if with_cost
        else "0.0"
    )
    return f"""{sql_scores(labels)}, {AVERAGES}, totals AS (
  SELECT approach, count(*) FILTER (truth = prediction) / count(*) AS accuracy,
         avg(latency_ms) AS mean_latency_ms,
         quantile_cont(latency_ms, 0.95) AS p95_latency_ms,
         {cost} AS token_cost_per_1k,
         count(*) FILTER (truth = prediction) AS correct_samples,
         count(*) AS total_samples
  FROM predictions GROUP BY approach),
summary AS (
  SELECT approach, accuracy, macro_precision, weighted_precision, macro_recall, weighted_recall,
         macro_f1, weighted_f1, mean_latency_ms, p95_latency_ms,
         token_cost_per_1k::DOUBLE AS token_cost_per_1k, correct_samples, total_samples,
         {len(labels)}::INT AS intent_count
  FROM totals JOIN averages USING (approach))"""


SUMMARY = f"{PREDICTIONS}, {sql_summary(EVENT_LABELS)}"
SUMMARY_COLUMNS = """approach, round(accuracy, 6) AS accuracy,
  round(macro_precision, 6) AS macro_precision, round(weighted_precision, 6) AS weighted_precision,
  round(macro_recall, 6) AS macro_recall, round(weighted_recall, 6) AS weighted_recall,
  round(macro_f1, 6) AS macro_f1, round(weighted_f1, 6) AS weighted_f1,
  round(mean_latency_ms, 6) AS mean_latency_ms, round(p95_latency_ms, 6) AS p95_latency_ms,
  round(token_cost_per_1k, 6) AS token_cost_per_1k, correct_samples, total_samples, intent_count"""
