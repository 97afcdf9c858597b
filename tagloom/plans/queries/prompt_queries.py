"""Queries on prompts, training records, the example bank and request validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagloom.fixed_values import (
    CHAT_TEMPLATE,
    FEW_SHOT_EXAMPLE,
    FEW_SHOT_SEPARATOR,
    FEW_SHOT_TEMPLATE,
    SERVING_BANK_ENTRIES,
    SERVING_EXAMPLE,
    SERVING_FEW_SHOT_TEMPLATE,
    SYSTEM_PROMPT,
    ZERO_SHOT_TEMPLATE,
)
from tagloom.functions import prompts
from tagloom.functions.text import word_count
from tagloom.operators import validate
from tagloom.operators.bank import first_examples, with_bank
from tagloom.operators.bank import few_shot_bank as draw_bank
from tagloom.operators.clean import drop_missing
from tagloom.plans.queries.registry import (
    BANK,
    KEPT,
    REQUESTS,
    SPLITS,
    STOPWORD_LABELS,
    UTTERANCE_LABELS,
    V1,
    registered,
    sql_strip,
)
from tagloom.session import staging_path
from tagloom.sources import jsonl
from tagloom.sources.jsonl import (
    read_chat_jsonl,
    read_example_bank,
    write_chat_jsonl,
    write_example_bank,
)


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sql_fill(template: str, **holes: str) -> str:
    """SQL text of the template with SQL expressions in its holes."""
    text = _quoted(template)
    for name, expression in holes.items():
        text = text.replace("{" + name + "}", f"' || {expression} || '")
    return text


def _sql_zero_shot(text: str, labels) -> str:
    filled = ZERO_SHOT_TEMPLATE.replace("{labels}", prompts.label_bullets(labels))
    return _sql_fill(filled, instruction=text)


def _sql_chat(text: str) -> str:
    return _sql_fill(CHAT_TEMPLATE.replace("{system}", SYSTEM_PROMPT), instruction=text)


def _sql_serving(text: str, block: str, labels) -> str:
    filled = SERVING_FEW_SHOT_TEMPLATE.replace("{labels}", prompts.label_bullets(labels))
    return _sql_fill(filled, examples=block, instruction=text)


_BLOCK = f"""block AS (
  SELECT coalesce(string_agg({_sql_fill(SERVING_EXAMPLE, example='examples[1]', intent='intent')},
         '' ORDER BY intent), '') AS shown
  FROM (SELECT * FROM bank ORDER BY intent LIMIT 3) WHERE len(examples) > 0)"""


def _train_bank(splits):
    return draw_bank(splits.where("split = 'train'"), UTTERANCE_LABELS)


def _serving_bank(splits):
    """What serving prompts show: the first example of the first labels."""
    return first_examples(_train_bank(splits), SERVING_BANK_ENTRIES)


def _texts(t):
    """All documents with a text."""
    documents = t.read("documents").where("text IS NOT NULL")
    return documents.select(F.col("doc_id").alias("row_id"), F.col("text").alias("instruction"))


@registered(f"""WITH {KEPT}
SELECT row_id, md5({_sql_zero_shot('instruction', UTTERANCE_LABELS)}) AS digest,
       length({_sql_zero_shot('instruction', UTTERANCE_LABELS)})::INT AS n_chars FROM kept""")
def zero_shot_prompt(t):
    prompt = prompts.zero_shot_prompt(F.col("instruction"), UTTERANCE_LABELS)
    rows = drop_missing(t.utterances()).select("row_id", prompt.alias("prompt"))
    return rows.select("row_id", F.md5("prompt").alias("digest"), F.length("prompt").alias("n_chars"))


@registered(f"""WITH {BANK}, drawn AS (
  SELECT s.doc_id AS row_id, s.text AS instruction, b.intent, b.examples,
         md5((42 + s.doc_id)::VARCHAR || ':' || b.intent) AS draw
  FROM documents s CROSS JOIN bank b WHERE len(b.examples) > 0 AND s.text IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY s.doc_id ORDER BY draw) <= 2),
blocks AS (
  SELECT row_id, instruction, string_agg({_sql_fill(FEW_SHOT_EXAMPLE,
    example="examples[1 + ('0x' || substr(draw, 1, 8))::BIGINT % len(examples)]", intent='intent')},
    {_quoted(FEW_SHOT_SEPARATOR)} ORDER BY draw) AS shown
  FROM drawn GROUP BY row_id, instruction)
SELECT row_id, {_sql_fill(FEW_SHOT_TEMPLATE.replace(
    '{labels}', prompts.label_bullets(UTTERANCE_LABELS)),
    examples='shown', instruction='instruction')} AS prompt FROM blocks""")
def few_shot_prompt(t):
    rows = with_bank(_texts(t), _train_bank(t.splits()))
    prompt = prompts.few_shot_prompt(
        F.col("instruction"), F.col("row_id"), F.col("_bank"), UTTERANCE_LABELS, n_labels=2
    )
    return rows.select("row_id", prompt.alias("prompt"))


@registered(f"""WITH {BANK}, {_BLOCK}
SELECT doc_id AS row_id, {_sql_serving('text', 'shown', UTTERANCE_LABELS)} AS prompt
FROM documents, block WHERE text IS NOT NULL""")
def fixed_few_shot_prompt(t):
    rows = with_bank(_texts(t), _serving_bank(t.splits()))
    prompt = prompts.fixed_few_shot_prompt(F.col("instruction"), F.col("_bank"), UTTERANCE_LABELS)
    return rows.select("row_id", prompt.alias("prompt"))


@registered(f"""WITH {KEPT}
SELECT row_id, 'system' AS role_1, {_quoted(SYSTEM_PROMPT)} AS content_1, 'user' AS role_2,
       'Customer message: ' || instruction AS content_2, 'assistant' AS role_3,
       intent AS content_3 FROM kept""")
def chat_record(t):
    record = prompts.chat_record(F.col("instruction"), F.col("intent"))
    rows = drop_missing(t.utterances()).select("row_id", record.alias("messages"))
    return rows.select(
        "row_id",
        *[F.col("messages")[i][part].alias(f"{part}_{i + 1}") for i in range(3) for part in ("role", "content")],
    )


@registered(f"WITH {KEPT} SELECT row_id, {_sql_chat('instruction')} AS prompt FROM kept")
def chat_prompt(t):
    prompt = prompts.chat_prompt(F.col("instruction"))
    return drop_missing(t.utterances()).select("row_id", prompt.alias("prompt"))


@registered(f"""WITH {BANK}, {_BLOCK}, requests AS ({REQUESTS})
SELECT request_id, approach,
  CASE approach WHEN 'zero_shot' THEN {_sql_zero_shot('text', STOPWORD_LABELS)}
       WHEN 'few_shot' THEN {_sql_serving('text', 'shown', STOPWORD_LABELS)}
       ELSE {_sql_chat('text')} END AS prompt
FROM requests, block""")
def prompt_dispatch(t):
    rows = with_bank(t.requests(), _serving_bank(t.splits()))
    prompt = prompts.prompt_for(F.col("approach"), F.col("text"), F.col("_bank"), STOPWORD_LABELS)
    return rows.select("request_id", "approach", prompt.alias("prompt"))


@registered(f"""WITH {BANK}
SELECT intent, len(examples)::INT AS n_examples, array_to_string(examples, '|') AS examples
FROM bank""")
def few_shot_bank(t):
    bank = _train_bank(t.splits())
    return bank.select(
        "intent",
        F.size("examples").alias("n_examples"),
        F.array_join("examples", "|").alias("examples"),
    )


@registered(f"""WITH {BANK}
SELECT intent, len(examples)::INT AS n_examples, array_to_string(examples, '|') AS examples
FROM bank""")
def example_bank_roundtrip(t):
    path = staging_path(t.spark, "bank")
    write_example_bank(_train_bank(t.splits()), path)
    return read_example_bank(t.spark, path).select(
        "intent",
        F.size("examples").alias("n_examples"),
        F.array_join("examples", "|").alias("examples"),
    )


@registered(f"""WITH {SPLITS}
SELECT split, 3::INT AS n_messages, 'Customer message: ' || instruction AS user_content,
       intent AS assistant_content FROM splits WHERE split IN ('train', 'val')""")
def write_chat_jsonl_query(t):
    path = staging_path(t.spark, "chat")
    write_chat_jsonl(t.splits(), path)
    return read_chat_jsonl(t.spark, path).select(
        "split",
        F.size("messages").alias("n_messages"),
        F.col("messages")[1]["content"].alias("user_content"),
        F.col("messages")[2]["content"].alias("assistant_content"),
    )


@registered(f"""WITH requests AS ({REQUESTS})
SELECT request_id, coalesce(approach, 'fine_tuned') AS approach,
       CASE WHEN text IS NULL THEN 'text is missing'
            WHEN length(text) < 1 THEN 'text is shorter than 1'
            WHEN length(text) > 1000 THEN 'text is longer than 1000' END AS error
FROM requests""")
def validate_requests(t):
    return validate.validate_requests(t.requests()).select("request_id", "approach", "error")


@registered(f"""WITH {V1}
SELECT row_id, instruction IS NOT NULL AND intent IS NOT NULL AS is_valid,
       CASE WHEN instruction IS NOT NULL AND intent IS NOT NULL
            THEN 'system,user,assistant' END AS roles FROM v1""")
def validate_chat_rows(t):
    record = prompts.chat_record(F.col("instruction"), F.col("intent"))
    complete = F.col("instruction").isNotNull() & F.col("intent").isNotNull()
    rows = t.utterances().select("row_id", F.when(complete, record).alias("messages"))
    roles = F.array_join(F.transform("messages", lambda m: m["role"]), ",")
    return validate.validate_chat_rows(rows).select("row_id", "is_valid", roles.alias("roles"))


@registered("""WITH turns AS (
  SELECT conv_id, count(*) AS n_messages, string_agg(role, ',' ORDER BY turn) AS roles
  FROM conversations GROUP BY conv_id)
SELECT conv_id, n_messages, roles = 'system,user,assistant' AS is_valid FROM turns""")
def validate_chat_turns(t):
    return validate.validate_chat_turns(t.chat_turns())


@registered(f"""WITH {V1}
SELECT row_id, CASE WHEN {sql_strip('instruction')} = '' THEN 0
  ELSE len(regexp_extract_all(instruction, '\\S+')) END::INT AS n_words
FROM v1 WHERE instruction IS NOT NULL""")
def word_counts(t):
    rows = t.utterances().where("instruction IS NOT NULL")
    return rows.select("row_id", word_count(F.col("instruction")).alias("n_words"))


# Chat records by doc_id: right ones, wrong order, wrong count, an empty list, none at all.
_BROKEN = """
SELECT doc_id AS row_id, CASE doc_id % 5 WHEN 0 THEN 'system,user,assistant' WHEN 1 THEN 'user,system,assistant'
  WHEN 2 THEN 'system,user' WHEN 3 THEN '' END AS roles, text FROM documents"""


@registered(f"""WITH made AS ({_BROKEN})
SELECT row_id, coalesce(roles = 'system,user,assistant', false) AS is_valid,
       (SELECT min(row_id) FROM made WHERE roles IS NULL) AS first_without FROM made""")
def validate_chat_broken(t):
    documents = t.read("documents")
    made = t.spark.sql(_BROKEN.replace("FROM documents", "FROM {documents}"), documents=documents)
    roles = F.filter(F.split("roles", ","), lambda role: role != "")
    messages = F.transform(roles, lambda role: F.struct(role.alias("role"), F.col("text").alias("content")))
    rows = made.select("row_id", messages.alias("messages"))
    try:
        validate.require_chat_rows(rows)
        first = None
    except ValueError as missing:
        first = int(str(missing).split()[1])
    return validate.validate_chat_rows(rows).select(
        "row_id", "is_valid", F.lit(first).cast("bigint").alias("first_without")
    )


@registered("""WITH placed AS (
  SELECT doc_id, doc_id // 100 AS part, row_number() OVER (PARTITION BY doc_id // 100 ORDER BY doc_id) AS line FROM documents)
SELECT part, line, CASE WHEN doc_id % 7 = 0 THEN 'broken' ELSE 'no messages' END AS reason
FROM placed WHERE doc_id % 7 = 0 OR (doc_id % 11 = 0 AND doc_id % 5 <> 0)""")
def validate_chat_jsonl(t):
    """File and line of the offenders among chat records written to many files, with blank lines between."""
    path = staging_path(t.spark, "chat-lines")
    messages = F.array(F.struct(F.lit("user").alias("role"), F.col("text").alias("content")))
    whole = F.to_json(F.struct(messages.alias("messages")))
    line = (
        F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit('{"messages": [{"role": '), F.col("doc_id")))
        .when(F.col("doc_id") % 5 == 0, F.lit(" "))
        .when(F.col("doc_id") % 11 == 0, F.to_json(F.struct("doc_id")))
        .otherwise(whole)
    )
    lines = t.read("documents").select(F.call_function("div", "doc_id", F.lit(100)).alias("part"), "doc_id", line.alias("value"))
    lines.repartition("part").sortWithinPartitions("part", "doc_id").select("part", "value").write.partitionBy("part").text(path)
    found = jsonl.chat_offenders(t.spark, path)
    part = F.regexp_extract("file", r"part=(\d+)/", 1).cast("bigint")
    return found.select(part.alias("part"), "line", "reason")
