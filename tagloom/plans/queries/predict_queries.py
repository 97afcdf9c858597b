"""Queries on predictors and the three-way comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagloom.labels import LabelSpace
from tagloom.operators import predict
from tagloom.operators.bank import few_shot_bank
from tagloom.operators.classifier import (
    load_classifier,
    predict_with,
    save_classifier,
    train_text_classifier,
)
from tagloom.operators.metrics import per_class_prf
from tagloom.operators.naive_bayes import predict_naive_bayes, train_naive_bayes
from tagloom.operators.softmax import Settings, predict_softmax, train_softmax
from tagloom.operators.split import hash_split
from tagloom.plans import evaluate
from tagloom.plans.queries.registry import (
    BANK,
    STOPWORD_LABELS,
    UTTERANCE_LABELS,
    registered,
    rounded,
    sql_list,
    sql_scores,
    sql_summary,
    sql_values,
)
from tagloom.session import stage, staging_path


def sql_tokens(text: str) -> str:
    parts = f"list_distinct(string_split_regex(lower({text}), '[^a-z0-9]+'))"
    return f"[x FOR x IN {parts} IF x <> '']"


def sql_lexical(source: str, key: str, text: str, labels) -> str:
    """WITH parts up to ``lexical(key, raw_output)`` for a table and its text column."""
    scores = [
        f"len(list_intersect(tokens, [{', '.join(repr(w) for w in label.split('_'))}]))"
        for label in labels
    ]
    best = f"greatest({', '.join(scores)})"
    cases = " ".join(
        f"WHEN {score} = {best} THEN '{label}'" for score, label in zip(scores, labels, strict=True)
    )
    return f"""tokenised AS (SELECT {key}, {sql_tokens(text)} AS tokens FROM {source}),
lexical AS (
  SELECT {key}, CASE WHEN {best} = 0 THEN 'unknown' {cases} END AS raw_output FROM tokenised)"""


_LEXICAL = f"""WITH {sql_lexical('documents', 'doc_id', 'text', STOPWORD_LABELS)}
SELECT doc_id, raw_output FROM lexical"""


@registered(_LEXICAL)
def zero_shot_lexical(t):
    documents = t.read("documents").select("doc_id", "text")
    predicted = predict.zero_shot_lexical(documents, STOPWORD_LABELS, "text")
    return predicted.select("doc_id", "raw_output")


@registered(_LEXICAL)
def predict_batch(t):
    documents = t.read("documents").select("doc_id", "text")
    labels = tuple(STOPWORD_LABELS)
    answered = predict.predict_batch(
        documents, lambda: predict.LexicalPredictor(labels), f"lexical:{labels}", "text"
    )
    return answered.select("doc_id", "raw_output")


@registered(f"""WITH {BANK}, examples AS (
  SELECT intent, {sql_tokens('e')} AS shown FROM bank, unnest(examples) AS u(e)),
texts AS (SELECT doc_id AS row_id, {sql_tokens('text')} AS tokens FROM documents WHERE text IS NOT NULL),
scored AS (
  SELECT row_id, intent, len(list_intersect(tokens, shown)) AS shared,
         len(tokens) + len(shown) - len(list_intersect(tokens, shown)) AS whole
  FROM texts CROSS JOIN examples),
ranked AS (
  SELECT row_id, intent, CASE WHEN whole > 0 THEN shared / whole ELSE 0 END AS similarity
  FROM scored
  QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY similarity DESC, intent) = 1)
SELECT row_id, intent AS raw_output, round(similarity, 6) AS similarity FROM ranked""")
def few_shot_nearest(t):
    """Examples from the train split, all documents with a text to label."""
    bank = stage(few_shot_bank(t.splits().where("split = 'train'"), UTTERANCE_LABELS), "bank")
    documents = t.read("documents").where("text IS NOT NULL").select(F.col("doc_id").alias("row_id"), "text")
    nearest = predict.few_shot_nearest(documents, bank, "text")
    return rounded(nearest.select("row_id", "raw_output", "similarity"))


def sql_naive_bayes(train: str, test: str, key: str, text: str, label: str, labels) -> str:
    """WITH parts up to ``bayes(key, raw_output)``; log probabilities in whole millionths."""
    return f"""learned AS (
  SELECT {label} AS label, {sql_tokens(text)} AS tokens FROM {train}
  WHERE {text} IS NOT NULL AND {label} IN ({sql_list(labels)})),
pairs AS (SELECT label, word, count(*) AS n FROM (SELECT label, unnest(tokens) AS word FROM learned) GROUP BY label, word),
vocabulary AS (SELECT DISTINCT word FROM pairs),
sizes AS (
  SELECT k.label, k.n AS documents, coalesce(p.words, 0) + (SELECT count(*) FROM vocabulary) AS places,
         sum(k.n) OVER () AS all_documents
  FROM (SELECT label, count(*) AS n FROM learned GROUP BY label) k
  LEFT JOIN (SELECT label, sum(n) AS words FROM pairs GROUP BY label) p ON p.label = k.label),
bases AS (
  SELECT label, places, round(ln(documents / all_documents) * 1000000)::BIGINT AS prior,
         round(ln(1 / places) * 1000000)::BIGINT AS unseen FROM sizes),
met_words AS (
  SELECT t.{key}, x.word FROM (SELECT {key}, unnest({sql_tokens(text)}) AS word FROM {test}) x
  JOIN vocabulary v ON v.word = x.word JOIN {test} t ON t.{key} = x.{key}),
seen AS (SELECT {key}, count(*) AS n FROM met_words GROUP BY {key}),
gains AS (
  SELECT k.{key}, p.label, sum(round(ln((p.n + 1) / b.places) * 1000000)::BIGINT - b.unseen) AS gain
  FROM met_words k JOIN pairs p ON p.word = k.word JOIN bases b ON b.label = p.label GROUP BY k.{key}, p.label),
bayes AS (
  SELECT t.{key}, b.label AS raw_output
  FROM {test} t CROSS JOIN bases b
  LEFT JOIN seen s ON s.{key} = t.{key} LEFT JOIN gains g ON g.{key} = t.{key} AND g.label = b.label
  QUALIFY row_number() OVER (PARTITION BY t.{key}
    ORDER BY b.prior + coalesce(s.n, 0) * b.unseen + coalesce(g.gain, 0) DESC, b.label) = 1)"""


_LANGUAGES = LabelSpace(["de", "en", "es", "fr"])


@registered(f"""WITH hashed AS (
  SELECT *, ('0x' || substr(md5('42:' || text), 1, 8))::BIGINT % 10000 AS bucket FROM documents WHERE text IS NOT NULL),
train AS (SELECT * FROM hashed WHERE bucket < 7000), test AS (SELECT * FROM hashed WHERE bucket >= 8500),
{sql_naive_bayes('train', 'test', 'doc_id', 'text', 'lang', _LANGUAGES)}
SELECT doc_id, lang, raw_output FROM bayes JOIN test USING (doc_id)""", name="train_text_classifier")
def naive_bayes_query(t):
    """Trained on the train split of all documents, asked about the test split."""
    documents = t.read("documents").where("text IS NOT NULL").select("doc_id", "text", "lang")
    split = hash_split(documents, key_col="text")
    model = train_naive_bayes(split.where("split = 'train'"), _LANGUAGES, "text", "lang")
    test = split.where("split = 'test'")
    answered = predict_naive_bayes(test, model, "doc_id", "text")
    return test.select("doc_id", "lang").join(answered, "doc_id")


# Three epochs of two batches, so that the SQL stays readable.
_SOFTMAX = Settings(epochs=3, batches=2, rate=60.0, warm_up=0.25, max_norm=0.5, dims=1 << 13)


def sql_softmax(train: str, test: str, key: str, text: str, label: str, labels, settings) -> str:
    """WITH parts up to ``softmax(key, raw_output)``: every step of the training in turn."""

    def features(source: str, more: str) -> str:
        bucket = f"('0x' || substr(md5(w), 1, 8))::BIGINT % {settings.dims}"
        return f"""SELECT {key}, {more} list_append(list_distinct([{bucket} FOR w IN {sql_tokens(text)}]), {settings.dims}) AS fs FROM {source}
  WHERE {text} IS NOT NULL"""

    batch = f"('0x' || substr(md5('{settings.seed}:batch:' || {key}), 1, 8))::BIGINT % {settings.batches}"
    parts = [
        f"listed(l) AS (VALUES {sql_values(labels)})",
        f"taught_rows AS MATERIALIZED ({features(train, f'{label} AS y, {batch} AS batch,')} AND {label} IN ({sql_list(labels)}))",
        f"tested_rows AS MATERIALIZED ({features(test, '')})",
        "weights_0 AS (SELECT 0 AS f, l, 0::BIGINT AS w FROM listed)",
    ]
    for step in range(settings.epochs * settings.batches):
        rate = settings.rate_at(step)
        parts.append(f"""rows_{step} AS MATERIALIZED (SELECT {key}, y, unnest(fs) AS f FROM taught_rows WHERE batch = {step % settings.batches}),
scores_{step} AS MATERIALIZED (
  SELECT r.{key}, r.y, x.l, sum(coalesce(w.w, 0)) AS s
  FROM rows_{step} r CROSS JOIN listed x LEFT JOIN weights_{step} w ON w.f = r.f AND w.l = x.l GROUP BY ALL),
powers_{step} AS (SELECT *, exp((s - max(s) OVER (PARTITION BY {key})) / 1000000) AS e FROM scores_{step}),
apart_{step} AS MATERIALIZED (
  SELECT {key}, l, floor(e / sum(e) OVER (PARTITION BY {key}) * 1048576 + 0.5)::BIGINT - CASE WHEN l = y THEN 1048576 ELSE 0 END AS d
  FROM powers_{step}),
slopes_{step} AS MATERIALIZED (
  SELECT r.f, a.l, sum(a.d) / (1048576 * (SELECT count(DISTINCT {key}) FROM rows_{step})) AS g
  FROM rows_{step} r JOIN apart_{step} a ON a.{key} = r.{key} GROUP BY r.f, a.l),
moves_{step} AS (
  SELECT f, l, floor({rate!r} * least(1.0, {settings.max_norm!r} / (SELECT sqrt(sum(g * g)) FROM slopes_{step})) * g * 1000000 + 0.5)::BIGINT AS m
  FROM slopes_{step}),
weights_{step + 1} AS MATERIALIZED (
  SELECT coalesce(w.f, m.f) AS f, coalesce(w.l, m.l) AS l, coalesce(w.w, 0) - coalesce(m.m, 0) AS w
  FROM weights_{step} w FULL JOIN moves_{step} m ON m.f = w.f AND m.l = w.l)""")
    last = settings.epochs * settings.batches
    parts.append(f"""asked AS (SELECT {key}, unnest(fs) AS f FROM tested_rows),
softmax AS (
  SELECT a.{key}, x.l AS raw_output
  FROM asked a CROSS JOIN listed x LEFT JOIN weights_{last} w ON w.f = a.f AND w.l = x.l GROUP BY a.{key}, x.l
  QUALIFY row_number() OVER (PARTITION BY a.{key} ORDER BY sum(coalesce(w.w, 0)) DESC, x.l) = 1)""")
    return ",\n".join(parts)


@registered(f"""WITH hashed AS (
  SELECT *, ('0x' || substr(md5('42:' || text), 1, 8))::BIGINT % 10000 AS bucket FROM documents WHERE text IS NOT NULL),
train AS (SELECT * FROM hashed WHERE bucket < 7000), test AS (SELECT * FROM hashed WHERE bucket >= 8500),
{sql_softmax('train', 'test', 'doc_id', 'text', 'lang', _LANGUAGES, _SOFTMAX)}
SELECT doc_id, lang, raw_output FROM softmax JOIN test USING (doc_id)""")
def softmax_regression(t):
    """Trained by gradient steps on the train split of all documents, asked about the test split."""
    documents = t.read("documents").where("text IS NOT NULL").select("doc_id", "text", "lang")
    split = hash_split(documents, key_col="text")
    model = train_softmax(split.where("split = 'train'"), _LANGUAGES, None, _SOFTMAX, "doc_id", "text", "lang")
    asked = split.where("split = 'test'").select("doc_id", "lang", "text")
    return predict_softmax(asked, model, "text").select("doc_id", "lang", "raw_output")


@registered()
def spark_ml_classifier(t):
    """The pipeline of Spark ML on the same split, stored and loaded."""
    documents = t.read("documents").where("text IS NOT NULL").select("doc_id", "text", "lang")
    split = hash_split(documents, key_col="text")
    model = train_text_classifier(split.where("split = 'train'"), _LANGUAGES, "text", "lang")
    path = staging_path(t.spark, "classifier")
    save_classifier(model, t.spark, path, "naive_bayes", _LANGUAGES)
    loaded, _ = load_classifier(t.spark, path)
    return predict_with(loaded, split.where("split = 'test'").drop("split")).select("doc_id", "lang", "raw_output")


@registered(f"""WITH {BANK}, samples AS (SELECT * FROM splits WHERE split = 'test'),
{sql_lexical('samples', 'row_id', 'instruction', UTTERANCE_LABELS)},
examples AS (SELECT intent, {sql_tokens('e')} AS shown FROM bank, unnest(examples) AS u(e)),
compared AS (
  SELECT row_id, x.intent, len(list_intersect(tokens, shown)) AS shared,
         len(tokens) + len(shown) - len(list_intersect(tokens, shown)) AS whole
  FROM tokenised CROSS JOIN examples x),
nearest AS (
  SELECT row_id, intent AS raw_output, CASE WHEN whole > 0 THEN shared / whole ELSE 0 END AS similarity
  FROM compared QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY similarity DESC, intent) = 1),
predictions AS (
  SELECT 'zero_shot' AS approach, intent AS truth, raw_output AS prediction
  FROM samples JOIN lexical USING (row_id)
  UNION ALL SELECT 'few_shot', intent, raw_output FROM samples JOIN nearest USING (row_id)),
{sql_scores(UTTERANCE_LABELS)}
SELECT approach, label, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1, support FROM scores""")
def compare_untrained(t):
    """The comparison without the trained approach, which is exactly reproducible in SQL."""
    train, samples = _train_and_samples(t)
    bank = stage(few_shot_bank(train, UTTERANCE_LABELS), "bank")
    approaches = evaluate.default_approaches(UTTERANCE_LABELS, bank, lambda: None)
    enabled = ("zero_shot", "few_shot")
    predictions = evaluate.compare_approaches(samples, approaches, UTTERANCE_LABELS, enabled)
    return rounded(per_class_prf(predictions, UTTERANCE_LABELS))


_SCORES = [f"{kind}_{name}" for kind in ("macro", "weighted") for name in ("precision", "recall", "f1")]
_WITHOUT_LATENCY = "approach, " + ", ".join(
    [f"round({c}, 6) AS {c}" for c in ("accuracy", *_SCORES, "token_cost_per_1k")]
    + ["correct_samples", "total_samples", "intent_count"]
)


def _train_and_samples(t):
    splits = stage(t.splits(), "splits")
    test = splits.where(F.col("split") == "test")
    samples = test.select(F.col("row_id").alias("sample_id"), "instruction", "intent")
    return splits.where(F.col("split") == "train"), samples


@registered(f"""WITH {BANK}, samples AS (SELECT * FROM splits WHERE split = 'test'),
taught AS (SELECT * FROM splits WHERE split = 'train'),
{sql_lexical('samples', 'row_id', 'instruction', UTTERANCE_LABELS)},
examples AS (SELECT intent, {sql_tokens('e')} AS shown FROM bank, unnest(examples) AS u(e)),
compared AS (
  SELECT row_id, x.intent, len(list_intersect(tokens, shown)) AS shared,
         len(tokens) + len(shown) - len(list_intersect(tokens, shown)) AS whole
  FROM tokenised CROSS JOIN examples x),
nearest AS (
  SELECT row_id, intent AS raw_output, CASE WHEN whole > 0 THEN shared / whole ELSE 0 END AS similarity
  FROM compared QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY similarity DESC, intent) = 1),
{sql_naive_bayes('taught', 'samples', 'row_id', 'instruction', 'intent', UTTERANCE_LABELS)},
predictions AS (
  SELECT 'zero_shot' AS approach, instruction AS input_text, intent AS truth, raw_output AS prediction, 0.0 AS latency_ms
  FROM samples JOIN lexical USING (row_id)
  UNION ALL SELECT 'few_shot', instruction, intent, raw_output, 0.0 FROM samples JOIN nearest USING (row_id)
  UNION ALL SELECT 'fine_tuned', instruction, intent, raw_output, 0.0 FROM samples JOIN bayes USING (row_id)),
{sql_summary(UTTERANCE_LABELS)}
SELECT {_WITHOUT_LATENCY}
FROM summary""")
def three_way_benchmark(t):
    """All but the latencies, which differ from run to run."""
    train, samples = _train_and_samples(t)
    bank = stage(few_shot_bank(train, UTTERANCE_LABELS), "bank")
    approaches = evaluate.default_approaches(
        UTTERANCE_LABELS, bank, lambda: train_naive_bayes(train, UTTERANCE_LABELS)
    )
    summary = evaluate.three_way_benchmark(samples, approaches, UTTERANCE_LABELS)
    return rounded(summary.drop("mean_latency_ms", "p95_latency_ms"))
