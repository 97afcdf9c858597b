"""Queries on label matching and classification metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagloom.functions.matching import confidence as confidence_of
from tagloom.functions.matching import match_many_labels
from tagloom.labels import LabelSpace
from tagloom.operators import metrics
from tagloom.plans.queries.registry import (
    AVERAGES,
    BULK,
    EVENT_LABELS,
    FLAG_LABELS,
    PREDICTIONS,
    SUMMARY,
    SUMMARY_COLUMNS,
    V2,
    registered,
    rounded,
    sql_scores,
    sql_summary,
    sql_values,
)
from tagloom.session import staging_path
from tagloom.sources import results


@registered(f"WITH {PREDICTIONS} SELECT sample_id, raw_output, prediction, strategy FROM predictions")
def normalise_prediction(t):
    return t.predictions().select("sample_id", "raw_output", "prediction", "strategy")


@registered(f"""WITH {PREDICTIONS}
SELECT sample_id, strategy, CASE strategy WHEN 'exact' THEN 1.0 WHEN 'substring' THEN 0.85
       WHEN 'fuzzy' THEN 0.7 ELSE 0.0 END::DOUBLE AS confidence FROM predictions""")
def confidence(t):
    return t.predictions().select(
        "sample_id", "strategy", confidence_of(F.col("strategy")).alias("confidence")
    )


@registered(f"""WITH {PREDICTIONS}
SELECT approach, count(*) FILTER (strategy = 'exact') AS n_exact,
       count(*) FILTER (strategy = 'substring') AS n_substring,
       count(*) FILTER (strategy = 'fuzzy') AS n_fuzzy,
       count(*) FILTER (strategy = 'unknown') AS n_unknown FROM predictions GROUP BY approach""")
def strategy_counts(t):
    return metrics.strategy_counts(t.predictions())


@registered(f"""WITH {PREDICTIONS}
SELECT approach, round(count(*) FILTER (truth = prediction) / count(*), 6) AS accuracy,
       count(*) FILTER (truth = prediction) AS correct_samples, count(*) AS total_samples
FROM predictions GROUP BY approach""")
def accuracy(t):
    return rounded(metrics.accuracy(t.predictions()))


_PER_CLASS = """SELECT approach, label, round(precision, 6) AS precision,
  round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM scores"""
_MACRO_WEIGHTED = """SELECT approach, round(macro_precision, 6) AS macro_precision,
  round(macro_recall, 6) AS macro_recall, round(macro_f1, 6) AS macro_f1,
  round(weighted_precision, 6) AS weighted_precision, round(weighted_recall, 6) AS weighted_recall,
  round(weighted_f1, 6) AS weighted_f1 FROM averages"""


@registered(f"WITH {PREDICTIONS}, {sql_scores(EVENT_LABELS)} {_PER_CLASS}")
def per_class_prf(t):
    return rounded(metrics.per_class_prf(t.predictions(), EVENT_LABELS))


@registered(f"WITH {BULK}, {sql_scores(FLAG_LABELS)} {_PER_CLASS}")
def per_class_prf_bulk(t):
    return rounded(metrics.per_class_prf(t.bulk_predictions(), FLAG_LABELS))


@registered(f"WITH {PREDICTIONS}, {sql_scores(EVENT_LABELS)}, {AVERAGES} {_MACRO_WEIGHTED}")
def macro_weighted(t):
    return rounded(metrics.macro_weighted(t.predictions(), EVENT_LABELS))


def _sql_matrix(labels) -> str:
    return f"""listed(label) AS (VALUES {sql_values(labels)}), matrix AS (
  SELECT a.approach, x.label AS truth, y.label AS prediction,
         (SELECT count(*) FROM predictions p WHERE p.approach = a.approach
          AND p.truth = x.label AND p.prediction = y.label) AS n
  FROM (SELECT DISTINCT approach FROM predictions) a, listed x, listed y)"""


@registered(f"WITH {PREDICTIONS}, {_sql_matrix(EVENT_LABELS)} SELECT * FROM matrix")
def confusion_matrix(t):
    return metrics.confusion_matrix(t.predictions(), EVENT_LABELS)


@registered(f"WITH {BULK}, {_sql_matrix(FLAG_LABELS)} SELECT * FROM matrix")
def confusion_matrix_bulk(t):
    return metrics.confusion_matrix(t.bulk_predictions(), FLAG_LABELS)


@registered(f"""WITH {BULK}, {_sql_matrix(FLAG_LABELS)}
SELECT approach, truth, prediction,
  round(n / greatest(sum(n) OVER (PARTITION BY approach, truth), 1), 6) AS share FROM matrix""")
def confusion_matrix_norm(t):
    matrix = metrics.confusion_matrix(t.bulk_predictions(), FLAG_LABELS)
    return rounded(metrics.confusion_matrix_norm(matrix))


_LATENCY = """SELECT approach, round(avg(latency_ms), 6) AS mean_latency_ms,
  round(quantile_cont(latency_ms, 0.95), 6) AS p95_latency_ms FROM predictions GROUP BY approach"""


@registered(f"WITH {PREDICTIONS} {_LATENCY}")
def latency_stats(t):
    return rounded(metrics.latency_stats(t.raw_predictions()))


@registered(f"WITH {BULK} {_LATENCY}")
def latency_stats_bulk(t):
    return rounded(metrics.latency_stats(t.bulk_predictions()))


@registered(rf"""WITH {PREDICTIONS}, w AS (
  SELECT approach, sum(len(regexp_extract_all(input_text, '\S+')))::BIGINT AS words,
         count(*) AS texts FROM predictions GROUP BY approach)
SELECT approach, words, texts, round((words * 13 // 10) / texts * 0.002, 6)::DOUBLE AS token_cost_per_1k
FROM w""")
def token_cost(t):
    return rounded(metrics.token_cost(t.raw_predictions()))


@registered(f"WITH {SUMMARY} SELECT {SUMMARY_COLUMNS} FROM summary")
def benchmark_summary(t):
    return rounded(metrics.benchmark_summary(t.predictions(), EVENT_LABELS))


@registered(f"""WITH {BULK}, {sql_summary(FLAG_LABELS, with_cost=False)}
SELECT {SUMMARY_COLUMNS} FROM summary""")
def benchmark_summary_bulk(t):
    return rounded(metrics.benchmark_summary(t.bulk_predictions(), FLAG_LABELS, text_col=None))


# NaN and infinite latencies: in some approaches at the wanted rank, in others only beside it.
_SPECIAL = """
SELECT approach, CASE WHEN approach = 'zero_shot' AND sample_id % 7 = 0 THEN {nan}
  WHEN approach = 'few_shot' AND sample_id % 9 = 0 THEN {inf}
  WHEN approach = 'fine_tuned' AND sample_id % 50 = 0 THEN {nan}
  WHEN approach = 'fine_tuned' AND sample_id % 11 = 0 THEN -{inf} ELSE latency_ms END AS latency_ms
FROM predictions"""


@registered(f"""WITH {PREDICTIONS}, special AS (
  {_SPECIAL.format(nan="'nan'::DOUBLE", inf="'inf'::DOUBLE")}),
found AS (SELECT approach, quantile_cont(latency_ms, 0.95) AS p FROM special GROUP BY approach)
SELECT approach, CASE WHEN isnan(p) THEN 'nan' WHEN isinf(p) THEN 'inf' ELSE 'finite' END AS kind,
       CASE WHEN isfinite(p) THEN round(p, 6) END AS p95_latency_ms FROM found""")
def latency_stats_special(t):
    values = _SPECIAL.format(nan="double('NaN')", inf="double('Infinity')")
    special = t.spark.sql(values.replace("FROM predictions", "FROM {predictions}"), predictions=t.predictions())
    p95 = F.col("p95_latency_ms")
    finite = F.abs(p95) < float("inf")
    found = metrics.latency_stats(special).select(
        "approach",
        F.when(F.isnan(p95), "nan").when(finite, "finite").otherwise("inf").alias("kind"),
        F.when(finite, p95).alias("p95_latency_ms"),
    )
    return rounded(found)


@registered(f"""WITH {V2} SELECT approach, count(*) AS n, true AS within_bound FROM v2
WHERE latency_ms IS NOT NULL AND NOT isnan(latency_ms) GROUP BY approach""")
def latency_sketches(t):
    """The 95th percentile of four runs from their stored sketches: its rank is right within one percent."""
    path = staging_path(t.spark, "run-sketches")
    samples = t.raw_predictions()
    for run in range(4):
        results.write_latency_sketches(samples.where(F.col("sample_id") % 4 == run), path, f"run-{run}")
    merged = results.merged_latencies(t.spark, path)
    placed = samples.join(merged, "approach").groupBy("approach", "n").agg(
        (F.count_if(F.col("latency_ms") < F.col("percentile")) / F.first("n")).alias("below"),
        (F.count_if(F.col("latency_ms") <= F.col("percentile")) / F.first("n")).alias("upto"),
    )
    within = (F.col("below") - 0.01 <= 0.95) & (F.col("upto") + 0.01 >= 0.95)
    return placed.select("approach", "n", within.alias("within_bound"))


_NAMES = 20_000


@registered(f"""WITH asked AS (
  SELECT o_orderkey, md5((o_custkey % {_NAMES})::VARCHAR) AS name FROM orders)
SELECT o_orderkey,
  CASE WHEN o_orderkey % 5 = 4 THEN 'unknown' ELSE name END AS prediction,
  CASE o_orderkey % 5 WHEN 0 THEN 'exact' WHEN 1 THEN 'substring' WHEN 4 THEN 'unknown' ELSE 'fuzzy' END AS strategy
FROM asked""")
def normalise_prediction_many(t):
    """Raw output matched to one of 20,000 generated names: whole, inside a sentence, with letters wrong or missing."""
    names = t.spark.range(_NAMES).select(F.md5(F.col("id").cast("string")).alias("name"))
    space = LabelSpace.from_column(names, "name")
    name = F.md5((F.col("o_custkey") % _NAMES).cast("string"))
    kind = F.col("o_orderkey") % 5
    raw = (
        F.when(kind == 0, F.concat(F.lit("  "), F.upper(name)))
        .when(kind == 1, F.concat(F.lit("The name is "), name, F.lit(".")))
        .when(kind == 2, F.concat(F.substring(name, 1, 9), F.lit("zz"), F.substring(name, 12, 21)))
        .when(kind == 3, F.concat(F.substring(name, 4, 12), F.substring(name, 18, 15)))
        .otherwise(F.lit("no such thing"))
    )
    asked = t.read("orders").select("o_orderkey", raw.alias("raw_output"))
    return match_many_labels(asked, space).select("o_orderkey", "prediction", "strategy")
