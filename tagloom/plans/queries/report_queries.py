"""Queries on reports, stored results and run logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagloom.operators import report, runlog
from tagloom.operators.metrics import benchmark_summary
from tagloom.plans.queries.registry import (
    EVENT_LABELS,
    PREDICTIONS,
    RUN_LOG,
    SUMMARY,
    SUMMARY_COLUMNS,
    V2,
    registered,
    rounded,
    sql_scores,
    sql_values,
)
from tagloom.schema import SUMMARY_DOCUMENT
from tagloom.session import stage, staging_path
from tagloom.sources import results

_METRICS = tuple(report.TABLE_METRICS)


def _summary(t):
    return benchmark_summary(t.predictions(), EVENT_LABELS)


@registered(f"""WITH {PREDICTIONS}
SELECT sample_id, approach, truth, prediction FROM predictions
WHERE truth <> prediction AND truth = 'signup'""")
def explore_samples_filter(t):
    kept = report.explore_samples_filter(t.predictions(), "incorrect", "signup")
    return kept.select("sample_id", "approach", "truth", "prediction")


@registered(f"""WITH {PREDICTIONS}
SELECT count(*) FILTER (truth = prediction) AS correct, count(*) AS total,
       round(count(*) FILTER (truth = prediction) / count(*), 6) AS ratio
FROM predictions WHERE truth = 'signup'""")
def explore_samples_summary(t):
    return rounded(report.explore_samples_summary(t.predictions(), truth="signup"))


@registered(f"WITH {PREDICTIONS} SELECT DISTINCT truth FROM predictions")
def true_labels(t):
    return report.true_labels(t.predictions())


@registered(f"""WITH {PREDICTIONS}
SELECT approach, input_text, raw_output, prediction, truth, round(latency_ms, 1) AS latency_ms,
       prediction = truth AS correct FROM predictions""")
def align_parallel_arrays(t):
    records = report.to_parallel_arrays(t.predictions())
    return report.align_parallel_arrays(records).drop("shard", "position")


@registered(f"""WITH {V2} SELECT sample_id, raw_output, approach FROM v2
WHERE approach IN ('zero_shot', 'fine_tuned')""")
def union_approaches(t):
    rows = t.raw_predictions()
    parts = {
        name: rows.where(F.col("approach") == name).select("sample_id", "raw_output")
        for name in ("zero_shot", "few_shot", "fine_tuned")
    }
    return report.union_approaches(parts, ("zero_shot", "fine_tuned"))


@registered(f"""WITH {SUMMARY}, tidy AS (
  {' UNION ALL '.join(f"SELECT approach, '{m}' AS metric, {m} AS value FROM summary" for m in _METRICS)})
SELECT approach, metric, round(value, 6) AS value,
  CASE WHEN metric IN ('mean_latency_ms', 'p95_latency_ms', 'token_cost_per_1k')
       THEN value = min(value) OVER (PARTITION BY metric)
       ELSE value = max(value) OVER (PARTITION BY metric) END AS is_best
FROM tidy""")
def best_flags(t):
    return rounded(report.best_flags(_summary(t)))


@registered(f"""WITH {SUMMARY}, ends AS (
  SELECT max(accuracy) FILTER (approach = 'zero_shot') AS a0,
         max(accuracy) FILTER (approach = 'fine_tuned') AS a1,
         max(mean_latency_ms) FILTER (approach = 'zero_shot') AS l0,
         max(mean_latency_ms) FILTER (approach = 'fine_tuned') AS l1 FROM summary)
SELECT 'zero_shot' AS first_approach, 'fine_tuned' AS last_approach,
       round((a1 - a0) * 100, 6) AS accuracy_delta_pp,
       round(l1 / greatest(l0, 0.000001), 6) AS latency_ratio,
       CASE WHEN a1 > a0 THEN 'improves' ELSE 'reduces' END AS direction FROM ends""")
def first_last_delta(t):
    return rounded(report.first_last_delta(_summary(t)))


_TITLE = """CASE approach WHEN 'zero_shot' THEN 'Zero Shot' WHEN 'few_shot' THEN 'Few Shot'
  ELSE 'Fine Tuned' END AS approach"""


@registered(f"""WITH {SUMMARY}
SELECT {_TITLE}, printf('%.1f%%', accuracy * 100) AS accuracy,
  printf('%.1f%%', macro_precision * 100) AS macro_precision,
  printf('%.1f%%', macro_recall * 100) AS macro_recall, printf('%.1f%%', macro_f1 * 100) AS macro_f1,
  printf('%.0fms', mean_latency_ms) AS mean_latency_ms,
  printf('%.0fms', p95_latency_ms) AS p95_latency_ms,
  printf('$%.4f', token_cost_per_1k) AS token_cost_per_1k FROM summary""")
def benchmark_table(t):
    return report.benchmark_table(_summary(t))


@registered(f"""WITH {SUMMARY}
SELECT approach, printf('%-15s %10.3f %10.3f %8.3f %10.3f %8.3f %12.1f', approach, accuracy,
  macro_precision, macro_recall, macro_f1, weighted_f1, mean_latency_ms) AS line FROM summary""")
def benchmark_text(t):
    return report.benchmark_text(_summary(t))


@registered(f"""WITH {SUMMARY}
SELECT {_TITLE}, round(mean_latency_ms, 6) AS mean_latency_ms,
  round(accuracy * 100, 6) AS accuracy_pct, round(macro_f1, 6) AS macro_f1,
  round(token_cost_per_1k, 6) AS token_cost_per_1k FROM summary""")
def latency_tradeoff(t):
    return rounded(report.latency_tradeoff(_summary(t)))


@registered(f"""WITH {PREDICTIONS}, {sql_scores(EVENT_LABELS)}
SELECT approach, label, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1, support FROM scores""")
def write_results(t):
    path = staging_path(t.spark, "results")
    results.write_results(t.predictions(), EVENT_LABELS, path)
    return rounded(results.read_results(t.spark, path, "per_class"))


@registered(f"WITH {SUMMARY} SELECT {SUMMARY_COLUMNS} FROM summary")
def read_summary(t):
    path = staging_path(t.spark, "results")
    results.write_results(t.predictions(), EVENT_LABELS, path)
    return rounded(results.read_summary(t.spark, path))


@registered(f"""WITH {SUMMARY}
{' UNION ALL '.join(f"SELECT approach, '{m}' AS metric, round({m}, 6)::DOUBLE AS value, 'spark-ml' AS base_model_id, 'run-' || approach AS run_id, 3::INT AS step FROM summary"
                    for m in runlog.LOGGED_METRICS)}""")
def append_run_metrics(t):
    """A run per approach; the second writing of each replaces the first."""
    path = staging_path(t.spark, "run-metrics")
    summary = stage(_summary(t), "summary")
    for approach in ("zero_shot", "few_shot", "fine_tuned", "zero_shot"):
        one = summary.where(F.col("approach") == approach)
        results.write_run_metrics(one, path, f"run-{approach}", 3, {"base_model_id": "spark-ml"})
    return rounded(results.read_run_log(t.spark, path, "metrics"))


@registered("""SELECT 'run-1' AS run_id, key, value FROM (
  SELECT 'model.base' AS key, 'spark-ml' AS value
  UNION ALL SELECT 'train.rows', count(*)::VARCHAR FROM events
  UNION ALL SELECT 'train.shuffle', 'True')""")
def run_params(t):
    path = staging_path(t.spark, "run-params")
    rows = t.read("events").agg(F.count("*").alias("rows"))
    params = rows.select(
        F.struct(F.lit("spark-ml").alias("base")).alias("model"),
        F.struct("rows", F.lit(True).alias("shuffle")).alias("train"),
    )
    for _ in range(2):
        results.write_run_params(params, path, "run-1")
    return results.read_run_log(t.spark, path, "params")


@registered(f"""WITH {SUMMARY}
SELECT 'spark-ml' AS base_model_id, max(total_samples)::BIGINT AS test_set_size,
       max(intent_count)::INT AS intent_count, count(*) AS approaches,
       string_agg(approach || '=' || correct_samples || '/' || total_samples, ',' ORDER BY approach) AS samples
FROM summary""")
def summary_document(t):
    path = staging_path(t.spark, "summary-json")
    results.write_summary_json(_summary(t), "spark-ml", path)
    document = t.spark.read.schema(SUMMARY_DOCUMENT).json(path)
    entries = F.array_sort(F.map_entries("approaches"))
    shown = F.transform(
        entries,
        lambda e: F.concat(e["key"], F.lit("="), e["value"]["correct_samples"], F.lit("/"), e["value"]["total_samples"]),
    )
    return document.select(
        "base_model_id", "test_set_size", "intent_count",
        F.size("approaches").cast("bigint").alias("approaches"),
        F.array_join(shown, ",").alias("samples"),
    )


@registered(f"WITH {SUMMARY} SELECT {SUMMARY_COLUMNS} FROM summary")
def read_summary_json(t):
    path = staging_path(t.spark, "summary-json")
    results.write_summary_json(_summary(t), "spark-ml", path)
    return rounded(results.read_summary_json(t.spark, path))


@registered(f"""WITH {PREDICTIONS}, listed(label) AS (VALUES {sql_values(EVENT_LABELS)}), matrix AS (
  SELECT a.approach, x.label AS truth, y.label AS prediction
  FROM (SELECT DISTINCT approach FROM predictions) a CROSS JOIN listed x CROSS JOIN listed y)
SELECT m.approach, m.truth, m.prediction, count(p.sample_id) AS n
FROM matrix m LEFT JOIN predictions p
  ON p.approach = m.approach AND p.truth = m.truth AND p.prediction = m.prediction
GROUP BY m.approach, m.truth, m.prediction""")
def write_results_confusion(t):
    path = staging_path(t.spark, "results")
    results.write_results(t.predictions(), EVENT_LABELS, path)
    return results.read_results(t.spark, path, "confusion")


# Lists of a record end early, by the record's number, or are missing.
_SHORT = """
SELECT approach, shard, input_texts[:CASE WHEN shard % 3 = 0 THEN 2 ELSE 100000 END] AS input_texts,
       CASE WHEN shard % 4 <> 1 THEN raw_outputs END AS raw_outputs, predictions,
       ground_truth[:CASE WHEN shard % 2 = 0 THEN 3 ELSE 100000 END] AS ground_truth,
       CASE WHEN shard % 5 <> 2 THEN latencies_ms END AS latencies_ms"""


@registered(f"""WITH {PREDICTIONS}, packed AS (
  SELECT approach, sample_id // 1000 AS shard,
    list(input_text ORDER BY sample_id) AS input_texts, list(raw_output ORDER BY sample_id) AS raw_outputs,
    list(prediction ORDER BY sample_id) AS predictions, list(truth ORDER BY sample_id) AS ground_truth,
    list(latency_ms ORDER BY sample_id) AS latencies_ms
  FROM predictions GROUP BY approach, sample_id // 1000),
cut AS ({_SHORT} FROM packed),
rows AS (SELECT *, unnest(range(1, len(predictions) + 1)) AS i FROM cut)
SELECT approach, coalesce(input_texts[i], '') AS input_text, coalesce(raw_outputs[i], '') AS raw_output,
       coalesce(predictions[i], '') AS prediction, coalesce(ground_truth[i], '') AS truth,
       round(latencies_ms[i], 1) AS latency_ms,
       coalesce(predictions[i], '') = coalesce(ground_truth[i], '') AS correct
FROM rows""")
def read_result_records(t):
    """Documents with short and missing lists, written, read and padded."""
    packed = report.to_parallel_arrays(t.predictions(), shard_rows=1000)

    def short(column: str, every: int, rest: int, length: int):
        return F.when(F.col("shard") % every == rest, F.slice(column, 1, length)).otherwise(F.col(column))

    documents = packed.select(
        F.concat_ws("-", "approach", "shard").alias("document"),
        F.col("approach").alias("approach_name"),
        short("input_texts", 3, 0, 2).alias("input_texts"),
        F.when(F.col("shard") % 4 != 1, F.col("raw_outputs")).alias("raw_outputs"),
        "predictions",
        short("ground_truth", 2, 0, 3).alias("ground_truth"),
        F.when(F.col("shard") % 5 != 2, F.col("latencies_ms")).alias("latencies_ms"),
    )
    path = staging_path(t.spark, "records")
    # One document a file, as separate evaluations leave them.
    documents.repartition("document").write.partitionBy("document").json(path)
    records = results.read_result_records(t.spark, path).drop("document")
    return report.align_parallel_arrays(records).drop("position")


@registered(f"""WITH {SUMMARY}, ends AS (
  SELECT max(accuracy) FILTER (approach = 'zero_shot') AS a0,
         max(accuracy) FILTER (approach = 'fine_tuned') AS a1,
         max(mean_latency_ms) FILTER (approach = 'zero_shot') AS l0,
         max(mean_latency_ms) FILTER (approach = 'fine_tuned') AS l1 FROM summary)
SELECT 'Fine Tuned ' || CASE WHEN a1 > a0 THEN 'improves' ELSE 'reduces' END
       || printf(' accuracy by %.1f%% over Zero Shot at %.1f× the latency.',
                 abs((a1 - a0) * 100), l1 / greatest(l0, 0.000001)) AS headline FROM ends""")
def headline(t):
    return report.headline(report.first_last_delta(_summary(t)))


@registered("""WITH flat AS (
  SELECT event_id,
    [{'key': 'run.user', 'value': user_id::VARCHAR},
     {'key': 'run.source.kind', 'value': event_type},
     {'key': 'run.source.tags', 'value': event_type || ',' || (event_id % 5)::VARCHAR},
     {'key': 'metric.value', 'value': value::VARCHAR},
     {'key': 'metric.large', 'value': CASE WHEN value > 50 THEN 'True' ELSE 'False' END}] AS entries
  FROM events)
SELECT event_id, e.key AS key, e.value AS value FROM flat, unnest(entries) AS u(e)""")
def flatten_params(t):
    nested = t.read("events").select(
        "event_id",
        F.struct(
            F.col("user_id").alias("user"),
            F.struct(
                F.col("event_type").alias("kind"),
                F.array("event_type", (F.col("event_id") % 5).cast("string")).alias("tags"),
            ).alias("source"),
        ).alias("run"),
        F.struct("value", (F.col("value") > 50).alias("large")).alias("metric"),
    )
    return runlog.flatten_params(nested, ["event_id"])


SQL_EPOCHS = f"""WITH run_log AS ({RUN_LOG}), numbered AS (
  SELECT *, 1 + coalesce(sum(CASE WHEN kind = 'val' THEN 1 ELSE 0 END) OVER (
    PARTITION BY run_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    AS epoch FROM run_log)
SELECT run_id, epoch::BIGINT AS epoch, count(*) FILTER (kind = 'train') AS n_steps,
       round(coalesce(avg(value) FILTER (kind = 'train'), 0), 6) AS train_loss,
       round(max(value) FILTER (kind = 'val'), 6) AS val_loss
FROM numbered GROUP BY run_id, epoch HAVING count(*) FILTER (kind = 'val') > 0"""


@registered(SQL_EPOCHS)
def epoch_rollup(t):
    return rounded(runlog.epoch_rollup(t.run_log()))


@registered("""WITH kinds AS (SELECT *, event_id % 4 AS kind FROM events),
flat AS (
  SELECT event_id, unnest(CASE kind
    WHEN 0 THEN [{'key': 'run.user', 'value': user_id::VARCHAR}, {'key': 'run.source.kind', 'value': event_type},
                 {'key': 'run.source.deep.tags', 'value': event_type || ',' || (event_id % 5)}]
    WHEN 1 THEN [{'key': 'user', 'value': user_id::VARCHAR}, {'key': 'large', 'value': CASE WHEN event_id % 3 = 0 THEN 'True' ELSE 'False' END}]
    WHEN 2 THEN [{'key': 'run.rate', 'value': CASE WHEN event_id % 8 = 2 THEN '0.5' ELSE '2e-05' END}, {'key': 'run.none', 'value': NULL}]
    ELSE [{'key': 'run.source.flags', 'value': 'True,False,1.5'}] END) AS e FROM kinds)
SELECT event_id, e.key AS key, e.value AS value FROM flat""")
def flatten_json_params(t):
    """Parameters in four shapes, nested up to three deep, with lists."""
    kind = F.col("event_id") % 4
    user, event = F.col("user_id"), F.col("event_type")
    nested = F.struct(F.struct(user.alias("user"), F.struct(event.alias("kind"), F.struct(F.array(event, (F.col("event_id") % 5).cast("string")).alias("tags")).alias("deep")).alias("source")).alias("run"))
    text = (
        F.when(kind == 0, F.to_json(nested))
        .when(kind == 1, F.to_json(F.struct(user.alias("user"), (F.col("event_id") % 3 == 0).alias("large"))))
        .when(kind == 2, F.concat(F.lit('{"run": {"rate": '), F.when(F.col("event_id") % 8 == 2, "0.5").otherwise("2e-5"), F.lit(', "none": null, "empty": {}}}')))
        .otherwise(F.lit('{"run": {"source": {"flags": [true, false, 1.5]}}}'))
    )
    return runlog.flatten_json_params(t.read("events").select("event_id", text.alias("params")), "params", ["event_id"])
