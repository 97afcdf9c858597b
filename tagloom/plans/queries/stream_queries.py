"""Streaming queries, run to the end of their input and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagloom.fixed_values import USER_TURN_PREFIX
from tagloom.operators.predict import LexicalPredictor
from tagloom.plans.queries.predict_queries import sql_lexical
from tagloom.plans.queries.registry import REQUESTS, RUN_LOG, STOPWORD_LABELS, registered, rounded
from tagloom.plans.queries.report_queries import SQL_EPOCHS
from tagloom.session import stage, staging_path
from tagloom.streaming.classify import classify, start_classify_stream, start_replay_stream, unique_requests
from tagloom.streaming.rollup import LATENESS, late_rows, read_epochs, start_epoch_rollup
from tagloom.streaming.state_rollup import read_rolled, start_state_rollup

_RESPONSES = f"""WITH requests AS ({REQUESTS}),
{sql_lexical('requests', 'request_id', 'text', STOPWORD_LABELS)}
SELECT request_id, coalesce(approach, 'fine_tuned') AS approach_used,
  CASE WHEN length(text) BETWEEN 1 AND 1000 THEN 'response' ELSE 'rejected' END AS outcome,
  CASE WHEN length(text) BETWEEN 1 AND 1000 THEN raw_output END AS intent,
  CASE WHEN length(text) BETWEEN 1 AND 1000
       THEN CASE raw_output WHEN 'unknown' THEN 0.0 ELSE 1.0 END END::DOUBLE AS confidence,
  CASE WHEN length(text) < 1 THEN 'text is shorter than 1'
       WHEN length(text) > 1000 THEN 'text is longer than 1000' END AS detail
FROM requests JOIN lexical USING (request_id)"""

_OUTPUT = ("request_id", "approach_used", "outcome", "intent", "confidence", "detail")


def _predictor():
    labels = tuple(STOPWORD_LABELS)
    return lambda: LexicalPredictor(labels, marker=USER_TURN_PREFIX)


def _stream_of(t, table: str, sql: str, files_per_batch: int | None = None):
    """The view as a stream over the table's files."""
    files = t.spark.readStream.schema(t.read(table).schema)
    if files_per_batch:
        files = files.option("maxFilesPerTrigger", files_per_batch)
    # A stream reads folders or patterns; the pattern fits a single file and a folder.
    source = files.parquet(f"{t.folder}/{table}*.parquet")
    return t.spark.sql(sql.replace(f"FROM {table}", "FROM {source}"), source=source)


@registered(_RESPONSES)
def classify_batch(t):
    return classify(t.requests(), _predictor(), "stopwords", STOPWORD_LABELS).select(*_OUTPUT)


@registered(_RESPONSES)
def classify_stream(t):
    out = staging_path(t.spark, "responses")
    query = start_classify_stream(
        _stream_of(t, "conversations", REQUESTS, files_per_batch=1000),
        _predictor(),
        "stopwords",
        STOPWORD_LABELS,
        out,
        staging_path(t.spark, "responses-progress"),
    )
    query.awaitTermination()
    return t.spark.read.parquet(out).select(*_OUTPUT)


def _rolled(t, log, lateness):
    out = staging_path(t.spark, "epochs")
    query = start_epoch_rollup(log, out, staging_path(t.spark, "epochs-progress"), lateness)
    query.awaitTermination()
    return out


@registered(SQL_EPOCHS)
def epoch_rollup_stream(t):
    """Behind a watermark of a million steps, what waits at the end included."""
    return rounded(read_epochs(t.spark, _rolled(t, _stream_of(t, "events", RUN_LOG), LATENESS)))


@registered(SQL_EPOCHS)
def epoch_rollup_folded(t):
    """Without a watermark: any order of arrival is right."""
    return rounded(read_epochs(t.spark, _rolled(t, _stream_of(t, "events", RUN_LOG), None)))


def _shuffled_log(t):
    """The log in four folders that each hold every fourth step, read about a folder a micro-batch."""
    folder = staging_path(t.spark, "unordered-log")
    log = t.run_log()
    most = 1
    for rest in (2, 0, 3, 1):
        part = f"{folder}/every-fourth-{rest}"
        log.where(F.pmod("step", F.lit(4)) == rest).repartition("run_id", "step").write.parquet(part)
        most = max(most, len(t.spark.read.schema(log.schema).parquet(part).inputFiles()))
    files = t.spark.readStream.schema(log.schema).option("maxFilesPerTrigger", most)
    return files.parquet(f"{folder}/*")


def _width(t) -> int:
    """Steps from the first of the log to behind its last: no row can come that late."""
    return t.run_log().agg(F.max("step") - F.min("step") + 1).first()[0] or 1


@registered(SQL_EPOCHS)
def epoch_rollup_unordered(t):
    return rounded(read_epochs(t.spark, _rolled(t, _shuffled_log(t), None)))


@registered(f"""{SQL_EPOCHS.replace("SELECT run_id, epoch::BIGINT", "SELECT 'rolled' AS part, run_id, epoch::BIGINT")}
UNION ALL SELECT 'late', NULL, NULL, 0, 0, 0""")
def epoch_rollup_watermark(t):
    """The same behind a watermark as wide as the log, with the number of late rows."""
    out = _rolled(t, _shuffled_log(t), _width(t))
    epochs = rounded(read_epochs(t.spark, out)).select(F.lit("rolled").alias("part"), "*")
    late = late_rows(t.spark, out).agg(F.count("*").alias("n_steps")).select(
        F.lit("late").alias("part"),
        F.lit(None).cast("bigint").alias("run_id"),
        F.lit(None).cast("bigint").alias("epoch"),
        "n_steps",
        F.lit(0.0).alias("train_loss"),
        F.lit(0.0).alias("val_loss"),
    )
    return epochs.unionByName(late)


# Batches of the log, and parts its steps are cut into: one part is the lateness.
_BATCHES, _WIDTHS = 4, 40


@registered(f"""WITH run_log AS ({RUN_LOG}), bounds AS (
  SELECT min(step) AS low, max(step) - min(step) + 1 AS width FROM run_log),
arriving AS (
  SELECT l.*, width // {_WIDTHS} AS lateness,
         least((step - low) * {_BATCHES} // width + CASE WHEN step % 10 = 3 THEN 1 ELSE 0 END, {_BATCHES} - 1) AS batch
  FROM run_log l, bounds),
tops AS (
  SELECT run_id, batch, max(max(step)) OVER (PARTITION BY run_id ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
  FROM arriving GROUP BY run_id, batch),
marked AS (
  SELECT a.*, coalesce(a.step <= t.before - lateness, false) AS late, max(step) OVER (PARTITION BY a.run_id) - lateness AS mark
  FROM arriving a JOIN tops t ON t.run_id = a.run_id AND t.batch = a.batch),
numbered AS (
  SELECT *, 1 + coalesce(sum(CASE WHEN kind = 'val' THEN 1 ELSE 0 END) OVER (
    PARTITION BY run_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS epoch
  FROM marked WHERE NOT late AND step <= mark)
SELECT 'epoch' AS part, run_id, epoch::BIGINT AS epoch, count(*) FILTER (kind = 'train') AS n_steps,
       round(coalesce(avg(value) FILTER (kind = 'train'), 0), 6) AS train_loss,
       round(max(value) FILTER (kind = 'val'), 6) AS val_loss
FROM numbered GROUP BY run_id, epoch HAVING count(*) FILTER (kind = 'val') > 0
UNION ALL
SELECT 'late', run_id, NULL, count(*), NULL, NULL FROM marked WHERE late GROUP BY run_id""")
def epoch_rollup_state(t):
    """Closed epochs and late rows by run, behind a watermark of a fortieth of the log.

    The log comes in four parts by step, a tenth of the rows one part late; the query ends after each and is started
    again on its checkpoint.
    """
    log = t.run_log()
    low, width = log.agg(F.min("step"), F.max("step") - F.min("step") + 1).first()
    folder, out, progress = (staging_path(t.spark, n) for n in ("state-log", "state-epochs", "state-progress"))
    part = F.call_function("div", (F.col("step") - low) * _BATCHES, F.lit(width))
    late = F.when(F.col("step") % 10 == 3, 1).otherwise(0)
    arriving = stage(log.withColumn("batch", F.least(part + late, F.lit(_BATCHES - 1))), "arriving")
    for batch in range(_BATCHES):
        arriving.where(F.col("batch") == batch).drop("batch").write.mode("append").parquet(folder)
        stream = t.spark.readStream.schema(log.schema).parquet(folder)
        start_state_rollup(stream, out, progress, width // _WIDTHS).awaitTermination()
    epochs, behind = read_rolled(t.spark, out)
    counted = behind.groupBy("run_id").agg(F.count("*").alias("n_steps")).withColumn("part", F.lit("late"))
    rolled = rounded(epochs).withColumn("part", F.lit("epoch")).unionByName(counted, allowMissingColumns=True)
    return rolled.select("part", "run_id", "epoch", "n_steps", "train_loss", "val_loss")


class FlakyPredictor(LexicalPredictor):
    """Gives no answer to prompts of certain lengths."""

    def __call__(self, prompts: list[str]) -> list[str]:
        if any(len(prompt) % 10 == 3 for prompt in prompts):
            raise RuntimeError("no answer")
        return super().__call__(prompts)


@registered(_RESPONSES)
def classify_stream_repeated(t):
    """Every request sent twice over three micro-batches, some failing at first: one response each.

    The stream ends after each batch and goes on from its checkpoint; a replay answers what failed.
    """
    names = ("sent", "answers", "answers-progress", "replayed", "replayed-progress")
    folder, out, progress, again, again_progress = (staging_path(t.spark, n) for n in names)
    stamped = t.requests().withColumn("at", F.timestamp_seconds(F.col("request_id") % 1000 + 1_700_000_000))
    early = F.col("request_id") % 2 == 0
    labels = tuple(STOPWORD_LABELS)
    for sent in (stamped.where(early), stamped, stamped.where(~early)):
        sent.write.mode("append").parquet(folder)
        stream = unique_requests(t.spark.readStream.schema(stamped.schema).parquet(folder), "at", "1 day")
        start_classify_stream(
            stream, lambda: FlakyPredictor(labels, marker=USER_TURN_PREFIX), "flaky", STOPWORD_LABELS, out, progress
        ).awaitTermination()
    start_replay_stream(t.spark, out, t.requests(), _predictor(), "stopwords", STOPWORD_LABELS, again, again_progress).awaitTermination()
    first = t.spark.read.parquet(out).where("outcome <> 'failed'").select(*_OUTPUT)
    return first.unionByName(t.spark.read.parquet(again).select(*_OUTPUT))
