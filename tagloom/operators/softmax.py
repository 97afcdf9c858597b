"""Softmax regression over hashed words, trained by distributed gradients.

A text's features are its distinct words, hashed to ``dims`` buckets, and a constant.  A step is one pass over a
batch of the training rows: tasks make partial gradients, batch of Arrow rows by batch, which Spark adds up by feature;
at most ``dims + 1`` rows a label come back and move the weights.  The rate warms up linearly and then falls
along a cosine, a gradient longer than ``max_norm`` is shortened, and training stops when the validation
loss has not fallen for ``patience`` epochs; the weights of the best epoch are kept.

Weights, probabilities and losses are whole numbers of small units, so sums do not depend on their order: the same
rows give the same model, however they are partitioned.  What grows with the rows stays distributed; the
driver and every task hold ``labels x dims`` weights, a size that the caller sets.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions.text import distinct_tokens, hash_number, seeded_hash
from tagloom.labels import LabelSpace
from tagloom.operators.predict import predict_batch, words_of
from tagloom.session import stage

# Units of a weight, a probability and a loss.
WEIGHT_UNIT, SHARE_UNIT, LOSS_UNIT = 1_000_000, 1 << 20, 1_000_000


@dataclass(frozen=True)
class Settings:
    epochs: int = 3
    batches: int = 8
    rate: float = 20.0
    warm_up: float = 0.1
    max_norm: float = 1.0
    patience: int = 2
    dims: int = 1 << 12
    seed: int = 42

    def rate_at(self, step: int) -> float:
        """Rate of a step, counted from 0: linear up to ``warm_up`` of all steps, then a half cosine."""
        steps = self.epochs * self.batches
        warm = int(steps * self.warm_up)
        if step < warm:
            return self.rate * (step + 1) / (warm + 1)
        return self.rate * 0.5 * (1 + math.cos(math.pi * (step - warm) / max(1, steps - warm)))


@dataclass(frozen=True)
class Softmax:
    """Weights by feature and label, in units of a millionth; the last feature is the constant."""

    labels: LabelSpace
    weights: np.ndarray
    log: list[tuple[int, str, float]] = field(default_factory=list)

    @property
    def dims(self) -> int:
        return len(self.weights) - 1


def _prepared(df: DataFrame, labels: LabelSpace, settings: Settings, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """Stored rows ``(label, features, batch)``; rows without text or listed label are left out."""
    rows = df.where(labels.holds(F.col(label_col)) & F.col(text_col).isNotNull())
    names = F.array(*[F.lit(label) for label in labels])
    buckets = F.transform(
        distinct_tokens(F.col(text_col)), lambda word: (hash_number(F.md5(word)) % settings.dims).cast("int")
    )
    batch = hash_number(seeded_hash(settings.seed, F.lit("batch"), F.col(id_col))) % settings.batches
    return rows.select(
        (F.array_position(names, F.col(label_col)) - 1).cast("int").alias("label"),
        F.concat(F.array_distinct(buckets), F.array(F.lit(settings.dims))).alias("features"),
        batch.cast("int").alias("batch"),
    )


def _shares(weights: np.ndarray, features: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Probability of every label for each row."""
    scores = np.add.reduceat(weights[features], starts, axis=0)
    powers = np.exp((scores - scores.max(axis=1, keepdims=True)) / WEIGHT_UNIT)
    return powers / powers.sum(axis=1, keepdims=True)


def _passes(weights: np.ndarray, with_gradient: bool):
    """Partial sums of a task: per feature the gradient of each label; at feature -1 rows and loss."""
    wide, count = weights.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gradient = np.zeros((wide, count), dtype=np.int64)
        met = np.zeros(wide, dtype=bool)
        rows = loss = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            label = batch.column(0).to_numpy()
            lists = batch.column(1)
            starts = lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py()
            features = lists.flatten().to_numpy()
            shares = _shares(weights, features, starts)
            own = np.arange(len(label)), label
            rows += len(label)
            loss += int(np.floor(-np.log(np.maximum(shares[own], 1e-300)) * LOSS_UNIT + 0.5).sum())
            if with_gradient:
                apart = np.floor(shares * SHARE_UNIT + 0.5).astype(np.int64)
                apart[own] -= SHARE_UNIT
                owner = np.repeat(np.arange(len(label)), np.diff(np.append(starts, len(features))))
                for k in range(count):
                    # Whole numbers far below 2^53 add up exactly.
                    gradient[:, k] += np.bincount(features, weights=apart[owner, k], minlength=wide).astype(np.int64)
                met[features] = True
        kept = np.flatnonzero(met)
        sums = [[rows, loss] + [0] * max(0, count - 2), *gradient[kept].tolist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, *kept.tolist()], pa.int32()), pa.array(sums, pa.list_(pa.int64()))], names=["feature", "sums"]
        )

    return run


def _summed(rows: DataFrame, weights: np.ndarray, with_gradient: bool) -> tuple[int, int, np.ndarray]:
    """Rows, loss and gradient over ``rows``; at most a row a feature comes to the driver."""
    wide = max(2, weights.shape[1])
    partial = rows.select("label", "features").mapInArrow(_passes(weights, with_gradient), "feature int, sums array<long>")
    total = partial.groupBy("feature").agg(F.array(*[F.sum(F.get("sums", F.lit(k))) for k in range(wide)]).alias("sums"))
    gradient = np.zeros(weights.shape, dtype=np.int64)
    count = loss = 0
    for feature, sums in total.collect():
        if feature < 0:
            count, loss = sums[0] or 0, sums[1] or 0
        else:
            gradient[feature] = sums[: weights.shape[1]]
    return count, loss, gradient


def _moved(weights: np.ndarray, gradient: np.ndarray, count: int, rate: float, max_norm: float) -> np.ndarray:
    slope = gradient / (SHARE_UNIT * count)
    norm = math.sqrt(float((slope * slope).sum()))
    shorter = min(1.0, max_norm / norm) if norm else 1.0
    return weights - np.floor(rate * shorter * slope * WEIGHT_UNIT + 0.5).astype(np.int64)


def train_softmax(
    train: DataFrame,
    labels: LabelSpace,
    validation: DataFrame | None = None,
    settings: Settings = Settings(),
    id_col: str = "row_id",
    text_col: str = "instruction",
    label_col: str = "intent",
) -> Softmax:
    """Weights after at most ``epochs`` epochs, with a log of ``(step, kind, loss)``.

    Every step logs the ``train`` loss before it; every epoch ends with the ``val`` loss, at the step after its last.
    Without validation rows nothing stops early.  Batches without rows are passed over.
    """
    # A step reads its batch's folder alone, which has a file of each task.
    taught = stage(_prepared(train, labels, settings, id_col, text_col, label_col), "taught", ("batch",))
    checked = None
    if validation is not None:
        checked = stage(_prepared(validation, labels, settings, id_col, text_col, label_col), "checked")
    weights = np.zeros((settings.dims + 1, len(labels)), dtype=np.int64)
    best, lowest, worse, log = weights, math.inf, 0, []
    for epoch in range(settings.epochs):
        for batch in range(settings.batches):
            step = epoch * settings.batches + batch
            count, loss, gradient = _summed(taught.where(F.col("batch") == batch), weights, True)
            if count:
                weights = _moved(weights, gradient, count, settings.rate_at(step), settings.max_norm)
                # A report stands at the step after an epoch's last.
                log.append((step + epoch, "train", loss / LOSS_UNIT / count))
        if checked is None:
            best = weights
            continue
        count, loss, _ = _summed(checked, weights, False)
        mean = loss / LOSS_UNIT / count if count else 0.0
        log.append(((epoch + 1) * settings.batches + epoch, "val", mean))
        if mean < lowest:
            best, lowest, worse = weights, mean, 0
        else:
            worse += 1
            if worse >= settings.patience:
                break
    return Softmax(labels, best, log)


def training_log(spark: SparkSession, model: Softmax, run_id: int) -> DataFrame:
    """The log as a run log, to be rolled up by epoch."""
    rows = [(run_id, step, kind, loss) for step, kind, loss in model.log]
    return spark.createDataFrame(rows, "run_id bigint, step bigint, kind string, value double")


class SoftmaxPredictor:
    """The trained model as a predictor; ties go to the first label."""

    def __init__(self, model: Softmax):
        self._labels, self._weights, self._dims = list(model.labels), model.weights, model.dims

    def __call__(self, prompts: list[str]) -> list[str]:
        return [self._labels[int(self._scores(prompt).argmax())] for prompt in prompts]

    def _scores(self, text: str) -> np.ndarray:
        buckets = {int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % self._dims for word in words_of(text)}
        return self._weights[[*buckets, self._dims]].sum(axis=0)


def predict_softmax(df: DataFrame, model: Softmax, text_col: str = "instruction") -> DataFrame:
    """Add ``raw_output`` and ``latency_ms``."""
    bare = replace(model, log=[])
    name = hashlib.sha256(bare.weights.tobytes()).hexdigest()
    return predict_batch(df, lambda: SoftmaxPredictor(bare), f"softmax:{name}", text_col)


def save_softmax(model: Softmax, spark: SparkSession, path: str) -> None:
    """Weights as a table, a row a feature, next to the labels in order."""
    rows = [(n, w) for n, w in enumerate(model.weights.tolist())]
    spark.createDataFrame(rows, "feature int, weights array<long>").write.mode("overwrite").parquet(f"{path}/weights")
    spark.createDataFrame([(list(model.labels),)], "labels array<string>").write.mode("overwrite").parquet(f"{path}/labels")


def load_softmax(spark: SparkSession, path: str) -> Softmax:
    rows = spark.read.parquet(f"{path}/weights").orderBy("feature").collect()
    labels = spark.read.parquet(f"{path}/labels").first().labels
    return Softmax(LabelSpace(labels), np.array([r.weights for r in rows], dtype=np.int64))
