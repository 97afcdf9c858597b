from __future__ import annotations

import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagloom.labels import LabelSpace
from tagloom.operators.predict import LexicalPredictor, NearestPredictor, few_shot_nearest, predict_batch
from tagloom.operators.runlog import epoch_rollup
from tagloom.operators.softmax import (
    Settings,
    SoftmaxPredictor,
    load_softmax,
    predict_softmax,
    save_softmax,
    train_softmax,
    training_log,
)
from tagloom.plans import evaluate

LABELS = LabelSpace(["one", "two", "zero"])
SCHEMA = "row_id bigint, instruction string, intent string"


@pytest.fixture(scope="module")
def rows(spark):
    draw = random.Random(5)
    own = {label: [f"{label[0]}{n}" for n in range(30)] for label in LABELS}
    data = []
    for n in range(300):
        label = draw.choice(list(LABELS))
        words = draw.choices(own[label], k=3) + draw.choices([f"w{m}" for m in range(40)], k=5)
        data.append((n, " ".join(words), label))
    data += [(1000, None, "one"), (1001, "x", None), (1002, "x", "other"), (1003, "", "two")]
    return spark.createDataFrame(data, SCHEMA)


def by_hand(data, settings):
    """The same steps, a row at a time."""
    from tagloom.operators.softmax import LOSS_UNIT, SHARE_UNIT, WEIGHT_UNIT  # fixed units
    import hashlib

    digest = lambda text: int(hashlib.md5(text.encode()).hexdigest()[:8], 16)
    taught = [
        ({*(digest(w) % settings.dims for w in set(r.instruction.split())), settings.dims}, list(LABELS).index(r.intent), digest(f"42:batch:{r.row_id}") % settings.batches)
        for r in data if r.instruction is not None and r.intent in list(LABELS)
    ]
    weights = np.zeros((settings.dims + 1, 3), dtype=np.int64)
    losses = []
    for step in range(settings.epochs * settings.batches):
        mine = [t for t in taught if t[2] == step % settings.batches]
        gradient, loss = np.zeros_like(weights), 0
        for features, label, _ in mine:
            scores = weights[sorted(features)].sum(axis=0)
            powers = [math.exp((int(s) - int(scores.max())) / WEIGHT_UNIT) for s in scores]
            shares = [p / sum(powers) for p in powers]
            loss += math.floor(-math.log(shares[label]) * LOSS_UNIT + 0.5)
            for f in features:
                for k in range(3):
                    gradient[f, k] += math.floor(shares[k] * SHARE_UNIT + 0.5) - (SHARE_UNIT if k == label else 0)
        losses.append(loss / LOSS_UNIT / len(mine))
        slope = gradient / (SHARE_UNIT * len(mine))
        factor = min(1.0, settings.max_norm / math.sqrt((slope * slope).sum()))
        weights = weights - np.floor(settings.rate_at(step) * factor * slope * WEIGHT_UNIT + 0.5).astype(np.int64)
    return weights, losses


def test_steps_as_by_hand_and_however_partitioned(rows):
    settings = Settings(epochs=2, batches=3, dims=64, rate=5.0, max_norm=0.3)
    model = train_softmax(rows, LABELS, None, settings)
    weights, losses = by_hand(rows.collect(), settings)
    assert np.abs(model.weights - weights).max() <= 1
    assert [loss for _, kind, loss in model.log if kind == "train"] == pytest.approx(losses, abs=1e-6)
    again = train_softmax(rows.repartition(7), LABELS, None, settings)
    assert (again.weights == model.weights).all() and again.log == model.log


def test_learns_logs_and_is_stored(spark, rows, tmp_path):
    train, rest = rows.where("row_id % 4 <> 0"), rows.where("row_id % 4 = 0 AND row_id < 1000")
    model = train_softmax(train, LABELS, rest, Settings(epochs=6, batches=2, dims=4096))
    found = predict_softmax(rest, model)
    right, slowest = found.agg(F.avg((F.col("intent") == F.col("raw_output")).cast("int")), F.max("latency_ms")).first()
    assert right >= 0.95 and slowest > 0
    epochs = epoch_rollup(training_log(spark, model, 3)).orderBy("epoch").collect()
    assert [(e.run_id, e.epoch, e.n_steps) for e in epochs] == [(3, n, 2) for n in range(1, len(epochs) + 1)]
    assert epochs[-1].val_loss < epochs[0].val_loss
    save_softmax(model, spark, str(tmp_path / "model"))
    loaded = load_softmax(spark, str(tmp_path / "model"))
    assert (loaded.weights == model.weights).all() and list(loaded.labels) == list(LABELS)
    texts = [r.instruction for r in rest.collect()]
    assert SoftmaxPredictor(loaded)(texts) == SoftmaxPredictor(model)(texts)


def test_stops_early_and_bears_no_rows(rows):
    settings = Settings(epochs=20, batches=1, dims=64, patience=2, rate=50.0, warm_up=0.0)
    wrong = rows.withColumn("intent", F.when(F.col("intent") == "one", "two").otherwise("one"))
    model = train_softmax(rows, LABELS, wrong, settings)
    assert sum(kind == "val" for _, kind, _ in model.log) < 20
    assert not train_softmax(rows.limit(0), LABELS, None, Settings(epochs=1, batches=2, dims=8)).weights.any()


def test_rate_warms_up_and_falls():
    settings = Settings(epochs=2, batches=10, rate=1.0, warm_up=0.2)
    rates = [settings.rate_at(step) for step in range(20)]
    assert rates[:4] == pytest.approx([0.2, 0.4, 0.6, 0.8]) and rates[4] == 1.0
    assert all(a > b for a, b in zip(rates[4:], rates[5:])) and rates[-1] > 0


def test_nearest_predictor_is_the_operator(spark):
    bank = spark.createDataFrame([("b", ["money back now", "x"]), ("a", ["where is it", ""]), ("c", ["x y"])], "intent string, examples array<string>")
    texts = ["money", "x", "where now", "", "nothing here", "X y", "it is x"]
    df = spark.createDataFrame([(t,) for t in texts], "instruction string")
    expected = {r.instruction: r.raw_output for r in few_shot_nearest(df, bank).collect()}
    shown = [(r.intent, e) for r in bank.orderBy("intent").collect() for e in r.examples]
    assert NearestPredictor(shown)(texts) == [expected[t] for t in texts]
    assert NearestPredictor([])(["x"]) == ["unknown"]


class Slow:
    """Takes its time over one text."""

    def __init__(self, inner):
        self.inner = inner

    def __call__(self, prompts):
        if any("slow" in prompt for prompt in prompts):
            time.sleep(0.3)
        return self.inner(prompts)


def test_every_approach_has_latencies_of_its_own(spark, monkeypatch):
    samples = spark.createDataFrame([(n, "get refund" if n else "slow refund", "one") for n in range(200)], "sample_id bigint, instruction string, intent string")
    bank = spark.createDataFrame([("one", ["get refund"])], "intent string, examples array<string>")
    model = train_softmax(samples.withColumnRenamed("sample_id", "row_id"), LABELS, None, Settings(epochs=1, batches=1, dims=8))
    slow = lambda df, factory, key, *rest: predict_batch(df, lambda: Slow(factory()), key, *rest)
    monkeypatch.setattr(evaluate, "predict_batch", slow)
    monkeypatch.setattr("tagloom.operators.softmax.predict_batch", slow)
    approaches = evaluate.default_approaches(LABELS, bank, lambda: model)
    summary = evaluate.three_way_benchmark(samples.coalesce(1), approaches, LABELS).collect()
    assert len(summary) == 3
    for row in summary:
        assert row.p95_latency_ms > 2 * row.mean_latency_ms or row.p95_latency_ms < 0.5 * row.mean_latency_ms
    assert LexicalPredictor(["one"])(["one"]) == ["one"]
