"""Classification metrics per approach.

Everything except the latency percentile derives from one aggregation of the predictions,
the *cells*: one row per (approach, truth, prediction) with its count and sums.  That is
the only shuffle of big data here, and it is combined on the map side.  All later frames
have at most approaches x labels^2 rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.fixed_values import COST_PER_1K_TOKENS, STRATEGY_CONFIDENCE
from tagloom.functions.text import word_count
from tagloom.labels import LabelSpace

# Resolution of the percentile search: logarithmic buckets, then linear steps in a bucket.
_STEPS_PER_OCTAVE = 1 << 12
_CODE_OF_ONE = 1100 * _STEPS_PER_OCTAVE
_LINEAR_STEPS = (1 << 16) - 1
# Codes of infinite values and, above all, of NaN; all finite ones lie between.
_CODE_OF_INFINITY = 1 << 24
# Accuracy of the approximate percentile; its rank error is 1 / accuracy.
_SKETCH_ACCURACY = 10_000


def cells(
    df: DataFrame,
    text_col: str | None = None,
    latency_col: str | None = None,
) -> DataFrame:
    """Counts per (approach, truth, prediction), with word and latency sums when asked for."""
    sums = [F.count("*").alias("n")]
    if text_col:
        sums.append(F.coalesce(F.sum(word_count(F.col(text_col))), F.lit(0)).alias("words"))
    if latency_col:
        sums.append(F.sum(latency_col).alias("latency"))
        sums.append(F.count(latency_col).alias("timed"))
    return df.groupBy("approach", "truth", "prediction").agg(*sums)


def _per_label(counted: DataFrame) -> DataFrame:
    """``tp``, ``support`` and ``predicted`` per (approach, label), unlisted labels included.

    Sums of the cells other than counts stay with the true label.
    """
    hit = F.when(F.col("truth") == F.col("prediction"), F.col("n")).otherwise(F.lit(0))
    extra = [c for c in ("words", "latency", "timed") if c in counted.columns]
    as_truth = F.struct(
        F.col("truth").alias("label"),
        hit.alias("tp"),
        F.col("n").alias("support"),
        F.lit(0).cast("bigint").alias("predicted"),
        *[F.col(c).alias(c) for c in extra],
    )
    as_prediction = F.struct(
        F.col("prediction").alias("label"),
        F.lit(0).cast("bigint").alias("tp"),
        F.lit(0).cast("bigint").alias("support"),
        F.col("n").alias("predicted"),
        *[F.lit(None).cast(counted.schema[c].dataType).alias(c) for c in extra],
    )
    roles = counted.select("approach", F.explode(F.array(as_truth, as_prediction)).alias("role"))
    return (
        roles.select("approach", "role.*")
        .groupBy("approach", "label")
        .agg(*[F.sum(c).alias(c) for c in ("tp", "support", "predicted", *extra)])
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def _precision() -> Column:
    return _ratio(F.col("tp"), F.col("predicted"))


def _recall() -> Column:
    return _ratio(F.col("tp"), F.col("support"))


def _f1() -> Column:
    return _ratio(2 * F.col("tp"), F.col("support") + F.col("predicted"))


def per_class_prf(df: DataFrame, labels: LabelSpace) -> DataFrame:
    """Precision, recall, F1 and support of every listed label, zeros where undefined."""
    zero = F.lit(0).cast("bigint")
    columns = ("label", "tp", "support", "predicted")
    zeros = F.transform(
        labels.as_array(),
        lambda label: F.struct(label.alias("label"), *[zero.alias(c) for c in columns[1:]]),
    )
    rows = _with_rows(_per_label(cells(df)), ["label"], F.struct(*columns), zeros)
    counts = rows.select("approach", "_row.*").where(labels.holds(F.col("label")))
    return counts.groupBy("approach", "label").agg(
        *[F.sum(c).alias(c) for c in ("tp", "support", "predicted")]
    ).select(
        "approach",
        "label",
        _precision().alias("precision"),
        _recall().alias("recall"),
        _f1().alias("f1"),
        "support",
    )


def _with_rows(counted: DataFrame, order: list[str], row: Column, added: Column) -> DataFrame:
    """``(approach, _row)``: every row, and once per approach the rows of the ``added`` array.

    One pass: the first row of an approach brings the added ones along.
    """
    first = F.row_number().over(Window.partitionBy("approach").orderBy(*order)) == 1
    flagged = counted.withColumn("_first", first)
    own = F.array(row)
    return flagged.select(
        "approach", F.explode(F.when(F.col("_first"), F.concat(own, added)).otherwise(own)).alias("_row")
    )


def _averages(per_label: DataFrame, labels: LabelSpace) -> DataFrame:
    """Accuracy, macro and weighted averages per approach.

    A listed label without rows scores 0, so macro averages divide by the number of listed
    labels and need no rows for the missing ones.
    """
    listed = labels.holds(F.col("label"))
    support = F.sum(F.when(listed, F.col("support")))
    scores = {"precision": _precision(), "recall": _recall(), "f1": _f1()}
    extra = [c for c in ("words", "latency", "timed") if c in per_label.columns]
    macro = [
        (F.coalesce(F.sum(F.when(listed, score)), F.lit(0.0)) / len(labels)).alias(f"macro_{name}")
        for name, score in scores.items()
    ]
    weighted = [
        _ratio(F.sum(F.when(listed, score * F.col("support"))), support).alias(f"weighted_{name}")
        for name, score in scores.items()
    ]
    return per_label.groupBy("approach").agg(
        _ratio(F.sum("tp"), F.sum("support")).alias("accuracy"),
        *macro,
        *weighted,
        F.sum("tp").alias("correct_samples"),
        F.sum("support").alias("total_samples"),
        *[F.sum(c).alias(c) for c in extra],
    )


def accuracy(df: DataFrame) -> DataFrame:
    """Accuracy with correct and total counts per approach."""
    correct = F.count_if(F.col("prediction") == F.col("truth"))
    return df.groupBy("approach").agg(
        (correct / F.count("*")).alias("accuracy"),
        correct.alias("correct_samples"),
        F.count("*").alias("total_samples"),
    )


def macro_weighted(df: DataFrame, labels: LabelSpace) -> DataFrame:
    """Macro and weighted precision, recall and F1 per approach."""
    averages = _averages(_per_label(cells(df)), labels)
    kept = [f"{kind}_{name}" for kind in ("macro", "weighted") for name in ("precision", "recall", "f1")]
    return averages.select("approach", *kept)


def confusion_matrix(df: DataFrame, labels: LabelSpace) -> DataFrame:
    """Dense counts ``(approach, truth, prediction, n)`` over the listed labels.

    Pairs with an unlisted label are left out, so a row can sum to less than its support.
    """
    none = F.lit(None).cast("string")
    zero = F.lit(0).cast("bigint")
    # Zero rows come one true label at a time, so no row holds the whole matrix.
    truths = F.transform(
        labels.as_array(),
        lambda truth: F.struct(truth.alias("truth"), none.alias("prediction"), zero.alias("n"), F.lit(True).alias("empty")),
    )
    cell = F.struct("truth", "prediction", "n", F.lit(False).alias("empty"))
    rows = _with_rows(cells(df), ["truth", "prediction"], cell, truths).select("approach", "_row.*")
    predictions = F.when(F.col("empty"), labels.as_array()).otherwise(F.array("prediction"))
    dense = rows.select("approach", "truth", F.explode(predictions).alias("prediction"), "n")
    return confusion_cells(dense, labels).groupBy("approach", "truth", "prediction").agg(F.sum("n").alias("n"))


def confusion_cells(counted: DataFrame, labels: LabelSpace) -> DataFrame:
    """The non-zero counts over the listed labels, from :func:`cells`; for large label spaces."""
    listed = labels.holds(F.col("truth")) & labels.holds(F.col("prediction"))
    return counted.where(listed).select("approach", "truth", "prediction", "n")


def confusion_matrix_norm(matrix: DataFrame) -> DataFrame:
    """Row-normalised matrix; a row of zeros stays zero."""
    row_sum = F.sum("n").over(Window.partitionBy("approach", "truth"))
    return matrix.select(
        "approach", "truth", "prediction", (F.col("n") / F.greatest(row_sum, F.lit(1))).alias("share")
    )


def _value_code(value: Column) -> Column:
    """Integer that never falls when the value grows: 4096 steps per power of two."""
    infinite = F.lit(float("inf"))
    size = F.floor(F.log2(F.abs(value)) * _STEPS_PER_OCTAVE) + F.lit(_CODE_OF_ONE)
    code = (
        F.when(F.isnan(value), F.lit(_CODE_OF_INFINITY + 1))
        .when(value == infinite, F.lit(_CODE_OF_INFINITY))
        .when(value == -infinite, F.lit(-_CODE_OF_INFINITY))
        .when(value > 0, size)
        .when(value < 0, -size)
    )
    return F.coalesce(code.cast("bigint"), F.lit(0).cast("bigint"))


def _holding_rank(counted: DataFrame, keys: list[str], order: str, fraction: float) -> DataFrame:
    """Entries of every group that hold the ranks next to the fraction, with the rows before them.

    ``counted`` has ``_rows`` per entry; ``_before`` and ``_total`` come along when known.
    """
    in_group = Window.partitionBy("_group")
    known = "_total" in counted.columns
    total = F.col("_total") if known else F.sum("_rows").over(in_group)
    start = F.min("_before").over(in_group) if known else F.lit(0)
    placed = counted.withColumns(
        {
            "_upto": start + F.sum("_rows").over(in_group.orderBy(*keys, order)),
            "_total": total,
        }
    ).withColumn("_before", F.col("_upto") - F.col("_rows"))
    position = (F.col("_total") - 1) * F.lit(fraction)
    return placed.where(
        (F.col("_upto") > F.floor(position)) & (F.col("_before") <= F.ceil(position))
    ).drop("_upto")


def exact_percentile(
    df: DataFrame,
    value_col: str,
    fraction: float = 0.95,
    group_col: str = "approach",
) -> DataFrame:
    """Exact linearly interpolated percentile: ``(group, percentile)``.

    NaN counts as larger than any other value, as in sorting; infinities are values.

    The built-in exact percentile gathers all values of a group in one task.  Here the
    wanted rank is narrowed down by counting, every count being combined on the map side:

    1. rows per logarithmic bucket of the value; the bucket holding the rank is kept;
    2. rows per linear step inside it;
    3. rows per distinct value of what is left, which is ranked.

    A double has 2^52 values per power of two, so after 2^12 buckets and 2^16 steps at most
    2^24 distinct values are ranked, whatever the data.  The plan is the same for any input;
    what the steps keep has one or two rows per group, and adaptive execution broadcasts it.
    """
    values = df.where(F.col(value_col).isNotNull()).select(
        F.col(group_col).alias("_group"), F.col(value_col).cast("double").alias("_value")
    )
    values = values.withColumn("_code", _value_code(F.col("_value")))
    measures = [
        F.count("*").alias("_rows"),
        F.min("_value").alias("_least"),
        F.max("_value").alias("_most"),
    ]
    buckets = values.groupBy("_group", "_code").agg(*measures)
    kept = _holding_rank(buckets, [], "_code", fraction)
    span = F.col("_most") - F.col("_least")
    inside = (F.abs(F.col("_code")) < _CODE_OF_INFINITY) & (span > 0)
    share = F.when(inside, (F.col("_value") - F.col("_least")) / span).otherwise(0.0)
    found = ["_before", "_total"]
    stepped = values.join(kept.drop("_rows"), ["_group", "_code"]).withColumn(
        "_step", F.floor(share * _LINEAR_STEPS)
    )
    steps = stepped.groupBy("_group", "_code", "_step", *found).agg(*measures)
    keys = ["_code", "_step"]
    held = _holding_rank(steps, ["_code"], "_step", fraction).select("_group", *keys, *found)
    left = stepped.drop("_least", "_most", *found).join(held, ["_group", *keys])
    counted = left.groupBy("_group", *keys, "_value", *found).agg(F.count("*").alias("_rows"))
    ends = _holding_rank(counted, keys, "_value", fraction)
    position = (F.col("_total") - 1) * F.lit(fraction)

    def value_at(rank: Column) -> Column:
        here = (F.col("_before") <= rank) & (F.col("_before") + F.col("_rows") > rank)
        return F.max(F.when(here, F.col("_value")))

    low, high = value_at(F.floor(position)), value_at(F.ceil(position))
    weight = F.max(position - F.floor(position))
    # Between finite values by their distance, else by shares, where infinity stays infinite.
    finite = (F.abs(low) < float("inf")) & (F.abs(high) < float("inf"))
    between = F.when(finite, low + (high - low) * weight).otherwise(low * (1 - weight) + high * weight)
    return ends.groupBy(F.col("_group").alias(group_col)).agg(
        F.when((low == high) | (weight == 0), low).otherwise(between).alias("percentile")
    )


def latency_stats(
    df: DataFrame, latency_col: str = "latency_ms", approximate: bool = False
) -> DataFrame:
    """Mean and 95th percentile latency per approach; one pass less when approximate."""
    if approximate:
        return df.groupBy("approach").agg(
            F.avg(latency_col).alias("mean_latency_ms"),
            F.percentile_approx(latency_col, 0.95, _SKETCH_ACCURACY)
            .cast("double")
            .alias("p95_latency_ms"),
        )
    mean = df.groupBy("approach").agg(F.avg(latency_col).alias("mean_latency_ms"))
    p95 = exact_percentile(df, latency_col, 0.95).withColumnRenamed("percentile", "p95_latency_ms")
    return _side_by_side(mean, p95)


def _side_by_side(left: DataFrame, right: DataFrame) -> DataFrame:
    """Columns of two tables with one row per approach, put together without a join."""
    rows = left.unionByName(right, allowMissingColumns=True)
    columns = [c for c in rows.columns if c != "approach"]
    return rows.groupBy("approach").agg(*[F.max(c).alias(c) for c in columns])


def _cost(words: Column, texts: Column, rate: float) -> Column:
    """Cost of 1,000 average texts at about 1.3 tokens per word, in integer arithmetic."""
    estimated = F.call_function("div", words * 13, F.lit(10))
    return _ratio(estimated, texts) * rate


def counted_token_cost(
    df: DataFrame, tokens_col: str, rate: float = COST_PER_1K_TOKENS
) -> DataFrame:
    """Token cost per 1,000 samples and approach from a column of token counts."""
    return df.groupBy("approach").agg(
        F.sum(tokens_col).alias("tokens"),
        F.count("*").alias("texts"),
        (_ratio(F.sum(tokens_col), F.count("*")) * rate).alias("token_cost_per_1k"),
    )


def token_cost(
    df: DataFrame, text_col: str = "input_text", rate: float = COST_PER_1K_TOKENS
) -> DataFrame:
    """Token cost per 1,000 samples and approach, estimated from the words."""
    words = F.coalesce(F.sum(word_count(F.col(text_col))), F.lit(0))
    return df.groupBy("approach").agg(
        words.alias("words"),
        F.count("*").alias("texts"),
        _cost(words, F.count("*"), rate).alias("token_cost_per_1k"),
    )


def strategy_counts(df: DataFrame) -> DataFrame:
    """Rows per matching strategy and approach, zeros included."""
    return df.groupBy("approach").agg(
        *[
            F.count_if(F.col("strategy") == name).alias(f"n_{name}")
            for name in STRATEGY_CONFIDENCE
        ]
    )


def benchmark_summary(
    df: DataFrame,
    labels: LabelSpace,
    text_col: str | None = "input_text",
    latency_col: str | None = "latency_ms",
    rate: float = COST_PER_1K_TOKENS,
) -> DataFrame:
    """The twelve metrics of every approach, one row each, plus the number of labels.

    Cells read the predictions once; the percentile reads approach and latency a few times.
    """
    averages = _averages(_per_label(cells(df, text_col, latency_col)), labels)
    if latency_col:
        p95 = exact_percentile(df, latency_col).withColumnRenamed("percentile", "p95_latency_ms")
        averages = _side_by_side(averages, p95)
    names = ("precision", "recall", "f1")
    return averages.select(
        "approach",
        "accuracy",
        *[f"{kind}_{name}" for name in names for kind in ("macro", "weighted")],
        (_ratio(F.col("latency"), F.col("timed")) if latency_col else F.lit(0.0)).alias("mean_latency_ms"),
        (F.coalesce("p95_latency_ms", F.lit(0.0)) if latency_col else F.lit(0.0)).alias("p95_latency_ms"),
        (
            _cost(F.col("words"), F.col("total_samples"), rate) if text_col else F.lit(0.0)
        ).alias("token_cost_per_1k"),
        "correct_samples",
        "total_samples",
        F.lit(len(labels)).alias("intent_count"),
    )
