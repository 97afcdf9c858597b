"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule over training time 0 to 1, linear between knots.  The integral
of a schedule is the source's share of the token budget; a source gives at most ``max_passes``
times its size, what is over goes to the others by weight.  The cumulative demand of a source
at time t is its target times the integral up to t over the whole integral.  A document whose
words begin at the n-th word drawn from its source is trained at the time when the demand
reaches n, which is the inverse of that function.

Sources repeat in whole passes; of the last pass as many words are taken as the target leaves,
so one document at most per source is cut.  The order inside a source is a seeded digest of the
document's id.  Sums run over digest buckets, so that one source may hold most of the rows.  Mixed documents
are range-sorted by position, so that their files follow the curriculum.

Null texts have no words, are taken with 0 and have no position.  Null ids, sources, repeated rows
and further columns are kept as they are; a null source is a source of its own.  An empty table
gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import SPACE_PATTERN, WORD_PATTERN, all_columns, numbered_rows, running_sum, word_count
from tagloom.operators.ordering import numbered
from tagloom.session import stage

MAX_PASSES = 3
SEED = "mix"
# Hex digits of the digest that make a bucket: 4096 buckets a source.
BUCKET_DIGITS = 3

Knots = list[tuple[float, float]]


def sized(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", row_col: str | None = None
) -> DataFrame:
    """Id, source and size in words of every document, stored: the texts are read once.

    ``row_col`` names the column that tells rows apart, where ids may be null or repeated.
    """
    row = F.lit(None) if row_col is None else F.col(row_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
        row.cast("long").alias("row"),
    )
    return stage(rows, "sized")


def ranked_sources(sized: DataFrame) -> DataFrame:
    """Every source with its size in words and its rank by code point, null last."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    return numbered(sums, [F.col("source").isNull(), F.col("source")], "rank")


def repeating_weights(sources: DataFrame, schedules: list[Knots]) -> DataFrame:
    """Give the sources the schedules in turn, by rank."""
    literal = F.array(*[_knots(s) for s in schedules])
    return sources.withColumn(
        "knots", F.element_at(literal, (F.col("rank") % len(schedules) + 1).cast("int"))
    )


def _knots(schedule: Knots) -> Column:
    return F.array(
        *[F.struct(F.lit(float(a)).alias("at"), F.lit(float(w)).alias("rate")) for a, w in schedule]
    )


def with_integrals(sources: DataFrame) -> DataFrame:
    """Add ``weight``, the integral of a schedule, and ``segments``, its linear pieces."""
    pieces = F.transform(
        F.sequence(F.lit(1), F.size("knots") - 1),
        lambda i: F.struct(
            F.element_at("knots", i)["at"].alias("at"),
            F.element_at("knots", i)["rate"].alias("rate"),
            (
                (F.element_at("knots", i + 1)["rate"] - F.element_at("knots", i)["rate"])
                / (F.element_at("knots", i + 1)["at"] - F.element_at("knots", i)["at"])
            ).alias("slope"),
            (
                (F.element_at("knots", i + 1)["rate"] + F.element_at("knots", i)["rate"])
                * (F.element_at("knots", i + 1)["at"] - F.element_at("knots", i)["at"])
                / 2
            ).alias("area"),
        ),
    )
    summed = F.aggregate("pieces", F.lit(0.0), lambda total, p: total + p["area"])
    upto = F.transform(
        "pieces",
        lambda p, i: F.struct(
            p["at"].alias("at"),
            p["rate"].alias("rate"),
            p["slope"].alias("slope"),
            F.aggregate(F.slice("pieces", 1, i), F.lit(0.0), lambda t, q: t + q["area"]).alias("upto"),
        ),
    )
    return (
        sources.withColumn("pieces", pieces)
        .withColumn("weight", summed)
        .withColumn("segments", upto)
        .drop("pieces", "knots")
    )


def target_sizes(sources: DataFrame, budget: int | None = None, max_passes: int = MAX_PASSES) -> DataFrame:
    """Add ``target``: the budget by weight, no source above ``max_passes`` times its size.

    Every round is one aggregate over the sources: those at their limit are set aside and the
    rest of the budget is dealt to the others, until no other source is above.  Only sums come
    to the driver.
    """
    sources = stage(sources, "sources")
    limit = F.col("source_size") * max_passes
    if budget is None:
        budget = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    left, weight, full = float(budget), None, -1
    while True:
        share = F.lit(0.0) if not weight else F.col("weight") * left / weight
        at_limit = F.lit(False) if weight is None else share > limit
        row = sources.agg(
            F.coalesce(F.sum(F.when(at_limit, limit)), F.lit(0)).alias("given"),
            F.coalesce(F.sum(F.when(~at_limit, F.col("weight"))), F.lit(0.0)).alias("weight"),
            F.coalesce(F.sum(at_limit.cast("long")), F.lit(0)).alias("full"),
        ).first()
        if row["full"] == full:
            break
        left, weight, full = float(budget - row["given"]), row["weight"], row["full"]
    target = F.when(at_limit, limit.cast("double")).otherwise(share)
    return sources.withColumn("target", F.least(target, limit.cast("double")))


def plan_mix(
    sized: DataFrame, sources: DataFrame, max_passes: int = MAX_PASSES, seed: str = SEED
) -> DataFrame:
    """One row per document: id, size, source's size and target, occurrences and words taken.

    ``sized`` comes from :func:`sized`, ``sources`` from :func:`target_sizes`.  ``occurrences`` lists pass, position (0 to 1) and
    words of each time the document is trained on.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    # A struct key is never null, so a null source needs no special join.
    rows = sized.select(
        "doc_id",
        F.struct(F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name")).alias("key"),
        "size",
        "row",
        digest.alias("draw"),
        F.substring(digest, 1, BUCKET_DIGITS).alias("bucket"),
    )
    placed = running_sum(rows, ["key"], "bucket", ["draw", "size", "row"], "size", "before")
    keyed = sources.select(
        F.struct(F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name")).alias("key"),
        "source_size", "target", "weight", "segments",
    )
    met = placed.join(keyed, "key")
    words = F.floor(F.col("target") + 0.5)
    whole = F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(F.lit(0))

    def words_of(k: Column) -> Column:
        rest = words - k * F.col("source_size") - F.col("before")
        return F.greatest(F.least(rest, F.col("size")), F.lit(0)).cast("long")

    def position(k: Column) -> Column:
        reached = F.col("weight") * (k * F.col("source_size") + F.col("before")) / F.nullif("target", F.lit(0.0))
        piece = F.try_element_at(F.filter("segments", lambda s: s["upto"] <= reached), F.lit(-1))
        area = reached - piece["upto"]
        root = F.sqrt(F.greatest(piece["rate"] * piece["rate"] + 2 * piece["slope"] * area, F.lit(0.0)))
        step = F.when(area > 0, 2 * area / (piece["rate"] + root)).otherwise(F.lit(0.0))
        return piece["at"] + step

    occurrences = F.filter(
        F.transform(
            F.sequence(F.lit(0), F.lit(max_passes - 1)),
            lambda k: F.struct(k.alias("pass"), position(k).alias("position"), words_of(k).alias("words")),
        ),
        lambda o: o["words"] > 0,
    )
    return (
        met.withColumn("occurrences", occurrences)
        .withColumn("taken", F.aggregate("occurrences", F.lit(0).cast("long"), lambda t, o: t + o["words"]))
        .withColumn("whole_passes", whole.cast("long"))
        .select(
            "doc_id", "row", "draw", "size", "source_size", "target", "taken", "whole_passes", "occurrences"
        )
    )


def curriculum(
    docs: DataFrame,
    weigh: Callable[[DataFrame], DataFrame],
    budget: int | None = None,
    max_passes: int = MAX_PASSES,
    **columns: str,
) -> DataFrame:
    """Plan the mix of ``docs``; ``weigh`` adds ``knots`` to the ranked sources."""
    rows = sized(docs, **columns)
    sources = target_sizes(with_integrals(weigh(ranked_sources(rows))), budget, max_passes)
    return plan_mix(rows, sources, max_passes)


def training_order(plan: DataFrame) -> DataFrame:
    """Every occurrence as a row, range-sorted by training position."""
    each = plan.select("doc_id", "size", F.explode("occurrences").alias("o"))
    rows = each.select("doc_id", "size", "o.pass", "o.position", "o.words")
    return rows.orderBy("position", "doc_id", "pass")


def mixed_documents(
    docs: DataFrame,
    weigh: Callable[[DataFrame], DataFrame],
    budget: int | None = None,
    max_passes: int = MAX_PASSES,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    position_col: str | None = None,
    stored: bool = False,
) -> DataFrame:
    """The documents as often as the curriculum takes them, range-sorted by position; a cut one keeps its leading words.

    Documents that the plan leaves out go.  ``position_col`` adds the position under that name;
    ``stored`` as in ``common.numbered_rows``.
    """
    rows, row = numbered_rows(docs, stored)
    plan = curriculum(rows, weigh, budget, max_passes, id_col=id_col, text_col=text_col, source_col=source_col, row_col=row)
    # Structs, so that no column's name matters.
    each = plan.select("row", "size", F.explode("occurrences").alias("o")).select("row", F.struct("size", "o").alias("taken"))
    met = rows.select(F.struct(*all_columns(docs)).alias("doc"), F.col(row).alias("row")).join(each, "row")
    words = F.regexp_extract_all(F.col("doc")[text_col], F.lit(SPACE_PATTERN[:-1] + "*" + WORD_PATTERN), F.lit(0))
    head = F.array_join(F.slice(words, F.lit(1), F.col("taken.o.words").cast("int")), "")
    cut = F.when(F.col("taken.o.words") < F.col("taken.size"), head).otherwise(F.col("doc")[text_col])
    columns = [(cut if c == text_col else F.col("doc")[c]).alias(c) for c in docs.columns if c != position_col]
    placed = [F.col("taken.o.position").alias(position_col)] if position_col else []
    # The order is the feature: position, then what makes it the same in every run.
    return met.orderBy("taken.o.position", F.col("doc")[id_col], "taken.o.pass", "row").select(*columns, *placed)
