"""The queries of the subpackage against their SQL, and the pipeline's stages."""

from __future__ import annotations

import html as entities
import re
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from tagloom.llm.common import stored_order
from tagloom.llm.queries import ORACLE, QUERIES

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in FOLDER.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    return connection


def test_every_operator_has_a_registered_query():
    names = [name for name in contract.queries() if name.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in contract.queries()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_sql(spark, duck, name):
    found = QUERIES[name](spark, str(FOLDER))
    expected = duck.sql(ORACLE[name])
    columns = sorted(found.columns)
    assert columns == sorted(expected.columns)

    def ordered(rows, names):
        places = [names.index(c) for c in columns]
        return sorted((tuple(row[p] for p in places) for row in rows), key=repr)

    rows = ordered([tuple(r) for r in found.collect()], found.columns)
    assert rows == ordered(expected.fetchall(), expected.columns)
    assert rows


def test_quality_rejects_what_is_labelled_bad_and_keeps_the_good(spark):
    folder = str(FOLDER).replace("sf0.001", "sf0.01")
    found = QUERIES["op2_quality"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet").where("coalesce(toxic, 0) = 0")
    rates = {r[0]: r[1] for r in found.join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("accepted").cast("int"))).collect()}
    assert rates[0] <= 0.15
    assert rates[1] >= 0.97


def test_language_on_held_out_documents(spark):
    found = QUERIES["op4_language"](spark, str(FOLDER)).where("held_out")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    right, total = found.join(docs, "doc_id").agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert total >= 20 and right / total >= 0.95


def test_main_text_of_the_pages(spark):
    """The pages put the article between an advert and a footer."""
    spaces = re.compile(r"[\x20\x09-\x0D]+")
    pages = {r.page_id: r for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    for row in QUERIES["op8_main_text"](spark, str(FOLDER)).collect():
        html = pages[row.page_id].html
        article = html[html.index("<article>") :].split("</article>")[0]
        blocks = re.sub(r"</?(?:article|h1|p|br)>", " ", re.sub(r"</?b>", "", article))
        assert row.text == spaces.sub(" ", entities.unescape(blocks)).strip(" ")
        assert row.n_chars == len(row.text)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before = docs.count()
    columns = docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "near-duplicates", "benchmark decontamination", "mixing", "sharding",
    ]
    counts = [before]
    for _, function in corpus_pipeline.STAGES[:4]:
        docs = corpus_pipeline.stage(function(spark, docs, str(FOLDER)), "tested")
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] > counts[3] > 0.5 * before
    sharded = corpus_pipeline.STAGES[4][1](spark, docs, str(FOLDER))
    assert sharded.count() == counts[4]
    assert {"text", "shard", "slot"} <= set(sharded.columns)
    # Slots follow the order of the mix: a shard's rows are met one after the other in it.
    part, place = stored_order(docs)
    order = [r.doc_id for r in docs.select("doc_id", part.alias("f"), place.alias("i")).orderBy("f", "i").collect()]
    shards = {}
    for r in sharded.orderBy("shard", "slot").collect():
        shards.setdefault(r.shard, []).append((r.doc_id, r.slot))
    for rows in shards.values():
        assert [slot for _, slot in rows] == list(range(len(rows)))
        following = iter(order)
        assert all(doc_id in following for doc_id, _ in rows)


def test_pipeline_trains_on_every_trusted_text(spark, tmp_path, monkeypatch):
    """Above a million documents too; the stage takes rows by their place in the files, draws go by doc_id."""
    docs = spark.range(1_400_000).selectExpr("id AS doc_id", "CAST(id AS STRING) AS text", "'en' AS lang", "'s' AS source", "6L AS n_chars")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.range(1_500_000).selectExpr("id AS doc_id", "IF(id % 50 = 7, 0, 1) AS quality", "0 AS toxic").write.parquet(f"{tmp_path}/labels.parquet")

    class Trained(Exception):
        pass

    def trained(texts, order):
        raise Trained(texts.selectExpr("count(*)", "sum(CAST(text AS LONG))").first())

    monkeypatch.setattr(corpus_pipeline.quality, "train", trained)
    with pytest.raises(Trained) as met:
        corpus_pipeline.keep_quality(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
    expected = docs.where(f"doc_id % 50 != 7 AND pmod(xxhash64(doc_id), {corpus_pipeline.quality.HOLD_OUT}) != 0")
    assert met.value.args[0] == expected.selectExpr("count(*)", "sum(doc_id)").first()
    assert met.value.args[0][0] > 1_000_000


CLASHING = ("_bad", "_bad_", "_other", "_bad_id", "_bad_key", "_id", "_words", "_o", "_row", "_good", "size", "row", "taken", "doc", "shard", "slot", "part", "place", "fails")


def test_pipeline_keeps_null_and_repeated_ids_and_clashing_columns(spark):
    """Every stage decides by rows: what befalls one row befalls no other with its id."""
    source = spark.read.parquet(f"{FOLDER}/documents.parquet")
    clean = source.where("lang = 'en' AND n_chars BETWEEN 500 AND 3000")
    first, second, third = [r.text for r in clean.orderBy("doc_id").limit(3).collect()]
    extra = [
        (None, first + " the end", "en", "src0"), (None, "", "en", "src0"), (None, None, None, None),
        (7001, second + " so it goes", "en", "src1"), (7001, "#$%&|" * 100, "en", "src1"),
        (7002, "unique words " + third[::-1], "en", "src1"), (7003, third + " at last", "en", None), (7003, third + " at last", "en", None),
    ]
    odd = spark.createDataFrame(extra, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    docs = source.unionByName(odd)
    for name in CLASHING:
        docs = docs.withColumn(name, F.lit(name))
    docs = corpus_pipeline.stage(docs, "clashing")
    counts = []
    for name, function in corpus_pipeline.STAGES[:4]:
        found = function(spark, docs, str(FOLDER))
        assert found.columns == docs.columns, name
        docs = corpus_pipeline.stage(found, "tested")
        counts.append({(r.doc_id, r.text) for r in docs.where("doc_id IS NULL OR doc_id > 7000").collect()})
    quality_kept, near_kept = counts[0], counts[1]
    assert (None, first + " the end") in quality_kept and (7001, second + " so it goes") in quality_kept
    assert not {(None, ""), (None, None), (7001, "#$%&|" * 100)} & quality_kept
    # Near copies of documents with smaller ids go, also without an id.
    assert near_kept <= quality_kept and not {(None, first + " the end"), (7003, third + " at last")} & near_kept
    sharded = corpus_pipeline.STAGES[4][1](spark, docs, str(FOLDER))
    assert sharded.count() == docs.count() and sharded.columns[-4:] == ["size", "words", "shard", "slot"]
    empty = docs.limit(0)
    for name, function in corpus_pipeline.STAGES:
        assert function(spark, empty, str(FOLDER)).count() == 0
