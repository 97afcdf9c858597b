"""Exact and near dedup, components."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tagloom.llm import digest_index, minhash
from tagloom.llm.components import connected_components

SCHEMA = "doc_id bigint, text string, rep string, bucket int"


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def words(number, seed=0):
    draw = random.Random(seed)
    return [f"w{draw.randrange(5000)}" for _ in range(number)]


def expected_components(rows, size, over, under):
    sets = {}
    for n, text in rows:
        parts = (text or "").encode().lower().split()
        grams = {tuple(parts[i : i + size]) for i in range(len(parts) - size + 1)} if len(parts) >= size else {tuple(parts)} if parts else set()
        sets[n] = grams
    root = {n: n for n in sets}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            shared = len(sets[a] & sets[b])
            if sets[a] and sets[b] and shared * under >= over * (len(sets[a]) + len(sets[b]) - shared):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: (len(sets[n]), find(n)) for n in ids}


def edited(base, count, seed):
    draw = random.Random(seed)
    text = list(base)
    for _ in range(count):
        text[draw.randrange(len(text))] = f"e{draw.randrange(10**6)}"
    return " ".join(text)


@pytest.mark.parametrize(("size", "threshold"), [(3, (85, 100)), (5, (4, 5))])
def test_components_as_by_brute_force(spark, size, threshold):
    rows = []
    for family in range(6):
        base = words(150, family)
        rows += [(family * 100 + n, edited(base, n % 9, family * 50 + n)) for n in range(40)]
    rows += [(1000, None), (1001, ""), (1002, " \n"), (1003, "one two"), (1004, "ONE\ttwo"), (1005, "one"), (1006, "ÉTÉ a b"), (1007, "été a b")]
    rows += [(1100 + n, " ".join(words(120, 1))) for n in range(20)]
    rows += [(1200, "long " * 30_000), (1201, "long " * 29_000)]
    found = minhash.near_duplicates(docs_of(spark, rows), size, threshold).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected_components(rows, size, *threshold)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


@pytest.mark.parametrize("threshold", [(2, 5), (1, 2), (3, 5), (85, 100)])
def test_recall_at_the_threshold(spark, threshold):
    """Pairs a little above the threshold are found at any threshold."""
    over, under = threshold
    rows = []
    for n in range(100):
        shared = words(200, 10_000 + n)
        # Two sets of single words share 200 of 200 + 2 k.
        k = int(200 * (under - over) / over / 2 * 0.97)
        rows += [(2 * n, " ".join(dict.fromkeys(shared + [f"a{n}x{m}" for m in range(k)]))), (2 * n + 1, " ".join(dict.fromkeys(shared + [f"b{n}x{m}" for m in range(k)])))]
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs_of(spark, rows), 1, threshold).collect()}
    truth = expected_components(rows, 1, over, under)
    linked = [n for n in truth if truth[n][1] != n]
    assert len(linked) >= 90
    assert sum(found[n] == truth[n][1] for n in linked) >= 0.99 * len(linked)
    assert all(found[n] in (n, truth[n][1]) for n in truth)


def test_one_row_of_each_group_stays(spark):
    text, other = " ".join(words(30)), " ".join(words(30, 1))
    rows = [(5, text), (3, text), (3, text), (None, text), (None, other), (None, other), (8, None), (8, ""), (9, "alone"), (9, "other row")]
    docs = docs_of(spark, rows)
    kept = minhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted([(3, text), (None, other), (8, None), (8, ""), (9, "alone"), (9, "other row")], key=repr)


def test_chunked_groups_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(minhash, "CHUNK", 8)
    base = words(150, 77)
    rows = [(n, edited(base, n % 7, n)) for n in range(60)]
    found = minhash.near_duplicates(docs_of(spark, rows), 3, (85, 100)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected_components(rows, 3, 85, 100)


def test_repeated_rows_null_ids_and_empty_table(spark):
    text = " ".join(words(30))
    rows = [(5, text), (5, text), (3, text), (None, text), (None, None)]
    found = sorted(map(tuple, minhash.near_duplicates(docs_of(spark, rows)).collect()), key=repr)
    assert [(r[0], r[2], r[3]) for r in found] == [(3, 3, True), (5, 3, False), (5, 3, False), (None, None, True), (None, None, True)]
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_shingles_agree_with_words(spark):
    """Equal words in other white space and case give equal sets; other words do not."""
    one, two, three = minhash.shingle_sets([b"A b\tC  d", b"a B\n c d ", b"a b c e"], 3)
    assert one.tolist() == two.tolist() and len(one) == 2
    assert len(np.intersect1d(one, three)) == 1


def test_estimate_is_near_the_similarity():
    draw = np.random.default_rng(1)
    pool = draw.integers(0, 1 << 62, 3000, dtype=np.uint64)
    bits = [minhash.packed(minhash.minima(pool[a:b])) for a, b in ((0, 2000), (0, 2000), (1000, 3000))]
    assert minhash.estimate(bits[0], bits[1][None])[0] == 1.0
    assert abs(minhash.estimate(bits[0], bits[2][None])[0] - 1 / 3) < 0.2


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(n, n + 1) for n in range(200)] + [(500, 501), (7, 7)], "a long, b long")
    found = {r.node: r.root for r in connected_components(edges).collect()}
    assert found == {**{n: 0 for n in range(201)}, 500: 500, 501: 500}


def test_exact_dedup_keeps_the_smallest_id(spark):
    rows = [(9, "a  b"), (4, "a\tb"), (7, "a b "), (8, None), (6, ""), (5, " "), (4, "a b"), (None, "a b"), (None, "q")]
    rows += [(100 + n, "copied text") for n in range(300)]
    for batches in (1, 3):
        found = digest_index.deduplicate(docs_of(spark, rows), batches=batches).collect()
        assert len(found) == len(rows)
        by = {(r.doc_id, r.text_sha256): (r.keep_id, r.group_size, r.kept) for r in found}
        keeps = sorted((r.doc_id or -1, r.keep_id, r.group_size, r.kept) for r in found if r.doc_id is not None and r.doc_id < 100)
        assert keeps == [(4, 4, 4, True), (4, 4, 4, True), (5, 5, 1, True), (6, 6, 2, True), (7, 7, 1, True), (8, 6, 2, False), (9, 4, 4, False)]
        assert {v for k, v in by.items() if k[0] and k[0] >= 100} == {(100, 300, True), (100, 300, False)}
    empty = digest_index.deduplicate(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0


def plan_of(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_index_persists_over_batches(spark):
    index = digest_index.DigestIndex.fresh(spark)
    digest_index.deduplicate(docs_of(spark, [(1, "a"), (2, "b")]), index)
    again = digest_index.deduplicate(docs_of(spark, [(0, "a"), (3, "c")]), index).collect()
    assert {(r.doc_id, r.keep_id, r.kept) for r in again} == {(0, 1, False), (3, 3, True)}
    assert index.read().count() == 3


def test_index_is_found_by_another_session(spark):
    """Fifty digests, an emptied catalog, a second session: one more text makes fifty-one."""
    index = digest_index.DigestIndex.fresh(spark)
    digest_index.deduplicate(docs_of(spark, [(n, f"text {n}") for n in range(50)]), index)
    spark.sql(f"DROP TABLE {index.name}")
    second = spark.newSession()
    opened = digest_index.DigestIndex(second, index.path, buckets=8)
    assert opened.buckets == index.buckets and opened.read().count() == 50
    found = digest_index.deduplicate(docs_of(second, [(70, "text 7"), (71, "new")]), opened).collect()
    assert {(r.doc_id, r.keep_id, r.kept) for r in found} == {(70, 7, False), (71, 71, True)}
    assert opened.read().count() == 51
    assert digest_index.DigestIndex(spark, index.path).read().count() == 51


def test_index_side_of_the_join_is_not_shuffled(spark):
    index = digest_index.DigestIndex.fresh(spark)
    digest_index.deduplicate(docs_of(spark, [(n, f"text {n}") for n in range(50)]), index)
    opened = digest_index.DigestIndex(spark.newSession(), index.path)
    batch = digest_index.digests(docs_of(opened.spark, [(1, "x")])).groupBy("text_sha256").agg({"doc_id": "min"})
    joined = batch.join(opened.read().select("text_sha256").hint("merge"), "text_sha256", "left_anti")
    plan = plan_of(joined)
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    # The batch's own aggregation is the only exchange.
    assert plan.split("\n\n")[0].count("Exchange") == 1


def test_index_refuses_files_that_are_none(spark, tmp_path):
    spark.range(3).write.parquet(f"file://{tmp_path}/other")
    with pytest.raises(ValueError, match="no complete digest index"):
        digest_index.DigestIndex(spark, f"file://{tmp_path}")


def test_index_grows_into_more_buckets(spark, monkeypatch):
    monkeypatch.setattr(digest_index, "BUCKET_ROWS", 4)
    index = digest_index.DigestIndex.fresh(spark, buckets=2)
    digest_index.deduplicate(docs_of(spark, [(n, f"text {n}") for n in range(6)]), index)
    assert index.buckets == 2
    digest_index.deduplicate(docs_of(spark, [(100 + n, f"text {n}") for n in range(30)]), index)
    assert index.buckets == 16 and index.read().count() == 30
    opened = digest_index.DigestIndex(spark.newSession(), index.path)
    assert opened.buckets == 16
    assert {r.keep_id for r in opened.read().collect()} == {*range(6), *range(106, 130)}
