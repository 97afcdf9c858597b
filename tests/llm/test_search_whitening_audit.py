"""Top-k search, whitening and filter audit against brute force."""

from __future__ import annotations

import math
import random
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tagloom.llm import filter_audit, maxscore, whitening

VECTORS = "vec_id bigint, embedding array<float>, score string, shard string, n string, x int"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, "s", "t", "u", 1) for i, v in rows], VECTORS)


def usable(v):
    return v is not None and all(c is not None and math.isfinite(c) and abs(c) < 2**40 for c in v)


def whole(v, scale):
    return [math.floor(scale * float(np.float32(c))) for c in v]


def expected_top(rows, every, k):
    kept = [(i, whole(v, 256)) for i, v in rows if usable(v)]
    out = []
    for q, x in kept:
        if q is None or q % every:
            continue
        scores = [(-sum(a * b for a, b in zip(x, y)), i is None, i or 0, i) for i, y in kept if i != q]
        for rank, (score, _, _, i) in enumerate(sorted(scores, key=lambda s: s[:3])[:k], 1):
            out.append((q, rank, i, max(-(1 << 63), min((1 << 63) - 1, -score))))
    return sorted(out, key=repr)


def found_top(spark, rows, every=5, k=5):
    return sorted(map(tuple, maxscore.top_k(vectors_of(spark, rows), F.col("vec_id") % every == 0, k).collect()), key=repr)


def test_top_k_as_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(maxscore, "BLOCK_POSTINGS", 600)
    monkeypatch.setattr(maxscore, "CHUNK_COMPONENTS", 100)
    draw = np.random.default_rng(3)
    dense = [(n, draw.normal(0, 0.125, 12).tolist()) for n in range(120)]
    sparse = [(200 + n, np.where(draw.random(12) < 0.2, draw.normal(0, 3, 12), 0).tolist()) for n in range(60)]
    odd = [
        (300, None), (305, []), (310, [None, 1.0]), (315, [float("nan")]), (320, [float("inf"), 1.0]), (325, [0.0] * 12),
        (330, [1.0, -1.0]), (331, [1.0, -1.0, 0.5]), (None, [2.0] * 12), (None, None), (335, [-5.0] * 12), (340, [3e38]),
        (345, draw.normal(0, 1, 40).tolist()),
    ]
    copies = [(400 + n, [0.5] * 12) for n in range(40)] + [(7, [9.0] * 12), (7, [9.0] * 12)]
    rows = dense + sparse + odd + copies
    assert found_top(spark, rows) == expected_top(rows, 5, 5)


def test_top_k_of_few_rows_repeated_queries_and_none(spark):
    rows = [(5, [1.0, 0.0]), (5, [0.0, 1.0]), (6, [-1.0, -1.0]), (7, [1.0, 2.0])]
    assert found_top(spark, rows) == expected_top(rows, 5, 5)
    assert found_top(spark, [(1, [1.0])]) == []
    assert found_top(spark, []) == []
    huge = [(0, [2.0**39, 1.0]), (1, [2.0**39, 5.0]), (2, [2.0**39, 7.0]), (3, [-(2.0**39), 0.0]), (4, [1.0, 1.0])]
    assert found_top(spark, huge, 4) == expected_top(huge, 4, 5)


def test_non_essential_lists_are_probed_for_few():
    """Two rare heavy terms decide; the documents that hold only common light ones are never looked at again."""
    draw = np.random.default_rng(5)
    flat = np.zeros((5000, 20), dtype=np.int64)
    flat[:, 2:] = draw.integers(0, 3, (5000, 18))
    flat[:30, 0], flat[20:50, 1] = draw.integers(80, 90, 30), draw.integers(80, 90, 30)
    block = maxscore.Block.of(pa.array(np.arange(5000)), np.full(5000, 20), flat.ravel())
    x = np.array([9, 9] + [1] * 18)
    read = []
    original = block.postings
    block.postings = lambda n: read.append(n) or original(n)
    places, scores = maxscore.search(block, x, 5, None)
    truth = flat @ x
    best = sorted(range(5000), key=lambda i: (-truth[i], i))[:5]
    assert places.tolist() == best and scores.tolist() == truth[best].tolist()
    floor = maxscore._floor(block, [(9 * int(block.highest[n]), n, 9) for n in (0, 1)] + [(int(block.highest[n]), n, 1) for n in range(2, 20)], [], 5, np.ones(5000, dtype=bool), np.int64)
    assert floor > sum(int(h) for h in block.highest[2:])


def test_whitening_as_by_eigenvectors(spark):
    draw = np.random.default_rng(8)
    mixing = draw.normal(0, 1, (10, 10)) * np.linspace(3, 0.1, 10)
    points = (draw.normal(0, 1, (400, 10)) @ mixing + 50).astype(np.float32)
    rows = [(n, p.tolist()) for n, p in enumerate(points)]
    rows += [(900, None), (901, [1.0]), (902, [None] + [1.0] * 9), (903, [float("nan")] * 10), (None, points[0].tolist()), (3, points[3].tolist())]
    found = whitening.whiten(vectors_of(spark, rows)).collect()
    kept = [(i, v) for i, v in rows if usable(v) and len(v) == 10]
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in kept])
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:8], vectors[:, ::-1][:, :8]
    assert len(found) == 8 * n
    mine = {}
    for r in found:
        assert r.n == n and r.identity_error < 1e-9
        assert abs(r.explained - values[r.component - 1] / np.trace(cov)) < 1e-9
        mine.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, r.whitened)
    for (i, _), row in zip(kept, x.tolist()):
        deviation = sum((n * a - int(s)) ** 2 for a, s in zip(row, sums))
        own = mine[i, deviation]
        white = (np.array(row) - sums / n) @ vectors / np.sqrt(values)
        assert all(abs(abs(own[c + 1]) - abs(white[c])) < 1e-8 for c in range(8))
    every = np.array([[mine[k][c] for c in range(1, 9)] for k in mine])
    assert np.abs(np.corrcoef(every.T) - np.eye(8)).max() < 0.02


def test_whitening_of_few_equal_and_no_rows(spark):
    assert whitening.whiten(vectors_of(spark, [])).count() == 0
    assert whitening.whiten(vectors_of(spark, [(1, [1.0, 2.0])])).count() == 0
    assert whitening.whiten(vectors_of(spark, [(n, [1.0, 2.0]) for n in range(3)])).count() == 0
    assert whitening.whiten(vectors_of(spark, [(1, None), (2, [])])).count() == 0
    line = whitening.whiten(vectors_of(spark, [(n, [float(n), 2.0 * n]) for n in range(5)])).collect()
    assert {r.component for r in line} == {1} and all(abs(r.explained - 1) < 1e-12 for r in line)
    far = whitening.whiten(vectors_of(spark, [(n, [2.0**39 * (n % 2), float(n)]) for n in range(6)])).collect()
    assert len(far) >= 6 and all(r.deviation is None for r in far)


@pytest.mark.parametrize(("size", "rank"), [(1, 1), (5, 5), (16, 16), (16, 6)])
def test_cholesky_and_jacobi(size, rank):
    draw = np.random.default_rng(size + rank)
    half = draw.normal(0, 1, (size, rank)) * np.logspace(0, 3, rank)
    cov = half @ half.T
    factor, order = whitening.pivoted_cholesky(cov)
    assert factor.shape == (size, rank)
    assert np.allclose(factor @ factor.T, cov[order][:, order], rtol=1e-10, atol=1e-9 * cov.max())
    assert np.allclose(np.triu(factor, 1), 0)
    values, vectors = whitening.components_of(cov, size)
    assert np.allclose(values, np.linalg.eigvalsh(cov)[::-1][:rank], rtol=1e-9)
    assert np.abs(vectors.T @ vectors - np.eye(rank)).max() < 1e-12


def expected_audit(docs, labels):
    rows = []
    for i, text, part in docs:
        text = text or ""
        words = text.encode().split()
        fails = set()
        if len(words) < 50:
            fails.add("A")
        if 100 * len(set(words)) < 65 * len(words):
            fails.add("B")
        if 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text):
            fails.add("C")
        if any(c in "#$%&*|" for c in text):
            fails.add("D")
        if i is not None and any(j is not None and j < i and (other or "") == text for j, other, _ in docs):
            fails.add("E")
        own = [m for m in labels if m[0] is not None and m[0] == i]
        rows.append((part or "", fails, any(m[1] == 1 for m in own), any(m[2] == 1 for m in own)))
    out = []
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        steps = []
        for order in permutations("ABCDE"):
            alive = mine
            for step, letter in enumerate(order, 1):
                gone = [r for r in alive if letter in r[1]]
                alive = [r for r in alive if letter not in r[1]]
                failing = sum(letter in r[1] for r in mine)
                steps.append([part, "".join(order), step, len(alive), len(gone), failing - len(gone), sum(r[1] == {letter} for r in mine), sum(r[2] for r in gone), sum(r[3] for r in gone)])
        for s in steps:
            out.append((*s, sum(o[4] for o in steps if o[1][o[2] - 1] == s[1][s[2] - 1])))
    return sorted(out)


def test_audit_as_by_brute_force(spark):
    draw = random.Random(4)
    docs = []
    for n in range(150):
        words = [f"w{draw.randrange(30 if n % 3 else 900)}" for _ in range(draw.choice([5, 50, 80]))]
        text = " ".join(words) + draw.choice(["", " #", " LOUD" * 20, "é" * 9])
        docs.append((draw.randrange(200), text, draw.choice(["a", "b", None, ""])))
    docs += [(n, "same text", "a") for n in range(300, 340)] + [(300, "same text", "b"), (None, "same text", "c"), (None, None, "c")]
    docs += [(-4, None, "d"), (2, "", "d"), (9, "long " * 50_000, "d"), (10, "LONG " * 50_000, None)]
    labels = [(n, draw.choice([0, 1, None]), draw.choice([0, 1, None])) for n in range(0, 330, 2)] + [(2, 1, 0), (2, 0, 1), (None, 1, 1)]
    frame = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id bigint, text string, source string, part string, fails int")
    marks = spark.createDataFrame([(*m, "x") for m in labels], "doc_id bigint, quality int, toxic int, label string")
    found = filter_audit.audit(frame, marks)
    assert found.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(map(tuple, found.collect())) == expected_audit(docs, labels)
    assert filter_audit.audit(frame.limit(0), marks).count() == 0
    assert filter_audit.audit(frame, marks.limit(0)).agg(F.sum("good_lost")).first()[0] == 0


def test_positional_popcounts_of_any_number_of_words():
    draw = np.random.default_rng(2)
    for size in [0, 1, 2, 3, 4, 7, 64, 1000]:
        words = draw.integers(0, 1 << 32, size, dtype=np.uint32)
        assert filter_audit.positional_popcounts(words).tolist() == [int((words >> s & 1).sum()) for s in range(32)]
