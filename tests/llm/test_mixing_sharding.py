"""Curriculum mixing and vector bin packing."""

from __future__ import annotations

import math
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tagloom.llm import mixing, sharding
from tagloom.llm.queries import CURRICULUM

SCHEMA = "doc_id bigint, text string, source string, words string, size int"


def docs_of(spark, rows):
    """Rows of id, text and source, with further columns whose names clash."""
    return spark.createDataFrame([(*r, "x", 7) for r in rows], SCHEMA)


def weigh(sources):
    return mixing.repeating_weights(sources, CURRICULUM)


def planned(docs, **more):
    return mixing.curriculum(docs, weigh, **more)


@pytest.fixture(scope="module")
def uneven(spark):
    """A source with most words, small ones, a null source, null and empty texts, repeated rows."""
    rows = [(n, "w " * (1 + n % 9), "big") for n in range(600)]
    rows += [(1000 + n, "a b c", f"s{n % 4}") for n in range(40)]
    rows += [(2000, None, "s1"), (2001, "", "s2"), (2002, " \t\n", None), (2003, "one two", None)]
    rows += [(2004, "x y", "s3"), (2004, "x y", "s3"), (None, "z z", "s0"), (None, None, None)]
    return docs_of(spark, rows)


def test_targets_fill_the_budget_and_respect_the_limit(uneven):
    rows = planned(uneven).collect()
    assert len(rows) == uneven.count()
    by_source = {}
    for r in rows:
        by_source.setdefault((r.source_size, round(r.target, 6)), []).append(r)
        assert 0 <= r.taken <= 3 * r.size
    total = sum(r.size for r in rows)
    assert sum(r.taken for r in rows) == pytest.approx(total, abs=6)
    small = [r for r in rows if r.source_size < 100]
    assert all(r.target == 3 * r.source_size for r in small)


def test_runs_agree(uneven):
    assert sorted(map(repr, planned(uneven).collect())) == sorted(map(repr, planned(uneven.repartition(7)).collect()))


def test_positions_invert_the_demand(spark):
    """Half of a rising schedule's words lie where its integral reaches a half."""
    docs = docs_of(spark, [(n, "w", "only") for n in range(2000)])
    rising = [(0.0, 0.0), (1.0, 2.0)]
    plan = mixing.curriculum(docs, lambda s: mixing.repeating_weights(s, [rising]))
    order = mixing.training_order(plan).collect()
    positions = [r.position for r in order]
    assert positions == sorted(positions)
    assert positions == pytest.approx(np.sqrt(np.arange(2000) / 2000), abs=1e-9)


def test_mixed_documents_hold_the_words_of_the_plan(uneven):
    clean = uneven.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    plan = planned(clean)
    mixed = mixing.mixed_documents(clean, weigh, position_col="at")
    assert mixed.columns == [*clean.columns, "at"]
    positions = [r["at"] for r in mixed.collect()]
    assert positions == sorted(positions) == [r.position for r in mixing.training_order(plan).collect()]
    words = mixed.agg(F.sum(F.regexp_count("text", F.lit(mixing.WORD_PATTERN)))).first()[0]
    assert words == plan.agg(F.sum("taken")).first()[0]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert planned(empty).count() == 0
    assert sharding.shard(empty, 24).count() == 0


def test_shards_are_even_gapless_and_keep_groups(spark):
    generator = np.random.default_rng(3)
    rows = [(n, "t%d " % n * int(generator.integers(1, 60)), "s") for n in range(1500)]
    rows += [(5000 + n, "copy of one text " * 5, "s") for n in range(30)]
    rows += [(6000, None, None), (6001, "", "s"), (None, "x", "s"), (None, "x", "s"), (6002, "long " * 3000, "s")]
    found = sharding.shard(docs_of(spark, rows), 24).collect()
    assert len(found) == len(rows)
    loads, slots, places = {}, {}, {}
    texts = {}
    for n, text, _ in rows:
        texts.setdefault(n, text or "")
    for r in found:
        loads[r.shard] = loads.get(r.shard, 0) + r.size
        slots.setdefault(r.shard, []).append(r.slot)
        places.setdefault(r.text_crc32, set()).add(r.shard)
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(data) + 8, zlib.crc32(data))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(p) == 1 for p in places.values())
    mean = sum(loads.values()) / 24
    others = [v for v in loads.values() if v < 15_000]
    assert max(others) - min(others) < 0.1 * mean


def test_a_group_larger_than_a_shard_is_cut(spark):
    rows = [(n, "the same text", "s") for n in range(900)] + [(1000 + n, f"other {n}", "s") for n in range(900)]
    loads = {r.shard: r["sum(size)"] for r in sharding.shard(docs_of(spark, rows), 8).groupBy("shard").sum("size").collect()}
    assert len(loads) == 8
    assert max(loads.values()) < 1.1 * sum(loads.values()) / 8


def test_packing_as_by_brute_force(spark):
    """Groups, units, their loads and the greedy choice, recomputed in plain Python."""
    generator = np.random.default_rng(6)
    rows = [(n, f"t{n} " * int(generator.integers(1, 40)), "s") for n in range(700)]
    rows += [(2000 + n, "copy of one text " * 9, "s") for n in range(400)] + [(3000 + n, "few copies " * 4, "s") for n in range(5)]
    rows += [(4000, None, "s"), (4001, "", "s"), (4002, "long " * 900, "s"), (None, "x", "s")]
    shards, kinds = 5, ("size", "words", "rows")

    def hashed(data, seed=42):
        value = xxhash.xxh64_intdigest(data, seed % (1 << 64))
        return value - (1 << 64) * (value >> 63)

    texts, groups, total = {}, defaultdict(lambda: [0, 0, 0]), [0, 0, 0]
    for n, text, _ in rows:
        text = text or ""
        loads = (len(text.encode()) + sharding.ROW_BYTES, len(text.split()), 1)
        texts[n] = text, loads
        for k, load in enumerate(loads):
            groups[text][k] += load
            total[k] += load
    capacity = [t / shards for t in total]
    units, of_row = defaultdict(lambda: [0, 0, 0]), {}
    for n, (text, loads) in texts.items():
        key = hashed(text.encode())
        part = max(g / c for g, c in zip(groups[text], capacity))
        if part > 1 / sharding.UNITS_PER_SHARD:
            pieces = math.ceil(part / sharding.WHOLE_GROUP * 2) if part > sharding.WHOLE_GROUP else 1
            row_key = hashed(b"row", hashed(("" if n is None else str(n)).encode()))
            of_row[n] = (True, key, row_key % pieces)
        else:
            of_row[n] = (False, hashed(key.to_bytes(8, "little", signed=True)) % (sharding.UNITS_PER_SHARD * shards), 0)
        for k, load in enumerate(loads):
            units[of_row[n]][k] += load
    found = sharding.shard(docs_of(spark, rows), shards).collect()
    assert len(found) == len(rows) and {r.piece for r in found} > {0}
    place = defaultdict(set)
    for r in found:
        assert (r.unit, r.piece) == of_row[r.doc_id][1:]
        place[of_row[r.doc_id]].add(r.shard)
    assert all(len(p) == 1 for p in place.values())
    # From the largest unit down, each lies where the dot product with the residual capacity is highest.
    weight = sharding.IMPORTANCE
    parts = {u: [load / t for load, t in zip(units[u], total)] for u in sorted(units)}
    residual = [[1 / shards] * len(kinds) for _ in range(shards)]
    for unit in sorted(parts, key=lambda u: -round(sum(w * p for w, p in zip(weight, parts[u])), 12)):
        gains = [sum(w * p * r for w, p, r in zip(weight, parts[unit], own)) for own in residual]
        (chosen,) = place[unit]
        assert gains[chosen] >= max(gains) - 1e-9
        residual[chosen] = [r - p for r, p in zip(residual[chosen], parts[unit])]
