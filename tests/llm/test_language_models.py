"""Quality classifier and language identification."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from tagloom.llm import langid, quality

SCHEMA = "doc_id bigint, text string, lang string, p double, shard int"


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, 0.5, 3) for r in rows], SCHEMA)


class BruteForce:
    """Interpolated modified Kneser-Ney straight from its definition."""

    def __init__(self, texts, order):
        self.order = order
        top = Counter(("\x02" * (order - 1) + t)[n : n + order] for t in texts for n in range(len(t)))
        self.counts = {order: top}
        types = {g[order - k :] for g in top for k in range(1, order + 1)}
        for k in range(order - 1, 0, -1):
            self.counts[k] = Counter(g[1:] for g in types if len(g) == k + 1)
        self.discounts = {}
        for k, table in self.counts.items():
            t = Counter(table.values())
            self.discounts[k] = quality._discounts(t[1], t[2], t[3], t[4])
        self.unseen = 1 / (len(self.counts[1]) + 1)

    def p(self, gram):
        if not gram:
            return self.unseen
        k, table = len(gram), self.counts[len(gram)]
        after = {g: c for g, c in table.items() if g[:-1] == gram[:-1]}
        lower = self.p(gram[1:])
        if not after:
            return lower
        total, d = sum(after.values()), self.discounts[k]
        saved = sum(d[min(c, 3) - 1] for c in after.values()) / total
        own = table.get(gram, 0)
        return (own - d[min(own, 3) - 1] if own else 0) / total + saved * lower

    def bits(self, text):
        padded = "\x02" * (self.order - 1) + text
        return -sum(math.log2(self.p(padded[n : n + self.order])) for n in range(len(text)))


def test_model_as_by_definition(spark):
    draw = random.Random(5)
    texts = ["".join(draw.choice("aab cdé") for _ in range(draw.randrange(1, 60))) for _ in range(30)]
    exact = BruteForce(texts, 4)
    model = quality.train(spark.createDataFrame([(t,) for t in texts] + [(None,), ("",)], "text string"), 4)
    probe = [texts[0], "abcd", "zzz", "aéa\U0001f600 q", "\x02a", "b"]
    found = quality.perplexity(docs_of(spark, [(n, t, "en") for n, t in enumerate(probe)]), model, 4).collect()
    for row in found:
        text = probe[row.doc_id].replace("\x02", " ")
        assert row.chars == len(text)
        assert row.bits == pytest.approx(exact.bits(text), rel=1e-9)
    assert sum(exact.p("\x02\x02\x02" + c) for c in "abcd é") <= 1.0


def test_large_alphabets_agree():
    texts = ["abcabc", "", "xé\U0001f600"]
    grams, places = quality.grams_of(texts, 3)
    other, slow = quality._one_by_one(texts, 3)
    assert [grams[p] for p in places] == [other[p] for p in slow]


def prose(draw, words=60):
    return " ".join("".join(draw.choice(["ba", "ne", "to", "li"]) for _ in range(3)) for _ in range(words))


def test_classifier_and_odd_rows(spark):
    draw = random.Random(2)
    rows = [(n, prose(draw), "en" if n % 2 else "xx") for n in range(400)]
    odd = [(500, None, "en"), (501, "", "en"), (502, prose(draw), None), (503, "#$%&" * 50, "en"), (504, "ba", "en"), (505, prose(draw, 20_000), "en"), (None, prose(draw), "en")]
    docs = docs_of(spark, rows + odd + [rows[0]])
    trusted = spark.createDataFrame([(n,) for n in range(300)] + [(None,), (7,)], "doc_id bigint")
    found = quality.classify(docs, trusted).collect()
    assert len(found) == len(rows) + len(odd) + 1
    verdict = {r.doc_id: r.accepted for r in found}
    assert [verdict[n] for n in (500, 501, 502, 503, 504, 505, None)] == [False, False, True, False, True, True, True]
    assert sum(verdict[n] for n in range(400)) >= 398
    labels = trusted.selectExpr("doc_id", "1 AS quality", "0 AS toxic")
    kept = quality.keep_accepted(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.accepted for r in found)


def test_repetition_is_rejected(spark):
    draw = random.Random(3)
    rows = [(n, prose(draw, 120), "en") for n in range(300)]
    words = [prose(draw, 1) for _ in range(12)]
    odd = [" ".join(w for w in words for _ in range(12)), (" ".join(words[:4]) + " ") * 20, prose(draw, 40) + (" " + words[0]) * 80]
    docs = docs_of(spark, rows + [(500 + n, text, "en") for n, text in enumerate(odd)] + [(600, words[0], "en")])
    trusted = spark.createDataFrame([(n,) for n in range(250)], "doc_id bigint")
    found = {r.doc_id: r for r in quality.classify(docs, trusted).collect()}
    assert all(found[n].perplexity <= found[n].threshold and not found[n].accepted for n in (500, 501, 502))
    assert all(found[n].accepted for n in (*range(300), 600))


def test_training_reads_every_trusted_text(spark, monkeypatch):
    """All that are not held out, above a million too; repeated rows count, null ids do not."""
    n = 1_400_000
    docs = spark.range(n).selectExpr("id AS doc_id", "CAST(id AS STRING) AS text", "'en' AS lang")
    docs = docs.unionByName(docs.where("doc_id < 9").selectExpr("doc_id", "'again' AS text", "lang"))
    docs = docs.unionByName(docs.where("doc_id < 9").selectExpr("CAST(NULL AS LONG) AS doc_id", "'null' AS text", "lang"))
    trusted = spark.range(0, n + 1000).where("id % 50 != 7").selectExpr("id AS doc_id")

    class Trained(Exception):
        pass

    def trained(texts, order):
        raise Trained(texts.selectExpr("count(*)", "sum(xxhash64(text) % 1000003)").first())

    monkeypatch.setattr(quality, "train", trained)
    with pytest.raises(Trained) as met:
        quality.classify(docs, trusted)
    expected = docs.where(f"doc_id % 50 != 7 AND pmod(xxhash64(doc_id), {quality.HOLD_OUT}) != 0")
    assert met.value.args[0] == expected.selectExpr("count(*)", "sum(xxhash64(text) % 1000003)").first()
    assert met.value.args[0][0] > 1_000_000


@pytest.mark.parametrize("words", [1, 1_000_000])
def test_texts_of_trusted_ids_by_shuffle(spark, monkeypatch, words):
    """A full bitmap only lets more rows through to the join by id."""
    monkeypatch.setattr(quality, "BITMAP_WORDS", words)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [(n * 7919 - 300_000, f"text {n}", "en") for n in range(2000)] + [(None, "null", "en"), (7919 - 300_000, "twice", "xx"), (5, None, "en")]
        ids = {n for n, _, _ in rows if n is not None and n % 3} | {1 << 62, -(1 << 63)}
        found = quality.texts_of(docs_of(spark, rows), spark.createDataFrame([(n,) for n in ids], "id long"))
        assert sorted(map(str, (r.text for r in found.collect()))) == sorted(str(t) for n, t, _ in rows if n in ids)
        assert quality.texts_of(docs_of(spark, rows), spark.createDataFrame([], "id long")).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("reach", [5, 256])
def test_repeats_as_by_definition(reach):
    draw = random.Random(1)
    texts = ["".join(draw.choice("ab") for _ in range(n)) for n in (0, 3, 50, 1, 200)] + ["ab" * 20, "ab" * 20]
    grams, places = quality.grams_of(texts, 2)
    expected = []
    for text in texts:
        ends, last = 0, {}
        for at in range(2, len(text)):
            run = ("\x02" + text)[at - 2 : at + 2]
            ends += at - last.get(run, -1000) <= reach
            last[run] = at
        expected.append(ends)
    assert quality.repeats_of(places, [len(t) for t in texts], len(grams), 2, reach).tolist() == expected


def test_verdicts_as_by_definition(spark):
    """Held-out documents, quantiles by language, the pooled ones, thresholds and verdicts in plain Python."""
    draw = random.Random(11)
    rows = [(n, prose(draw, draw.randrange(1, 50)), "en" if n % 3 else "de") for n in range(900)]
    rows += [(1000 + n, prose(draw, 20), None if n % 2 else "fr") for n in range(60)]
    rows += [(2000 + n, "".join(draw.choice("bantoeli #$%") for _ in range(90)), draw.choice(["en", "de", "fr"])) for n in range(30)]
    rows += [(3000 + n, prose(draw, 2 + n) + (" " + prose(draw, 1)) * n, "en") for n in range(30)] + [(4000, "", "en")]
    ids = [n for n, _, _ in rows if n < 1060]
    found = {r.doc_id: r for r in quality.classify(docs_of(spark, rows), spark.createDataFrame([(n,) for n in ids], "doc_id bigint")).collect()}

    def held_out(n):
        hashed = xxhash.xxh64_intdigest(n.to_bytes(8, "little"), 42)
        return (hashed - (1 << 64) * (hashed >> 63)) % quality.HOLD_OUT == 0

    texts = {n: text for n, text, _ in rows}
    model = quality.train(spark.createDataFrame([(texts[n],) for n in ids if not held_out(n)], "text string"), quality.ORDER)
    scored = quality.perplexity(docs_of(spark, rows), model).collect()
    kept = [r for r in scored if r.chars and r.doc_id < 1060 and held_out(r.doc_id)]
    held = Counter(r.lang for r in kept)
    assert held["en"] > held["de"] >= quality.LEAST_CALIBRATION > max(held["fr"], held[None])

    def score(amount, chars, mean):
        return (amount + mean * quality.PRIOR_CHARS) / (chars + quality.PRIOR_CHARS)

    def level(rows, of):
        mean = sum(getattr(r, of) for r in rows) / sum(r.chars for r in rows)
        steps = sorted(math.ceil(score(getattr(r, of), r.chars, mean) / quality.STEP) for r in rows)
        return mean, steps[math.ceil(len(steps) * quality.QUANTILE) - 1] * quality.STEP

    bad = 0
    for r in scored:
        of_lang = [k for k in kept if k.lang == r.lang]
        calibration = of_lang if len(of_lang) >= quality.LEAST_CALIBRATION else kept
        (mean, bits), (mean_repeats, repeats) = level(calibration, "bits"), level(calibration, "repeats")
        most = repeats + (1 - repeats) * quality.LEEWAY
        row = found[r.doc_id]
        assert row.threshold == pytest.approx(2**bits * quality.MARGIN) and row.repeated_threshold == pytest.approx(most)
        likely = bool(r.chars) and score(r.bits, r.chars, mean) <= bits + math.log2(quality.MARGIN)
        varied = bool(r.chars) and score(r.repeats, r.chars, mean_repeats) <= most
        assert (row.accepted_by_perplexity, row.accepted_by_repeats, row.accepted) == (likely, varied, likely and varied)
        bad += not row.accepted
    assert 30 < bad < 100


def test_without_trusted_or_documents(spark):
    docs = docs_of(spark, [(1, "abc", "en"), (2, None, None)])
    none = spark.createDataFrame([], "doc_id bigint")
    assert {r.doc_id: r.accepted for r in quality.classify(docs, none).collect()} == {1: True, 2: False}
    assert quality.classify(spark.createDataFrame([], SCHEMA), none).count() == 0


def test_trusted_labels(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 1), (3, 0, 0), (4, 1, None), (5, 1, 0), (5, 0, 0), (6, None, 0)], "doc_id long, quality int, toxic int")
    assert {r.doc_id for r in quality.trusted_ids(labels).collect()} == {1, 4}


def test_language_of_odd_rows(spark):
    learn = spark.createDataFrame([("aa", "lala lalo lula " * 20), ("bb", "krik krok kruk " * 20), ("bb", None)], "lang string, text string")
    profiles = langid.prototypes(learn)
    rows = [(1, "lalo lula", None), (2, "KROK, krik!", "aa"), (3, None, "aa"), (4, "12 !? _", "aa"), (5, "", "aa"), (6, "krok " * 40_000, "x"), (6, "krok " * 40_000, "x"), (None, "lala", "y")]
    found = langid.identify(docs_of(spark, rows), profiles).collect()
    assert sorted((r.doc_id or -1, r.lang_pred) for r in found) == [(-1, "aa"), (1, "aa"), (2, "bb"), (3, "und"), (4, "und"), (5, "und"), (6, "bb"), (6, "bb")]
    assert all(0 <= r.score <= 1 and (r.score > 0) == (r.lang_pred != "und") for r in found)
    assert langid.identify(spark.createDataFrame([], SCHEMA), profiles).count() == 0
    untrained = langid.prototypes(spark.createDataFrame([], "lang string, text string"))
    assert {r.lang_pred for r in langid.identify(docs_of(spark, rows), untrained).collect()} == {"und"}


def test_many_languages_in_groups(spark, monkeypatch):
    learn = spark.createDataFrame([(chr(97 + n) * 2, (chr(97 + n) * 5 + " ") * 9) for n in range(9)], "lang string, text string")
    profiles = langid.prototypes(learn)
    monkeypatch.setattr(langid, "GROUP", 4)
    docs = docs_of(spark, [(n, chr(97 + n) * 5, None) for n in range(9)])
    assert {r.doc_id: r.lang_pred for r in langid.identify(docs, profiles).collect()} == {n: chr(97 + n) * 2 for n in range(9)}


def test_bundle_is_the_sum_of_bound_vectors():
    (bundle,) = langid.bundles(["Ab!"])
    a, b, s = (langid.letter_vector(ord(c)).astype(int) for c in "ab ")
    expected = np.roll(s, 2) * np.roll(a, 1) * b + np.roll(a, 2) * np.roll(b, 1) * s
    assert bundle.astype(int).tolist() == expected.tolist()


def test_language_as_by_brute_force(spark):
    """Bound letters, bundles, prototypes, cosines and the choice, n-gram by n-gram."""
    draw = random.Random(4)
    alphabets = {"aa": "aeioulrst", "bb": "aeioukmnp", "cc": "éèaiouxyz"}

    def sentence(lang, words):
        return " ".join("".join(draw.choice(alphabets[lang]) for _ in range(draw.randrange(1, 7))) for _ in range(words))

    learn = [(lang, sentence(lang, 30) + draw.choice([".", " 12!", ""])) for lang in alphabets for _ in range(10)] + [("cc", None)]
    probe = [sentence(lang, n) for lang in alphabets for n in (1, 2, 5, 40)] + ["Lalo-LULA, 7 x", "ÉÈ", "a", "?", ""]

    def bundle(text):
        words = re.findall(r"[^\W\d_]+", (text or "").lower())
        line = f" {' '.join(words)} " if words else ""
        total = np.zeros(langid.DIMENSIONS, dtype=np.int64)
        for at in range(len(line) - langid.ORDER + 1):
            gram = np.ones(langid.DIMENSIONS, dtype=np.int64)
            for place in range(langid.ORDER):
                gram *= np.roll(langid.letter_vector(ord(line[at + place])).astype(np.int64), langid.ORDER - 1 - place)
            total += gram
        return total

    profiles = defaultdict(lambda: np.zeros(langid.DIMENSIONS, dtype=np.int64))
    for lang, text in learn:
        profiles[lang] += bundle(text)
    stored = langid.prototypes(spark.createDataFrame(learn, "lang string, text string"))
    assert {r.lang: r.vector for r in stored.collect()} == {lang: v.tolist() for lang, v in profiles.items()}
    found = {r.doc_id: r for r in langid.identify(docs_of(spark, [(n, t, "aa") for n, t in enumerate(probe)]), stored).collect()}
    for n, text in enumerate(probe):
        own = bundle(text)
        if not own.any():
            assert (found[n].lang_pred, found[n].score) == ("und", 0.0)
            continue
        cosines = {lang: float(own @ v / (np.linalg.norm(own) * np.linalg.norm(v))) for lang, v in profiles.items()}
        best = max(cosines, key=cosines.get)
        assert found[n].score == pytest.approx(max(0.0, cosines[best]), abs=1e-5)
        assert cosines[found[n].lang_pred] == pytest.approx(cosines[best], abs=1e-5)
