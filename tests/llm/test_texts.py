"""Decontamination, main text, archives and chat formatting."""

from __future__ import annotations

import contextlib
import hashlib
import io
import json
import math
import random
import time

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from tagloom.llm import chat, decontaminate, html_text, warc

DOCS = "doc_id bigint, text string, items string, block int"


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], DOCS)


def expected_hits(rows, items, size):
    def cut(text):
        out, word = [], ""
        for c in (text or "") + " ":
            c = chr(ord(c) + 32) if "A" <= c <= "Z" else c
            if c.isascii() and not (c.isdigit() or c.isalpha()):
                if word:
                    out.append(word)
                word = ""
            else:
                word += c
        return out

    found = {}
    for n, text in rows:
        words, hit, names = cut(text), set(), set()
        for item, line in items:
            own = cut(line)
            k = min(size, len(own))
            windows = {tuple(own[i : i + k]) for i in range(len(own) - k + 1)} if own else set()
            for i in range(len(words) - k + 1 if windows else 0):
                if tuple(words[i : i + k]) in windows:
                    hit |= set(range(i, i + k))
                    if item is not None:
                        names.add(str(item))
        found[n] = (len(words), len(hit), sorted(names))
    return found


@pytest.mark.parametrize("block_bytes", [4 << 20, 40])
def test_hits_as_by_brute_force(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block_bytes)
    draw = random.Random(4)
    items = [(n, " ".join(draw.choice("abcé") for _ in range(draw.randrange(3, 9)))) for n in range(12)]
    items += [(50, None), (51, "--"), (None, "q q q q"), (52, items[0][1]), (3, "z1 Z2, z3")]
    rows = [(n, " ".join(draw.choice("abcé.") for _ in range(40))) for n in range(60)]
    rows += [(100, None), (101, ""), (102, "Q-q;Q q"), (103, "z1z2 z3"), (104, "Z1.Z2.z3"), (105, "a " * 30_000)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contamination(docs_of(spark, rows), benchmark, size=4).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in found} == expected_hits(rows, items, 4)


def test_large_benchmark_in_one_scan(spark, monkeypatch, tmp_path):
    """Many blocks, a passage that most documents share, long texts: one reading of the documents."""
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(decontaminate, "STRETCH_BYTES", 2_000)
    draw = random.Random(11)
    vocabulary = [f"v{n}" for n in range(3000)]
    items = [(n, " ".join(draw.choices(vocabulary, k=40))) for n in range(400)]
    common = items[5][1]
    rows = [(n, " ".join(draw.choices(vocabulary, k=30)) + ". " + (common if n % 3 else items[n][1][:80])) for n in range(300)]
    rows.append((999, " ".join(draw.choices(vocabulary, k=60_000)) + " " + items[7][1]))
    docs_of(spark, rows).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    windows = decontaminate.benchmark_windows(spark.createDataFrame(items, "item_id long, text string"))
    assert windows.agg(F.max("block")).first()[0] > 10
    reads = []
    original = decontaminate._stretches
    monkeypatch.setattr(decontaminate, "_stretches", lambda *a: reads.append(a) or original(*a))
    found = decontaminate.contamination(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert len(reads) == 1 and str(tmp_path) not in plan_text(found)
    assert {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in found.collect()} == expected_hits(rows, items, 10)
    (long,) = found.where("doc_id = 999").collect()
    assert rows[-1][1][long.spans[-1].start : long.spans[-1].end] == items[7][1]


def plan_text(df):
    with contextlib.redirect_stdout(io.StringIO()) as printed:
        df.explain()
    return printed.getvalue()


def test_spans_lie_on_the_original(spark):
    benchmark = spark.createDataFrame([("i", "über alles, was")], "item_id string, text string")
    text = "Ähm: ÜBER... über  ALLES (was) - ende"
    (row,) = decontaminate.contamination(docs_of(spark, [(1, text)]), benchmark, size=3).collect()
    assert [text[s.start : s.end] for s in row.spans] == ["über  ALLES (was"]


def test_contaminated_documents_go(spark):
    benchmark = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    rows = [(1, "x one two three"), (2, "one two"), (3, None), (None, "ONE two; three"), (None, "fine"), (1, "other text"), (2, "one two")]
    docs = docs_of(spark, rows)
    kept = decontaminate.drop_contaminated(docs, benchmark, size=3)
    assert kept.columns == docs.columns
    assert sorted(map(repr, ((r.doc_id, r.text) for r in kept.collect()))) == sorted(map(repr, [(2, "one two"), (2, "one two"), (3, None), (None, "fine"), (1, "other text")]))
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(docs, none).where("n_hit > 0").count() == 0
    assert decontaminate.contamination(spark.createDataFrame([], DOCS), benchmark).count() == 0


PAGES = {
    "<p>only &lt;one&gt; para</p>": "only <one> para",
    "": "",
    "<nav>a</nav><footer>b</footer>": "",
    "<script>var t='</p>';</script><article><h1>T</h1><p>x\n\t y</p><p>z</article><aside>s</aside>": "T x y z",
    "<article><p>long text goes here and on<div class='comments'><p>great</p></div><p>ok</article>": "long text goes here and on ok",
    "<main><b>bo</b>ld <i>it</main><div id=cookie-notice>We use</div>": "bold it",
    "<div class='post ad-free'><p>Kept text of the page.</p></div><div class='ad'>Buy</div>": "Kept text of the page.",
    "<body><div><p>A first paragraph with many words in it.</p><p>Short.</p><p>Another one with many words in it.</p></div><div><a href=1>x</a><a>y</a></div>": "A first paragraph with many words in it. Short. Another one with many words in it.",
    "<article><p>cut &amp; off <b>here": "cut & off here",
    "text &eacute; &#233; &bogus; <": "text é é &bogus; <",
}


def test_main_text(spark):
    cases = PAGES
    rows = [(n, "u", html) for n, html in enumerate(cases)] + [(90, None, None), (91, "u", "<p>" + "word " * 60_000), (91, "u", "<p>" + "word " * 60_000)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    found = html_text.extract(pages, ["page_id", "url"]).collect()
    assert len(found) == len(rows)
    texts = {r.page_id: r.text for r in found}
    assert [texts[n] for n in range(len(cases))] == list(cases.values())
    assert texts[90] == "" and texts[91] == ("word " * 60_000).strip()
    assert all(r.n_chars == len(r.text) for r in found)
    assert html_text.extract(pages.limit(0), ["page_id"]).count() == 0


WORDS = " ".join(["many different words"] * 12)


@pytest.mark.parametrize(
    "html, text",
    [
        (f"<article><p>Teaser</p></article><div><p>{WORDS}</p><p>short</p><p>{WORDS}</p></div>", f"Teaser {WORDS} short {WORDS}"),
        (f"<article><h1>T</h1><p>{WORDS}</p><div><a href=1>Share this</a> <a href=2>Print</a></div><p>end</p></article>", f"T {WORDS} end"),
        (f"<article><p>{WORDS}</p><ul><li><a href=1>Other page</a></li><li><a href=2>One more</a></li></ul></article>", f"{WORDS} Other page One more"),
        (f"<article><p><a href=1>Teaser of links</a></article><div><p>{WORDS}</p><p>short</p><p>{WORDS}</p></div>", f"{WORDS} short {WORDS}"),
        (f"<article><p>{WORDS}</p></article><article><h2>Head</h2><p>Brief.</p></article>", f"{WORDS} Head Brief."),
        (f"<article><header><h1>Title</h1></header><p>{WORDS}</p><table><tr><td><a href=1>a</a><td><a href=2>b</a></table><footer>f</footer></article><header>Site</header>", f"Title {WORDS} a b"),
        (f"<article><p>{WORDS}</p><section><h2>References</h2><ol><li><a href=1>One</a><li><a href=2>Two</a></ol></section></article>", f"{WORDS} References One Two"),
        (f"<article><p>{WORDS}</p><p>See <a href=1>this</a>.</p><h2><a href=2>Head</a></h2><p>{WORDS}</p></article>", f"{WORDS} See this. Head {WORDS}"),
        ("<ul><li><a href=1>one</a></li><li><a href=2>one</a></li></ul>", "one one"),
    ],
)
def test_density_chooses_the_regions(html, text):
    assert html_text.main_text(html) == text


@pytest.mark.parametrize(
    "html, text",
    [
        (f"<form id=aspnet><nav>menu</nav><div><p>{WORDS}</p><p>end</p></div><select><option>x</select></form>", f"{WORDS} end"),
        (f"<form><article><p>{WORDS}</article><aside>s</aside></form>", WORDS),
        (f"<div aria-hidden=true><article><p>{WORDS}</article></div><div role=dialog>Accept</div>", WORDS),
        (f"<div hidden><p>{WORDS}</p><p>end</p></div>", f"{WORDS} end"),
        (f"<noscript><article><p>{WORDS}</article></noscript><p>Turn on scripts", WORDS),
        (f"<article><p>{WORDS}<form>Your comment<textarea>x</textarea></form></article>", WORDS),
        (f"<article><p>{WORDS}</article><div hidden><article><p>{WORDS} {WORDS}</article></div>", WORDS),
        (f"<div><p>{WORDS}</p><p>b</p></div><form><p>Sign up now</form>", f"{WORDS} b"),
        (f"<article><p>{WORDS}</article><div class=comments><article><p>{WORDS} {WORDS}</article></div>", WORDS),
        (f"<article><p>{WORDS}</article><div class=related-posts><article><p>{WORDS}</article></div>", WORDS),
        ("cut &lt; off <a hr", "cut < off <a hr"),
        ("<p>one <!-- two <!-- three", "one two <!-- three"),
    ],
)
def test_coverings_hide_no_whole_page(html, text):
    assert html_text.main_text(html) == text


@pytest.mark.parametrize(
    "html",
    [
        "<div>" * 50_000 + "x" + "</span>" * 50_000, "<i>" * 100_000 + "<div>x", "<p>a<i>" * 50_000, "<p>" + "<i>" * 50_000 + "<div>" * 50_000,
        "<div>" * 100_000 + "x", "<ul><li><a href=1>x" * 30_000, "<!--" * 50_000, "</" * 50_000, "<?" * 50_000, "<a " * 50_000,
    ],
)
def test_time_is_in_proportion_to_the_page(html):
    def seconds(page):
        begin = time.process_time()
        html_text.main_text(page)
        return time.process_time() - begin

    tenth = min(seconds(html[: len(html) // 10]) for _ in range(2))
    # Quadratic time would be a hundred times as long.
    assert seconds(html) < 35 * tenth + 1


def test_ratio_smoothing_and_clusters_by_definition():
    """Against the definitions, one line and one split at a time."""
    draw = random.Random(6)
    for _ in range(20):
        values = [draw.choice([0.0, draw.random() * 3, 20 + draw.random() * 60]) for _ in range(draw.randrange(1, 30))]
        found = html_text.smoothed(np.array(values))
        for n in range(len(values)):
            near = [(m, math.exp(-((m - n) ** 2) / 2)) for m in range(max(0, n - 3), min(len(values), n + 4))]
            assert math.isclose(found[n], sum(values[m] * w for m, w in near) / sum(w for _, w in near), abs_tol=1e-9)
        threshold = html_text.split_point(found)
        low, high = [v for v in found if v <= threshold], [v for v in found if v > threshold]
        if low and high:
            # No value lies nearer to the other cluster's mean.
            means = sum(low) / len(low), sum(high) / len(high)
            assert all(abs(v - means[0]) <= abs(v - means[1]) + 1e-9 for v in low)
            assert all(abs(v - means[1]) <= abs(v - means[0]) + 1e-9 for v in high)
    parser = html_text._Lines()
    parser.feed("<div><p>one <b>two</b> three</p><p><a href=1>x</a> y<br>z</p></div>")
    parser.close()
    assert [("".join(line.parts), line.tags, line.links, line.linked) for line in parser.lines if line.parts] == [("one two three", 4, 0, 0), ("x y z", 5, 1, 1)]


LISTS = "<ul><li>one<li>two<li>three<li>four<li>five</ul><h2>Head</h2><table><tr><td>a</td><td>b</td></tr></table><blockquote>q</blockquote><pre>c</pre><dl><dt>t<dd>d</dl><figure><figcaption>f</figcaption></figure><h3>g</h3>"
LISTED = "one two three four five Head a b q c t d f g"


@pytest.mark.parametrize(
    "html, text",
    [
        (f"<div><h1>T</h1><p>{WORDS}</p>{LISTS}<p>{WORDS}</p></div>", f"T {WORDS} {LISTED} {WORDS}"),
        (f"<body><p>{WORDS}</p>{LISTS}<section>s</section></body>", f"{WORDS} {LISTED} s"),
        (f"<div><div><p>{WORDS}</p></div><div><h2>a</h2></div><div>b</div><div>c</div><div><p>{WORDS}</p></div></div>", f"{WORDS} a b c {WORDS}"),
        (f"<div><p>{WORDS}</p></div><div>a</div><div>b</div><div>c</div><div>d</div><div><p>{WORDS}</p></div>", f"{WORDS} a b c d {WORDS}"),
        (f"<table><tr><td></td><td><p>{WORDS}</p>{LISTS}</td></tr></table>", f"{WORDS} {LISTED}"),
    ],
)
def test_regions_without_articles_are_whole(html, text):
    assert html_text.main_text(html) == text


@pytest.mark.parametrize(
    "html, text",
    [
        ("<div class='post ad-free'><p>Kept text of the page.</p></div><div class='ad'>Buy</div>", "Kept text of the page."),
        *((f"<div {name}><p>{WORDS}</p><div class=ad>Buy</div></div>", WORDS) for name in ("class='content has-sidebar'", "class=no-sidebar", "class=page-header-large", "class=comments-open", "id=main-navigation-page", "class=header")),
        (f"<article class='post sidebar'><p>{WORDS}</p></article>", WORDS),
        (f"<div id=header><main><p>{WORDS}</p></main><div class=comments>{WORDS} {WORDS}</div></div>", WORDS),
        (f"<div><p>{WORDS}</p></div><div class='comments'>{WORDS} {WORDS}</div>", WORDS),
        (f"<nav><article>a</article></nav><div><p>{WORDS}</p></div><div class='x Social_Links'>b</div>", WORDS),
    ],
)
def test_names_skip_no_main_text(html, text):
    assert html_text.main_text(html) == text


def page_rows():
    draw = random.Random(9)
    big = ["<p>" + " ".join(draw.choice(("alpha", "beta", "gamma")) for _ in range(400)) for _ in range(5)]
    rows = [(n, f"http://x/{n}", big[n % 5]) for n in range(60)]
    return rows + [(100, None, None), (101, "http://x/\r\ny", ""), (102, "u", "short"), (103, "u", "short"), (104, "u", "é" * 500), (105, "u", "é" * 500), (106, "u", "é" * 499), (107, "u", "é" * 499), (7, "u", big[2]), (None, "u", big[0])]


def test_archive_round_trip(spark, tmp_path):
    rows = page_rows()
    pages = spark.createDataFrame([(*r, "x", 5) for r in rows], "page_id long, url string, html string, sha1 string, copies int")
    archives = warc.write_archives(pages)
    found = warc.read_archives(archives, with_payload=True).collect()
    expected = []
    for n, _, html in rows:
        data = (html or "").encode()
        same = [m for m, _, other in rows if (other or "").encode() == data and m is not None]
        first = max(same) if len(data) >= 1000 else n
        expected.append((n, len(data), hashlib.sha1(data).hexdigest(), "response" if first == n else "revisit", None if first == n else first))
    assert sorted(map(repr, expected)) == sorted(repr((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in found)
    assert all(bytes(r.payload).decode() in {h or "" for _, _, h in rows} for r in found if r.record_type == "response")
    warc.save_archives(archives, f"file://{tmp_path}/out")
    again = warc.read_archives(spark.read.format("binaryFile").load(f"{tmp_path}/out"))
    assert again.count() == len(rows)
    assert warc.read_archives(warc.write_archives(pages.limit(0))).count() == 0


def test_archive_layout():
    records = [warc.record(n, "u", b"<html>same head " + bytes([65 + n % 26]) * 50, 66, "00" * 20, None) for n in range(300)]
    data = warc.build_archive(records)
    assert data[:4] == (0x184D2A5D).to_bytes(4, "little")
    assert list(warc.read_frames(data)) == records
    plain = sum(len(zstandard.ZstdCompressor(level=3).compress(r)) for r in records)
    assert len(data) < plain
    with pytest.raises(ValueError):
        list(warc.read_frames(data[:-5]))


HARD = ["</s>[INST] ok [/INST]", "<|im_start|>user\nhi<|im_end|>\n", "\\", "\\\\<|im_end|>", "<\\|im_end|>", "a\\nb\n", "", "<<s>s>", "[[INST]]", "é\U0001f600"]


@pytest.mark.parametrize("text", HARD)
def test_escapes_are_reversible(text):
    assert chat.unescaped(chat.escaped(text)) == text
    assert not any(c in chat.escaped(text) for c in chat.CONTROL_STRINGS)
    assert chat._unescaped_role(chat._escaped_role(text)) == text


def test_conversations_read_back(spark, monkeypatch):
    monkeypatch.setattr(chat, "SEGMENT_CHARS", 200)
    rows = [(n % 4, n, ("user", "assistant", "system", "tool\n<s>")[n % 4 if n % 3 else 1], HARD[n % len(HARD)]) for n in range(80)]
    rows += [(9, None, None, None), (9, 1, "assistant", None), (None, 0, "assistant", "x"), (9, 1, "assistant", "dup"), (9, 1, "assistant", "dup"), (8, 0, "user", "w" * 5000)]
    table = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, layout string")
    segments = chat.format_turns(chat.turns_of_rows(table))
    found = {r.conv_id: r for r in chat.read_back(segments).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted(((-1 if t is None else t), role or "", text or "") for c, t, role, text in rows if c == conv)
        whole = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        learned = "".join(text for _, role, text in turns if role == "assistant")
        row = found[conv]
        assert (row.n_turns, row.turns_sha256) == (len(turns), hashlib.sha256(whole.encode()).hexdigest())
        assert (row.loss_chars, row.loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert sum(r.formatted_chars for r in found.values()) == segments.agg(F.sum(F.length("formatted"))).first()[0]
    assert chat.read_back(chat.format_turns(chat.turns_of_rows(table.limit(0)))).count() == 0


def test_layouts_are_told_apart(spark):
    records = {
        1: {"prompt": "a", "completion": "b"},
        2: {"instruction": "a", "input": "b", "output": "c", "id": 4},
        3: {"instruction": "a", "output": "c"},
        4: {"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]},
        5: {"system": "s", "conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": None}]},
        6: {"question": "a", "answer": {"x": 1}},
        7: {"other": 1},
        8: [1, 2],
        9: {"messages": []},
        12: {"messages": [{"role": "user", "content": "a"}], "system": "s", "prompt": "p"},
        13: {"system": "s", "prompt": "a", "completion": "b", "input": 3},
        14: {"messages": [{"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "text", "text": "b"}]}]},
        15: {"messages": [{"role": "user", "content": [{"type": "image", "url": "u"}]}]},
        16: {"prompt": "a", "response": "b", "completion": "c"},
    }
    table = spark.createDataFrame([(k, json.dumps(v)) for k, v in records.items()] + [(10, "{"), (11, None)], "conv_id long, record string")
    found = {}
    for r in chat.turns_of_records(table).orderBy("conv_id", "turn").collect():
        found.setdefault(r.conv_id, []).append((r.role, r.text) if r.layout else None)
    assert found == {
        1: [("user", "a"), ("assistant", "b")],
        2: [("user", "a"), ("user", "b"), ("assistant", "c")],
        3: [("user", "a"), ("assistant", "c")],
        4: [("user", "a"), ("assistant", "b")],
        5: [("system", "s"), ("user", "a"), ("assistant", "")],
        6: [None], 7: [None], 8: [None], 9: [None], 10: [None], 11: [None],
        12: [("system", "s"), ("user", "a")], 13: [("system", "s"), ("user", "a"), ("assistant", "b")],
        14: [("user", "ab")], 15: [("user", '[{"type": "image", "url": "u"}]')], 16: [("user", "a"), ("assistant", "c")],
    }
    with pytest.raises(ValueError):
        chat.turns_of_rows(spark.createDataFrame([(1,)], "a int"))


def test_rows_with_columns_of_other_layouts(spark):
    """Columns named like fields of other layouts do not stand in the way; the fingerprint tells them apart."""
    plain = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b")], "conv_id long, turn int, role string, text string")
    wide = plain.selectExpr("*", "'x' AS system", "'y' AS prompt", "'z' AS completion", "array('i') AS input", "1 AS unknown")
    one, two = chat.turns_of_rows(plain), chat.turns_of_rows(wide)
    assert one.drop("fingerprint").collect() == two.drop("fingerprint").collect()
    assert one.select("fingerprint").first() != two.select("fingerprint").first()
    assert one.select("fingerprint").first() == chat.turns_of_rows(plain.selectExpr("*", "1 AS unknown")).select("fingerprint").first()
