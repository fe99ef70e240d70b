"""Operators on embeddings, conversations and pages, the SQL twins, and the pipeline."""

import hashlib
import io
import random
import re
import struct
import zipfile
from html import unescape

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from check_queries import check, connect
from eta_spark.llm import chat, html, search, warc
from eta_spark.llm.queries import ORACLE, QUERIES
from eta_spark.session import new_run_dir

from .test_documents import check_packing, plain_components


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_its_sql(spark, sf_dir, name):
    connection = connect(sf_dir)
    outcome, _ = check(spark, connection, sf_dir, name)
    connection.close()
    assert outcome.startswith("equal")


# 2 Search


def plain_top(vectors, k):
    rows = {i: np.floor(64 * np.array(v, dtype=np.float64)).astype(int) for i, v in vectors}
    best = {}
    for q in rows:
        if q % 20 == 0:
            scored = sorted((-int(sum(a * b for a, b in zip(rows[q], rows[c]))), c) for c in rows if c != q)
            best[q] = [(c, -s) for s, c in scored[:k]]
    return best


def found_top(df):
    best = {}
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        best.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return best


@pytest.mark.parametrize("shape", ["normal", "ties", "skewed"])
def test_search_equals_brute_force(spark, monkeypatch, shape):
    monkeypatch.setattr(search, "BLOCK", 100)
    monkeypatch.setattr(search, "QUERY_BLOCK", 7)
    draw = np.random.default_rng(4)
    data = draw.normal(size=(450, 8))
    if shape == "ties":
        data = np.round(data[:30])[draw.integers(0, 30, 450)]
    if shape == "skewed":
        data[:, 0] += 50 * (draw.random(450) < 0.1)
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(data)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert found_top(search.top_k(df)) == plain_top(rows, 20)


def test_search_stops_by_proof_on_skewed_impacts():
    draw = np.random.default_rng(4)
    rows = np.floor(draw.normal(size=(4000, 16)) * 4).astype(np.int64)
    rows[:40, 3] += 500
    index = search.Index(np.arange(4000), rows)
    reads = []
    index.order = type("Seen", (), {"__getitem__": lambda _, key, order=index.order: reads.append(key[1].stop - key[1].start) or order[key]})()
    query = np.ones(16, dtype=np.int64)
    ids, scores = index.top(query, -1, 10)
    want = sorted((-int(s), i) for i, s in enumerate(rows @ query))[:10]
    assert [(-s, i) for i, s in zip(ids, scores)] == want and sum(reads) < 4000 * 16 / 2


@pytest.mark.parametrize("largest", [40, 30_000, 2**31])
@pytest.mark.parametrize("n", [3, 90, 700])
def test_search_of_a_block_in_every_precision(n, largest):
    draw = np.random.default_rng(n)
    rows = draw.integers(-largest, largest, size=(n, 6))
    rows[: n // 3] = rows[n // 3]
    ids = draw.permutation(n) * 3
    kth = [sorted((-int(s), i) for i, s in zip(ids, rows @ q) if i != own)[:5] for q, own in zip(rows, ids, strict=True)]
    index = search.Index(ids, rows)
    for bars in (np.full(n, -np.inf), np.array([-k[-1][0] for k in kth], dtype=float)):
        found = index.best(rows, ids, 5, bars)
        assert [[(-int(s), i) for i, s in zip(*f, strict=True)] for f in found] == kth


def test_search_reads_part_of_the_given_postings(spark):
    given = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").where("vec_id is not null and embedding is not null")
    rows = np.floor(64 * np.array([r.embedding for r in given.collect()], dtype=float)).astype(np.int64)
    index = search.Index(np.arange(len(rows)), rows)
    reads = []
    index.order = type("Seen", (), {"__getitem__": lambda _, key, order=index.order: reads.append(key[1].stop - key[1].start) or order[key]})()
    for i in range(0, len(rows), 20):
        index.top(rows[i], i, 20)
    assert sum(reads) < 0.9 * rows.size * len(range(0, len(rows), 20))


def test_search_counts_repeated_rows_once(spark):
    rows = [(i % 7 if i < 3000 else i, [float(i % 5), 1.0]) for i in range(3100)]
    largest = {}
    for i, v in rows:
        largest[i] = max(v, largest.get(i, v))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert found_top(search.top_k(df)) == plain_top(largest.items(), 20)


def test_search_of_odd_rows(spark):
    schema = "vec_id long, embedding array<float>, score string, rank string, block string"
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (0, [1.0, 0.5]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (4, [inf, 0.0]), (None, [1.0, 1.0]), (5, [1.0]), (6, []), (7, [-1.0, 2.0])]
    df = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], schema)
    assert found_top(search.top_k(df)) == {0: [(5, 4096), (6, 0), (7, 0)]}
    assert search.top_k(df.limit(0)).count() == 0


# 5 Chat


def test_chat_collapses_snapshots(spark, monkeypatch):
    monkeypatch.setattr(chat, "RANGE", 3)
    talk = [("system", "s"), *((("user", "assistant")[i % 2], f"t{i}") for i in range(11))]
    logs = {1: talk[:3], 2: talk, 3: talk[:7], 4: talk, 5: [*talk[:3], ("user", "other")], 6: talk[1:], 7: [("user", None)], 8: [(None, "x <|user|>")]}
    rows = [(c, t, role, text, "z") for c, turns in logs.items() for t, (role, text) in enumerate(turns)]
    rows += [(2, 4, *talk[4], "z"), (None, 0, "user", "lost", "z"), (8, None, "user", "before", "z")]
    random.Random(2).shuffle(rows)
    found = chat.render(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, position string")).collect()
    texts, copies = {}, {}
    for r in sorted(found, key=lambda r: r.position):
        assert r.start == len(texts.get(r.conv_id, ""))
        texts[r.conv_id] = texts.get(r.conv_id, "") + r.rendered
        copies[r.conv_id] = r.copies
    assert copies == {2: 2, 5: 1, 6: 1, 7: 1, 8: 1}
    assert texts[2] == "".join(f"<|{role}|>\n{text}\n" for role, text in talk)
    assert texts[7] == "<|user|>\n\n" and texts[8] == "<|user|>\nbefore\n<||>\nx < |user|>\n"
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.render(empty).count() == 0


# 7 HTML


def test_html_articles(spark, sf_dir):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in QUERIES["op7_html_main_text"](spark, sf_dir).collect():
        article = re.search("<article>(.*)</article>", pages[r.page_id], re.S)[1]
        blocks = [" ".join(unescape(re.sub("<br>", " ", re.sub("</?b>", "", b))).split()) for b in re.split("</?(?:p|h1)>", article)]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


LONG = "A paragraph with quite a few words in it, so that it surely counts as text of the page. " * 2


def test_html_forms_go_unless_they_wrap_the_page():
    page = f"<body><form id=aspnetForm><div><h1>Title</h1><p>{LONG}<p>{LONG}</div>{{}}</form></body>"
    assert html.main_text(page.format("")) == "\n\n".join(["Title", LONG.strip(), LONG.strip()])
    assert html.main_text(f"<article><p>{LONG}<form><p>Your name, please<input></form><p>{LONG}</article>") == "\n\n".join([LONG.strip()] * 2)


@pytest.mark.parametrize("start", ["div class=user-comments", "section class=commentlist", "ol class='comment-list'", "div class='box readerComments'", "div id=comment-thread"])
def test_html_reader_comments_go_by_any_spelling(start):
    page = f"<article><p>{LONG}<{start}><p>{LONG} I disagree.</{start.split()[0]}><p>The end.</article>"
    assert html.main_text(page) == f"{LONG.strip()}\n\nThe end."


def test_html_blocks_of_links_go_without_article():
    links = "<div><a href=1>Home</a> <a href=2>News</a> <a href=3>About us</a></div>"
    page = f"<body><div><h2>Title</h2>{links}<p>{LONG}<p>{LONG}<p><a href=x>One link</a></div></body>"
    assert html.main_text(page) == "\n\n".join(["Title", LONG.strip(), LONG.strip(), "One link"])
    assert html.main_text(links) == "Home News About us"


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header>
<div class="cookie-notice">We use cookies to make this site better for you and for everybody else who reads it.</div>
<ul class=menu><li><a href=/>Home</a><li><a href=/b>More</a></ul>
<div id=wrap><div class=content><h2>Head &amp; line</h2><p>First   paragraph with quite a few words in it, so that it counts.
<p>Short.<p>Another paragraph, <a href=x>linked words</a> inside, and a good number of other words around them.
<ul><li>A point of the list that is text</ul><script>var x = "<p>no</p>";</script><form><p>Your name</p><input></form>
<div class="comments"><p>I do not agree with any of this, said a reader who wrote a long comment below the article.</p></div></div>
<aside>Related stories that are long enough to look like a paragraph of the article, which they are not.</aside></div>
<footer><p>Copyright of everything on this page belongs to somebody who wants to be named in a long line.</footer>"""


def test_html_without_article_element():
    assert html.main_text(PAGE) == (
        "Head & line\n\nFirst paragraph with quite a few words in it, so that it counts.\n\nShort.\n\n"
        "Another paragraph, linked words inside, and a good number of other words around them.\n\nA point of the list that is text"
    )


LONG_TEXT = "A long paragraph of the article with a good number of plain words that carry what it says, as articles do."


@pytest.mark.parametrize(
    "inner",
    [
        f"<section id='related-work'><h2 id='social-history'>Related work</h2><p>{LONG_TEXT}</p></section>",
        f"<div class='share-price'><h2 class=share>The share price</h2><p>{LONG_TEXT}</p></div>",
        f"<div class='notice'><p>{LONG_TEXT}</p></div>",
        f"<p class='notice'>Cookies<p>{LONG_TEXT}<p>{LONG_TEXT}",
        f"<ul><li class=reply>One<li>Two</ul><p>{LONG_TEXT}",
        f"<p>{LONG_TEXT} <span class=menu>and</span> more",
    ],
)
def test_html_names_inside_an_article_lose_no_text(inner):
    page = f"<body><article><h1>Title</h1><p>{LONG_TEXT}</p>{inner}</article></body>"
    words = re.sub("<[^>]*>", " ", page).split()
    assert html.main_text(page).split() == words


def test_html_parts_by_name_and_look():
    page = (
        f"<article><h1>Title</h1><p>{LONG_TEXT}</p><div class='share-buttons'><a href=a>Here</a> or <a href=b>there</a></div>"
        f"<div class=related><p><a href=x>Another story</a></p></div><div class='ad'>Buy this.</div><p>{LONG_TEXT}</p></article>"
    )
    assert html.main_text(page) == f"Title\n\n{LONG_TEXT}\n\n{LONG_TEXT}"


def test_html_omitted_end_tags():
    rest = f"<p>{LONG_TEXT}<p>{LONG_TEXT}"
    for first in ("<p hidden>gone", "<ul><li hidden>gone<li>kept</ul>", "<dl><dt hidden>gone<dd>kept</dl>", "<table><tr><td hidden>gone<td>kept<tr><td>too</table>"):
        text = html.main_text(f"<article><h1>Title</h1>{first}{rest}</article>")
        assert text.endswith(f"{LONG_TEXT}\n\n{LONG_TEXT}") and "gone" not in text and ("kept" in text) == ("kept" in first)


def test_html_title_lead_and_end_outside_of_the_body_element():
    body = "".join(f"<p>{LONG_TEXT}</p>" for _ in range(12))
    chrome = "<div id=top><ul><li><a href=/>Home</a><li><a href=/b>More</a></ul></div>"
    texts = [LONG_TEXT] * 12
    page = f"<body>{chrome}<div class=post><div class=intro><h1>Title</h1><p>A lead of a few words.</p></div><div class=body>{body}</div></div></body>"
    assert html.main_text(page).split("\n\n") == ["Title", "A lead of a few words.", *texts]
    page = f"<body>{chrome}<h1>Title</h1><p>By somebody</p><div class=body>{body}</div><div><a href=c>Links</a></div></body>"
    assert html.main_text(page).split("\n\n") == ["Title", "By somebody", *texts]
    page = f"<body>{chrome}<div class=post><h1>Title</h1><div class=body>{body}</div><div class=end><h2>End</h2><p>{LONG_TEXT}</p></div></div></body>"
    assert html.main_text(page).split("\n\n") == ["Title", *texts, "End", LONG_TEXT]


def test_html_all_text_in_links():
    page = "<body><div><a href=a>One</a></div><div><p><a href=b>Two words</a></p></div><ul><li><a href=c>Three</a></ul></body>"
    assert html.main_text(page) == "One\n\nTwo words\n\nThree"


def test_html_of_odd_rows(spark):
    rows = [(1, "u", None, "a"), (1, "u", "", "a"), (None, None, "<p>", "a"), (3, "u", "just text &lt; here", "a"), (4, "u", "<p>" + "word " * 50_000, "a"), (5, "u", "</div></p><b><", "a")]
    found = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert [r.text for r in found[:4]] == ["", "", "", "just text < here"] and found[4].n_chars == 249_999
    assert html.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# 8 WARC


def test_zip_reader_follows_zip64_and_comments():
    class Wide(zipfile.ZipFile):
        pass

    made = io.BytesIO()
    with zipfile.ZipFile(made, "w") as archive:
        archive.comment = b"PK\x05\x06 looks like an end"
        archive.writestr("a.txt", b"alpha")
        archive.writestr("packed.txt", b"x" * 1000, compress_type=zipfile.ZIP_DEFLATED)
        with archive.open(zipfile.ZipInfo("b.txt"), "w", force_zip64=True) as out:
            out.write(b"beta")
    data = made.getvalue()
    read = lambda offset, length: data[offset : offset + length]
    members = {m.name: m for m in warc.directory(read, len(data))}
    assert set(members) == {"a.txt", "b.txt"}
    for name, content in (("a.txt", b"alpha"), ("b.txt", b"beta")):
        start = warc.content_start(read, members[name])
        assert read(start, members[name].size) == content

    # The same with 64-bit places: sizes and offset in the extra field, locator and record before the end.
    local = struct.pack("<4sHHHHHIIIHH", b"PK\x03\x04", 45, 0, 0, 0, 0, 0, 3, 3, 1, 0) + b"c" + b"abc"
    extra = struct.pack("<HHQQQ", 1, 24, 3, 3, 0)
    entry = struct.pack("<4sHHHHHHIIIHHHHHII", b"PK\x01\x02", 45, 45, 0, 0, 0, 0, 0, 2**32 - 1, 2**32 - 1, 1, len(extra), 0, 0, 0, 0, 2**32 - 1) + b"c" + extra
    end64 = struct.pack("<4sQHHIIQQQQ", b"PK\x06\x06", 44, 45, 45, 0, 0, 1, 1, len(entry), len(local))
    locator = struct.pack("<4sIQI", b"PK\x06\x07", 0, len(local) + len(entry), 1)
    end = struct.pack("<4sHHHHIIH", b"PK\x05\x06", 0, 0, 2**16 - 1, 2**16 - 1, 2**32 - 1, 2**32 - 1, 0)
    data = local + entry + end64 + locator + end
    (member,) = warc.directory(read, len(data))
    assert member == ("c", 0, 3) and read(warc.content_start(read, member), 3) == b"abc"
    with pytest.raises(ValueError):
        warc.directory(lambda o, n: b"nothing"[o : o + n], 7)


def test_warc_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 500)
    page = "<p>é</p>" * 30
    rows = [(5, "http://a b/é\r\n", page), (2, None, page), (2, "u", page), (9, "u", "short"), (8, "u", "short"), (3, "u", None), (4, "u", ""), (None, "u", page), (7, "u", page + "x" * 200_000)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, record_type string")
    folder = warc.archive_folder(df)
    manifest = warc.write_archives(warc.decide(df), folder)
    found = warc.read_records(warc.read_index(manifest, folder), folder, with_payload=True).collect()
    assert len(found) == len(rows) and manifest.count() >= 1
    for r in found:
        if r.record_type == "response":
            assert hashlib.sha256(r.payload).hexdigest() == r.payload_digest and len(r.payload) == r.payload_bytes
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to or 0, r.payload_bytes) for r in found)
    size = len(page.encode())
    assert kinds == [(0, "revisit", 2, size), (2, "response", 0, size), (2, "response", 0, size), (3, "response", 0, 0), (4, "response", 0, 0), (5, "revisit", 2, size), (7, "response", 0, size + 200_000), (8, "response", 0, 5), (9, "response", 0, 5)]
    assert warc.round_trip(df.limit(0)).count() == 0


# Pipeline


def test_pipeline_stages(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    kept = {r.doc_id for r in QUERIES["op6_quality_rules"](spark, sf_dir).where("kept").collect()}
    after = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id IN (%s)" % ",".join(map(str, kept)))
    clean = corpus_pipeline.toxicity_stage(spark, after, sf_dir)
    assert clean.columns == after.columns
    left = {r.doc_id for r in clean.collect()}
    single = {d for d, (_, c) in plain_components([(d, docs[d].text) for d in left]).items() if c == d}
    assert {r.doc_id for r in rows} == single
    check_packing(rows, [(d, docs[d].text) for d in single], 2048)


def test_pipeline_of_odd_rows(spark, odd, none, sf_dir):
    for docs in (odd, none):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf_dir)
            assert out.columns == docs.columns
            out.count()
    left = corpus_pipeline.near_duplicate_stage(spark, odd, sf_dir)
    assert sorted(r.doc_id or 0 for r in left.select("doc_id").collect()) == [0, 1, 2, 3, 4, 5, 8, 9]


def test_verdicts_stay_with_their_rows_when_splits_change(spark, sf_dir):
    """Executors lost or gained between two scans change the splits of a table, so rows must not be told apart by their place."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(8)
    path = new_run_dir(spark, "splits")
    docs.write.parquet(path)
    docs = spark.read.parquet(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for stage, keep in (
        (corpus_pipeline.quality_stage, QUERIES["op6_quality_rules"](spark, sf_dir).where("kept")),
        (corpus_pipeline.toxicity_stage, QUERIES["op9_toxicity"](spark, sf_dir).where("predicted = 0")),
    ):
        want = sorted(r.doc_id for r in keep.select("doc_id").collect())
        out = stage(spark, docs, sf_dir)
        try:
            spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
            assert sorted(r.doc_id for r in out.select("doc_id").collect()) == want
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_stages_read_no_row_twice(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for stage in (corpus_pipeline.quality_stage, corpus_pipeline.toxicity_stage):
        plan = stage(spark, docs, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
        assert "monotonically_increasing_id" not in plan and "LeftSemi" not in plan


def test_rows_that_share_a_doc_id_but_not_their_texts_stay(spark, sf_dir):
    texts = [" ".join(f"{a}{i}" for i in range(40)) for a in "abc"]
    rows = [(1, texts[0]), (1, texts[1]), (2, texts[0] + " end"), (3, texts[2]), (None, texts[2]), (1, texts[1])]
    left = corpus_pipeline.near_duplicate_stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), sf_dir).collect()
    assert sorted(tuple(r) for r in left) == [(1, texts[0]), (1, texts[1]), (3, texts[2])]
