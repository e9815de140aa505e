"""WARC round trips and HTML extraction."""

import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from quarry.llm import warc
from quarry.llm.html_extract import extract, main_text, smooth
from quarry.session import new_work_dir

PAGE = "page_id long, url string, html string"


def expected(rows, least=100):
    first = {}
    for p, _, h in rows:
        if p is not None and len((h or "").encode()) >= least:
            first[h] = min(first.get(h, p), p)
    out = []
    for p, _, h in rows:
        data = (h or "").encode()
        low = first.get(h) if len(data) >= least else None
        again = low is not None and low != p
        out.append((p, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", low if again else None))
    return sorted(out, key=repr)


def archived(spark, rows):
    out = warc.archive(spark, spark.createDataFrame(rows, PAGE))
    return sorted(map(tuple, out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)


def test_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK", 7)  # many blocks
    same = "é" * 50  # 100 bytes: just large enough
    rows = [(i, f"http://h{i % 3}.example.org/{i % 11}", f"<p>page {i % 20}</p>" * 9) for i in range(150)]
    rows += [(500, "http://x.org/", same), (400, "http://x.org/", same), (501, None, same), (502, "", "y" * 99), (503, "no url", "y" * 99)]
    rows += [(504, "http://a/\r\nX: y", None), (505, "http://[bad", ""), (None, "http://n.org", same), (400, "http://x.org/", same), (600, "u", "\r\n\r\nWARC/1.1\r\n" * 20)]
    assert archived(spark, rows) == expected(rows)
    assert archived(spark, []) == []


def test_one_url_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK", 5)
    rows = [(i, "http://hot.example.org/", f"{i}") for i in range(300)]
    assert archived(spark, rows) == expected(rows)


def stored(spark, root):
    """The archives as files: their chunks in turn."""
    files = {}
    for r in warc.read_archive(spark, root).orderBy("file", "chunk").collect():
        files[r.file] = files.get(r.file, b"") + bytes(r.data)
    return files


def test_archives_are_plain_warc(spark):
    root = new_work_dir(spark, "warc-test")
    pages = spark.createDataFrame([(1, "http://a.org/x", "z" * 200), (2, "http://b.org/", "z" * 200)], PAGE)
    captures = warc.write(spark, pages, root)
    warc.build_index(spark, captures, root)
    data = b"".join(gzip.decompress(f) for f in stored(spark, root).values())
    assert data.count(b"WARC/1.1\r\n") == 2 and data.count(b"WARC-Type: revisit") == 1 and b"WARC-Refers-To: <urn:page:1>" in data
    wanted = spark.createDataFrame([(warc.capture_key("http://b.org/", "2"),), ("org,none)/ 9",), (None,)], "key string")
    found = warc.lookup(spark, wanted, root).collect()
    assert [r.page for r in found] == ["2"]


def test_many_chunks_of_one_archive(spark, monkeypatch):
    monkeypatch.setattr(warc, "CHUNK_BYTES", 300)
    root = new_work_dir(spark, "warc-test")
    rows = [(i, f"http://h.org/{i}", f"page {i} " * 40) for i in range(60)]
    captures = warc.write(spark, spark.createDataFrame(rows, PAGE).coalesce(2), root)
    assert captures.agg(F.max("chunk")).first()[0] > 5
    assert sum(gzip.decompress(f).count(b"WARC-Type: response") for f in stored(spark, root).values()) == 60
    assert archived(spark, rows) == expected(rows)


def test_a_folder_that_only_spark_can_open(spark):
    """Archives, index and directory go through Hadoop's file system, here a
    mount table that no other library knows; and a folder without a scheme is
    on Spark's default file system."""
    conf = spark._jsc.hadoopConfiguration()
    real = new_work_dir(spark, "warc-mounted")
    spark.range(1).write.parquet(f"{real}/made")
    plain = real if real.startswith("file:") else f"file://{real}"
    conf.set("fs.viewfs.mounttable.warctest.link./in", plain)
    rows = [(i, f"http://h{i % 4}.org/{i}", f"page {i} " * 40) for i in range(80)]
    for root in ("viewfs://warctest/in/a", real.removeprefix("file://").removeprefix("file:") + "/b"):
        warc.build_index(spark, warc.write(spark, spark.createDataFrame(rows, PAGE), root), root)
        wanted = spark.createDataFrame([(warc.capture_key(u, str(p)),) for p, u, _ in rows[::3]] + [("zzz",), ("",)], "key string")
        found = warc.fetch(spark, warc.lookup(spark, wanted, root), root)
        assert sorted(r.page_id for r in found.collect()) == [p for p, _, _ in rows[::3]]


def test_keys_that_repeat_over_blocks_and_parts(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK", 4)
    rows = [(7, "http://hot.org/", "same")] * 60 + [(i, f"http://{'ab'[i % 2]}.org/{i}", "x") for i in range(40)]
    assert archived(spark, rows) == expected(rows)


def test_other_columns_do_not_clash(spark):
    df = spark.createDataFrame([(1, "http://a.org/", "p" * 150, 3, "x", b"y")], PAGE + ", digest int, refers_to string, data binary")
    assert [r.page_id for r in warc.archive(spark, df).collect()] == [1]


def test_a_record_unlike_its_digest_raises(spark):
    raw = warc.record("1", "u", b"payload", hashlib.sha256(b"other").hexdigest(), None)
    with pytest.raises(ValueError, match="digest"):
        warc._read("1", raw)
    with pytest.raises(ValueError, match="names page"):
        warc._read("2", raw)


def test_url_keys():
    assert warc.url_key("http://a.B.org/x?y#z") == "org,b,a)/x?y"
    assert warc.url_key("https://b.org:8080") == "org,b:8080)/"
    assert warc.url_key(None) == "" and warc.url_key("http://[bad") == "http://[bad"


LONG = "A long paragraph of an article with quite a few words in it, so that its ratio is high. " * 3


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""),
        ("", ""),
        ("plain &amp; simple&nbsp;text", "plain & simple text"),
        ("<div><span></span></div>", ""),
        ("<nav>menu</nav><article><h1>T&eacute;</h1><p>a<b>b</b>c<br>d<p>e\n f</article><footer>x</footer>", "Té abc d e f"),
        ("<head><title>t</title><style>p{}</style></head><body><script>var a='</p>';</script><p>x</p>", "x"),
        ("<article><p>a</p><form>send</form><aside>n</aside><div class='ad'>buy</div><section id=comments><article>c</article></section></article>", "a"),
        ("<div class='page with-sidebar'><div class='sidebar'>s</div><p>" + LONG + "</p></div>", LONG.strip()),
        ("<header><h1>Site</h1></header><main><header><h1>T</h1></header><p>b</p></main>", "T b"),
        ("<div role=navigation>m</div><div><p>" + LONG + "</p><p>Short.</p><p>" + LONG + "</p></div>", f"{LONG.strip()} Short. {LONG.strip()}"),
        ("<p>a<!-- no --><p hidden>b</p><p style='display: none'>c</p>", "a"),
        ("<article>never <p>closed <div>at <b>all", "never closed at all"),
        ("<div class=cookieNotice>We use cookies</div><article>" + "<p>x</p>" * 3 + "</article>", "x x x"),
    ],
)
def test_main_text(html, text):
    assert main_text(html) == text


def test_low_ratio_regions_are_left_out():
    links = "<div>" + "".join(f"<p><a href=x><i>l{i}</i></a></p>" for i in range(12)) + "</div>"
    body = "<div>" + f"<p>{LONG}</p>" * 12 + "</div>"
    assert main_text(links + body + links) == " ".join([LONG.strip()] * 12)


def test_ratios_decide_whether_an_article_is_believed():
    card = "<div class=more><article><h3><a href=x>Another story</a></h3><p>A few words of it.</p></article></div>"
    story = "<div><h1>T</h1>" + f"<p>{LONG}</p>" * 6 + "</div>"
    wanted = "T " + " ".join([LONG.strip()] * 6)
    assert main_text(card + story).endswith(wanted) and main_text(story + card).startswith(wanted)
    assert main_text("<div class='page with-sidebar'>" + story + "</div>" + card).startswith(wanted)
    assert main_text(story + "<ul>" + "<li><a href=x><i>link</i></a></li>" * 9 + "</ul>" + card) == wanted
    article = "<article><h1>T</h1>" + f"<p>{LONG}</p>" * 6 + "</article>"
    assert main_text(article + f"<div><p>{LONG}</p></div>") == wanted  # the most text, so believed


def test_regions_inside_an_article_are_judged():
    links = "<div>" + "<p><a href=x><i>l</i></a></p>" * 12 + "</div>"
    text = f"<p>{LONG}</p>" * 6 + "<table><tr><td>1<td>2</table><ul><li>x<li>y</ul>" + f"<p>{LONG}</p>" * 6
    long = " ".join([LONG.strip()] * 6)
    body = f"{long} 1 2 x y {long}"
    assert main_text("<article><section>" + text + "</section><hr>" + links + links + "</article>") in (body, f"{body} l")
    assert main_text("<article>" + text + "</article>") == body


def test_smooth_keeps_constants_and_length():
    assert smooth([3.0] * 5) == pytest.approx([3.0] * 5)
    assert smooth([7.0]) == [7.0] and smooth([]) == []


def test_very_long_page():
    assert main_text("<article>" + "<p>word</p>" * 50_000) == " ".join(["word"] * 50_000)


def test_given_pages_are_extracted_whole(spark):
    """The given pages keep their text in one article element."""
    import html as h
    import re

    got = extract(spark, spark.read.parquet("/root/testdata/sf0.001/pages.parquet")).collect()
    source = {r.page_id: r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()}
    assert len(got) == len(source)
    for r in got:
        inner = re.search(r"<article>(.*)</article>", source[r.page_id], re.S)[1]
        blocks = [" ".join(h.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", inner)]
        assert r.text == " ".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_extract_edges(spark):
    df = spark.createDataFrame([(None, None, None, 1), (1, "u", "<p>a", 2), (1, "u", "<p>a", 3)], PAGE + ", text int")
    assert sorted(map(tuple, extract(spark, df).collect()), key=repr) == sorted([(None, None, "", 0), (1, "u", "a", 1), (1, "u", "a", 1)], key=repr)
    assert extract(spark, df.where(F.lit(False))).collect() == []


@pytest.mark.parametrize(
    "page",
    ["<div class=ad>x" * 70_000, "<div>" * 60_000 + "</p>" * 60_000, "<article><p>t" * 50_000, "<a " * 300_000, "<!-- x >" * 100_000, "</" * 300_000, "<div class=nav>" * 50_000 + "text " * 50_000 + "</div>" * 50_000],
)
def test_a_megabyte_of_nested_or_broken_markup_takes_seconds(page):
    import time

    start = time.time()
    main_text(page)
    assert time.time() - start < 10


def test_what_a_page_cuts_off():
    assert main_text("<p>some text</p><!-- never ends") == "some text <!-- never ends"
    assert main_text("<p>some text</p><div class='x") == "some text"
