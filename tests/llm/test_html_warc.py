"""Main text of pages, and archives written and read back."""

import base64
import hashlib
import html
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from postsift.llm import htmltext, warc
from postsift.llm.common import Scratch
from postsift.llm.htmltext import extract, main_text

ARTICLE = "<h1>Title</h1><p>One, two &amp; three.</p><p>Four,<br>five.<p>Six"
PAGES = {
    f"<html><head><title>t</title><style>p{{}}</style></head><body><nav><a href=x>Home</a></nav><article>{ARTICLE}</article><footer>f</footer></body></html>": "Title\nOne, two & three.\nFour, five.\nSix",
    f"<div class='header'>Site</div><div id='content'>{ARTICLE}</div><div class='side-bar sidebar'><p>a, b, c</p></div><div id=comments><p>nice, very nice, post</p></div>": "Title\nOne, two & three.\nFour, five.\nSix",
    "<main><header><h1>T</h1></header><form><p>mail</p></form><p>a\n\t b&nbsp;c</p><div class='cookie-notice'>ok</div><aside>x</aside></main>": "T\na b c",
    "<article><p>one<script>var t='</p>';</script> two</p><table><tr><td>1<td>2</table><ul><li>x<li>y</ul></article>": "one two\n1\n2\nx\ny",
    "<div><ul><li><a href=1>a</a><li><a href=2>b</a><li><a href=3>c</a></ul><p>x &lt; y</p></div>": "x < y",
    "<p style='display:none'>hidden, text</p><p>shown</p>": "shown",
    "plain text": "plain text",
    "": "",
    "<nav>menu</nav>": "",
    "<!-- only a comment -->": "",
    "<p>" + "w, " * 30_000 + "</p>": " ".join(["w,"] * 30_000),
    "<div>" * 3000 + "deep": "deep",
}


@pytest.mark.parametrize("page", list(PAGES), ids=lambda p: p[:20])
def test_main_text(page):
    assert main_text(page) == PAGES[page]


WRAPPERS = {
    f'<article class="post category-social">{ARTICLE}</article>': "Title\nOne, two & three.\nFour, five.\nSix",
    f'<div class="content has-sidebar">{ARTICLE}</div><div class="sidebar"><p>a, b</p></div>': "Title\nOne, two & three.\nFour, five.\nSix",
    f'<div id="page" class="no-comments">{ARTICLE}</div>': "Title\nOne, two & three.\nFour, five.\nSix",
    f'<div class="layout-sidebar"><article>{ARTICLE}</article></div>': "Title\nOne, two & three.\nFour, five.\nSix",
    f'<article class="social">{ARTICLE}</article>': "Title\nOne, two & three.\nFour, five.\nSix",
    f'<div class="page-widget">{ARTICLE}</div>': "Title\nOne, two & three.\nFour, five.\nSix",
    '<article><div class="entry-header"><h1>T</h1></div><p class="commentary">One, two.</p><p>H<sub class="subscript">2</sub>O</p></article>': "T\nOne, two.\nH2O",
    "<body>" + "".join(f'<div class="widget"><p>Part {i}, of many.</p></div>' for i in range(9)) + "</body>": "\n".join(f"Part {i}, of many." for i in range(9)),
    # What the names are for still goes, comments also where they outweigh the article or are articles themselves.
    f'<article>{ARTICLE}</article><div id="comments">' + '<article class="comment-body"><p>so, so, so, nice</p></article>' * 20 + "</div>": "Title\nOne, two & three.\nFour, five.\nSix",
    f'<div class="post-content">{ARTICLE}</div><div class="social share">Share</div><div class="post-comments">' + "<p>so, so, nice</p>" * 20 + "</div>": "Title\nOne, two & three.\nFour, five.\nSix",
}


@pytest.mark.parametrize("page", list(WRAPPERS), ids=lambda p: p[:40])
def test_names_of_wrappers(page):
    """A word of a class or id alone does not drop the page's text."""
    assert main_text(page) == WRAPPERS[page]


LONG = "".join(f"<p>Paragraph {i}, " + "with words, " * 30 + "and an end.</p>" for i in range(10))
LONG_TEXT = "\n".join(f"Paragraph {i}, " + "with words, " * 30 + "and an end." for i in range(10))
UNEQUAL = {
    f"<body><div><h1>Title</h1><div class=content>loose <b>text</b><div class=lead><p>Short lead.</p></div><div class=text>{LONG}</div></div></div></body>": f"Title\nloose text\nShort lead.\n{LONG_TEXT}",
    f"before<div>{LONG}</div><div><div><p>Far.</p></div></div>after": f"before\n{LONG_TEXT}\nFar.\nafter",
    f"<div><p><a href=1>Home</a></p></div><h2><a href=2>Title</a></h2><div>{LONG}</div><div><p>Source: <a href=3>b</a> and more.</p><p><a href=4>c</a></p></div>": f"Title\n{LONG_TEXT}\nSource: b and more.\nc",
    f"<main><h1>Title</h1><article>{LONG}</article><article><p>Short.</p></article></main><div><p>Elsewhere.</p></div>": f"Title\n{LONG_TEXT}\nShort.",
    f"<div><article>{LONG}</article></div><div><article><p>Short.</p></article><article><a href=1>link</a></article></div>": f"{LONG_TEXT}\nShort.",
    f"<div>loose<nav>n</nav>text<div><a href=1>b</a></div>here<hr>there<div>{LONG}</div></div>": f"loose\ntext\nhere\nthere\n{LONG_TEXT}",
    "<div><p><a href=1>a</a></p></div><div><p><a href=2>b</a></p></div>": "a\nb",
    f"<ul><li><a href=1>a</a><li><a href=2>b</a><li><a href=3>c</a></ul><div>{LONG}</div><footer>f</footer>": LONG_TEXT,
}


@pytest.mark.parametrize("page", list(UNEQUAL), ids=lambda p: p[:40])
def test_unequal_containers(page):
    """Short sections, leads, titles and loose text stay, however long the rest is."""
    assert main_text(page) == UNEQUAL[page]


SIDE = "<h3>Popular</h3><p>Most read story today</p>"
COLUMNS = {
    f"<div class=row><div class=col-8>{LONG}</div><div class=col-4>{SIDE}</div></div><div id=copyright>(c) 2024 Foo. All rights reserved.</div>": LONG_TEXT,
    f"<div class=row><div class='column left'>{SIDE}</div><div class='column wide'><div>{LONG}</div></div></div>": LONG_TEXT,
    f"<div class=row><div class=col-12><h1>Title</h1></div><div class=col-8>{LONG}</div><div class=col-4>{SIDE}</div></div>": f"Title\n{LONG_TEXT}",
    f"<table><tr><td colspan=2><h1>Title</h1></td></tr><tr><td>Call 0800 1, free</td><td><div>{LONG}</div></td></tr></table>": f"Title\n{LONG_TEXT}",
    f"<div class=row><div class=col-6>{LONG}</div><div class=col-6>{LONG}</div></div>": f"{LONG_TEXT}\n{LONG_TEXT}",
    f"<div>{LONG}<table><tr><td>a</td><td>b, c</td></tr></table></div>": f"{LONG_TEXT}\na\nb, c",
    "<table>" + f"<tr><td><p>{'long, ' * 20}</p></td><td><p>b</p></td></tr>" * 4 + "</table>": "\n".join([("long, " * 20).strip(), "b"] * 4),
    "<p class=column>a</p>": "a",
}


@pytest.mark.parametrize("page", list(COLUMNS), ids=lambda p: p[:40])
def test_columns(page):
    """Columns beside the article go by their score; tables of data stay."""
    assert main_text(page) == COLUMNS[page]


def test_scores_decide(monkeypatch):
    """Other scores give another text."""
    page = next(iter(COLUMNS))
    rate = htmltext.rate

    def changed(root):
        rated = rate(root)
        for node in rated.values():
            node.score = chance.random()
        return rated

    monkeypatch.setattr(htmltext, "rate", changed)
    chance = random.Random(7)
    assert sum(main_text(page) != LONG_TEXT for _ in range(30)) > 5


CITED = "".join(f"<li><a href={i}>Work {i}</a></li>" for i in range(5))
FORMS = {
    f"<body><form id=x><div>{LONG}</div><button>Go</button><select><option>a<option>b</select></form></body>": LONG_TEXT,
    f"<body><form id=x><nav>n</nav><article>{ARTICLE}</article><div class=sidebar><p>a, b</p></div></form></body>": "Title\nOne, two & three.\nFour, five.\nSix",
    f"<form><main>{ARTICLE}<textarea>t</textarea></main><p>Search</p></form>": "Title\nOne, two & three.\nFour, five.\nSix",
    f"<article>{LONG}<form><p>Your address, please, for our letter</p><input name=a></form></article>": LONG_TEXT,
    f"<div class=content>{LONG}</div><form class=big>" + "<p>A field, to fill in, now</p>" * 20 + "</form>": LONG_TEXT,
    f"<form><div class=entry>{LONG}</div><div id=comments>" + '<p>so, nice</p>' * 3 + "</div></form>": LONG_TEXT,
    f"<article>{LONG}<h2>Cited</h2><ol>{CITED}</ol><p>End.</p></article><ul>{CITED}</ul>": LONG_TEXT + "\nCited\n" + "\n".join(f"Work {i}" for i in range(5)) + "\nEnd.",
    "<p>shown</p><!-- never closed <p>hidden</p>": "shown",
    "<p>a<![CDATA[ x > y ]]>b</p><![CDATA[ z <!doctype html><p>c": "ab\nc",
    "<p>shown</p><a href='never closed": "shown",
    "<p>a<!-- x --!>b</p><script>'<!--'</script><p>c</p>": "ab\nc",
}


@pytest.mark.parametrize("page", list(FORMS), ids=lambda p: p[:40])
def test_forms_and_lists_in_articles(page):
    assert main_text(page) == FORMS[page]


@pytest.mark.parametrize("part", ["<!--", "<![CDATA[", "<?", "<!", "</", "<a ", "<", "&", "<!-- x -->", "<form>", "<p><!--"])
def test_broken_markup_in_linear_time(part):
    start = time.time()
    main_text("<p>text</p>" + part * (400_000 // len(part)))
    assert time.time() - start < 10


def test_given_pages(spark, sf):
    """The pages of the test tables have one article each, of a heading and paragraphs."""
    done = extract(spark.read.parquet(f"{sf}/pages.parquet")).collect()
    assert done
    for r in done:
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n".join(x for x in parts if x)


def test_extract_columns_and_nulls(spark):
    df = spark.createDataFrame([(1, None, "t"), (1, None, "t"), (2, "<p>a</p>", "u")], "page_id long, html string, text string")
    assert sorted(r.text for r in extract(df).collect()) == ["", "", "a"]
    assert extract(df.limit(0)).count() == 0


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def test_base32(spark):
    payloads = [b"", b"a", b"\x00" * 10, "é".encode() * 100]
    df = spark.createDataFrame([(p,) for p in payloads], "p binary").select("p", warc.base32_sha1(F.col("p")).alias("d"))
    assert all(r.d == digest(bytes(r.p)) for r in df.collect())


ROWS = [(3, b"same"), (1, b"same"), (2, b"other\r\n\r\nWARC/1.1\r\n"), (5, None), (4, b""), (None, b"same"), (1, b"same"), (9, b"\xff" * 300_000)]


def marked(spark, min_bytes=0):
    df = spark.createDataFrame(ROWS, "key long, payload binary").withColumn("first", F.lit("clash"))
    df = df.withColumnRenamed("key", "page")
    return warc.mark_revisits(df, "page", "payload", Scratch(spark, "test-warc").written, min_bytes)


def test_mark_revisits(spark):
    got = {(r.page, r.record_type, r.refers_to) for r in marked(spark).drop("first").collect()}
    assert got == {(3, "revisit", 1), (1, "response", None), (2, "response", None), (5, "revisit", 4), (4, "response", None), (None, "revisit", 1), (9, "response", None)}
    assert marked(spark).count() == len(ROWS)
    assert {r.record_type for r in marked(spark, 5).collect()} == {"response"}


@pytest.mark.parametrize("compress", [False, True])
def test_round_trip(spark, compress):
    path = Scratch(spark, "test-warc").path("archive")
    rows = [("response", "http://a/\r\nb", b"\x00payload\r\n\r\n", 1), ("resource", None, b"x", 2), ("revisit", "http://a/", b"gone", 3), ("odd", "", b"", 4)]
    df = spark.createDataFrame(rows, "record_type string, target_uri string, payload binary, payload_length long")
    warc.write_warc(df.repartition(3), path, compress=compress, roll_bytes=100)
    back = warc.read_warc(spark, path)
    got = {r.record_type: (r.target_uri, bytes(r.payload), r.payload_length) for r in back.collect()}
    assert got == {"response": ("http://a/%0D%0Ab", rows[0][2], 1), "resource": (None, b"x", 2), "revisit": ("http://a/", b"", 3), "odd": ("", b"", 4)}
    some = back.where((F.col("record_type") == "response") & (F.col("payload_length") < 5) & F.col("target_uri").startswith("http"))
    assert [bytes(r.payload) for r in some.collect()] == [rows[0][2]]
    assert "PushedFilters" not in some._jdf.queryExecution().toString() or some.count() == 1
    assert all(r.payload is None for r in warc.read_warc(spark, path, payload=False).collect())
    warc.write_warc(df.limit(1), path, compress=compress, mode="overwrite")
    assert warc.read_warc(spark, path).count() == 1


def test_skips_unwanted_blocks(tmp_path):
    """Headers are parsed first: blocks of records that no one wants are stepped over."""
    record = warc.record({"record_type": "response", "payload": b"p" * 5000}) + warc.record({"record_type": "resource", "payload": b"q"})
    (tmp_path / "a.warc").write_bytes(record)
    reader = warc.WarcReader(f"file://{tmp_path}", True)
    assert list(reader.pushFilters([warc.EqualTo(("record_type",), "resource")])) == []
    (partition,) = reader.partitions()
    (batch,) = reader.read(partition)
    assert batch.to_pylist()[0]["payload"] == b"q" and batch.num_rows == 1
    (tmp_path / "a.warc").write_bytes(record[:3000])
    with pytest.raises(ValueError, match="inside a record"):
        list(warc.WarcReader(f"file://{tmp_path}", True).read(partition))


def test_empty_archive(spark):
    path = Scratch(spark, "test-warc").path("archive")
    warc.write_warc(spark.createDataFrame([], "record_type string, payload binary"), path)
    assert warc.read_warc(spark, path).count() == 0
