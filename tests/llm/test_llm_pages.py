"""The page operators against SQL and plain versions."""

import html
import re
import time

import compare
import duckdb
import pytest

from newsmart.llm import tagpath, urlfilter, warc
from newsmart.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "page_id long, url string, html string, row string, found string, digest string, payload string"


@pytest.fixture(scope="module")
def awkward(spark):
    body = "<p>Many words here, and there.</p>" * 5
    rows = [
        (1, "http://A.Example.NET/en/x?y#z", body), (2, None, None), (3, "no scheme", ""), (4, "x://net", body), (5, "x://b.org/fr/", body),
        (5, "x://b.org/fr/", body), (None, "http://net/", body), (6, "http://net?a/b", "<"), (7, "a\r\nWARC-Type: z://h/\n", "é" * 60),
        (8, "http://u", "<p>" * 20_000 + "x"), (9, "http://notnet/", ""), (10, "http://x.example.com/de", "tiny"),
    ]
    return spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], SCHEMA)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    left = compare.spark_side(QUERIES[name](spark, FOLDER))
    assert compare.differences(left, compare.duck_side(compare.connect(FOLDER), ORACLES[name])) is None and left[1]


def test_url_rules_of_awkward_rows(awkward):
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("org", "/fr/", "block"), ("org", "/fr/", "allow")]
    rows = {r.page_id: r for r in urlfilter.verdicts(awkward, rules).collect()}
    assert (rows[1].host, rows[1].path, rows[1].rule, rows[1].verdict) == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert (rows[2].host, rows[2].path, rows[2].rule, rows[2].verdict) == ("", "", None, "allow")
    assert (rows[4].path, rows[4].rule, rows[5].verdict, rows[6].rule, rows[9].rule) == ("", None, "block", None, None)
    assert rows[None].rule == "net/" and urlfilter.verdicts(awkward, rules).count() == 12
    kept = urlfilter.judge(awkward, [], otherwise="block")
    assert {r.found.verdict for r in kept.collect()} == {"block"} and kept.select("row.*").columns == awkward.columns
    assert urlfilter.verdicts(awkward.limit(0), rules).count() == 0


def test_colliding_digests_are_confirmed(spark):
    def few_bits(text):
        return sum(text) % 3

    rules = [(f"h{i}.com", "/", "block") for i in range(50)]
    name = urlfilter.write_index(spark, spark.createDataFrame(rules, "host string, path string, verdict string"), few_bits)
    index = urlfilter.Index(urlfilter.SparkFiles.get(name))
    wanted = [f"h{i}.com\0/".encode() for i in range(60)]
    assert index.find(wanted, few_bits) == [1] * 50 + [None] * 10


def test_archives_of_awkward_rows(awkward):
    rows = warc.archived(awkward).collect()
    assert len(rows) == 12
    by_id = {r.page_id: r for r in rows}
    assert (by_id[4].record_type, by_id[4].refers_to, by_id[1].record_type) == ("revisit", 1, "response")
    assert by_id[2].payload_bytes == 0 and by_id[3].record_type == "response" and by_id[7].payload_bytes == 120
    assert by_id[7].record_type == "response" and by_id[None].record_type == "response"
    assert warc.archived(awkward.limit(0)).count() == 0


def test_records_keep_their_bytes(spark, awkward):
    folder = warc.new_folder(spark, "test")
    warc.write_archive(awkward, folder)
    records = [(bytes(r.header), bytes(r.payload), bytes(r.record)) for r in warc.read_archive(spark, folder).collect()]
    pages = {f"<urn:page:{r.page_id}>".encode(): (r.html or "").encode() for r in awkward.collect() if r.page_id is not None}
    for header, payload, record in records:
        assert header.startswith(b"WARC/1.1\r\n") and header.endswith(b"\r\n\r\n") and header.count(b"\r\n\r\n") == 1
        own = b"" if b"WARC-Type: revisit\r\n" in header else payload
        assert record == header + own + b"\r\n\r\n" and b"\r\nContent-Length: %d\r\n" % len(own) in header
        page = re.search(rb"WARC-Record-ID: (.*)\r", header)[1]
        assert page == b"<urn:page:none>" or pages[page] == payload
    payloads = spark.read.parquet(f"{folder}/payloads")
    assert payloads.count() == payloads.select("digest").distinct().count() == 6


def test_articles_of_the_given_pages(spark):
    pages = dict(duckdb.sql(f"SELECT page_id, html FROM '{FOLDER}/pages.parquet'").fetchall())
    rows = QUERIES["op5_html_extraction"](spark, FOLDER).collect()
    assert len(rows) == len(pages)
    for row in rows:
        article = re.search(r"<article>(.*?)</article>", pages[row.page_id], re.DOTALL)[1]
        parts = re.split(r"</?(?:p|h1)>", article.replace("<br>", " ").replace("<b>", "").replace("</b>", ""))
        expected = [" ".join(html.unescape(p).split()) for p in parts]
        assert row.text == "\n".join(p for p in expected if p) and row.n_chars == len(row.text)


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header><a href=/>Site</a> tagline here.</header>
<div class=menu><a href=1>One</a> | <a>Two</a></div><div class="cookie-notice">We use cookies, sadly.</div>
<ARTICLE-TAG class=wrap><h2>The   headline</h2><p>First paragraph with some, punctuation. And <b>more</b> text&nbsp;to read, really.<p>Short.
<p>Another long paragraph, with words &amp; entities. It goes on, and on.<ul><li>point one, yes.<li>point two</ul>
<script>var x = "<p>no</p>";</script><!-- <p>no</p> --><p>Closing words, in the end. Really<br>the end.</p>
<div class="ad banner">Buy now, cheap!</div></ARTICLE-TAG>
<aside><p>Buy things, now. Great, cheap.</p></aside><div id=comments><p>I disagree, strongly. You are all wrong, says a reader.</p></div>
<form><input><p>Subscribe, please.</p></form><footer>c 2020, all rights"""
TEXT = """The headline
First paragraph with some, punctuation. And more text to read, really.
Short.
Another long paragraph, with words & entities. It goes on, and on.
point one, yes.
point two
Closing words, in the end. Really the end."""


@pytest.mark.parametrize("tag", ["article", "main", "div", "section"])
def test_articles_among_boilerplate(tag):
    assert tagpath.main_text(PAGE.replace("ARTICLE-TAG", tag)) == TEXT


def test_pages_that_are_awkward(awkward):
    rows = {r.page_id: r for r in tagpath.texts(awkward).collect()}
    assert (rows[2].text, rows[3].text, rows[6].n_chars) == ("", "", 1) and rows[8].text == "x"
    assert tagpath.extracted(awkward).select("row.*").columns == awkward.columns
    assert tagpath.texts(awkward.limit(0)).count() == 0


LONG = "This is a long paragraph, with commas and stops. It goes on for a while; then it ends, at last."
UNDECLARED = f"""<body><div class=x1><div>Home</div><div>About us</div><div>Contact</div></div>
<div class=x2>Opening words, bare.<h2>Head</h2><p>{LONG} One.</p><p>{LONG} Two.</p><p>Short.</p><p>{LONG} Three.</p>Closing words, bare.</div>
<div class=x3><span>Copyright notice</span><div>All rights</div><div>Imprint</div></div></body>"""


def test_the_ratio_decides_where_nothing_is_declared(monkeypatch):
    expected = ["Opening words, bare.", "Head", f"{LONG} One.", f"{LONG} Two.", "Short.", f"{LONG} Three.", "Closing words, bare."]
    assert tagpath.main_text(UNDECLARED) == "\n".join(expected)
    monkeypatch.setattr(tagpath, "_fused", lambda found, settings: [1.0] * len(found))
    assert "Imprint" in tagpath.main_text(UNDECLARED)


def test_bare_text_of_the_container_stays():
    page = f"<body><div>Bare, to begin with.<h1>T</h1><p>{LONG}</p><p>{LONG}</p>and to end with</div><div>Other</div></body>"
    assert tagpath.main_text(page) == f"Bare, to begin with.\nT\n{LONG}\n{LONG}\nand to end with"
    leaves = f"<body><div><div>{LONG} {LONG}</div><div>Short one.</div></div><div class=z><div>Foot</div></div></body>"
    assert tagpath.main_text(leaves) == f"{LONG} {LONG}\nShort one."


@pytest.mark.parametrize("broken", ['<p title="abc>', "<p title='abc>", '<p a="x" b="y>', '<p title="a > b">', "<p title='<b>'>"])
def test_markup_with_quotes_is_no_text(broken):
    text = tagpath.main_text(f"<article>{broken}Some text, it says.</p><p>And more.</p></article>")
    assert text == "Some text, it says.\nAnd more."


@pytest.mark.parametrize(
    "page",
    [
        "<div>" * 20_000 + "<p>x, y.</p>" * 20_000, "".join(f"<div>t{i}, u." for i in range(20_000)),
        "<div class=ad>" * 20_000 + "x" * 9, "<b>" * 20_000 + "<p>x" * 20_000, "<b>" * 20_000 + "<h2>x</h2></i>" * 20_000,
        "<p a='>' " * 20_000 + '"', "<a href='" * 20_001, "<" * 20_000, "<ul><li>x" * 20_000, "<a" * 20_000 + '"',
    ],
)
def test_broken_pages_take_time_in_proportion(page):
    begun = time.process_time()
    tagpath.main_text(page)
    assert time.process_time() - begun < 3
