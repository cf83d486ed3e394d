"""Registry sync, payload parsing, ingest and stored tables."""

import datetime as dt
import json

from pyspark.sql import functions as F

from newsmart.operators import ingest
from newsmart.operators.identity import number_rows
from newsmart.operators.registry import sync_registry
from newsmart.schemas import SCHEMAS
from newsmart.sources import tables
from newsmart.sources.payloads import parse_payloads

NOW = dt.datetime(2024, 1, 1, 12)


def _registry(spark, entries):
    fields = ("media_name", "country", "language", "tier", "active", "categories", "feeds")
    rows = [(n, *[entry.get(field) for field in fields]) for n, entry in enumerate(entries)]
    return spark.createDataFrame(rows, "pos int, " + SCHEMAS["registry"])


def _medium(name, feeds, **more):
    return {"media_name": name, "country": "KR", "language": "en", "tier": 1, "feeds": [("world", u) for u in feeds], **more}


def _empty(spark):
    return [spark.createDataFrame([], SCHEMAS[name]) for name in ("sources", "source_categories", "feeds")]


def _state(result):
    sources = {r.media_name: (r.source_id, r.primary_country_code) for r in result.sources.collect()}
    feeds = {r.feed_url: (r.feed_id, r.source_id, r.is_active) for r in result.feeds.collect()}
    categories = sorted(tuple(r) for r in result.categories.collect())
    return sources, feeds, categories


def test_registry_sync(spark):
    first = sync_registry(
        _registry(spark, [_medium("a", ["u1", "u2"], categories=["KR", "X"]), _medium("b", ["u3"]),
                          _medium("c", ["u4"], active=False)]),
        *_empty(spark),
    )
    assert _state(first) == (
        {"a": (1, "KR"), "b": (2, "KR"), "c": (3, "KR")},
        {"u1": (1, 1, True), "u2": (2, 1, True), "u3": (3, 2, True)},
        [(1, "KR"), (1, "X")],
    )
    stored = (first.sources, first.categories, first.feeds.withColumn("last_status", F.lit(200)))
    changed = _registry(spark, [_medium("d", ["u2", "u5"]), _medium("a", [], country="US", categories=["Y"])])
    second = sync_registry(changed, *stored)
    sources, feeds, categories = _state(second)
    assert sources == {"a": (1, "US"), "b": (2, "KR"), "c": (3, "KR"), "d": (4, "KR")}
    assert feeds == {"u1": (1, 1, False), "u2": (2, 4, True), "u3": (3, 2, False), "u5": (4, 4, True)}
    assert categories == [(1, "Y")]
    assert {r.feed_url: r.last_status for r in second.feeds.collect()}["u2"] == 200
    assert _state(sync_registry(changed, second.sources, second.categories, second.feeds)) == (sources, feeds, categories)
    kept = sync_registry(_registry(spark, []), second.sources, second.categories, second.feeds)
    assert _state(kept) == (sources, feeds, categories)


def test_registry_listing_a_name_or_url_twice(spark):
    entries = [_medium("a", ["u1", "u2"]), _medium("b", ["u1"]), _medium("a", ["u3"], country="US")]
    sources, feeds, _ = _state(sync_registry(_registry(spark, entries), *_empty(spark)))
    assert sources == {"a": (1, "US"), "b": (2, "KR")}
    assert feeds == {"u1": (1, 2, True), "u2": (2, 1, False), "u3": (3, 1, True)}


def test_registry_reader(spark, tmp_path):
    document = {"sources": [{"media_name": "a", "country": "KR", "language": "ko", "tier": 0,
                             "feeds": [{"section": "world", "url": "u"}]}, {"media_name": "b", "active": False}]}
    path = tmp_path / "registry.json"
    path.write_text(json.dumps(document, indent=1), encoding="utf-8")
    rows = tables.read_registry(spark, str(path)).orderBy("pos").collect()
    assert [(r.pos, r.media_name, r.active, r.feeds) for r in rows] == [(0, "a", None, [("world", "u")]), (1, "b", False, None)]


RSS = """<?xml version="1.0"?><rss version="2.0"><channel><title>t</title>
<item><title>A &amp; B</title><link>http://x/1</link><description><![CDATA[<p>hi &amp; ho</p>]]></description>
<pubDate>Mon, 01 Jan 2024 10:00:00 +0900</pubDate></item>
<item><title>C</title><guid>http://x/2</guid></item>
<item><title>D</title><guid isPermaLink="false">id</guid></item></channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><entry><title type="html">E</title><link rel="self" href="http://s"/>
<link href="http://y/1"/><content type="html">body</content><updated>2024-01-02T00:00:00Z</updated></entry></feed>"""
RDF = """<rdf:RDF xmlns:rdf="r"><channel><title>t</title></channel><item><title>F</title><link>http://z/1</link></item></rdf:RDF>"""
XHTML = """<feed xmlns="http://www.w3.org/2005/Atom"><entry><title type="xhtml"><div xmlns="http://www.w3.org/1999/xhtml">H <b>i</b></div>
</title><link href="http://h/1"/><content type="xhtml"><div xmlns="http://www.w3.org/1999/xhtml"><p>in</p> it</div></content></entry></feed>"""
BROKEN_ATOM = """<feed><entry><title>J</title><link href="http://j/1"/></entry><entry><title>K & L</title><link href="http://j/2?a=1&b=2"/>
<summary>x&nbsp;y</summary></entry><entry><title>M<i></title><link href="http://j/3"/></entry><entry><title>cut"""
ENCODED = """<rss xmlns:content="c"><channel><item><title>N</title><link>http://n/1</link><description></description>
<content:encoded><![CDATA[<p>whole & full</p>]]></content:encoded></item></channel></rss>"""
BROKEN = "<rss><channel><item><title>G</title><link>http://b/1</link></item><item><title>cut"


def _payloads(spark):
    bodies = [RSS, ATOM, RDF, BROKEN, "nonsense", "<rss><channel><title>none</title></channel></rss>", None, None]
    rows = [(n, 1, NOW, 200, None, body) for n, body in enumerate(bodies)]
    rows[6], rows[7] = (6, 1, NOW, 503, None, None), (7, 1, NOW, -1, "ssl_error", None)
    return spark.createDataFrame(rows, SCHEMAS["feed_payloads"])


def test_payloads(spark):
    parsed = parse_payloads(_payloads(spark))
    feeds = {r.feed_id: (r.error, r.entry_count) for r in parsed.feeds.collect()}
    assert feeds == {0: (None, 3), 1: (None, 1), 2: (None, 1), 3: (None, 1), 4: ("unparsable body", 0), 5: (None, 0),
                     6: ("http 503", 0), 7: ("ssl_error", 0)}
    rows = {r.title: r for r in ingest.entry_rows(parsed.entries).collect()}
    assert sorted(rows) == ["A & B", "C", "E", "F", "G"]
    assert rows["A & B"].summary == "hi & ho" and rows["A & B"].published_at == dt.datetime(2024, 1, 1, 1)
    assert rows["C"].link == "http://x/2" and rows["C"].published_at == NOW
    assert (rows["E"].link, rows["E"].summary, rows["E"].published_at) == ("http://y/1", "body", dt.datetime(2024, 1, 2))


def test_rescued_entries_markup_and_full_contents(spark):
    rows = [(n, 1, NOW, 200, None, body) for n, body in enumerate([XHTML, BROKEN_ATOM, ENCODED])]
    payloads = spark.createDataFrame(rows, SCHEMAS["feed_payloads"])
    for parsed in (parse_payloads(payloads), parse_payloads(payloads, store=None)):
        assert {r.feed_id: (r.error, r.entry_count) for r in parsed.feeds.collect()} == {0: (None, 1), 1: (None, 2), 2: (None, 1)}
        got = {r.title: (r.link, r.summary) for r in ingest.entry_rows(parsed.entries).collect()}
        assert got == {"H <b>i</b>": ("http://h/1", "in it"), "J": ("http://j/1", ""), "N": ("http://n/1", "whole & full"),
                       "K & L": ("http://j/2?a=1&b=2", "x\xa0y")}
    assert "from_xml" not in parse_payloads(payloads).entries._jdf.queryExecution().optimizedPlan().toString()


def test_no_filter_parses_the_payloads_once_more(spark):
    entries = parse_payloads(_payloads(spark).repartition(2), store=None).entries
    lines = entries._jdf.queryExecution().optimizedPlan().toString().split("\n")
    assert any("from_xml" in line for line in lines)
    assert not any("from_xml" in line for line in lines if "Filter" in line or "Join" in line)
    assert "pos" in entries.columns and entries.filter("pos IS NULL").count() == 0


def _entries(spark, rows):
    full = [(feed, 1, pos, title, link, None, None, None, NOW) for feed, pos, title, link in rows]
    return spark.createDataFrame(
        full, "feed_id long, source_id long, pos int, title string, link string, summary string, published string,"
              " updated string, fetched_at timestamp"
    )


def test_insert_ignores_known_and_repeated_hashes(spark):
    entries = _entries(spark, [(2, 0, "a", "l"), (1, 1, " a ", "l"), (1, 0, "b", "l"), (1, 2, "", "l"), (1, 3, "c" * 1500, "l")])
    feeds = spark.createDataFrame([(1, 200, None, NOW), (2, 200, None, NOW), (3, 404, "http 404", NOW)],
                                  "feed_id long, status int, error string, fetched_at timestamp")
    stored = spark.createDataFrame([], SCHEMAS["articles"])
    run = ingest.ingest(feeds, entries, stored)
    rows = run.articles.collect()
    assert sorted((r.feed_id, r.title[:1]) for r in rows) == [(1, "a"), (1, "b"), (1, "c")]
    assert sorted(r.article_id for r in rows) == [1, 2, 3]
    assert [r.article_id for r in sorted(rows, key=lambda r: r.content_hash)] == [1, 2, 3]
    assert max(len(r.title) for r in rows) == 1000
    assert tuple(run.run.first()) == (3, 2, 1, 3, 1)
    again = ingest.ingest(feeds, entries, run.articles)
    assert again.articles.count() == 0 and again.run.first().dup_articles == 4


def test_row_numbers_are_dense_over_buckets(spark):
    rows = spark.range(500).withColumn("h", F.sha2(F.col("id").cast("string"), 256)).repartition(9)
    numbered = number_rows(rows, "n", F.lit(100), F.substring("h", 1, 1), "h").collect()
    assert [r.n for r in sorted(numbered, key=lambda r: r.h)] == list(range(101, 601))


def test_links(spark):
    prefix = ingest.REDIRECT_PREFIX
    articles = spark.createDataFrame(
        [(1, prefix + "a"), (2, prefix + "b"), (3, "https://x/a"), (4, prefix.upper() + "a"), (5, prefix + "c")],
        "article_id long, link string",
    )
    redirects = spark.createDataFrame(
        [(prefix + "a", "https://real/" + "r" * 3000), (prefix + "b", prefix + "consent"), ("https://x/a", "https://y"),
         (prefix + "c", None)],
        SCHEMAS["redirects"],
    )
    got = {r.article_id: r.link for r in ingest.resolve_links(articles, redirects).collect()}
    assert len(got[1]) == 2000 and got[1].startswith("https://real/")
    assert [got[n] for n in (2, 3, 4, 5)] == [prefix + "b", "https://x/a", prefix.upper() + "a", prefix + "c"]


def test_feed_health_keeps_the_latest_outcome(spark):
    feeds = spark.createDataFrame(
        [(1, 1, "u", "w", True, 200, None, "old"), (2, 1, "v", "w", True, 500, None, "kept")], SCHEMAS["feeds"]
    )
    later = NOW + dt.timedelta(hours=1)
    counts = spark.createDataFrame([(1, 404, NOW, "http 404"), (1, 200, later, None)],
                                   "feed_id long, status int, fetched_at timestamp, error string")
    got = {r.feed_id: (r.last_status, r.last_fetched, r.last_error) for r in ingest.update_feed_health(feeds, counts).collect()}
    assert got == {1: (200, later, None), 2: (500, None, "kept")}


def test_stored_tables(spark, tmp_path):
    path = str(tmp_path / "articles")
    rows = spark.createDataFrame([(1, 1, 1, "t", "l", "s", NOW, NOW, "h", 0, "pending")], SCHEMAS["articles"])
    tables.append_articles(rows, path)
    tables.append_articles(rows.withColumn("article_id", F.lit(2)), path)
    assert sorted(r.article_id for r in tables.read_table(spark, path, "articles").collect()) == [1, 2]
    runs = str(tmp_path / "runs")
    totals = ingest.run_metrics(spark.createDataFrame([(None, 1, 0)], "error string, new_articles long, dup_articles long"))
    tables.append_run(totals, runs, 1, NOW, NOW)
    assert tables.read_table(spark, runs, "fetch_runs").first().feeds_ok == 1
    document = str(tmp_path / "document")
    tables.write_document(spark.range(1).select(F.lit(None).cast("string").alias("q"), F.lit("금리").alias("t")), document)
    assert json.loads(spark.read.text(document).first()[0]) == {"q": None, "t": "금리"}
    words = tmp_path / "words.txt"
    words.write_text("rate hike\n won \nbank\n", encoding="utf-8")
    assert tables.read_keywords(spark, str(words)) == ["rate hike", " won ", "bank"]
    report = str(tmp_path / "report")
    tables.write_report(totals, report, "csv")
    assert spark.read.csv(report, header=True).count() == 1
