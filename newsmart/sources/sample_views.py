"""Pipeline tables as views over the given parquet tables.

``documents`` joined with ``events`` gives the articles; their ``source`` column gives the sources,
feeds, categories and registry; a rule on the article id gives the stored model responses.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmart.config import WIDTHS
from newsmart.functions.lexicon import LanguageLists, Lexicon
from newsmart.functions.taxonomy import TOPICS, Topic
from newsmart.functions.text import content_hash, strip
from newsmart.functions.wordlists import published_lexicon
from newsmart.session import prepare, spread

COUNTRY_CODES = ["KR", "US", "CN", "JP", "ID", "VN", "KH", "MM", "IN", "GB", "HK", "SG"]

_TEST_COUNTRIES = (
    ("KR", ("thon",)), ("US", ("ther",)), ("CN", ("thnt",)), ("JP", ("erat",)), ("ID", ("asci",)),
    ("VN", ("leou",)), ("KH", ("thre",)), ("MM", ("eror",)), ("IN", ("heit",)), ("GB", ("this",)),
    ("HK", ("eine",)), ("SG", ("anea",)),
)

# Lists whose words occur in the invented prose of the given tables: "de" plays the language with
# its own list, "es" and "fr" the languages with an additional list.
TEST_LEXICON = Lexicon(
    finance=("license", "that", "the by", "erin", "re-"),
    countries=_TEST_COUNTRIES,
    exclusion=("apache", "of the", "worthless", "ouai"),
    own={"de": LanguageLists(("nicht", "sich"), _TEST_COUNTRIES)},
    extra={"es": ("mente", "para"), "fr": ("dans", "pour")},
)


def published_sample() -> Lexicon:
    """All published lists with words of the invented prose behind their own, so that each list is met.

    "de", "es" and "fr" play the languages that have lists of their own. The main list, a parameter, is made by a rule: all
    words of two of the syllables that the prose is made of, and some words of it.
    """
    syllables = "an at en er es he in is it le nd on or ou re st te th ti".split()
    finance = [first + second for first in syllables for second in syllables if first != second]
    published = published_lexicon([*finance, *TEST_LEXICON.finance])
    sample = dict(_TEST_COUNTRIES)

    def longer(countries):
        return tuple((cc, (*keywords, *sample[cc])) for cc, keywords in countries)

    (_, own), = published.own.items()
    german, (spanish, french) = TEST_LEXICON.own["de"], TEST_LEXICON.extra.values()
    indonesian, vietnamese = published.extra["id"], published.extra["vi"]
    return Lexicon(
        finance=published.finance,
        countries=longer(published.countries),
        exclusion=(*published.exclusion, *TEST_LEXICON.exclusion),
        own={"de": LanguageLists((*own.finance, *german.finance), longer(own.countries))},
        extra={"es": (*indonesian, *spanish), "fr": (*vietnamese, *french)},
    )


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def _source_number(source: Column) -> Column:
    return F.replace(source, F.lit("src"), F.lit("")).cast("long")


def _country_of(source_id: Column) -> Column:
    return F.element_at(F.lit(COUNTRY_CODES), (source_id % 12 + 1).cast("int"))


def sources(spark: SparkSession, folder: str) -> DataFrame:
    names = table(spark, folder, "documents").select(F.col("source").alias("media_name")).distinct()
    number = _source_number(F.col("media_name"))
    return names.select(
        number.alias("source_id"),
        "media_name",
        _country_of(number).alias("primary_country_code"),
        (number % 3).cast("int").alias("tier"),
    )


def categories(spark: SparkSession, folder: str) -> DataFrame:
    codes = F.array_compact(
        F.array(
            "primary_country_code",
            F.when(F.col("source_id") % 4 == 0, "GLOBAL_GENERAL"),
            F.when(F.col("source_id") % 4 == 1, "GLOBAL_ECONOMY"),
        )
    )
    return sources(spark, folder).select("source_id", F.explode(codes).alias("category_code"))


def feeds(spark: SparkSession, folder: str) -> DataFrame:
    """Two feeds per source with a spread of health states."""
    numbered = sources(spark, folder).select(
        "source_id", F.explode(F.array(F.lit(0), F.lit(1))).alias("n")
    ).withColumn("feed_id", F.col("source_id") * 2 + F.col("n"))
    state = F.col("feed_id") % 5
    status = F.when(state == 0, 200).when(state == 1, 404).when(state == 2, 503).when(state == 3, -1)
    return numbered.select(
        "feed_id",
        "source_id",
        F.format_string("https://src%d.example.com/feed/%d", "source_id", "n").alias("feed_url"),
        F.when(F.col("n") == 0, "world").otherwise("business").alias("feed_section"),
        (F.col("feed_id") % 10 != 9).alias("is_active"),
        status.cast("int").alias("last_status"),
        F.when(state.isin(1, 2), F.concat(F.lit("http "), status)).when(state == 3, "request_error").alias("last_error"),
    )


def article_columns(documents: DataFrame) -> DataFrame:
    """Row-local part of the article view."""
    number = _source_number(F.col("source"))
    return documents.select(
        F.col("doc_id").alias("article_id"),
        (number * 2 + F.expr("doc_id div 20") % 2).alias("feed_id"),
        number.alias("source_id"),
        F.left(F.substring_index("text", "\n", 1), F.lit(WIDTHS.title)).alias("title"),
        F.concat(F.lit("https://"), "source", F.lit(".example.com/a/"), "doc_id").alias("link"),
        F.col("text").alias("summary"),
        F.col("lang").alias("language"),
    )


def articles(spark: SparkSession, folder: str) -> DataFrame:
    times = table(spark, folder, "events").select(
        F.col("event_id").alias("article_id"), F.col("ts").cast("timestamp").alias("published_at")
    )
    rows = spread(article_columns(table(spark, folder, "documents")))
    return rows.join(times, "article_id").withColumn(
        "fetched_at", F.col("published_at") + F.expr("INTERVAL 1 HOUR")
    )


def responses(articles: DataFrame, stage: str) -> DataFrame:
    """Stored model replies: eight kinds by article id, the last kind being a missing reply."""
    replies = [
        '{"keep": true, "ai_score": 85, "topics": ["esg","RISK","esg"], "summary_ko": "s"}',
        '```json\n{"keep": false, "reason": "noise", "ai_score": 120}\n```',
        'Answer: {"keep": true, "ai_score": "42"} done',
        "oops",
        '{"keep": null, "ai_score": 85.7}',
        '{"keep": "false", "ai_score": "85.7"}',
        "[1]",
    ]
    kind = (F.col("article_id") % 8).cast("int")
    return articles.filter(kind < len(replies)).select(
        F.lit(stage).alias("stage"),
        F.col("article_id").cast("string").alias("key"),
        F.get(F.lit(replies), kind).alias("raw_text"),
        F.lit("stored:sample").alias("model"),
    )


def sample_topics() -> tuple[Topic, ...]:
    """The published topic codes with seed words that occur in the invented prose."""
    seeds = {
        "MARKET": ("that", "the by"), "BANKING": ("nicht", "erin"), "DIGITAL": ("para", "dans"),
        "ESG": ("worthless", "apache"), "RISK": ("license", "sich"),
    }
    return tuple(replace(topic, seeds=seeds[topic.code]) for topic in TOPICS)


# -- ingest ----------------------------------------------------------------------------------------
def _rfc(ts: Column, hours: int, zone: str, weekday: bool = True) -> Column:
    pattern = ("EEE, " if weekday else "") + "dd MMM yyyy HH:mm:ss"
    return F.concat(F.date_format(ts + F.expr(f"INTERVAL {hours} HOURS"), pattern), F.lit(zone))


def _iso(ts: Column, hours: int, zone: str) -> Column:
    return F.concat(F.date_format(ts + F.expr(f"INTERVAL {hours} HOURS"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit(zone))


def entry_columns(rows: DataFrame) -> DataFrame:
    """Feed entries from article rows: padded titles, one link per source and title, mixed dates."""
    ts, kind = F.col("published_at"), F.col("article_id") % 6
    published = (
        F.when(kind == 0, _rfc(ts, 9, " +0900")).when(kind == 1, _rfc(ts, 0, " GMT")).when(kind == 2, _iso(ts, 0, "Z"))
        .when(kind == 4, "n/a").when(kind == 5, _rfc(ts, -5, " EST", weekday=False))
    )
    return rows.select(
        "feed_id",
        "source_id",
        F.col("article_id").cast("int").alias("pos"),
        F.concat(F.lit("  "), "title", F.lit("\n")).alias("title"),
        F.concat(F.lit(" https://src"), "source_id", F.lit(".example.com/"), F.sha2("title", 256)).alias("link"),
        "summary",
        published.alias("published"),
        F.when(kind == 3, _iso(ts, 9, "+09:00")).alias("updated"),
        "fetched_at",
    )


def entries(spark: SparkSession, folder: str) -> DataFrame:
    return entry_columns(articles(spark, folder))


def stored_articles(spark: SparkSession, folder: str) -> DataFrame:
    """Articles of earlier runs: those whose document carries a label."""
    labelled = table(spark, folder, "labels").select(F.col("doc_id").alias("article_id")).distinct()
    rows = articles(spark, folder).select("article_id", "source_id", "title").join(labelled, "article_id", "left_semi")
    title = strip(F.col("title"))
    link = F.concat(F.lit("https://src"), "source_id", F.lit(".example.com/"), F.sha2("title", 256))
    return rows.select("article_id", content_hash(title, link).alias("content_hash"))


def _xml(text: Column) -> Column:
    printable = F.regexp_replace(text, r"[\x00-\x08\x0b-\x1f\x{fffe}\x{ffff}]", "")
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        printable = F.replace(printable, F.lit(char), F.lit(entity))
    return printable


def payload_columns(rows: DataFrame) -> DataFrame:
    """One stored payload per article: RSS, Atom, a broken body of either, or a failed fetch.

    Some RSS bodies have their text in ``content:encoded``, and some broken ones an undefined entity in a whole item.
    """
    kind, half = F.col("article_id") % 10, F.col("article_id") % 20
    title, summary = _xml(F.col("title")), _xml(F.col("summary"))
    date = _rfc(F.col("published_at"), 0, " GMT")
    body_tag = F.when(half == 5, "content:encoded").otherwise("description")
    item = F.concat(
        F.lit("<item><title>"), title, F.lit("</title><link>"), "link", F.lit("</link><"), body_tag, F.lit(">"), summary,
        F.lit("</"), body_tag, F.lit("><pubDate>"), date, F.lit("</pubDate>"),
        F.when(half == 17, "<category>R&D&nbsp;x</category>").otherwise(""), F.lit("</item>"),
    )
    rss = F.concat(F.lit('<?xml version="1.0"?><rss version="2.0"><channel><title>feed</title>'), item,
                   F.lit("</channel></rss>"))
    atom = F.concat(
        F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>'), title,
        F.lit('</title><link rel="self" href="https://self.example.com/"/><link href="'), "link",
        F.lit('"/><summary>'), summary, F.lit("</summary><published>"), _iso(F.col("published_at"), 0, "Z"),
        F.lit("</published></entry>"), F.when(half == 16, "<entry><title>cut").otherwise("</feed>"),
    )
    broken = F.concat(F.lit("<rss><channel>"), item, F.lit("<item><title>cut"))
    body = F.when(kind < 6, rss).when(kind == 6, atom).when(kind == 7, broken).when(kind == 8, "no feed at all")
    return rows.select(
        F.col("article_id").alias("feed_id"),
        "source_id",
        "fetched_at",
        F.when(kind == 9, 404).otherwise(200).cast("int").alias("status"),
        F.lit(None).cast("string").alias("error"),
        body.alias("body"),
    )


def payloads(spark: SparkSession, folder: str) -> DataFrame:
    return payload_columns(articles(spark, folder))


def page_links(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return pages.select(F.col("page_id").alias("article_id"), F.col("url").alias("link"))


def page_redirects(spark: SparkSession, folder: str) -> DataFrame:
    """Page URLs with a query resolve to the URL without it."""
    urls = table(spark, folder, "pages").filter(F.contains("url", F.lit("?"))).select(F.col("url").alias("from_url"))
    return urls.select("from_url", F.regexp_replace(F.split_part("from_url", F.lit("?"), F.lit(1)), "^http://", "https://").alias("to_url"))


# -- registry --------------------------------------------------------------------------------------
def _nation_code(shift: int) -> Column:
    return F.element_at(F.lit(COUNTRY_CODES), (F.col("c_nationkey") + shift) % 12 + 1)


def registry(spark: SparkSession, folder: str) -> DataFrame:
    """Desired registry with one medium per customer outside one market segment."""
    rows = table(spark, folder, "customer").filter(F.col("c_mktsegment") != "MACHINERY")

    def feed(section: str, url: Column) -> Column:
        return F.struct(F.lit(section).alias("section"), url.alias("url"))

    own = F.concat(F.lit("https://m"), F.col("c_custkey"), F.lit(".example.com/"))
    hub = F.concat(F.lit("https://hub.example.com/"), F.col("c_nationkey"))
    feeds_list = F.array_compact(
        F.array(
            feed("world", F.concat(own, F.lit("world"))),
            F.when(F.col("c_nationkey") % 2 == 0, feed("business", F.concat(own, F.lit("business")))),
            F.when(F.col("c_acctbal") > 5000, feed("hub", hub)),
        )
    )
    return rows.select(
        F.col("c_custkey").alias("pos"),
        F.col("c_name").alias("media_name"),
        _nation_code(1).alias("country"),
        F.when(F.col("c_nationkey") % 3 == 0, "ko").otherwise("en").alias("language"),
        ((F.col("c_custkey") + 1) % 3).cast("int").alias("tier"),
        F.when(F.col("c_acctbal") < 0, False).when(F.col("c_acctbal") > 9000, None).otherwise(True).alias("active"),
        F.array_compact(F.array(_nation_code(1), F.when(F.col("c_nationkey") % 4 == 0, "GLOBAL_GENERAL"))).alias("categories"),
        F.when((F.col("c_acctbal") < 8000) | (F.col("c_acctbal") > 8500), feeds_list).alias("feeds"),
    )


def registry_state(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sources, categories and feeds before the sync."""
    rows = table(spark, folder, "customer").filter(F.col("c_mktsegment") != "BUILDING")
    known_sources = rows.select(
        F.col("c_custkey").alias("source_id"), F.col("c_name").alias("media_name"),
        _nation_code(0).alias("primary_country_code"), F.lit("en").alias("language"),
        (F.col("c_custkey") % 3).cast("int").alias("tier"),
    )
    known_categories = rows.select(
        F.col("c_custkey").alias("source_id"),
        F.explode(F.array(_nation_code(0), F.lit("GLOBAL_ECONOMY"))).alias("category_code"),
    )
    known_feeds = rows.select(
        "c_custkey", "c_nationkey", F.posexplode(F.array(F.lit("world"), F.lit("sport"))).alias("n", "feed_section")
    ).select(
        (F.col("c_custkey") * 2 + F.col("n")).alias("feed_id"),
        F.col("c_custkey").alias("source_id"),
        F.concat(F.lit("https://m"), "c_custkey", F.lit(".example.com/"), "feed_section").alias("feed_url"),
        "feed_section",
        (F.col("c_nationkey") % 5 != 4).alias("is_active"),
        F.lit(200).alias("last_status"),
        F.lit(None).cast("timestamp").alias("last_fetched"),
        F.lit(None).cast("string").alias("last_error"),
    )
    return known_sources, known_categories, known_feeds
