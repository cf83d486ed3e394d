"""Stored feed payloads (RSS 2.0, RSS 1.0 and Atom) to entries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmart.session import cut

_ITEM = (
    "STRUCT<title: STRING, link: STRING, description: STRING, summary: STRING, `content:encoded`: STRING,"
    " pubDate: STRING, published: STRING, updated: STRING, `dc:date`: STRING,"
    " guid: STRUCT<_VALUE: STRING, _isPermaLink: STRING>, _broken: STRING>"
)
# Texts of an entry are strings: markup inside them (type="xhtml") is kept as it is written.
_ENTRY = (
    "STRUCT<title: STRING, link: ARRAY<STRUCT<_href: STRING, _rel: STRING>>, summary: STRING, content: STRING,"
    " published: STRING, updated: STRING, _broken: STRING>"
)
_FEED = f"STRUCT<channel: STRUCT<item: ARRAY<{_ITEM}>>, item: ARRAY<{_ITEM}>, entry: ARRAY<{_ENTRY}>, _broken: STRING>"
_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}

_FIELDS = "struct<title:string,link:string,summary:string,published:string,updated:string>"
_BARE_AMPERSAND = r"&(?!(?:amp|lt|gt|quot|apos|#[0-9]+|#x[0-9a-fA-F]+);)"
_XHTML = r"(?s)^\s*<(?:\w+:)?div(?:\s[^>]*)?>(.*)</(?:\w+:)?div\s*>\s*$"


@dataclass(frozen=True)
class Parsed:
    """``feeds``: one row per payload with status and error. ``entries``: one row per entry."""

    feeds: DataFrame
    entries: DataFrame


def _parse(body: Column, schema: str = _FEED) -> Column:
    return F.from_xml(body, schema, _OPTIONS)


def _rescued(body: Column, tag: str, schema: str) -> Column:
    """The complete elements of a broken feed that can be read, each by itself.

    Ampersands that begin no XML entity, which break most feeds, are taken as text in elements that cannot be read
    otherwise.
    """
    pieces = F.regexp_extract_all(body, F.lit(rf"(?s)<{tag}(?=[\s>]).*?</{tag}\s*>"), F.lit(0))
    tried = F.transform(pieces, lambda piece: F.struct(piece.alias("piece"), _parse(piece, schema).alias("read")))

    def again(one: Column) -> Column:
        escaped = F.regexp_replace(one["piece"], _BARE_AMPERSAND, "&amp;")
        return F.when(one["read"]["_broken"].isNull(), one["read"]).otherwise(_parse(escaped, schema))

    return F.filter(F.transform(tried, again), lambda read: read.isNotNull() & read["_broken"].isNull())


def _item_fields(item: Column) -> Column:
    permalink = F.when(F.coalesce(item["guid"]["_isPermaLink"], F.lit("true")) != "false", item["guid"]["_VALUE"])

    def filled(name: str) -> Column:
        return F.nullif(item[name], F.lit(""))

    return F.struct(
        item["title"].alias("title"),
        F.coalesce(item["link"], permalink).alias("link"),
        F.coalesce(filled("summary"), filled("description"), item["content:encoded"]).alias("summary"),
        F.coalesce(item["pubDate"], item["published"], item["dc:date"]).alias("published"),
        item["updated"].alias("updated"),
    )


def _entry_fields(entry: Column) -> Column:
    links = F.filter(entry["link"], lambda link: F.coalesce(link["_rel"], F.lit("alternate")) == "alternate")

    def inner(name: str) -> Column:
        return F.regexp_replace(entry[name], _XHTML, "$1")

    return F.struct(
        inner("title").alias("title"),
        F.get(links, F.lit(0))["_href"].alias("link"),
        F.coalesce(F.nullif(inner("summary"), F.lit("")), inner("content")).alias("summary"),
        entry["published"].alias("published"),
        entry["updated"].alias("updated"),
    )


def parse_payloads(payloads: DataFrame, store: Callable[[DataFrame], DataFrame] | None = cut) -> Parsed:
    """Parse stored fetch results ``(feed_id, source_id, fetched_at, status, error, body)``.

    A stored error or a status of 400 and above fails the feed; so does a body that cannot be parsed
    and yields no entry. A broken body still gives its complete items and entries, each read by itself.
    A text without description or summary has its full content as summary. The parsed rows are
    stored once, and both results read them; with ``store=None``, for a caller of one result, they are not.
    """
    failed = F.coalesce(
        F.col("error"), F.when(F.col("status") >= 400, F.concat(F.lit("http "), F.col("status").cast("string")))
    )
    first = payloads.withColumn("_failed", failed).withColumn(
        "_xml", _parse(F.when(F.col("_failed").isNull(), F.col("body")))
    )
    broken = F.col("_failed").isNull() & (F.col("_xml._broken").isNotNull() | F.col("_xml").isNull())
    body = F.when(F.col("_broken"), F.col("body"))
    second = first.withColumn("_broken", broken).select(
        "*", _rescued(body, "item", _ITEM).alias("_items"), _rescued(body, "entry", _ENTRY).alias("_atoms")
    )
    empty = F.expr(f"cast(array() as array<{_FIELDS}>)")

    def listed(items: str, fields) -> Column:
        return F.coalesce(F.transform(F.col(items), fields), empty)

    entries = F.concat(
        listed("_xml.channel.item", _item_fields),
        listed("_xml.item", _item_fields),
        listed("_xml.entry", _entry_fields),
        listed("_items", _item_fields),
        listed("_atoms", _entry_fields),
    )
    unusable = F.col("_broken") & (F.size("_entries") == 0)
    parsed = second.withColumn("_entries", entries).select(
        "feed_id",
        "source_id",
        "fetched_at",
        "status",
        F.coalesce(F.col("_failed"), F.when(unusable, "unparsable body")).alias("error"),
        F.size("_entries").alias("entry_count"),
        F.col("_entries").alias("entries"),
    )
    parsed = store(parsed) if store else parsed
    # The optimizer would derive a filter on the size of the entries from an inner explode, and parse once more for it.
    exploded = F.posexplode_outer("entries").alias("pos", "entry")
    rows = parsed.select("feed_id", "source_id", "fetched_at", exploded).filter(F.col("pos").isNotNull())
    return Parsed(parsed.drop("entries"), rows.select("feed_id", "source_id", "pos", "entry.*", "fetched_at"))
