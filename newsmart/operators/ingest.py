"""Ingest run: entries to new articles, feed health and run metrics."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsmart.config import REDIRECT_PREFIX, WIDTHS
from newsmart.functions import text as X
from newsmart.operators.identity import next_id, number_rows
from newsmart.session import cut

HASH_PREFIX = 3
ARTICLE_COLUMNS = (
    "article_id", "feed_id", "source_id", "title", "link", "summary", "published_at", "fetched_at",
    "content_hash", "filter_stage", "filter_decision",
)


@dataclass(frozen=True)
class IngestResult:
    articles: DataFrame
    feed_counts: DataFrame
    run: DataFrame


def entry_rows(entries: DataFrame) -> DataFrame:
    """Valid entries as article rows: stripped, hashed on the full strings, then cut to size."""
    title, link = X.strip(F.coalesce("title", F.lit(""))), X.strip(F.coalesce("link", F.lit("")))
    trimmed = entries.withColumn("title", title).withColumn("link", link)
    valid = trimmed.filter((F.col("title") != "") & (F.col("link") != ""))
    return valid.select(
        "feed_id",
        "source_id",
        "pos",
        F.left("title", F.lit(WIDTHS.title)).alias("title"),
        F.left("link", F.lit(WIDTHS.link)).alias("link"),
        F.left(X.strip_html(F.col("summary")), F.lit(WIDTHS.summary)).alias("summary"),
        X.parse_published(F.col("published"), F.col("updated"), F.col("fetched_at")).alias("published_at"),
        "fetched_at",
        X.content_hash(F.col("title"), F.col("link")).alias("content_hash"),
    )


def unseen_rows(rows: DataFrame, articles: DataFrame) -> DataFrame:
    """First row per content hash (by feed, fetch and position) that no stored article has.

    The per-hash limit runs before the shuffle as well as after it, so a hash repeated very often
    costs one row per task; the anti join then meets unique hashes on both sides.
    """
    order = Window.partitionBy("content_hash").orderBy("feed_id", "fetched_at", "pos")
    firsts = rows.withColumn("_nth", F.row_number().over(order)).filter(F.col("_nth") == 1).drop("_nth")
    return firsts.join(articles.select("content_hash"), "content_hash", "left_anti")


def insert_new(rows: DataFrame, articles: DataFrame) -> DataFrame:
    """New article rows with ids following the highest stored one, in content-hash order."""
    # Numbering reads its input twice, so what is new is found once.
    fresh = cut(unseen_rows(rows, articles))
    numbered = number_rows(
        fresh, "article_id", next_id(articles, "article_id"),
        F.substring("content_hash", 1, HASH_PREFIX), "content_hash",
    )
    pending = numbered.withColumn("filter_stage", F.lit(0)).withColumn("filter_decision", F.lit("pending"))
    return pending.select(*ARTICLE_COLUMNS)


def resolve_links(articles: DataFrame, redirects: DataFrame, prefix: str = REDIRECT_PREFIX) -> DataFrame:
    """Replace redirect links by their stored target.

    Only links starting with ``prefix`` are looked up, and a target that still is a redirect is not
    used. The content hash keeps describing the original link.
    """
    usable = F.contains("from_url", F.lit(prefix)) & ~F.contains("to_url", F.lit(prefix))
    targets = redirects.filter(usable).groupBy("from_url").agg(F.min("to_url").alias("to_url"))
    starts = F.lower(F.left("link", F.lit(len(prefix)))) == prefix.lower()
    # The prefix test ignores case, the lookup does not: a differently cased link stays as it is.
    redirect = starts & F.contains("link", F.lit(prefix))
    # Only redirects are shuffled; all other rows pass by the join.
    asked = F.coalesce(redirect, F.lit(False))
    joined = articles.where(asked).join(targets, F.col("link") == F.col("from_url"), "left")
    found = joined.withColumn("link", F.coalesce(F.left("to_url", F.lit(WIDTHS.link)), "link")).select(*articles.columns)
    return articles.where(~asked).union(found)


def feed_counts(feeds: DataFrame, rows: DataFrame, new_articles: DataFrame) -> DataFrame:
    """Per fetch of a feed: status, error and how many of its rows were new or already known."""
    fetch = ["feed_id", "fetched_at"]
    total = rows.groupBy(*fetch).agg(F.count("*").alias("rows"))
    new = new_articles.groupBy(*fetch).agg(F.count("*").alias("new"))
    joined = feeds.join(total, fetch, "left").join(new, fetch, "left")
    added = F.coalesce("new", F.lit(0))
    return joined.select(
        "feed_id",
        "status",
        "error",
        "fetched_at",
        added.alias("new_articles"),
        (F.coalesce("rows", F.lit(0)) - added).alias("dup_articles"),
    )


def run_metrics(counts: DataFrame) -> DataFrame:
    """One row of run totals."""
    return counts.agg(
        F.count("*").alias("feeds_total"),
        F.count_if(F.col("error").isNull()).alias("feeds_ok"),
        F.count_if(F.col("error").isNotNull()).alias("feeds_failed"),
        F.coalesce(F.sum("new_articles"), F.lit(0)).alias("new_articles"),
        F.coalesce(F.sum("dup_articles"), F.lit(0)).alias("dup_articles"),
    )


def update_feed_health(feeds: DataFrame, counts: DataFrame) -> DataFrame:
    """Feeds with the outcome of their latest fetch; feeds not fetched keep what they had."""
    outcome = F.struct(F.col("status"), F.col("fetched_at"), F.col("error"))
    latest = counts.groupBy("feed_id").agg(F.max_by(outcome, "fetched_at").alias("latest"))
    joined = feeds.join(latest, "feed_id", "left")

    def current(new: str, old: str):
        return F.when(F.col("latest").isNotNull(), F.col(f"latest.{new}")).otherwise(F.col(old)).alias(old)

    kept = [name for name in feeds.columns if name not in ("last_status", "last_fetched", "last_error")]
    return joined.select(
        *kept, current("status", "last_status"), current("fetched_at", "last_fetched"), current("error", "last_error")
    )


def active_feeds(feeds: DataFrame) -> DataFrame:
    return feeds.filter("is_active").select("feed_id", "source_id", "feed_url")


def ingest(
    feeds: DataFrame,
    entries: DataFrame,
    articles: DataFrame,
    redirects: DataFrame | None = None,
    store: Callable[[DataFrame], DataFrame] = cut,
) -> IngestResult:
    """Outcome of one run over parsed payloads (see ``sources.payloads``).

    The article rows and the new articles are both read several times, so each is stored once and
    no payload is parsed again.
    """
    rows = store(entry_rows(entries))
    new = store(insert_new(rows, articles))
    counts = store(feed_counts(feeds, rows.select("feed_id", "fetched_at"), new))
    if redirects is not None:
        new = resolve_links(new, redirects)
    return IngestResult(new, counts, run_metrics(counts))
