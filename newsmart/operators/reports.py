"""Availability and filter reports, counters and the recent list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmart.config import GLOBAL_CATEGORIES, LIMITS, WIDTHS
from newsmart.functions import text as X


def _is(decision: str):
    return F.col("filter_decision") == decision


# -- availability ------------------------------------------------------------------------------------
def feed_availability(feeds: DataFrame, sources: DataFrame, articles: DataFrame) -> DataFrame:
    """One row per active feed. Articles are counted per feed before anything is joined."""
    counts = articles.groupBy("feed_id").agg(
        F.count("*").alias("article_count"), F.max("published_at").alias("last_published")
    )
    rows = feeds.filter("is_active").join(sources, "source_id").join(counts, "feed_id", "left")
    return rows.select(
        "feed_id", "media_name", "primary_country_code", "tier", "feed_section", "feed_url", "last_status",
        "last_error", F.coalesce("article_count", F.lit(0)).alias("article_count"), "last_published",
    ).orderBy("primary_country_code", "media_name", "feed_section", "feed_url")


def feed_availability_display(report: DataFrame) -> DataFrame:
    """Display form: '-' for a missing or zero status and a missing date, errors cut to 60 characters."""
    status = F.when(F.coalesce("last_status", F.lit(0)) == 0, "-").otherwise(F.col("last_status").cast("string"))
    last = F.coalesce(F.date_format("last_published", "yyyy-MM-dd HH:mm:ss"), F.lit("-"))
    return report.withColumns({
        "last_status": status,
        "last_published": last,
        "last_error": F.left(X.or_empty(F.col("last_error")), F.lit(WIDTHS.report_error)),
    })


def country_availability(sources: DataFrame, feeds: DataFrame, articles: DataFrame) -> DataFrame:
    """Per country: media, active feeds, feeds in and out of the 2xx band, articles.

    A source without an active feed still counts as a medium, and once as a bad feed.
    """
    counts = articles.groupBy("feed_id").agg(F.count("*").alias("article_count"))
    active = feeds.filter("is_active").select("source_id", "feed_id", "last_status")
    rows = sources.join(active, "source_id", "left").join(counts, "feed_id", "left")
    ok = F.coalesce(F.col("last_status").between(200, 299), F.lit(False))
    return (
        rows.groupBy(F.col("primary_country_code").alias("country"))
        .agg(
            F.count_distinct("source_id").alias("media_count"),
            F.count_distinct("feed_id").alias("feed_count"),
            F.sum(F.when(ok, 1).otherwise(0)).alias("feeds_ok"),
            F.sum(F.when(ok, 0).otherwise(1)).alias("feeds_bad"),
            F.coalesce(F.sum("article_count"), F.lit(0)).alias("articles"),
        )
        .orderBy("country")
    )


# -- filter report -----------------------------------------------------------------------------------
def filter_totals(articles: DataFrame) -> DataFrame:
    """Totals by decision with shares, and the number of marked duplicates."""
    totals = articles.agg(
        F.count("*").alias("total"),
        F.count_if(_is("passed")).alias("passed"),
        F.count_if(_is("rejected")).alias("rejected"),
        F.count_if(_is("pending")).alias("pending"),
        F.count("duplicate_of").alias("total_dups"),
    )
    shares = {f"{name}_pct": X.percent(F.col(name), F.col("total")) for name in ("passed", "rejected", "pending")}
    return totals.withColumns(shares)


def filter_global_categories(
    articles: DataFrame, categories: DataFrame, codes: Sequence[str] = GLOBAL_CATEGORIES
) -> DataFrame:
    """Totals over the sources of the global categories; a semi join keeps every article single."""
    wanted = categories.filter(F.col("category_code").isin(list(codes))).select("source_id")
    rows = articles.join(wanted, "source_id", "left_semi")
    return rows.agg(
        F.count("*").alias("total"),
        F.count_if(_is("passed")).alias("passed"),
        F.count_if(_is("rejected")).alias("rejected"),
    )


def filter_by_country(articles: DataFrame) -> DataFrame:
    """Per country: collected, passed, rejected, duplicates and pass rate."""
    totals = articles.groupBy(F.col("primary_country_code").alias("country")).agg(
        F.count("*").alias("total"),
        F.count_if(_is("passed")).alias("passed"),
        F.count_if(_is("rejected")).alias("rejected"),
        F.count("duplicate_of").alias("dups"),
    )
    rated = totals.withColumn("pass_rate", X.percent(F.col("passed"), F.col("total")))
    return rated.orderBy(F.col("passed").desc(), "country")


def _top_reasons(rows: DataFrame, limit: int) -> DataFrame:
    counted = rows.groupBy("filter_reason").agg(F.count("*").alias("cnt"))
    return counted.orderBy(F.col("cnt").desc(), "filter_reason").limit(limit)


def top_pass_reasons(articles: DataFrame, limit: int = LIMITS.pass_reasons) -> DataFrame:
    return _top_reasons(articles.filter(_is("passed") & (F.col("filter_stage") == 2)), limit)


def top_exclusions(articles: DataFrame, limit: int = LIMITS.exclusion_reasons) -> DataFrame:
    return _top_reasons(articles.filter(_is("rejected") & F.col("filter_reason").startswith("excl:")), limit)


def rejected_sample(articles: DataFrame, seed: int, limit: int = LIMITS.rejected_sample) -> DataFrame:
    """Random rejected articles for inspection: those with the least digest of seed and id, whatever the layout."""
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.col("article_id").cast("string")))
    return articles.filter(_is("rejected")).orderBy(draw, "article_id").limit(limit).select(
        "media_name",
        F.left(X.or_empty(F.col("title")), F.lit(WIDTHS.report_title)).alias("title"),
        F.left(X.or_empty(F.col("filter_reason")), F.lit(WIDTHS.report_reason)).alias("filter_reason"),
    )


# -- lists and counters ------------------------------------------------------------------------------
def recent_articles(articles: DataFrame, limit: int = LIMITS.recent) -> DataFrame:
    newest = articles.orderBy(F.col("fetched_at").desc_nulls_last(), "article_id").limit(limit)
    return newest.select(
        "article_id",
        "filter_decision",
        "media_name",
        F.coalesce(F.date_format("published_at", "yyyy-MM-dd HH:mm:ss"), F.lit("-")).alias("published_at"),
        F.left("title", F.lit(WIDTHS.report_title)).alias("title"),
    )


def filter_counters(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count("*").alias("total"),
        F.count_if(_is("passed")).alias("passed"),
        F.count_if(_is("rejected")).alias("rejected"),
    )


def dedup_counters(marked: DataFrame) -> DataFrame:
    return marked.agg(F.count("*").alias("checked"), F.count("duplicate_of").alias("duplicates"))


def triage_counters(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("decision") == "keep").alias("keep"),
        F.count_if(F.col("decision") == "drop").alias("drop"),
    )


def rank_counters(results: DataFrame, threshold: int = LIMITS.active_score) -> DataFrame:
    return results.agg(
        F.count("*").alias("ranked"), F.count_if(F.col("ai_score") >= threshold).alias("active")
    )


def briefing_counters(countries: DataFrame, written: DataFrame) -> DataFrame:
    """Countries looked at (with or without articles left) and briefings written."""
    looked_at = countries.select(F.lit(1).alias("seen"), F.lit(0).alias("wrote"))
    wrote = written.select(F.lit(0).alias("seen"), F.lit(1).alias("wrote"))
    return looked_at.unionByName(wrote).agg(
        F.coalesce(F.sum("seen"), F.lit(0)).alias("countries"), F.coalesce(F.sum("wrote"), F.lit(0)).alias("written")
    )


def registry_counts(sources: DataFrame, feeds: DataFrame) -> DataFrame:
    return sources.agg(F.count("*").alias("sources")).withColumn(
        "feeds", feeds.select(F.count("*")).scalar()
    )
