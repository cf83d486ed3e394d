"""Registry sync: sources, their categories and their feeds follow the registry."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmart.operators.identity import next_id, number_rows

POSITIONS_PER_BUCKET = 1024


@dataclass(frozen=True)
class SyncResult:
    sources: DataFrame
    categories: DataFrame
    feeds: DataFrame


def _complete(registry: DataFrame) -> DataFrame:
    """Registry rows with the defaults of missing fields: active, no categories, no feeds."""
    no_feeds = F.array().cast("array<struct<section:string,url:string>>")
    return registry.select(
        "pos",
        "media_name",
        "country",
        "language",
        "tier",
        F.coalesce("active", F.lit(True)).alias("active"),
        F.coalesce("categories", F.array().cast("array<string>")).alias("categories"),
        F.coalesce("feeds", no_feeds).alias("feeds"),
    )


def _bucket(position):
    return F.floor(position / POSITIONS_PER_BUCKET)


def _desired_sources(registry: DataFrame) -> DataFrame:
    """One row per media name; when a name is listed twice the last listing wins."""
    fields = F.struct("country", "language", "tier", "categories")
    last = registry.groupBy("media_name").agg(
        F.max_by(fields, "pos").alias("last"), F.max("pos").alias("last_pos"), F.min("pos").alias("first_pos")
    )
    return last.select("media_name", "last.*", "last_pos", "first_pos")


def _desired_feeds(registry: DataFrame, desired: DataFrame) -> DataFrame:
    """One row per URL listed by an active entry; the last listing owns it.

    The URL is active unless a later entry of the same medium no longer lists it.
    """
    listed = registry.filter("active").select("pos", "media_name", F.posexplode("feeds").alias("feed_pos", "feed"))
    place = F.struct("pos", "feed_pos")
    owner = F.struct("media_name", F.col("feed.section").alias("section"), "pos")
    urls = listed.groupBy(F.col("feed.url").alias("feed_url")).agg(
        F.max_by(owner, place).alias("owner"), F.min(place).alias("first_place")
    )
    return (
        urls.select("feed_url", "owner.*", "first_place")
        .join(desired.select("media_name", "last_pos"), "media_name")
        .select("feed_url", "media_name", "section", "first_place", (F.col("pos") == F.col("last_pos")).alias("listed"))
    )


def sync_registry(registry: DataFrame, sources: DataFrame, categories: DataFrame, feeds: DataFrame) -> SyncResult:
    """New state of the three tables. Re-running with the same registry changes nothing.

    Sources are matched by name and keep their id, feeds are matched by URL and keep their id and
    health. Nothing is deleted: feeds no longer listed are switched off.
    """
    registry = _complete(registry)
    desired = _desired_sources(registry)
    merged = sources.select(
        "source_id",
        "media_name",
        F.col("primary_country_code").alias("old_country"),
        F.col("language").alias("old_language"),
        F.col("tier").alias("old_tier"),
    ).join(desired.drop("categories"), "media_name", "full_outer")
    state = merged.select(
        "source_id",
        "media_name",
        F.coalesce("country", "old_country").alias("primary_country_code"),
        F.coalesce("language", "old_language").alias("language"),
        F.coalesce("tier", "old_tier").alias("tier"),
        "first_pos",
    )
    added = number_rows(
        state.filter(F.col("source_id").isNull()).drop("source_id"),
        "source_id", next_id(sources, "source_id"), _bucket(F.col("first_pos")), "first_pos",
    )
    synced = state.filter(F.col("source_id").isNotNull()).unionByName(added).drop("first_pos")

    ids = synced.select("source_id", "media_name")
    listed = desired.join(ids, "media_name")
    replaced = listed.select("source_id", F.explode(F.array_distinct("categories")).alias("category_code"))
    kept = categories.join(listed.select("source_id"), "source_id", "left_anti")

    wanted = _desired_feeds(registry, desired).join(ids.withColumnRenamed("source_id", "new_source"), "media_name")
    any_entry = registry.select((F.count("*") > 0).alias("any")).scalar()
    feed_state = feeds.join(wanted.drop("media_name"), "feed_url", "full_outer").select(
        "feed_id",
        F.coalesce("new_source", "source_id").alias("source_id"),
        "feed_url",
        F.when(F.col("new_source").isNotNull(), F.col("section")).otherwise(F.col("feed_section")).alias("feed_section"),
        F.coalesce("listed", F.col("is_active") & ~any_entry).alias("is_active"),
        "last_status",
        "last_fetched",
        "last_error",
        "first_place",
    )
    new_feeds = number_rows(
        feed_state.filter(F.col("feed_id").isNull()).drop("feed_id"),
        "feed_id", next_id(feeds, "feed_id"), _bucket(F.col("first_place.pos")), "first_place",
    )
    synced_feeds = feed_state.filter(F.col("feed_id").isNotNull()).unionByName(new_feeds).drop("first_place")
    return SyncResult(synced, kept.unionByName(replaced), synced_feeds)
