"""Country export: the active articles of each listed country as one nested document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsmart.config import LIMITS
from newsmart.functions import taxonomy
from newsmart.functions import text as X

# Exported countries in display order, with their flags.
EXPORT_COUNTRIES = (
    ("GB", "🇬🇧"), ("US", "🇺🇸"), ("JP", "🇯🇵"), ("HK", "🇭🇰"), ("SG", "🇸🇬"),
    ("CN", "🇨🇳"), ("VN", "🇻🇳"), ("IN", "🇮🇳"), ("MM", "🇲🇲"),
)


def country_dimension(spark: SparkSession, countries: Sequence[tuple[str, str]] = EXPORT_COUNTRIES) -> DataFrame:
    return spark.createDataFrame(
        [(n, cc, flag) for n, (cc, flag) in enumerate(countries)], "ord int, cc string, flag string"
    )


def active_articles(
    articles: DataFrame, countries: Sequence[str], threshold: int = LIMITS.active_score, limit: int = LIMITS.export_articles
) -> DataFrame:
    """Best active articles per listed country, numbered by score, date and id.

    The country list reaches the scan as a filter and the rank limit runs before the shuffle.
    """
    rows = articles.filter(
        F.col("primary_country_code").isin(list(countries))
        & (F.col("ai_score") >= threshold)
        & F.col("duplicate_of").isNull()
    ).select(
        "article_id", F.col("primary_country_code").alias("cc"), "media_name", "title", "link",
        "published_at", "ai_score", "summary_ko", "implication", "topics",
    )
    order = Window.partitionBy("cc").orderBy(
        F.col("ai_score").desc(), F.col("published_at").desc_nulls_last(), "article_id"
    )
    best = rows.withColumn("rn", F.row_number().over(order)).filter(F.col("rn") <= limit)
    return best.select(
        "cc",
        "rn",
        taxonomy.ui_string(F.coalesce("topics", F.array().cast("array<string>"))).alias("c"),
        F.col("media_name").alias("src"),
        X.utc_day(F.col("published_at")).alias("d"),
        F.col("title").alias("t"),
        X.or_empty(F.col("summary_ko")).alias("q"),
        X.or_empty(F.col("implication")).alias("k"),
        F.col("link").alias("u"),
        F.col("ai_score").alias("score"),
    )


def export_countries(
    articles: DataFrame,
    countries: Sequence[tuple[str, str]] = EXPORT_COUNTRIES,
    threshold: int = LIMITS.active_score,
    limit: int = LIMITS.export_articles,
) -> DataFrame:
    """``ord, cc, flag, status, count, articles[]``; countries without articles are listed too."""
    best = active_articles(articles, [cc for cc, _ in countries], threshold, limit)
    card = F.struct("rn", "c", "src", "d", "t", "q", "k", "u", "score")
    cards = best.groupBy("cc").agg(F.array_sort(F.collect_list(card)).alias("cards"))
    joined = country_dimension(articles.sparkSession, countries).join(cards, "cc", "left")
    listed = F.transform(
        "cards", lambda a: F.struct(*[a[name].alias(name) for name in ("c", "src", "d", "t", "q", "k", "u", "score")])
    )
    none = F.array().cast("array<struct<c:string,src:string,d:string,t:string,q:string,k:string,u:string,score:int>>")
    shaped = joined.select("ord", "cc", "flag", F.coalesce(listed, none).alias("articles"))
    count = F.size("articles")
    return shaped.select(
        "ord", "cc", "flag", F.when(count > 0, "ACTIVE").otherwise("SOURCE WATCH").alias("status"),
        count.alias("count"), "articles",
    )


def export_document(countries: DataFrame, generated_at: Column, threshold: int = LIMITS.active_score) -> DataFrame:
    """One row: the whole document. Its size is bounded by the country list times the article limit."""
    row = F.struct("ord", "cc", "flag", "status", "count", "articles")
    nested = countries.agg(F.array_sort(F.collect_list(row)).alias("rows"))
    listed = F.transform(
        "rows", lambda r: F.struct(*[r[name].alias(name) for name in ("cc", "flag", "status", "count", "articles")])
    )
    return nested.select(
        generated_at.alias("generated_at"), F.lit(threshold).alias("active_threshold"), listed.alias("countries")
    )
