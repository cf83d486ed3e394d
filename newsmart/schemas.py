"""Explicit schemas of the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMAS = {
    "sources": "source_id bigint, media_name string, primary_country_code string, language string, tier int",
    "source_categories": "source_id bigint, category_code string",
    "feeds": "feed_id bigint, source_id bigint, feed_url string, feed_section string, is_active boolean,"
             " last_status int, last_fetched timestamp, last_error string",
    "feed_payloads": "feed_id bigint, source_id bigint, fetched_at timestamp, status int, error string, body string",
    "articles": "article_id bigint, feed_id bigint, source_id bigint, title string, link string, summary string,"
                " published_at timestamp, fetched_at timestamp, content_hash string, filter_stage int,"
                " filter_decision string",
    "filter_results": "article_id bigint, filter_stage int, filter_decision string, filter_reason string,"
                      " filter_score int",
    "duplicates": "article_id bigint, duplicate_of bigint",
    "triage_results": "article_id bigint, decision string, reject_reason string",
    "rank_results": "article_id bigint, ai_score int, summary_ko string, topics array<string>, implication string,"
                    " model string",
    "requests": "stage string, key string, prompt string",
    "responses": "stage string, key string, raw_text string, model string",
    "redirects": "from_url string, to_url string",
    "fetch_runs": "run_id bigint, started_at timestamp, finished_at timestamp, feeds_total bigint, feeds_ok bigint,"
                  " feeds_failed bigint, new_articles bigint, dup_articles bigint",
    "briefings": "cc string, briefing_date date, briefing_type string, generated_at timestamp, summary string,"
                 " issues array<string>, outlook string, keywords array<string>, key_stat string, model string,"
                 " article_count int, source_articles array<string>",
    "registry": "media_name string, country string, language string, tier int, active boolean,"
                " categories array<string>, feeds array<struct<section: string, url: string>>",
}


def conform(df: DataFrame, table: str) -> DataFrame:
    """``df`` with exactly the columns and types of a stored table; missing columns become NULL."""
    columns = [column.strip().split(" ", 1) for column in _split(SCHEMAS[table])]
    return df.select(
        *[(F.col(name) if name in df.columns else F.lit(None)).cast(kind).alias(name) for name, kind in columns]
    )


def _split(schema: str) -> list[str]:
    parts, depth, start = [], 0, 0
    for place, char in enumerate(schema):
        depth += {"<": 1, ">": -1}.get(char, 0)
        if char == "," and depth == 0:
            parts.append(schema[start:place])
            start = place + 1
    return [*parts, schema[start:]]
