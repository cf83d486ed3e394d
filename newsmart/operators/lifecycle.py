"""The current article: raw rows with the results of every stage joined on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_source(articles: DataFrame, sources: DataFrame) -> DataFrame:
    """Articles with the columns of their source. The join strategy follows the measured sizes."""
    extra = [name for name in sources.columns if name == "source_id" or name not in articles.columns]
    return articles.join(sources.select(*extra), "source_id")


def current_articles(
    articles: DataFrame,
    filter_results: DataFrame | None = None,
    duplicates: DataFrame | None = None,
    triage_results: DataFrame | None = None,
    rank_results: DataFrame | None = None,
) -> DataFrame:
    """Left-join the stage tables; a missing table gives NULL columns of its stage.

    All joins share the key ``article_id``, so the articles are shuffled once.
    """
    out = articles
    if filter_results is None:
        out = out.withColumns({
            "filter_stage": F.lit(0), "filter_decision": F.lit("pending"),
            "filter_reason": F.lit(None).cast("string"), "filter_score": F.lit(None).cast("int"),
        })
    else:
        out = out.join(filter_results, "article_id", "left").withColumns({
            "filter_stage": F.coalesce("filter_stage", F.lit(0)),
            "filter_decision": F.coalesce("filter_decision", F.lit("pending")),
        })
    if duplicates is None:
        out = out.withColumn("duplicate_of", F.lit(None).cast("long"))
    else:
        out = out.join(duplicates.select("article_id", "duplicate_of"), "article_id", "left")
    if triage_results is None:
        out = out.withColumns({
            "triage_decision": F.lit(None).cast("string"), "reject_reason": F.lit(None).cast("string")
        })
    else:
        out = out.join(triage_results.withColumnRenamed("decision", "triage_decision"), "article_id", "left")
    if rank_results is None:
        return out.withColumns({
            "ai_score": F.lit(None).cast("int"), "summary_ko": F.lit(None).cast("string"),
            "topics": F.lit(None).cast("array<string>"), "implication": F.lit(None).cast("string"),
            "model": F.lit(None).cast("string"),
        })
    return out.join(rank_results, "article_id", "left")
