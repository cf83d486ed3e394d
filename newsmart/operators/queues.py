"""Work queues of the enrichment stages.

A stage takes the highest-scored articles that have no result yet. NULLs sort last; the article id
breaks ties. ``orderBy().limit()`` runs as a per-task top-k followed by one merge of the survivors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmart.config import LIMITS


def _top(rows: DataFrame, limit: int | None, default: int) -> DataFrame:
    return rows.orderBy(F.col("filter_score").desc_nulls_last(), "article_id").limit(limit or default)


def untriaged(articles: DataFrame) -> DataFrame:
    return articles.filter(
        (F.col("filter_decision") == "passed") & F.col("duplicate_of").isNull() & F.col("triage_decision").isNull()
    )


def unranked(articles: DataFrame) -> DataFrame:
    """Kept articles without a score. Duplicates are not excluded here."""
    return articles.filter((F.col("triage_decision") == "keep") & F.col("ai_score").isNull())


def triage_queue(articles: DataFrame, limit: int | None = None) -> DataFrame:
    return _top(untriaged(articles), limit, LIMITS.triage_queue)


def rank_queue(articles: DataFrame, limit: int | None = None) -> DataFrame:
    return _top(unranked(articles), limit, LIMITS.rank_queue)
