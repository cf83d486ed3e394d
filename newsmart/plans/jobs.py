"""Whole jobs: the collect chain and the enrich chain."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmart.config import DEDUP, Dedup
from newsmart.functions.lexicon import Lexicon
from newsmart.functions.taxonomy import TOPICS
from newsmart.operators import enrich, queues
from newsmart.operators.dedup import mark_duplicates
from newsmart.operators.ingest import IngestResult, ingest, update_feed_health
from newsmart.operators.lifecycle import current_articles, with_source
from newsmart.operators.scoring import score_articles
from newsmart.session import Counters, cut
from newsmart.sources.payloads import parse_payloads


@dataclass(frozen=True)
class Collected:
    """Results of one run; ``duplicates`` covers all unmarked articles of the blocks that the run touched."""

    ingest: IngestResult
    filter_results: DataFrame
    duplicates: DataFrame
    feeds: DataFrame | None = None


def _after(stored: DataFrame | None, fresh: DataFrame) -> DataFrame:
    """A stage's result table after a run: the rows of the run and the stored ones it has not replaced."""
    if stored is None:
        return fresh
    return fresh.unionByName(stored.join(fresh.select("article_id"), "article_id", "left_anti"), allowMissingColumns=True)


def collect_chain(
    payloads: DataFrame,
    articles: DataFrame,
    sources: DataFrame,
    lexicon: Lexicon,
    redirects: DataFrame | None = None,
    dedup: Dedup = DEDUP,
    filter_results: DataFrame | None = None,
    duplicates: DataFrame | None = None,
    feeds: DataFrame | None = None,
    counters: Counters | None = None,
) -> Collected:
    """Ingest one run's payloads, score every pending article and mark duplicates among all stored ones.

    ``articles``, ``filter_results`` and ``duplicates`` are the stored tables of earlier runs. All articles without a
    filter result are scored, whether new or not. Near duplicates are looked for in the country and day blocks of the
    articles just scored, with all passed and unmarked stored articles of these blocks. With ``feeds`` the outcome of the
    fetches is written back to them; ``counters`` takes what the stages count. Each stage's result is stored once and read by the later stages.
    """
    parsed = parse_payloads(payloads)
    outcome = ingest(parsed.feeds, parsed.entries, articles, redirects)
    everything = outcome.articles.unionByName(articles, allowMissingColumns=True).drop("filter_stage", "filter_decision")
    pending = everything
    if filter_results is not None:
        pending = everything.join(filter_results.select("article_id"), "article_id", "left_anti")
    scores = cut(score_articles(pending, sources, lexicon, counters=counters))
    current = current_articles(with_source(everything, sources), _after(filter_results, scores), duplicates)
    marks = mark_duplicates(current, settings=dedup, touched_by=scores.select("article_id"), counters=counters)
    health = None if feeds is None else update_feed_health(feeds, outcome.feed_counts)
    return Collected(outcome, scores, marks, health)


@dataclass(frozen=True)
class Enriched:
    triage_results: DataFrame
    rank_results: DataFrame
    briefings: DataFrame


def _of_queue(responses: DataFrame, queue: DataFrame) -> DataFrame:
    """The replies to a queue's requests; ``queue`` is stored and has no more rows than a queue may have."""
    keys = queue.select(F.col("article_id").cast("string").alias("key"))
    return responses.join(F.broadcast(keys), "key", "left_semi").select(*responses.columns)


def enrich_chain(
    articles: DataFrame,
    filter_results: DataFrame,
    duplicates: DataFrame,
    responses: DataFrame,
    briefing_date: str,
    generated_at: Column,
    topics=TOPICS,
    triage_results: DataFrame | None = None,
    rank_results: DataFrame | None = None,
    counters: Counters | None = None,
) -> Enriched:
    """Triage, rank and brief one run's queues from stored replies; ``articles`` carry source columns.

    ``triage_results`` and ``rank_results`` are the stored results of earlier runs: their articles do not enter the
    queues again, and the briefings see them. The results returned are those of this run alone.
    """
    ids = cut(articles.select("article_id"))  # all that the queues need besides the stage tables
    waiting = current_articles(ids, filter_results, duplicates, triage_results)
    queue = cut(queues.triage_queue(waiting).select("article_id"))
    triaged = cut(enrich.triage(queue, _of_queue(responses, queue), counters))
    all_triaged = _after(triage_results, triaged)
    kept = current_articles(ids, filter_results, duplicates, all_triaged, rank_results)
    queue = cut(queues.rank_queue(kept).select("article_id"))
    # Texts only of the queue: a semi-join is taken to the scan, below the joins that make up the articles.
    rows = articles.join(F.broadcast(queue), "article_id", "left_semi")
    ranked = cut(enrich.rank(rows, _of_queue(responses, queue), topics, counters=counters))
    final = current_articles(articles, filter_results, duplicates, all_triaged, _after(rank_results, ranked))
    inputs = enrich.briefing_inputs(final)
    written = enrich.briefings(inputs, responses, briefing_date, generated_at, counters=counters)
    return Enriched(triaged, ranked, written)
