"""Typed job settings: score weights, thresholds and per-run limits."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Weights:
    """Points of the relevance score and the two pass marks."""

    title_finance: int = 5
    body_finance: int = 3
    title_country: int = 2
    body_country: int = 1
    exclusion: int = -4
    pass_mark: int = 3
    body_only_pass_mark: int = 5
    official: int = 99


@dataclass(frozen=True)
class Limits:
    """Row limits that are part of a feature (queues, top-k reports, nested exports)."""

    triage_queue: int = 300
    rank_queue: int = 150
    active_score: int = 60
    briefing_articles: int = 25
    export_articles: int = 20
    pass_reasons: int = 20
    exclusion_reasons: int = 10
    rejected_sample: int = 15
    recent: int = 20
    topics: int = 3


@dataclass(frozen=True)
class Widths:
    """Character widths that are part of the stored formats; a caller may lift them."""

    title: int = 1000
    link: int = 2000
    summary: int = 4000
    triage_prompt: int = 600
    rank_prompt: int = 1200
    briefing_prompt: int = 160
    reject_reason: int = 300
    rank_summary: int = 1500
    implication: int = 1000
    report_error: int = 60
    report_title: int = 70
    report_reason: int = 40


@dataclass(frozen=True)
class Dedup:
    """Near-duplicate settings.

    ``chunk_rows`` bounds how many undecided titles of one block the first wave resolves together in one task;
    ``slot_rows`` bounds how many of the remaining titles one task compares with them. Both double with every wave, up to
    ``most_rows``.
    ``hot_copies`` is the number of rows per exact title above which the join back is salted.
    """

    threshold: float = 0.75
    chunk_rows: int = 8192
    slot_rows: int = 8192
    most_rows: int = 8192
    hot_copies: int = 1_000_000
    hot_titles_broadcast: int = 50_000


WEIGHTS = Weights()
LIMITS = Limits()
WIDTHS = Widths()
DEDUP = Dedup()

GLOBAL_CATEGORIES = ("GLOBAL_GENERAL", "GLOBAL_ECONOMY")
REDIRECT_PREFIX = "https://news.google.com/"
