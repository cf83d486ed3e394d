"""Triage, rank and briefing around stored model replies.

Each stage is: queue -> requests table -> replies table (filled by a completer or from outside) ->
typed results. Replies are joined by stage and key, so a stage can be repeated without new calls.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsmart.config import LIMITS, WIDTHS
from newsmart.functions import offices, replies, taxonomy
from newsmart.functions import text as X
from newsmart.session import Counters, counted

Completer = Callable[[str, str, int, float], str]

TRIAGE, RANK, BRIEFING = "triage", "rank", "briefing"
#: The field of a rank reply that holds what an article means for the reader's institution.
IMPLICATION_FIELD = "implication"
MAX_TOKENS = {TRIAGE: 200, RANK: 600, BRIEFING: 900}


# -- completers ------------------------------------------------------------------------------------
def _stub(_system: str, _user: str, _max_tokens: int = 1024, _temperature: float = 0.0) -> str:
    return "{}"


COMPLETERS: dict[str, Callable[[str], tuple[str, Completer]]] = {"stub": lambda role: (f"stub:{role}", _stub)}


def get_completer(role: str = "smart", name: str = "stub") -> tuple[str, Completer]:
    """Model id and completion function by name; register further ones in ``COMPLETERS``."""
    try:
        return COMPLETERS[name.lower()](role)
    except KeyError:
        raise ValueError(f"unknown completer {name!r}, known: {sorted(COMPLETERS)}") from None


def complete(requests: DataFrame, completer: Completer, model: str, system: str = "") -> DataFrame:
    """Replies for a requests table; the calls run in the tasks, one Arrow batch at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [
                completer(system, prompt, MAX_TOKENS.get(stage, 1024), 0.0)
                for stage, prompt in zip(batch["stage"], batch["prompt"])
            ]
            yield batch[["stage", "key"]].assign(raw_text=texts, model=model)

    return requests.select("stage", "key", "prompt").mapInPandas(
        run, "stage string, key string, raw_text string, model string"
    )


def _replies(responses: DataFrame, stage: str) -> DataFrame:
    """One reply per key. A call that was retried may have several; the last by text stands for them."""
    single = responses.filter(F.col("stage") == stage).groupBy("key").agg(F.max(F.struct("raw_text", "model")).alias("last"))
    return single.select(
        F.col("key").alias("_key"), "last.model", replies.reply_object(F.col("last.raw_text")).alias("reply")
    )


def _with_reply(queue: DataFrame, responses: DataFrame, stage: str, how: str = "left") -> DataFrame:
    """Queue rows with ``reply`` (VARIANT object or NULL) and the reply's model."""
    own = _replies(responses, stage)
    return queue.join(own, F.col("article_id").cast("string") == F.col("_key"), how).drop("_key")


# -- triage ----------------------------------------------------------------------------------------
def triage_requests(queue: DataFrame) -> DataFrame:
    prompt = F.concat(
        F.lit("[국가:"), "primary_country_code", F.lit("] 제목: "), "title",
        F.lit("\n요약: "), F.left(X.or_empty(F.col("summary")), F.lit(WIDTHS.triage_prompt)),
    )
    return queue.select(
        F.lit(TRIAGE).alias("stage"), F.col("article_id").cast("string").alias("key"), prompt.alias("prompt")
    )


def triage(queue: DataFrame, responses: DataFrame, counters: Counters | None = None) -> DataFrame:
    """``article_id, decision, reject_reason``; without a usable reply the article is kept."""
    joined = _with_reply(queue.select("article_id"), responses, TRIAGE)
    keep = replies.keep_flag(F.col("reply"))
    reason = F.left(X.or_empty(replies.text_of(F.col("reply"), "reason")), F.lit(WIDTHS.reject_reason))
    flagged = joined.select("article_id", keep.alias("keep"), reason.alias("reason"))
    results = flagged.select(
        "article_id",
        F.when(F.col("keep"), "keep").otherwise("drop").alias("decision"),
        F.when(~F.col("keep"), F.col("reason")).alias("reject_reason"),
    )
    return counted(
        results, TRIAGE, counters, total=F.count(F.lit(1)), keep=F.count_if(F.col("decision") == "keep"),
        drop=F.count_if(F.col("decision") == "drop"),
    )


# -- rank ------------------------------------------------------------------------------------------
def rank_requests(
    queue: DataFrame, owner: str = "", network: Sequence[offices.Office] = offices.OFFICES
) -> DataFrame:
    prompt = F.concat(
        F.lit("[거점 맥락: "), offices.context_for(F.col("primary_country_code"), network, owner), F.lit("]\n매체: "),
        "media_name", F.lit("  국가: "), "primary_country_code", F.lit("\n제목: "), "title",
        F.lit("\n요약: "), F.left(X.or_empty(F.col("summary")), F.lit(WIDTHS.rank_prompt)),
    )
    return queue.select(
        F.lit(RANK).alias("stage"), F.col("article_id").cast("string").alias("key"), prompt.alias("prompt")
    )


def rank(
    queue: DataFrame,
    responses: DataFrame,
    topics: Sequence[taxonomy.Topic] = taxonomy.TOPICS,
    default_model: str = "stub:smart",
    implication_field: str = IMPLICATION_FIELD,
    counters: Counters | None = None,
) -> DataFrame:
    """Score, summary, topics and implication per queued article.

    Topics of the reply are validated; where none is left the seed words of title and summary decide.
    """
    wanted = queue.select("article_id", "title", "summary")
    joined = _with_reply(wanted, responses, RANK)
    reply = F.col("reply")
    fields = joined.select(
        "article_id",
        replies.score_value(reply).alias("ai_score"),
        F.left(replies.text_or_empty(reply, "summary_ko"), F.lit(WIDTHS.rank_summary)).alias("summary_ko"),
        taxonomy.validate(replies.string_list(reply, "topics"), topics).alias("_named"),
        F.left(replies.text_or_empty(reply, implication_field), F.lit(WIDTHS.implication)).alias("implication"),
        F.coalesce("model", F.lit(default_model)).alias("model"),
        F.concat("title", F.lit(" "), X.or_empty(F.col("summary"))).alias("_text"),
    )
    seeded = taxonomy.seed_topics(F.col("_text"), topics)
    results = fields.select(
        "article_id",
        "ai_score",
        "summary_ko",
        F.when(F.size("_named") > 0, F.col("_named")).otherwise(seeded).alias("topics"),
        "implication",
        "model",
    )
    return counted(
        results, RANK, counters, ranked=F.count(F.lit(1)), active=F.count_if(F.col("ai_score") >= LIMITS.active_score)
    )


# -- briefing --------------------------------------------------------------------------------------
def ranked_countries(articles: DataFrame) -> DataFrame:
    """Countries with a scored article, duplicates included."""
    scored = articles.filter(F.col("ai_score").isNotNull())
    return scored.select(F.col("primary_country_code").alias("cc")).distinct()


def briefing_inputs(
    articles: DataFrame,
    countries: Sequence[str] | None = None,
    limit: int = LIMITS.briefing_articles,
    owner: str = "",
    network: Sequence[offices.Office] = offices.OFFICES,
) -> DataFrame:
    """Per country the best-scored articles as one request: prompt, links and article count.

    The rank limit is applied inside every task before the shuffle, so a country holding a third of
    all articles still sends ``limit`` rows per task.
    """
    rows = articles.filter(F.col("ai_score").isNotNull() & F.col("duplicate_of").isNull())
    if countries:
        rows = rows.filter(F.col("primary_country_code").isin(list(countries)))
    slim = rows.select("article_id", F.col("primary_country_code").alias("cc"), "title", "summary_ko", "ai_score", "link")
    order = Window.partitionBy("cc").orderBy(F.col("ai_score").desc(), "article_id")
    best = slim.withColumn("rn", F.row_number().over(order)).filter(F.col("rn") <= limit)
    bullet = F.concat(
        F.lit("- ("), F.col("ai_score").cast("string"), F.lit(") "), "title", F.lit(" :: "),
        F.left(X.or_empty(F.col("summary_ko")), F.lit(WIDTHS.briefing_prompt)),
    )
    listed = best.groupBy("cc").agg(
        F.array_sort(F.collect_list(F.struct("rn", bullet.alias("bullet"), "link"))).alias("items")
    )
    prompt = F.concat(
        F.lit("국가: "), "cc", F.lit(" ("), offices.context_for(F.col("cc"), network, owner), F.lit(")\n기사 목록:\n"),
        F.array_join(F.transform("items", lambda item: item["bullet"]), "\n"),
    )
    return listed.select(
        "cc",
        prompt.alias("prompt"),
        F.size("items").alias("article_count"),
        F.transform("items", lambda item: item["link"]).alias("source_articles"),
    )


def briefing_requests(inputs: DataFrame) -> DataFrame:
    return inputs.select(F.lit(BRIEFING).alias("stage"), F.col("cc").alias("key"), "prompt")


def briefings(
    inputs: DataFrame, responses: DataFrame, briefing_date: str, generated_at: Column, briefing_type: str = "weekly",
    counters: Counters | None = None,
) -> DataFrame:
    """Briefing rows of the countries that have a non-empty reply."""
    own = _replies(responses, BRIEFING).withColumnRenamed("_key", "cc")
    usable = own.filter(F.to_json("reply") != "{}")
    reply = F.col("reply")

    def cut_text(name: str, size: int) -> Column:
        return F.substring(X.or_empty(replies.text_of(reply, name)), 1, size).alias(name)

    results = inputs.join(usable, "cc").select(
        "cc",
        F.lit(briefing_date).cast("date").alias("briefing_date"),
        F.lit(briefing_type).alias("briefing_type"),
        generated_at.alias("generated_at"),
        cut_text("summary", 2000),
        replies.stored_list(reply, "issues").alias("issues"),
        cut_text("outlook", 1000),
        replies.stored_list(reply, "keywords").alias("keywords"),
        cut_text("key_stat", 200),
        "model",
        "article_count",
        "source_articles",
    )
    return counted(results, BRIEFING, counters, written=F.count(F.lit(1)), articles=F.sum("article_count"))


BRIEFING_KEY = ["cc", "briefing_date", "briefing_type"]


def upsert_briefings(existing: DataFrame, new: DataFrame) -> DataFrame:
    """New briefings replace those of the same country, date and type."""
    return existing.join(new.select(*BRIEFING_KEY), BRIEFING_KEY, "left_anti").unionByName(new)
