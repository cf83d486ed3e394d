"""The registered queries: every operator over the given tables.

Each function takes the session and the table folder. Timestamps leave as text so that every engine
shows them alike.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmart.config import WIDTHS, Dedup
from newsmart.functions import offices, taxonomy
from newsmart.functions import text as X
from newsmart.operators import dedup, enrich, export, queues, reports
from newsmart.operators import ingest as ingesting
from newsmart.operators.lifecycle import current_articles, with_source
from newsmart.operators.registry import SyncResult, sync_registry
from newsmart.operators.scoring import score_articles as score
from newsmart.plans.jobs import collect_chain, enrich_chain
from newsmart.session import Counters, checkpoint_dir, cut
from newsmart.sources import sample_views as V
from newsmart.sources import tables
from newsmart.sources.payloads import parse_payloads
from newsmart.streaming import incremental

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def stamp(column: str | Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


# -- shared inputs -------------------------------------------------------------------------------------
def _scores(spark, folder, counters=None) -> DataFrame:
    return score(V.articles(spark, folder), V.sources(spark, folder), V.TEST_LEXICON, counters=counters)


def _rows(spark, folder) -> DataFrame:
    return with_source(V.articles(spark, folder), V.sources(spark, folder))


def _filtered(spark, folder, counters=None) -> DataFrame:
    """Articles with filter results, no duplicates marked."""
    return current_articles(_rows(spark, folder), cut(_scores(spark, folder, counters)))


def _marked(spark, folder, counters=None) -> DataFrame:
    """Articles without their bodies, with filter results and near-duplicate marks.

    Both are stored once as narrow tables; all later stages read these and fetch bodies for the rows that are left.
    """
    heads = cut(_filtered(spark, folder, counters).drop("summary"))
    marks = cut(dedup.mark_duplicates(heads, counters=counters).select("article_id", "duplicate_of"))
    return heads.drop("duplicate_of").join(marks, "article_id", "left")


def _with_body(rows: DataFrame, spark, folder, width: int | None = None) -> DataFrame:
    """Articles with their bodies, or the first ``width`` characters of them.

    They are articles already, so their bodies come straight from the documents and are shuffled for one join only.
    """
    bodies = V.article_columns(V.table(spark, folder, "documents")).select("article_id", "summary")
    if width is not None:
        bodies = bodies.withColumn("summary", F.left("summary", F.lit(width)))
    return rows.join(bodies, "article_id")


def _without_enrichment(marked: DataFrame) -> DataFrame:
    return marked.drop("triage_decision", "reject_reason", "ai_score", "summary_ko", "topics", "implication", "model")


def _triage(marked: DataFrame, counters=None) -> DataFrame:
    waiting = queues.untriaged(marked)
    return enrich.triage(waiting, V.responses(waiting, enrich.TRIAGE), counters)


def _triaged(spark, folder) -> DataFrame:
    return _triage(_marked(spark, folder))


def _kept(spark, folder, counters=None) -> DataFrame:
    """Articles with filter, duplicate and triage results; every stage result is stored once."""
    marked = _marked(spark, folder, counters)
    return _with_triage(marked, cut(_triage(marked, counters)))


def _with_triage(marked: DataFrame, triaged: DataFrame) -> DataFrame:
    base, triaged = _without_enrichment(marked), triaged.withColumnRenamed("decision", "triage_decision")
    return base.join(triaged, "article_id", "left").withColumn("ai_score", F.lit(None).cast("int"))


def _rank(kept: DataFrame, spark, folder, counters=None) -> DataFrame:
    waiting = queues.unranked(kept)
    rows, replies = _with_body(waiting, spark, folder), V.responses(waiting, enrich.RANK)
    return enrich.rank(rows, replies, V.sample_topics(), counters=counters)


def _ranked(spark, folder) -> DataFrame:
    return _rank(_kept(spark, folder), spark, folder)


def _final(spark, folder, counters=None) -> DataFrame:
    kept = cut(_kept(spark, folder, counters))
    return kept.drop("ai_score").join(cut(_rank(kept, spark, folder, counters)), "article_id", "left")


# -- filter ---------------------------------------------------------------------------------------------
@query
def score_articles(spark, folder):
    return _scores(spark, folder)


@query
def score_published_lexicon(spark, folder):
    """The published lists, long as they are, with a main list of over 300 words."""
    return score(V.articles(spark, folder), V.sources(spark, folder), V.published_sample())


@query
def refilter_pending(spark, folder):
    """Only articles without a stored decision are scored; those of the first tier already have one."""
    official = V.sources(spark, folder).filter("tier = 0").select("source_id", F.lit("passed").alias("done"))
    articles = V.articles(spark, folder).join(official, "source_id", "left")
    pending = articles.withColumn("filter_decision", F.coalesce("done", F.lit("pending")))
    return score(pending, V.sources(spark, folder), V.TEST_LEXICON)


@query
def filter_totals(spark, folder):
    return reports.filter_totals(_marked(spark, folder))


@query
def filter_global_categories(spark, folder):
    return reports.filter_global_categories(_filtered(spark, folder), V.categories(spark, folder))


@query
def filter_by_country(spark, folder):
    return reports.filter_by_country(_marked(spark, folder))


@query
def top_pass_reasons(spark, folder):
    return reports.top_pass_reasons(_filtered(spark, folder))


@query
def top_exclusions(spark, folder):
    return reports.top_exclusions(_filtered(spark, folder))


@query
def rejected_sample(spark, folder):
    return reports.rejected_sample(_filtered(spark, folder), seed=7)


@query
def filter_counters(spark, folder):
    return reports.filter_counters(_scores(spark, folder))


# -- near duplicates --------------------------------------------------------------------------------------
@query
def dedup_blocks(spark, folder):
    rows = dedup.candidates(_filtered(spark, folder))
    return dedup.distinct_titles(rows).select(
        "cc", "art_date", "title_key", "copies", F.col("rank.id").alias("first_id")
    )


@query
def dedup_equal_titles(spark, folder):
    return dedup.mark_equal_titles(dedup.candidates(_filtered(spark, folder)))


@query
def dedup_marks(spark, folder):
    return dedup.mark_duplicates(_filtered(spark, folder))


@query
def dedup_all_titles(spark, folder):
    """Marks over all articles, passed or not: the largest blocks the tables offer."""
    return dedup.mark_duplicates(_rows(spark, folder).withColumn("filter_decision", F.lit("passed")))


@query
def dedup_in_waves(spark, folder):
    """The same marks with small chunks and slots: every block takes several waves, bands and slots."""
    articles = _rows(spark, folder).withColumn("filter_decision", F.lit("passed"))
    return dedup.mark_duplicates(articles, settings=Dedup(chunk_rows=32, slot_rows=24))


# -- text, time and identity --------------------------------------------------------------------------------
@query
def strip_html_pages(spark, folder):
    return V.table(spark, folder, "pages").select("page_id", X.strip_html(F.col("html")).alias("plain"))


@query
def clean_text_docs(spark, folder):
    return V.table(spark, folder, "documents").select(
        "doc_id", X.clean_text(F.col("text")).alias("clean"),
        X.normalize(X.clean_text(F.split_part("text", F.lit("\n"), F.lit(1)))).alias("first_line"),
    )


@query
def clean_text_pages(spark, folder):
    return V.table(spark, folder, "pages").select("page_id", X.clean_text(F.col("html")).alias("clean"))


@query
def scoring_text_docs(spark, folder):
    return V.table(spark, folder, "documents").select("doc_id", X.scoring_text(F.col("text")).alias("scored"))


@query
def title_keys(spark, folder):
    return V.articles(spark, folder).select("article_id", X.title_key(F.col("title")).alias("title_key"))


@query
def content_hashes(spark, folder):
    return V.articles(spark, folder).select(
        "article_id", X.content_hash(F.col("title"), F.col("link")).alias("content_hash")
    )


@query
def published_parse(spark, folder):
    parsed = X.parse_published(F.col("published"), F.col("updated"), F.col("fetched_at"))
    return V.entries(spark, folder).select(F.col("pos").cast("long").alias("article_id"), stamp(parsed).alias("published_at"))


@query
def kst_day(spark, folder):
    day = X.kst_day(F.col("published_at"), F.col("fetched_at"))
    return V.articles(spark, folder).select("article_id", day.cast("string").alias("kst_day"),
                                            X.utc_day(F.col("published_at")).alias("utc_day"))


# -- registry ------------------------------------------------------------------------------------------------
def _sync(spark, folder) -> SyncResult:
    return sync_registry(V.registry(spark, folder), *V.registry_state(spark, folder))


@query
def registry_sync_sources(spark, folder):
    return _sync(spark, folder).sources


@query
def registry_sync_categories(spark, folder):
    return _sync(spark, folder).categories


@query
def registry_sync_feeds(spark, folder):
    return _sync(spark, folder).feeds.drop("last_fetched", "last_error")


@query
def registry_counts(spark, folder):
    synced = _sync(spark, folder)
    return reports.registry_counts(synced.sources, synced.feeds)


@query
def active_feeds(spark, folder):
    return ingesting.active_feeds(V.feeds(spark, folder))


# -- ingest --------------------------------------------------------------------------------------------------
@query
def parse_feed_xml(spark, folder):
    return parse_payloads(V.payloads(spark, folder), store=None).entries.select(
        "feed_id", "source_id", "pos", X.strip(F.col("title")).alias("title"), "link",
        X.strip(F.col("summary")).alias("summary"), "published",
    )


@query
def parse_feed_status(spark, folder):
    return parse_payloads(V.payloads(spark, folder), store=None).feeds.select("feed_id", "status", "error", "entry_count")


@query
def ingest_insert_ignore(spark, folder):
    rows = ingesting.entry_rows(V.entries(spark, folder))
    new = ingesting.insert_new(rows, V.stored_articles(spark, folder))
    return new.withColumn("published_at", stamp("published_at")).drop("fetched_at")


def _ingest_counts(spark, folder) -> DataFrame:
    """A batch in which every feed was fetched twice: entries of even position first, the others an hour later."""
    first = F.to_timestamp(F.lit("2024-02-01 00:00:00"))
    times = [first, first + F.expr("INTERVAL 1 HOUR")]
    rows = ingesting.entry_rows(V.entries(spark, folder)).withColumn(
        "fetched_at", F.when(F.col("pos") % 2 == 0, times[0]).otherwise(times[1])
    )
    new = ingesting.insert_new(rows, V.stored_articles(spark, folder))
    fetched = V.feeds(spark, folder).select(
        "feed_id", F.col("last_status").alias("status"), F.col("last_error").alias("error"),
        F.explode(F.array(*times)).alias("fetched_at"),
    )
    return ingesting.feed_counts(fetched, rows.select("feed_id", "fetched_at"), new)


@query
def ingest_feed_counts(spark, folder):
    return _ingest_counts(spark, folder).withColumn("fetch", F.hour("fetched_at")).drop("fetched_at")


@query
def ingest_run_metrics(spark, folder):
    return ingesting.run_metrics(_ingest_counts(spark, folder))


@query
def feed_health(spark, folder):
    """Feeds of the first section were fetched now; all others keep their earlier outcome."""
    feeds = V.feeds(spark, folder).withColumn("last_fetched", F.to_timestamp(F.lit("2024-01-01 00:00:00")))
    outcome = parse_payloads(V.payloads(spark, folder), store=None).feeds
    counts = outcome.withColumn("feed_id", F.col("source_id") * 2).select("feed_id", "status", "fetched_at", "error")
    updated = ingesting.update_feed_health(feeds, counts)
    return updated.withColumn("last_fetched", stamp("last_fetched"))


@query
def resolve_links(spark, folder):
    return ingesting.resolve_links(V.page_links(spark, folder), V.page_redirects(spark, folder), prefix="http://")


# -- enrichment ----------------------------------------------------------------------------------------------
@query
def triage_queue(spark, folder):
    return queues.triage_queue(_marked(spark, folder)).select("article_id", "filter_score")


@query
def triage_requests(spark, folder):
    waiting = queues.untriaged(_marked(spark, folder))
    return enrich.triage_requests(_with_body(waiting, spark, folder, WIDTHS.triage_prompt))


@query
def triage_decisions(spark, folder):
    return _triaged(spark, folder)


@query
def triage_without_replies(spark, folder):
    """The offline stub answers every request with an empty object: everything is kept."""
    waiting = queues.untriaged(_marked(spark, folder))
    model, completer = enrich.get_completer("fast")
    requests = enrich.triage_requests(_with_body(waiting, spark, folder, WIDTHS.triage_prompt))
    answered = enrich.complete(requests, completer, model)
    return enrich.triage(waiting, answered)


@query
def rank_queue(spark, folder):
    return queues.rank_queue(_kept(spark, folder)).select("article_id", "filter_score")


@query
def rank_requests(spark, folder):
    waiting = queues.unranked(_kept(spark, folder))
    return enrich.rank_requests(_with_body(waiting, spark, folder, WIDTHS.rank_prompt))


@query
def rank_fields(spark, folder):
    ranked = _ranked(spark, folder)
    return ranked.select(
        "article_id", "ai_score", "summary_ko", X.csv_encode(F.col("topics")).alias("topics"), "implication", "model"
    )


@query
def seed_topics(spark, folder):
    text = F.concat("title", F.lit(" "), "summary")
    found = taxonomy.seed_topics(text, V.sample_topics())
    return V.articles(spark, folder).select("article_id", X.csv_encode(found).alias("topics"))


@query
def topic_ui_strings(spark, folder):
    """Topic lists as stored text, decoded and mapped to screen keys and labels."""
    ranked = rank_fields(spark, folder)
    codes = X.csv_decode(F.col("topics"))
    first = F.coalesce(F.get(codes, F.lit(0)), F.lit("NONE"))
    return ranked.select(
        "article_id",
        taxonomy.ui_string(codes).alias("ui"),
        taxonomy.label(first, "ko").alias("label_ko"),
        taxonomy.label(first, "en").alias("label_en"),
        taxonomy.ui_key(first).alias("first_ui"),
    )


@query
def office_context(spark, folder):
    rows = _rows(spark, folder)
    return rows.select(
        "article_id",
        offices.context_for(F.col("primary_country_code")).alias("context"),
        F.col("primary_country_code").isin(offices.subsidiary_countries()).alias("subsidiary"),
    )


@query
def stage_counters(spark, folder):
    """Both stages count what one run marked and triaged; neither is done twice."""
    marked = _marked(spark, folder)
    stored = cut(_triage(marked))
    triaged = reports.triage_counters(stored)
    ranked = reports.rank_counters(_rank(_with_triage(marked, stored), spark, folder))
    return triaged.select(F.lit("triage").alias("stage"), F.col("total"), F.col("keep").alias("good"),
                          F.col("drop").alias("rest")).unionByName(
        ranked.select(F.lit("rank").alias("stage"), F.col("ranked").alias("total"), F.col("active").alias("good"),
                      (F.col("ranked") - F.col("active")).alias("rest")))


# -- briefing and export -------------------------------------------------------------------------------------
@query
def ranked_countries(spark, folder):
    return enrich.ranked_countries(_final(spark, folder))


@query
def briefing_inputs(spark, folder):
    inputs = enrich.briefing_inputs(_final(spark, folder))
    return inputs.select("cc", "prompt", "article_count", F.to_json("source_articles").alias("source_articles"))


def _briefing_replies(inputs: DataFrame) -> DataFrame:
    """Stored briefing replies per country; the countries from 'S' on have none."""
    text = F.concat(
        F.lit('```json\n{"summary": "'), "cc", F.lit(' 요약", "issues": ["a", "'), F.col("article_count").cast("string"),
        F.lit('"], "outlook": "o", "keywords": ["k"], "key_stat": 5}\n```'),
    )
    answered = inputs.filter(F.col("cc") < "S")
    return answered.select(
        F.lit(enrich.BRIEFING).alias("stage"), F.col("cc").alias("key"),
        F.when(F.col("cc") == "IN", "{}").otherwise(text).alias("raw_text"), F.lit("stored:sample").alias("model"),
    )


def _briefings(spark, folder, counters=None) -> DataFrame:
    inputs = enrich.briefing_inputs(_final(spark, folder, counters))
    now = F.to_timestamp(F.lit("2024-02-01 00:00:00"))
    return enrich.briefings(inputs, _briefing_replies(inputs), "2024-02-01", now, counters=counters)


@query
def briefing_rows(spark, folder):
    return _briefings(spark, folder).select(
        "cc", F.col("briefing_date").cast("string").alias("briefing_date"), "briefing_type", "summary",
        F.to_json("issues").alias("issues"), "outlook", F.to_json("keywords").alias("keywords"), "key_stat", "model",
        "article_count",
    )


@query
def run_counters(spark, folder):
    """What all stages of one run counted while their results were stored."""
    counters = Counters()
    cut(_briefings(spark, folder, counters))
    return counters.to_frame(spark)


@query
def briefing_upsert(spark, folder):
    """Existing briefings of two dates for every country; those of the new date are replaced."""
    new = _briefings(spark, folder)
    dates = F.explode(F.expr("array(DATE'2024-01-25', DATE'2024-02-01')"))
    countries = V.sources(spark, folder).select(F.col("primary_country_code").alias("cc")).distinct()
    existing = countries.select(
        "cc", dates.alias("briefing_date"), F.lit("weekly").alias("briefing_type"),
        F.lit(None).cast("timestamp").alias("generated_at"), F.lit("old").alias("summary"),
        F.lit(None).cast("array<string>").alias("issues"), F.lit(None).cast("string").alias("outlook"),
        F.lit(None).cast("array<string>").alias("keywords"), F.lit(None).cast("string").alias("key_stat"),
        F.lit(None).cast("string").alias("model"), F.lit(0).alias("article_count"),
        F.lit(None).cast("array<string>").alias("source_articles"),
    )
    merged = enrich.upsert_briefings(existing, new)
    return merged.select("cc", F.col("briefing_date").cast("string").alias("briefing_date"), "briefing_type",
                         "summary", "article_count")


@query
def export_articles(spark, folder):
    countries = [cc for cc, _ in export.EXPORT_COUNTRIES]
    return export.active_articles(_final(spark, folder), countries)


@query
def export_countries(spark, folder):
    nested = export.export_countries(_final(spark, folder))
    return nested.select(
        "ord", "cc", "flag", "status", "count",
        F.array_join(F.transform("articles", lambda a: a["u"]), "\n").alias("links"),
    )


@query
def export_document(spark, folder):
    now = F.to_timestamp(F.lit("2024-02-01 00:00:00"))
    document = export.export_document(export.export_countries(_final(spark, folder)), now)
    return document.select(
        stamp("generated_at").alias("generated_at"), "active_threshold",
        F.size("countries").alias("countries"),
        F.aggregate("countries", F.lit(0), lambda n, c: n + c["count"]).alias("articles"),
        F.array_join(F.transform("countries", lambda c: F.concat(c["cc"], F.lit("="), c["status"])), ";").alias("states"),
    )


# -- availability and lists ----------------------------------------------------------------------------------
@query
def feed_availability(spark, folder):
    report = reports.feed_availability(V.feeds(spark, folder), V.sources(spark, folder), V.articles(spark, folder))
    return report.withColumn("last_published", stamp("last_published"))


@query
def feed_availability_display(spark, folder):
    report = reports.feed_availability(V.feeds(spark, folder), V.sources(spark, folder), V.articles(spark, folder))
    return reports.feed_availability_display(report)


@query
def country_availability(spark, folder):
    return reports.country_availability(V.sources(spark, folder), V.feeds(spark, folder), V.articles(spark, folder))


@query
def recent_articles(spark, folder):
    return reports.recent_articles(_filtered(spark, folder))


# -- chains --------------------------------------------------------------------------------------------------
@query
def collect_chain_rows(spark, folder):
    sources = V.sources(spark, folder).withColumn("language", F.lit("en"))
    stored = V.stored_articles(spark, folder)
    done = collect_chain(V.payloads(spark, folder), stored, sources, V.TEST_LEXICON)
    scored = done.ingest.articles.join(done.filter_results.drop("filter_stage", "filter_decision"), "article_id")
    return scored.join(done.duplicates.select("article_id", "duplicate_of"), "article_id", "left").select(
        "article_id", "content_hash", "filter_reason", "filter_score", "duplicate_of"
    )


@query
def enrich_chain_rows(spark, folder):
    articles = V.articles(spark, folder)
    stored = V.responses(articles, enrich.TRIAGE).unionByName(V.responses(articles, enrich.RANK))
    countries = V.sources(spark, folder).select(F.col("primary_country_code").alias("key")).distinct()
    brief = countries.select(F.lit(enrich.BRIEFING).alias("stage"), "key",
                             F.lit('{"summary": "weekly"}').alias("raw_text"), F.lit("stored:sample").alias("model"))
    marked = cut(_marked(spark, folder))
    results = marked.select("article_id", "filter_stage", "filter_decision", "filter_reason", "filter_score")
    done = enrich_chain(
        _rows(spark, folder), results, marked.select("article_id", "duplicate_of"), stored.unionByName(brief),
        "2024-02-01", F.to_timestamp(F.lit("2024-02-01 00:00:00")), V.sample_topics(),
    )
    return done.briefings.select("cc", "summary", "article_count", F.to_json("source_articles").alias("links"))


@query
def collect_chain_second_run(spark, folder):
    """The collect chain over the payloads of odd feeds, then over those of even feeds on top of what it stored."""
    sources = V.sources(spark, folder).withColumn("language", F.lit("en"))
    payloads = V.payloads(spark, folder)
    first = collect_chain(
        payloads.filter("feed_id % 2 = 1"), V.stored_articles(spark, folder), sources, V.TEST_LEXICON
    )
    stored = cut(first.ingest.articles.unionByName(V.stored_articles(spark, folder), allowMissingColumns=True))
    marks = cut(first.duplicates)
    done = collect_chain(
        payloads.filter("feed_id % 2 = 0"), stored, sources, V.TEST_LEXICON,
        filter_results=first.filter_results, duplicates=marks,
    )
    new = done.ingest.articles.select("article_id", "content_hash", F.lit(2).alias("run"))
    rows = new.unionByName(first.ingest.articles.select("article_id", "content_hash", F.lit(1).alias("run")))
    scores = done.filter_results.unionByName(first.filter_results).select("article_id", "filter_reason", "filter_score")
    both = done.duplicates.select("article_id", F.col("duplicate_of").alias("later")).join(
        marks.select("article_id", F.col("duplicate_of").alias("earlier")), "article_id", "full"
    )
    found = both.select("article_id", F.coalesce("earlier", "later").alias("duplicate_of"))
    return rows.join(scores, "article_id").join(found, "article_id", "left")


def _two_enrich_runs(spark, folder):
    marked = cut(_marked(spark, folder).select(
        "article_id", "filter_stage", "filter_decision", "filter_reason", "filter_score", "duplicate_of"
    ))
    stored = V.responses(marked, enrich.TRIAGE).unionByName(V.responses(marked, enrich.RANK))
    given = (
        _rows(spark, folder), marked.drop("duplicate_of"), marked.select("article_id", "duplicate_of"), stored, "2024-02-01",
        F.to_timestamp(F.lit("2024-02-01 00:00:00")), V.sample_topics(),
    )
    first = enrich_chain(*given)
    return first, enrich_chain(*given, triage_results=first.triage_results, rank_results=first.rank_results)


@query
def enrich_chain_second_run(spark, folder):
    """What the second run of the enrich chain triages: the queue goes on where the first run stopped."""
    first, second = _two_enrich_runs(spark, folder)
    runs = first.triage_results.withColumn("run", F.lit(1)).unionByName(second.triage_results.withColumn("run", F.lit(2)))
    return runs.select("run", "article_id", "decision", "reject_reason")


# -- sinks ---------------------------------------------------------------------------------------------------
def _run_folder(spark) -> str:
    return f"{checkpoint_dir(spark)}/run-{uuid.uuid4().hex}"


@query
def sink_articles(spark, folder):
    """Articles appended in two runs and read back, with the day of their partition."""
    path, rows = f"{_run_folder(spark)}/articles", V.articles(spark, folder)
    for rest in (0, 1):
        tables.append_articles(rows.filter(F.col("article_id") % 2 == rest), path)
    return spark.read.parquet(path).select("article_id", "title", F.col("art_date").cast("string").alias("art_date"))


@query
def sink_report_csv(spark, folder):
    """The report by country written as CSV with a header and read back."""
    path = f"{_run_folder(spark)}/report"
    tables.write_report(reports.filter_by_country(_marked(spark, folder)), path, "csv")
    schema = "country string, total bigint, passed bigint, rejected bigint, dups bigint, pass_rate string"
    return spark.read.schema(schema).option("header", "true").csv(path)


@query
def sink_fetch_runs(spark, folder):
    """Totals of two runs appended to the run table and read back."""
    path, counts = f"{_run_folder(spark)}/runs", cut(_ingest_counts(spark, folder))
    for run in (1, 2):
        tables.append_run(ingesting.run_metrics(counts), path, run, "2024-02-01 00:00:00", "2024-02-01 00:10:00")
    stored = tables.read_table(spark, path, "fetch_runs")
    return stored.withColumns({"started_at": stamp("started_at"), "finished_at": stamp("finished_at")})


# -- streaming -----------------------------------------------------------------------------------------------
STREAM_BATCHES = 3


def _document_stream(spark, folder, run: str) -> DataFrame:
    """The documents as a stream of several micro-batches, so that history and late rows matter.

    The number of files grows with the table, so that no task writes more than a split of it.
    """
    documents = V.table(spark, folder, "documents")
    files = max(STREAM_BATCHES, documents.rdd.getNumPartitions())
    documents.repartition(files, "doc_id").write.parquet(f"{run}/documents")
    batch = -(-files // STREAM_BATCHES)
    return spark.readStream.schema(documents.schema).option("maxFilesPerTrigger", batch).parquet(f"{run}/documents")


def _article_stream(spark, folder, run: str) -> DataFrame:
    times = V.table(spark, folder, "events").select(
        F.col("event_id").alias("article_id"), F.col("ts").cast("timestamp").alias("published_at")
    )
    rows = V.article_columns(_document_stream(spark, folder, run)).join(times, "article_id")
    return rows.withColumn("fetched_at", F.col("published_at") + F.expr("INTERVAL 1 HOUR"))


@query
def stream_ingest(spark, folder):
    run = _run_folder(spark)
    payloads = V.payload_columns(_article_stream(spark, folder, run))
    incremental.ingest_stream(payloads, f"{run}/articles", f"{run}/counts", f"{run}/state").awaitTermination()
    stored = spark.read.parquet(f"{run}/articles")
    return stored.select(
        "feed_id", "source_id", "title", "link", stamp("published_at").alias("published_at"), "content_hash"
    )


@query
def stream_score(spark, folder):
    run = _run_folder(spark)
    articles = V.article_columns(_document_stream(spark, folder, run))
    results = incremental.score_stream(articles, V.sources(spark, folder), V.TEST_LEXICON)
    incremental.write_stream(results, f"{run}/results", f"{run}/state").awaitTermination()
    return spark.read.parquet(f"{run}/results")


@query
def stream_dedup(spark, folder):
    run = _run_folder(spark)
    articles = with_source(_article_stream(spark, folder, run), V.sources(spark, folder)).withColumn(
        "filter_decision", F.lit("passed")
    )
    incremental.dedup_stream(articles, f"{run}/store", f"{run}/marks", f"{run}/state").awaitTermination()
    return spark.read.schema("article_id bigint, duplicate_of bigint, art_date string, cc string").parquet(f"{run}/marks")
