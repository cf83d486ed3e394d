"""Structured Streaming forms of the batch operators.

Every sink is safe to replay: a micro-batch writes only to a folder or partition of its own, so a
batch repeated after a lost executor or driver replaces what it had written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from newsmart.config import DEDUP, Dedup
from newsmart.functions.lexicon import Lexicon
from newsmart.operators.dedup import BLOCK, candidates, mark_duplicates
from newsmart.operators.ingest import entry_rows, feed_counts, insert_new
from newsmart.operators.scoring import score_articles
from newsmart.schemas import SCHEMAS, conform
from newsmart.session import cut
from newsmart.sources.payloads import parse_payloads

TRIGGER = {"availableNow": True}


def _start_store(spark: SparkSession, path: str, schema: str) -> None:
    """Make an empty table so that the first batch finds a history to read."""
    empty = spark.createDataFrame([], schema)
    empty.write.mode("overwrite").partitionBy("art_date").parquet(f"{path}/batch=-1") if "art_date" in schema else (
        empty.write.mode("overwrite").parquet(f"{path}/batch=-1")
    )


def _history(spark: SparkSession, path: str, schema: str, batch_id: int) -> DataFrame:
    """Everything stored before this batch (the batch's own folder is left out, so replays agree)."""
    stored = spark.read.schema(f"{schema}, batch bigint").parquet(path)
    return stored.filter(F.col("batch") < batch_id).drop("batch")


def ingest_stream(
    payloads: DataFrame, articles_path: str, counts_path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Parse payload batches and append articles no earlier batch has, matched by content hash.

    The whole history counts, however old, which a watermark could not express.
    """
    spark = payloads.sparkSession
    _start_store(spark, articles_path, SCHEMAS["articles"])

    def write(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        # Each body is parsed once, into a stage table that both the fetches and the entries are read from.
        parsed = parse_payloads(batch)
        fetched, rows = parsed.feeds, cut(entry_rows(parsed.entries))
        new = insert_new(rows, _history(own, articles_path, SCHEMAS["articles"], batch_id))
        folder = f"{articles_path}/batch={batch_id}"
        conform(new, "articles").write.mode("overwrite").parquet(folder)
        written = own.read.schema(SCHEMAS["articles"]).parquet(folder)
        counts = feed_counts(fetched, rows.select("feed_id", "fetched_at"), written)
        counts.write.mode("overwrite").parquet(f"{counts_path}/batch={batch_id}")

    return (
        payloads.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or TRIGGER)).start()
    )


def score_stream(articles: DataFrame, sources: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Filter results of a stream of articles: the batch operator as a stateless projection."""
    return score_articles(articles, sources, lexicon)


def write_stream(results: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append a stateless stream to Parquet; the file sink commits each batch exactly once."""
    return (
        results.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(**(trigger or TRIGGER)).start()
    )


_DEDUP_STORE = (
    "article_id bigint, title string, published_at timestamp, fetched_at timestamp, primary_country_code string,"
    " tier int, filter_decision string, cc string, art_date string"
)


def dedup_stream(
    articles: DataFrame,
    store_path: str,
    marks_path: str,
    checkpoint: str,
    settings: Dedup = DEDUP,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Keep duplicate marks current while passed articles (with source columns) arrive.

    A better-ranked or late article can change a whole block, so the blocks a batch touches are
    marked anew from all their stored articles and replace their partition; other blocks stay.
    """
    spark = articles.sparkSession
    _start_store(spark, store_path, _DEDUP_STORE)

    def write(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        blocks = candidates(batch, recheck=True).select("article_id", *BLOCK)
        folder = f"{store_path}/batch={batch_id}"
        columns = _DEDUP_STORE.split(", cc ")[0]
        names = [part.split()[0] for part in columns.split(", ")]
        dated = batch.select(*names).join(blocks, "article_id")
        dated.write.mode("overwrite").partitionBy("art_date").parquet(folder)
        stored = own.read.schema(f"{_DEDUP_STORE}, batch bigint").parquet(store_path).filter(
            F.col("batch") <= batch_id
        )
        touched = own.read.schema(_DEDUP_STORE).parquet(folder).select(*BLOCK).distinct()
        rows = stored.join(touched, BLOCK, "left_semi").select(*names)
        # Otherwise every task writes a file into nearly every block's folder; large blocks still get several tasks.
        marks = mark_duplicates(rows, recheck=True, settings=settings).hint("rebalance", "art_date", "cc")
        marks.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "art_date", "cc"
        ).parquet(marks_path)

    return (
        articles.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or TRIGGER)).start()
    )
