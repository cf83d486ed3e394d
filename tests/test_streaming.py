"""Incremental forms against their batch operators, over several micro-batches and replays."""

import datetime as dt

from pyspark.sql import functions as F

from newsmart.config import Dedup
from newsmart.operators.dedup import mark_duplicates
from newsmart.operators.scoring import score_articles
from newsmart.schemas import SCHEMAS
from newsmart.sources.sample_views import TEST_LEXICON
from newsmart.streaming import incremental

NOW = dt.datetime(2024, 1, 1, 3)


def _folder_of_batches(spark, path, batches, schema):
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def _rss(*titles):
    items = "".join(f"<item><title>{t}</title><link>http://x/{t}</link></item>" for t in titles)
    return f"<rss><channel>{items}</channel></rss>"


def test_ingest_sees_every_earlier_batch(spark, tmp_path):
    bodies = [("a", "b", "b"), ("b", "c"), ("a", "d")]
    batches = [[(n, 1, NOW, 200, None, _rss(*titles))] for n, titles in enumerate(bodies)]
    stream = _folder_of_batches(spark, str(tmp_path / "in"), batches, SCHEMAS["feed_payloads"])
    paths = [str(tmp_path / name) for name in ("articles", "counts", "state")]
    incremental.ingest_stream(stream, *paths).awaitTermination()
    stored = spark.read.schema(SCHEMAS["articles"]).parquet(paths[0]).collect()
    assert sorted(r.title for r in stored) == ["a", "b", "c", "d"]
    assert sorted(r.article_id for r in stored) == [1, 2, 3, 4]
    totals = spark.read.parquet(paths[1]).agg(F.sum("new_articles"), F.sum("dup_articles")).first()
    assert tuple(totals) == (4, 3)


def test_scores_equal_the_batch(spark, tmp_path):
    schema = "article_id long, source_id long, title string, summary string, language string"
    words = ["license that", "of the erat", "nicht", "para this", "dans"]
    batches = [[(n * 5 + k, k % 2, words[k], words[(k + n) % 5], ["en", "de", "es", "fr", "xx"][n]) for k in range(5)]
               for n in range(5)]
    sources = spark.createDataFrame([(0, 1), (1, 2)], "source_id long, tier int")
    stream = _folder_of_batches(spark, str(tmp_path / "in"), batches, schema)
    scored = incremental.score_stream(stream, sources, TEST_LEXICON)
    incremental.write_stream(scored, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    batch = score_articles(spark.read.schema(schema).parquet(str(tmp_path / "in")), sources, TEST_LEXICON)
    assert sorted(spark.read.parquet(str(tmp_path / "out")).collect()) == sorted(batch.collect())


def test_a_late_better_article_reopens_its_block(spark, tmp_path):
    schema = ("article_id long, title string, published_at timestamp, fetched_at timestamp,"
              " primary_country_code string, tier int, filter_decision string")

    def row(n, title, tier, hours=0, country="KR", decision="passed"):
        return (n, title, NOW + dt.timedelta(hours=hours), NOW, country, tier, decision)

    batches = [
        [row(1, "fed signals rate hike", 2), row(2, "fed signals rate hold", 2), row(3, "yen falls", 1, 24)],
        [row(4, "fed signals rate hikes", 1), row(5, "yen falls", 1, country="JP"), row(6, "fed", 0, decision="rejected")],
        [row(7, "yen falls", 1, 24)],
    ]
    stream = _folder_of_batches(spark, str(tmp_path / "in"), batches, schema)
    paths = [str(tmp_path / name) for name in ("store", "marks", "state")]
    incremental.dedup_stream(stream, *paths, settings=Dedup(chunk_rows=2, slot_rows=2)).awaitTermination()
    marks = spark.read.parquet(paths[1]).select("article_id", "duplicate_of").collect()
    batch = mark_duplicates(spark.read.schema(schema).parquet(str(tmp_path / "in")), recheck=True)
    assert sorted(map(tuple, marks), key=str) == sorted(map(tuple, batch.select("article_id", "duplicate_of").collect()), key=str)
    assert dict(map(tuple, marks))[1] == 4


def test_document_stream_files_grow_with_the_table(spark, tmp_path):
    from newsmart.plans import registered

    spark.range(0, 4000, numPartitions=9).selectExpr("id AS doc_id", "repeat('x', 50) AS text").write.parquet(
        str(tmp_path / "in" / "documents.parquet")
    )
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")
    try:
        stream = registered._document_stream(spark, str(tmp_path / "in"), str(tmp_path / "run"))
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(list((tmp_path / "run" / "documents").glob("part-*.parquet"))) >= 9
    query = stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "state")).trigger(
        availableNow=True
    ).start()
    query.awaitTermination()
    assert [row["numInputRows"] > 0 for row in query.recentProgress].count(True) == registered.STREAM_BATCHES
    assert sum(row["numInputRows"] for row in query.recentProgress) == 4000


def test_a_block_of_marks_is_one_file(spark, tmp_path):
    """Not one file of every task: a batch of many small blocks would write tasks times blocks files."""
    rows = [(n, f"title {chr(97 + n)} {'xyz'[n % 3] * 9}", "2024-01-02 00:00:00", n % 3) for n in range(24)]
    frame = spark.createDataFrame(rows, "article_id long, title string, at string, tier int").selectExpr(
        "article_id", "title", "timestamp(at) published_at", "timestamp(at) fetched_at", "'KR' primary_country_code", "tier",
        "'passed' filter_decision",
    )
    frame.repartition(6).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(frame.schema).parquet(f"{tmp_path}/in")
    incremental.dedup_stream(stream, *(f"{tmp_path}/{name}" for name in ("store", "marks", "state"))).awaitTermination()
    assert len(list((tmp_path / "marks").rglob("part-*.parquet"))) == 1
    assert spark.read.parquet(f"{tmp_path}/marks").count() == 24
