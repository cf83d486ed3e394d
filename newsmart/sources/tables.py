"""Readers and writers of the pipeline's stored tables and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmart.functions import text as X
from newsmart.functions.lexicon import Lexicon
from newsmart.schemas import SCHEMAS, conform


def read_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A stored table with its declared schema; columns absent from older files read as NULL."""
    return spark.read.schema(SCHEMAS[table]).parquet(path)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Registry document ``{"sources": [...]}`` as rows with their position."""
    document = spark.read.schema(f"sources array<struct<{_struct(SCHEMAS['registry'])}>>").json(path, multiLine=True)
    return document.select(F.posexplode("sources").alias("pos", "source")).select("pos", "source.*")


def _struct(schema: str) -> str:
    fields = schema.replace("array<struct<section: string, url: string>>", "array<struct<section:string,url:string>>")
    out = []
    for part in fields.split(", "):
        name, kind = part.strip().split(" ", 1)
        out.append(f"{name}:{kind}")
    return ",".join(out)


def read_keywords(spark: SparkSession, path: str) -> list[str]:
    """Keyword list kept as a text file, one keyword per line, in list order (configuration-sized)."""
    lines = spark.read.text(path, wholetext=True).first()
    return [line for line in (lines[0] if lines else "").splitlines() if line]


def read_lexicon(spark: SparkSession, path: str) -> Lexicon:
    """Lexicon kept as a table of rows (configuration-sized)."""
    columns = ["list", "seq", "keyword", "country", "country_seq", "match_kind"]
    return Lexicon.from_rows(spark.read.parquet(path).select(*columns).collect())


def append_articles(articles: DataFrame, path: str) -> None:
    """Append new articles, one partition per Korean day."""
    dated = conform(articles, "articles").withColumn(
        "art_date", X.kst_day(F.col("published_at"), F.col("fetched_at"))
    )
    dated.write.mode("append").partitionBy("art_date").parquet(path)


def write_stage(results: DataFrame, path: str) -> None:
    """Write a stage's result table to a new path; a stage never overwrites what it reads."""
    results.write.mode("errorifexists").parquet(path)


def write_briefings(briefings: DataFrame, path: str) -> None:
    """Replace the touched dates of the briefing table, leaving all other dates as they are."""
    briefings.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "briefing_date"
    ).parquet(path)


def write_document(document: DataFrame, path: str) -> None:
    """Write a one-row document as JSON, keeping empty fields and non-ASCII text."""
    document.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_report(report: DataFrame, path: str, kind: str = "parquet") -> None:
    """Write a report table as Parquet or as CSV with a header."""
    writer = report.write.mode("overwrite")
    writer.option("header", "true").csv(path) if kind == "csv" else writer.parquet(path)


def append_run(run: DataFrame, path: str, run_id: int, started_at, finished_at) -> None:
    """Append the totals of one ingest run."""
    stamped = run.select(
        F.lit(run_id).cast("long").alias("run_id"),
        F.lit(started_at).cast("timestamp").alias("started_at"),
        F.lit(finished_at).cast("timestamp").alias("finished_at"),
        "*",
    )
    conform(stamped, "fetch_runs").write.mode("append").parquet(path)
