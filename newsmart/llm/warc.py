"""Content-addressed WARC archives: payload bytes once per digest, exact record headers apart, records by a join.

Writing makes two Parquet tables in a folder. ``headers`` has one row per record: the header block of a WARC/1.1 record,
byte for byte, with the digest of its payload. ``payloads`` has every distinct payload once, by SHA-256. Reading joins them by
digest, computes the digest of the bytes anew and stops if it differs.

Which record is the response of its payload follows from a narrow aggregate (smallest page per digest). A digest that
very many pages share is a hot key of a narrow join, which the adaptive join splits; of its payload one copy per task is
shuffled. Only built-in expressions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmart.llm.tables import new_folder, stage

#: Payloads below this many bytes are always stored as responses of their own.
LEAST = 100
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _lines(*lines: Column) -> Column:
    """Header lines, without those that are NULL, and the empty line that ends them."""
    return F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"))


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value)


def _record_id(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("none")), F.lit(">"))


def _header(date: str) -> Column:
    revisit = F.col("record_type") == "revisit"
    # Line ends inside a url would end the header line.
    uri = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return _lines(
        F.lit("WARC/1.1"),
        _line("WARC-Type", F.col("record_type")),
        _line("WARC-Record-ID", _record_id(F.col("page_id"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        F.when(revisit, _line("WARC-Refers-To", _record_id(F.col("refers_to")))),
        F.when(revisit, _line("WARC-Profile", F.lit(PROFILE))),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("n_bytes").cast("string"))),
        _line("WARC-Target-URI", uri),
    )


def write_archive(pages: DataFrame, folder: str, least: int = LEAST, date: str = DATE) -> None:
    """Write a record for every row of ``pages`` (page_id, url, html) into ``folder``.

    The payload is the html in UTF-8, empty for NULL. Of equal payloads of at least ``least`` bytes the smallest page_id is
    the response and the others revisit it; smaller payloads are all responses. Rows that repeat that page_id are responses
    too, and so are rows with a NULL page_id. A NULL url has no target line. Other columns are ignored.
    """
    raw = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload")
    ).withColumn("digest", F.sha2("payload", 256))
    narrow = stage(raw.select("page_id", "url", "digest", F.octet_length("payload").cast("long").alias("n_bytes")), "records")
    first = narrow.groupBy("digest").agg(F.min("page_id").alias("first_page"))
    revisit = (F.col("n_bytes") >= least) & (F.col("page_id") > F.col("first_page"))
    records = narrow.join(first, "digest").withColumns({
        "record_type": F.when(revisit, "revisit").otherwise("response"),
        "refers_to": F.when(revisit, F.col("first_page")),
    })
    records.select("digest", _header(date).cast("binary").alias("header")).write.parquet(f"{folder}/headers")
    once = raw.select("digest", "payload").dropDuplicates(["digest"])
    once.write.option("compression", "zstd").parquet(f"{folder}/payloads")


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Every record as (header, payload, record): its header block, its full payload and the record's own bytes.

    A revisit has no payload bytes in the record; ``payload`` is then that of the record it refers to. A payload whose bytes do
    not have their digest any more is an error.
    """
    headers = spark.read.schema("digest string, header binary").parquet(f"{folder}/headers")
    payloads = spark.read.schema("digest string, payload binary").parquet(f"{folder}/payloads")
    sound = F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("payload differs from its digest "), "digest")).cast("binary")
    )
    joined = headers.join(payloads.select("digest", sound.alias("payload")), "digest")
    own = F.when(_value("WARC-Type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return joined.select("header", "payload", F.concat("header", own, F.lit(b"\r\n\r\n")).alias("record"))


def _value(name: str) -> Column:
    """The value of the first header line of that name, or the empty text."""
    return F.regexp_extract(F.col("header").cast("string"), rf"\r\n{name}: ([^\r]*)\r\n", 1)


def described(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of records that have been read."""
    page = F.regexp_extract(_value("WARC-Record-ID"), r"<urn:page:(-?\d+)>", 1).try_cast("long")
    target = F.regexp_extract(_value("WARC-Refers-To"), r"<urn:page:(-?\d+)>", 1).try_cast("long")
    return records.select(
        page.alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
        _value("WARC-Type").alias("record_type"),
        target.alias("refers_to"),
    )


def archived(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to a new archive in the shared folder and describe what is read back."""
    folder = new_folder(pages.sparkSession, "warc")
    write_archive(pages, folder)
    return described(read_archive(pages.sparkSession, folder))
