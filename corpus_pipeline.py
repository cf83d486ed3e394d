"""The training-data pipeline over ``documents``: five filtering and encoding stages, each written as Parquet.

Each stage works on all that its predecessor kept, and its decisions take effect: toxic documents go, one document of each
group of near copies stays, later copies of repeated strings are cut out of the texts, contaminated documents go, and
what is left is encoded. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from newsmart.llm import bpe, decontam, minhash, suffixdedup, toxicity
from newsmart.llm.queries import VOCABULARY
from newsmart.llm.tables import read, small_batches, stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the threshold go; learned from the labels of these documents."""
    return toxicity.without_toxic(docs, read(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8) the smallest doc_id stays."""
    return minhash.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 51 words and more, and strings of 400 bytes and more, that an earlier document or place has are cut out
    of the text."""
    return suffixdedup.without_repeats(docs, (suffixdedup.PASSAGES, suffixdedup.Repeats()))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows cover a twentieth or more of the words go."""
    return decontam.remove_contaminated(docs, read(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, as counts and digests, and the digest of the text decoded from them."""
    small_batches(spark)
    return bpe.round_trip(docs, VOCABULARY)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_copies),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", drop_contaminated),
    ("bpe_encode_decode", encode),
]

#: Trees, components and suffix arrays are not SQL; the tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
