"""Registered queries of the subpackage and their comparison SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from newsmart.llm import (
    alignment, bpe, decontam, imatch, langid, merkle, minhash, simhash, suffixdedup, tagpath, toxicity, urlfilter, warc,
)
from newsmart.llm.tables import read

#: The tokenizer file of the byte-pair query.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
#: The piece model of the alignment query.
PIECES = public_tokenizers.path("piece_bpe_32k.model")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_imatch_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document, of its edited text, and how alike they are."""
    return imatch.fingerprints(read(spark, folder, "documents"))


@query
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document's whole text, learned from the labels that are not held out."""
    return toxicity.judged(read(spark, folder, "documents"), read(spark, folder, "labels"))


@query
def op7_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Components of near-equal documents over two-word shingles and a similarity of 0.8."""
    return minhash.near_duplicates(read(spark, folder, "documents"), minhash.Near(words=2))


@query
def op8_bpe_encode_decode(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document's text and the text decoded from them, as digests."""
    return bpe.round_trip(read(spark, folder, "documents"), VOCABULARY)


@query
def op9_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that lie in benchmark windows of 13 words."""
    return decontam.contamination(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


@query
def op10_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes of every document that a string of 400 bytes found elsewhere too covers, and those that repeated passages of over
    fifty words cover, however short the words are."""
    return suffixdedup.removed(read(spark, folder, "documents"), beside=suffixdedup.PASSAGES)


#: The rules of the url query (host, path, verdict). Fixed values.
URL_RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


@query
def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document's whole text, learned from the documents that are not held out."""
    return langid.predicted(read(spark, folder, "documents"))


@query
def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Host, path, deciding rule and verdict of every page's url."""
    return urlfilter.verdicts(read(spark, folder, "pages"), URL_RULES)


ORACLES["op4_url_filter"] = r"""
WITH cut AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages
), parts AS (
    SELECT page_id,
        translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM cut
), rules(rule_host, rule_path, said) AS (
    VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), fit AS (
    SELECT page_id, host, path, rule_host || rule_path AS rule, said,
        row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC) AS n
    FROM parts LEFT JOIN rules
        ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule, coalesce(said, 'allow') AS verdict FROM fit WHERE n = 1
"""


@query
def op5_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return tagpath.texts(read(spark, folder, "pages"))


@query
def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Records of a content-addressed archive of all pages, as read back from it."""
    return warc.archived(read(spark, folder, "pages"))


ORACLES["op6_warc"] = """
WITH payloads AS (
    SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages
), firsts AS (
    SELECT *, min(page_id) OVER (PARTITION BY digest) AS least FROM payloads
)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
    CASE WHEN n >= 100 AND page_id > least THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN n >= 100 AND page_id > least THEN least END AS refers_to
FROM firsts
"""


@query
def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Leaf, root, proof and folded root of every document."""
    return merkle.manifest(read(spark, folder, "documents"))


ORACLES["op11_merkle_manifest"] = """
WITH RECURSIVE rows_of AS (
    SELECT *, coalesce('=' || lang, '') AS tree,
        coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
            || coalesce(strlen(lang) || ':' || lang, '-') AS head,
        coalesce(strlen(text) || ':' || text, '-') AS tail,
        n_chars IS NOT NULL AND xor(list_reduce(
            list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(CAST(doc_id AS VARCHAR), '.'), lambda c: CAST(ascii(c) AS BIGINT))),
            lambda crc, c: list_reduce(
                list_prepend(xor(crc, c), CAST(range(8) AS BIGINT[])),
                lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END
            )
        ), 4294967295) % 7 = 0 AS tampered
    FROM documents
), leaves AS (
    SELECT doc_id, tree, sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
        CASE WHEN tampered THEN sha256(head || strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1) || tail) END AS changed
    FROM rows_of
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n
    FROM leaves
), nodes AS (
    SELECT tree, 0 AS level, pos, n, leaf AS node FROM placed
    UNION ALL
    SELECT tree, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(node, '' ORDER BY pos)) FROM nodes WHERE n > 1
    GROUP BY tree, level, pos // 2, n
), subroots AS (
    SELECT tree, node, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1
), tops AS (
    SELECT 0 AS level, pos, n, node FROM subroots
    UNION ALL
    SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(node, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY level, pos // 2, n
), folds AS (
    SELECT doc_id, tree, leaf, 0 AS level, pos, pos AS place, n, coalesce(changed, leaf) AS node, '' AS siblings FROM placed
    UNION ALL
    SELECT f.doc_id, f.tree, f.leaf, f.level + 1, f.pos // 2, f.place, (f.n + 1) // 2,
        sha256(CASE WHEN f.pos % 2 = 1 THEN s.node || f.node ELSE f.node || coalesce(s.node, '') END), f.siblings || coalesce(s.node, '')
    FROM folds f LEFT JOIN nodes s ON s.tree = f.tree AND s.level = f.level AND s.pos = xor(f.pos, 1) WHERE f.n > 1
), above AS (
    SELECT f.doc_id, f.leaf, t.node AS subroot, 0 AS level, t.pos, f.tree, f.place, t.n, f.node, f.siblings
    FROM folds f JOIN subroots t USING (tree) WHERE f.n = 1
    UNION ALL
    SELECT f.doc_id, f.leaf, f.subroot, f.level + 1, f.pos // 2, f.tree, f.place, (f.n + 1) // 2,
        sha256(CASE WHEN f.pos % 2 = 1 THEN s.node || f.node ELSE f.node || coalesce(s.node, '') END), f.siblings || coalesce(s.node, '')
    FROM above f LEFT JOIN tops s ON s.level = f.level AND s.pos = xor(f.pos, 1) WHERE f.n > 1
)
SELECT a.doc_id, a.leaf, a.subroot, t.node AS root, sha256(a.siblings) AS proof_sha256, a.node AS folded_root, a.node = t.node AS verified
FROM above a, tops t WHERE a.n = 1 AND t.n = 1
"""


@query
def op13_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and the components of those that differ in three bits at most."""
    return simhash.near_duplicates(read(spark, folder, "documents"))


@query
def op12_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Groups and links between the tokens of two tokenizers in every document, and how common the links are."""
    return alignment.alignment(read(spark, folder, "documents"), alignment.Tokenizers(VOCABULARY, PIECES))
