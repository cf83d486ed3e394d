"""Fingerprints of documents whose ids are hashes of 64 bits."""

import hashlib

from newsmart.llm import imatch


def test_no_document_with_a_large_id_is_lost(spark):
    ids = [(1 << 62) + 1_000_003 * n + n % 7 for n in range(600)] + [-(1 << 62) - 777 * n for n in range(300)]
    rows = sorted(((i, f"text of {i} with words {n}") for n, i in enumerate(ids)), reverse=True)
    found = imatch.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    following = dict(zip((i for i, _ in rows), [t for _, t in rows[1:]] + [rows[0][1]], strict=True))
    assert {r.doc_id: r.edited_sha256 for r in found} == {
        i: hashlib.sha256(imatch.edited(t, following[i]).encode()).hexdigest() for i, t in rows
    }
    assert len(found) == len(rows)
