"""Repeated passages of whole words, as the pipeline cuts them, against a plain version."""

import random
import re

import brute
import duckdb
import pytest

import corpus_pipeline
from newsmart.llm import suffixdedup

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"


def spans(rows, length, copies="later", size=None):
    """{id: bytes of the text that repeated runs of ``length`` words (and strings of ``size`` bytes) cover}"""
    data = sorted((i, (t or "").encode()) for i, t in rows)
    out = {i: bytearray(len(d)) for i, d in data}

    def mark(units):
        times, seen = {}, set()
        for _, keys in units:
            for key, _, _ in keys:
                times[key] = times.get(key, 0) + 1
        for i, keys in units:
            for key, low, high in keys:
                if times[key] > 1 if copies == "all" else key in seen:
                    out[i][low:high] = b"\1" * (high - low)
                seen.add(key)

    found = [(i, list(re.finditer(rb"[^\x20\x09-\x0D]+", d))) for i, d in data]
    mark([
        (i, [(tuple(m[0] for m in w[k : k + length]), w[k].start(), w[k + length - 1].end()) for k in range(len(w) - length + 1)])
        for i, w in found
    ])
    if size:
        mark([(i, [(d[p : p + size], p, p + size) for p in range(len(d) - size + 1)]) for i, d in data])
    return {i: bytes(b for b, g in zip(d, out[i], strict=True) if not g) for i, d in data}


def test_pipeline_cuts_passages_of_over_fifty_short_words(spark):
    rng = random.Random(3)
    short = [f"{rng.choice('abcdefgh')}{rng.choice('ijkl')}" for _ in range(51)]
    assert len(" ".join(short)) < 400
    fifty = [f"{rng.choice('mnopq')}{rng.choice('rstu')}" for _ in range(50)]
    wide = "".join(chr(0x4E00 + n) for n in range(150))
    rows = [
        (1, "the first one has " + " ".join(short) + " and goes on"), (2, "another begins\n" + " \n".join(short) + "\tbut ends"),
        (3, "third " + " ".join(fifty) + " tail"), (4, "fourth " + " ".join(fifty) + " end"), (5, "x" + wide), (6, "y" + wide),
        (7, None), (8, ""),
    ]
    left = corpus_pipeline.cut_repeats(spark, spark.createDataFrame(rows, SCHEMA), "")
    texts = {r.doc_id: r.text for r in left.collect()}
    assert texts == dict(rows) | {2: "another begins\n\tbut ends", 6: "y"}


def test_pipeline_cuts_all_passages_of_the_given_documents(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall()
    expected, _ = brute.components(rows, 5)
    rows = [(i, t) for i, t in rows if expected[i] == i]
    left = corpus_pipeline.cut_repeats(spark, spark.createDataFrame(rows, SCHEMA), "").collect()
    wanted = spans(rows, 51, size=400)
    assert {r.doc_id for r in left if r.text != dict(rows)[r.doc_id]} == {i for i, t in rows if wanted[i] != t.encode()}
    assert {r.doc_id: r.text for r in left} == {i: t.decode("utf-8", "replace") for i, t in wanted.items()}


@pytest.mark.parametrize("copies", ["all", "later"])
def test_frequent_passage_of_words_over_several_shards(spark, copies):
    rng = random.Random(9)
    passage = [rng.choice("abcdef") * rng.randint(1, 3) for _ in range(40)]
    rows = [
        (i, " ".join([rng.choice("ghij") for _ in range(rng.randint(0, 30))] + passage[rng.randint(0, 8) :] + ["k"] * rng.randint(0, 25)))
        for i in range(60)
    ]
    settings = suffixdedup.Repeats(length=20, gram=5, shard=700, runs_per_shard=7, words=True)
    found = suffixdedup.without_repeats(spark.createDataFrame(rows, SCHEMA), settings, copies).collect()
    assert {r.doc_id: r.text.encode() for r in found} == spans(rows, 20, copies)


def test_passages_are_reported_beside_the_removed_strings(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall()
    found = {r.doc_id: r for r in suffixdedup.removed(spark.createDataFrame(rows, SCHEMA), beside=suffixdedup.PASSAGES).collect()}
    plain, wanted = brute.repeats(rows, 400), spans(rows, 51, "all")
    assert {i: tuple(r)[1:5] for i, r in found.items()} == plain
    assert {i: r.n_passage_bytes for i, r in found.items()} == {i: len((t or "").encode()) - len(wanted[i]) for i, t in rows}
    assert any(r.n_passage_bytes and not r.n_removed for r in found.values())
