"""The document operators against plain versions, on the given small tables and on awkward ones."""

import hashlib
import random

import brute
import duckdb
import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from newsmart.llm import bpe, decontam, imatch, langid, minhash, suffixdedup, toxicity
from newsmart.llm import text_arrays as A
from newsmart.llm.components import components
from newsmart.llm.queries import QUERIES, VOCABULARY

FOLDER = "/root/testdata/sf0.001"
LONG = "word " * 30_000
#: Names that the operators use themselves.
EXTRA = ["row", "found", "id", "tag", "label", "score", "n_words", "band", "source", "c0", "kept", "matches"]
SCHEMA = "doc_id long, text string, " + ", ".join(f"{n} string" for n in EXTRA)


def table(name, columns="doc_id, text"):
    return duckdb.sql(f"SELECT {columns} FROM '{FOLDER}/{name}.parquet'").fetchall()


@pytest.fixture(scope="module")
def awkward(spark):
    passage = " ".join(f"passage{i}" for i in range(90))
    texts = [
        (1, "A few words that stand here."), (2, None), (3, ""), (4, "  \n\t "), (5, "one"), (6, "ONE"), (7, LONG),
        (8, "x" * 3000), (9, "ü" * 500 + passage), (10, passage + " 日本語 😀"), (11, "A few words that stand here."),
        (11, "A few words that stand here."), (None, "A few words that stand here."), (None, None), (12, "!!! ???"),
    ]
    return spark.createDataFrame([(i, t, *["x"] * len(EXTRA)) for i, t in texts], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_words_equal_regular_expressions():
    texts = ["Ab c", None, "", "x-y ZÜ日 9", "\tA\x0bB\x00c ", "some words " * 100_000, "ab", "ab"]
    found = A.words(A.Texts.of(pa.array(texts)), A.NOT_SPACE)
    data = A.Texts.of(pa.array(texts)).data
    for i, text in enumerate(texts):
        spans = range(found.bounds[i], found.bounds[i + 1])
        assert [A.LOWER[data[found.starts[n] : found.ends[n]]].tobytes().decode() for n in spans] == brute.near_words(text)
    assert found.hashes[-1] == found.hashes[-2]


def test_op7_equals_all_pairs(spark):
    expected, sizes = brute.components(table("documents"))
    rows = QUERIES["op7_minhash_near_dedup"](spark, FOLDER).collect()
    assert {r.doc_id: (r.component_id, r.n_shingles, r.kept) for r in rows} == {
        i: (c, sizes[i], c == i) for i, c in expected.items()
    }
    assert any(not r.kept for r in rows)


def test_near_copies_around_the_threshold_in_small_blocks(spark):
    rng = random.Random(4)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(160):
        words = list(base)
        for _ in range(rng.randint(0, 9)):
            words[rng.randrange(60)] = f"v{rng.randrange(10_000)}"
        rows.append((i, " ".join(words)))
    settings = minhash.Near(words=2, block=16, centres=1, links=1)
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), settings).collect()
    expected, _ = brute.components(rows)
    assert {r.doc_id: r.component_id for r in found} == expected
    assert len(set(expected.values())) > 1


def test_near_duplicates_of_awkward_rows(awkward, empty):
    rows = minhash.near_duplicates(awkward).collect()
    assert len(rows) == awkward.count()
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert [by_id[i].n_shingles for i in (2, 3, 4, 5)] == [0, 0, 0, 1]
    assert (by_id[6].component_id, by_id[11].component_id, by_id[2].component_id) == (5, 1, 2)
    assert {r.component_id for r in rows if r.doc_id is None} == {1, None}
    kept = minhash.keep_one(awkward)
    assert kept.columns == awkward.columns
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == [1, 2, 3, 4, 5, 7, 8, 9, 12]
    assert minhash.near_duplicates(empty).count() == 0


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(61)} | {100: 100, 101: 100}


def test_op9_equals_plain_search(spark):
    items = [(str(i), t) for i, t in table("benchmark", "item_id, text")]
    expected = brute.contamination(table("documents"), items)
    rows = QUERIES["op9_benchmark_decontamination"](spark, FOLDER).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows} == expected
    assert any(r.contaminated for r in rows)


def test_contamination_by_short_and_repeated_items_in_blocks(spark, awkward, empty):
    docs = [(1, "a b c d a b " * 5), (2, "c " * 20), (3, None), (4, "The A-B thing"), (5, "")]
    items = [("i", "a b"), ("j", "C D A"), ("k", None), ("l", "!"), ("i", "b c d"), ("m", " ".join("abcdabcdabcdabcd"))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id string, text string")
    for settings in (decontam.Contamination(), decontam.Contamination(block=8)):
        rows = decontam.contamination(frame, bench, settings).collect()
        assert {r.doc_id: tuple(r)[1:] for r in rows} == brute.contamination(docs, [(i, t) for i, t in items])
    kept = decontam.remove_contaminated(awkward, bench)
    assert kept.columns == awkward.columns and kept.count() == awkward.count()
    assert decontam.contamination(empty, bench).count() == 0
    assert {r.n_hit for r in decontam.contamination(awkward, bench.limit(0)).collect()} == {0}


def test_longest_matches_have_places(spark):
    frame = spark.createDataFrame([(1, "x x " + " ".join("abcdefghijklmnop") + " y")], "doc_id long, text string")
    bench = spark.createDataFrame([("i", " ".join("bcdefghijklmnopq"))], "item_id string, text string")
    found = decontam.matches(frame, bench).select("found.matches").first()[0]
    assert [tuple(m) for m in found] == [("i", 3, 15)]


@pytest.mark.parametrize("copies", ["all", "later"])
def test_removed_repeats_equal_plain_version(spark, copies):
    rows = table("documents")
    expected = brute.repeats(rows, 400, copies)
    found = suffixdedup.removed(spark.createDataFrame(rows, "doc_id long, text string"), copies=copies).collect()
    assert {r.doc_id: tuple(r)[1:] for r in found} == expected
    assert any(r.n_spans for r in found)


@pytest.mark.parametrize("copies", ["all", "later"])
def test_repeats_of_a_frequent_passage_over_several_shards(spark, copies):
    rng = random.Random(9)
    passage = "".join(rng.choice("abcdef ") for _ in range(120))
    rows = [
        (i, "".join(rng.choice("ghij") for _ in range(rng.randint(0, 90))) + passage[rng.randint(0, 20) :] + "k" * rng.randint(0, 70))
        for i in range(60)
    ]
    settings = suffixdedup.Repeats(length=60, gram=16, shard=2000, runs_per_shard=7)
    found = suffixdedup.removed(spark.createDataFrame(rows, "doc_id long, text string"), settings, copies).collect()
    assert {r.doc_id: tuple(r)[1:] for r in found} == brute.repeats(rows, 60, copies)


def test_shards_exchange_few_strings_of_near_copies(spark, monkeypatch):
    """Of near copies with one edit each, strings whose part of a slot no other shard has are not exchanged one by one."""
    stored, stage = {}, suffixdedup.stage
    monkeypatch.setattr(suffixdedup, "stage", lambda df, name: stored.setdefault(name, stage(df, name)))
    rng = random.Random(4)
    copy = "".join(rng.choice("abcdef ") for _ in range(200))
    rows = [(i, copy[:at] + f"<{i}>" + copy[at + 1 :]) for i, at in enumerate(rng.choices(range(20, 180), k=90))]
    settings = suffixdedup.Repeats(length=60, gram=16, shard=2000, runs_per_shard=7)
    found = suffixdedup.removed(spark.createDataFrame(rows, "doc_id long, text string"), settings).collect()
    assert {r.doc_id: tuple(r)[1:] for r in found} == brute.repeats(rows, 60)
    held = [(r.anchor, c.slot, bytes(c.core), sum(len(p.strings) for p in c.parts)) for r in stored["factors"].collect() for c in r.cores]
    cores = [core[:3] for core in held]
    below = sum(core[3] for core in held if cores.count(core[:3]) > 1)
    assert 0 < stored["strings"].count() < 0.7 * below


def test_repeats_of_awkward_rows(awkward, empty):
    rows = suffixdedup.removed(awkward).collect()
    assert len(rows) == awkward.count()
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert (by_id[2].n_bytes, by_id[7].n_removed, by_id[8].n_removed) == (0, len(LONG), 3000)
    assert by_id[10].n_removed >= 800 and by_id[10].n_spans == 1
    left = suffixdedup.without_repeats(awkward)
    assert left.columns == awkward.columns and left.count() == awkward.count()
    texts = {r.doc_id: r.text for r in left.collect()}
    assert texts[1] == "A few words that stand here." and texts[2] is None and texts[7] == "word "
    assert suffixdedup.removed(empty).count() == 0


def test_longest_previous_factors():
    assert suffixdedup.previous_factors(b"abaabaab") == [0, 0, 1, 5, 4, 3, 2, 1]
    assert suffixdedup.previous_factors(b"") == []
    order, _ = suffixdedup.suffix_order(np.frombuffer(b"mississippi", np.uint8), 11)
    assert order.tolist() == [10, 7, 4, 1, 0, 9, 8, 6, 3, 5, 2]


def test_op8_equals_the_library(spark, awkward, empty):
    library = Tokenizer.from_file(VOCABULARY)
    tricky = ["<|endoftext|>", "a<|endoftext|> b", "I'll we've 'S  x\n\n y ", " " * 3000, "ab" * 2000, "é日本😀\xa0\x85 ½", "don't"]
    rng = random.Random(2)
    tricky += ["".join(rng.choice("aeb' \n\t.,0é日½Ⅷ\x1c") for _ in range(40)) for _ in range(300)]
    rows = [*enumerate(tricky, 10_000), *table("documents")]
    found = bpe.round_trip(spark.createDataFrame(rows, "doc_id long, text string"), VOCABULARY).collect()
    for row, (doc, text) in zip(sorted(found), sorted(rows), strict=True):
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected = (doc, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
        assert tuple(row) == expected
    again = bpe.round_trip(awkward, VOCABULARY)
    assert again.count() == awkward.count() and again.where("doc_id = 2").first().n_tokens == 0
    assert bpe.round_trip(empty, VOCABULARY).count() == 0


def test_op1_edits_and_likeness(spark):
    rows = sorted(((i, t or "") for i, t in table("documents")), reverse=True)
    found = {r.doc_id: r for r in QUERIES["op1_imatch_fingerprints"](spark, FOLDER).collect()}
    assert len(found) == len(rows)
    prints = {}
    for n, (doc, text) in enumerate(rows):
        following, half = rows[(n + 1) % len(rows)][1], len(text) // 2
        edit = text[: len(text) - half] + following[:half]
        assert found[doc].edited_sha256 == hashlib.sha256(edit.encode()).hexdigest() and found[doc].n_chars == len(text)
        prints.setdefault(text, set()).add(found[doc].fingerprint)
    assert all(len(p) == 1 for p in prints.values())
    mean = [sum(getattr(r, c) for r in found.values()) / len(found) for c in ("near_edited", "near_next")]
    assert mean[0] > 0.15 > 5 * mean[1]


def test_fingerprints_of_awkward_rows(spark, awkward, empty):
    rows = imatch.fingerprints(awkward).collect()
    assert len(rows) == awkward.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[2].fingerprint == by_id[3].fingerprint == by_id[12].fingerprint == "empty"
    assert by_id[3].near_edited == 1.0 and by_id[1].fingerprint == by_id[11].fingerprint
    single = imatch.fingerprints(spark.createDataFrame([(5, "abcd")], "doc_id long, text string")).collect()
    assert [(r.n_chars, r.edited_sha256) for r in single] == [(4, hashlib.sha256(b"abab").hexdigest())]
    assert imatch.fingerprints(empty).count() == 0


def test_op2_ranks_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in QUERIES["op2_toxicity"](spark, folder).collect()}
    labels = duckdb.sql(f"SELECT doc_id, toxic FROM '{folder}/labels.parquet'").fetchall()
    held = [(rows[i].score, t) for i, t in labels if rows[i].held_out]
    bad, good = [s for s, t in held if t], [s for s, t in held if not t]
    assert sum((b > g) + (b == g) / 2 for b in bad for g in good) / len(bad) / len(good) > 0.8
    assert all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in rows.values())


def test_toxicity_of_awkward_rows(spark, awkward, empty):
    none = spark.createDataFrame([(1, 1), (2, None), (3, 5)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.judged(awkward, none).collect()} == {1.0}
    assert {r.score for r in toxicity.judged(awkward, none.limit(0)).collect()} == {0.0}
    rows = [(i, "you utter fool " * (i % 2) + f"some plain text {i}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int")
    scores = {r.doc_id: r.score for r in toxicity.judged(docs, labels).collect()}
    assert min(scores[i] for i in range(1, 400, 2)) > 0.7 > 0.3 > max(scores[i] for i in range(0, 400, 2))
    model = toxicity.fit(docs, labels)
    assert toxicity.score(awkward, model).select("row.*").columns == awkward.columns
    assert toxicity.score(awkward, model).count() == awkward.count() and toxicity.score(empty, model).count() == 0


def test_op3_finds_held_out_languages(spark):
    found = QUERIES["op3_language_id"](spark, FOLDER).collect()
    langs = dict(table("documents", "doc_id, lang"))
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.95 * len(held) > 0


def test_language_of_awkward_rows(spark, awkward, empty):
    docs = awkward.selectExpr("doc_id", "text", "'en' AS lang")
    rows = {r.doc_id: r for r in langid.predicted(docs).collect()}
    assert [rows[i].lang_pred for i in (2, 3, 4, 12)] == ["und"] * 4 and rows[1].lang_pred == "en"
    nothing = langid.identify(awkward, {})
    assert {r.found.lang_pred for r in nothing.collect()} == {"und"} and nothing.select("row.*").columns == awkward.columns
    assert langid.predicted(docs.limit(0)).count() == 0
