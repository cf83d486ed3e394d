"""The alignment of two tokenizers against a plain version."""

import collections
import hashlib
import json
import random

import duckdb
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from newsmart.llm import alignment

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"
PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def spell():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=PATHS[1])
    signs = {v: k for k, v in {b: chr(b) for b in [*range(33, 127), *range(161, 173), *range(174, 256)]}.items()}
    missing = [b for b in range(256) if b not in signs.values()]
    signs |= {chr(256 + n): b for n, b in enumerate(missing)}
    tokens = {i: t for t, i in json.load(open(PATHS[0]))["model"]["vocab"].items()}

    def both(text):
        one = [(i, bytes(signs[c] for c in tokens[i])) for i in a.encode(" " + text, add_special_tokens=False).ids]
        two = [
            (i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode())
            for i, p in ((i, b.id_to_piece(i)) for i in b.encode(text))
        ]
        return one, two

    return both


def spans(tokens):
    at, out = 0, []
    for i, raw in tokens:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def plain(rows, spell):
    found, counts = [], collections.Counter()
    for doc, text in rows:
        one, two = spell(text) if text else ([], [])
        raw = (" " + (text or "")).encode()
        if not text or b"".join(r for _, r in one) != raw or b"".join(r for _, r in two) != raw:
            found.append((doc, [], [], [], []))
            continue
        a, b = spans(one), spans(two)
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, low = [], 0
        for cut in cuts:
            groups.append(tuple([i for i, s, e in side if low <= s and e <= cut] for side in (a, b)))
            low = cut
        links = [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e]
        counts.update(set(links))
        found.append((doc, a, b, groups, links))
    best = {}
    for (i, _), n in counts.items():
        best[i] = max(n, best.get(i, 0))
    out = []
    for doc, a, b, groups, links in found:
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        digest = hashlib.sha256(shown.encode()).hexdigest() if a else ""
        n_best = sum(counts[link] == best[link[0]] for link in links)
        out.append((doc, len(a), len(b), len(groups), len(links), n_best, sum(counts[link] for link in links), digest))
    return sorted(out, key=repr)


def found(spark, rows, schema=SCHEMA):
    frame = spark.createDataFrame(rows, schema)
    return sorted(map(tuple, alignment.alignment(frame, alignment.Tokenizers(*PATHS)).collect()), key=repr)


def texts():
    rng = random.Random(2)
    words = "the cat sat on größe naïve 日本語 🙂🙂 <|endoftext|> </s> <0x41> antidisestablishmentarianism x1y2 \t \n\n   it's".split(" ")
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 40)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, " "), (103, "  two"), (104, "a▁b"), (105, " nbsp "), (106, "\x00\x01"), (107, "é")]
    return rows + [(100, "a b"), (None, "the cat"), (None, "the cat"), (None, None), (108, "word " * 3000), (109, "the cat sat")]


@pytest.mark.parametrize("hot", [1 << 15, 20, 0])
def test_texts(spark, spell, monkeypatch, hot):
    monkeypatch.setattr(alignment, "HOT", hot)
    rows = texts()
    assert found(spark, rows) == plain(rows, spell)
    assert any(r[1] == 0 and r[0] == 104 for r in plain(rows, spell))


def test_no_rows_and_other_columns(spark, spell):
    assert found(spark, []) == []
    rows = [(1, "one two", 5, [1], "x"), (2, "one", 6, [], "y")]
    assert found(spark, rows, SCHEMA + ", row long, pairs array<int>, n_a string") == plain([r[:2] for r in rows], spell)


def test_partial_counts_of_several_rounds(spark, spell, monkeypatch):
    rows = texts()
    frame = alignment.aligned(spark.createDataFrame(rows, SCHEMA).coalesce(1), alignment.Tokenizers(*PATHS)).cache()
    whole = {r.pair: (r.n, r.best) for r in alignment.pair_counts(frame).collect()}
    monkeypatch.setattr(alignment, "HELD", 3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    assert {r.pair: (r.n, r.best) for r in alignment.pair_counts(frame).collect()} == whole
    frame.unpersist()


def test_groups_are_the_tokens_in_order(spark, spell):
    rows = texts()
    frame = spark.createDataFrame(rows, SCHEMA)
    for r in alignment.groups(frame, alignment.Tokenizers(*PATHS)).collect():
        one, two = spell(r.row.text) if r.found.groups else ([], [])
        assert [i for g in r.found.groups for i in g.a] == [i for i, _ in one]
        assert [i for g in r.found.groups for i in g.b] == [i for i, _ in two]


def test_given_documents(spark, spell):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall()
    assert found(spark, rows) == plain(rows, spell)
