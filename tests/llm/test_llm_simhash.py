"""SimHash fingerprints and their components against plain versions."""

import itertools
import random
import re

import duckdb
import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st

from newsmart.llm import simhash

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"
LOWER = {c: c + 32 for c in range(65, 91)}


def plain_fingerprint(text, length=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + length]) for i in range(max(len(words) - length + 1, 1))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(prints):
    """{fingerprint: least fingerprint reachable} over all pairs."""
    known = np.array(sorted(set(prints)), np.uint64)
    labels = np.arange(len(known))
    for i, fp in enumerate(known):
        for j in np.flatnonzero(np.bitwise_count(known ^ fp) <= 3).tolist():
            if labels[i] != labels[j]:
                low, high = sorted((labels[i], labels[j]))
                labels[labels == high] = low
    return {int(fp): int(known[label]) for fp, label in zip(known, labels, strict=True)}


def expected(rows):
    prints = [(i, plain_fingerprint(t)) for i, t in rows]
    classes, least = plain_classes([fp for _, fp in prints]), {}
    for i, fp in prints:
        if i is not None:
            least[classes[fp]] = min(i, least.get(classes[fp], i))
    return sorted(((i, f"{fp:016x}", least.get(classes[fp])) for i, fp in prints), key=repr)


def found(spark, rows, **settings):
    frame = spark.createDataFrame(rows, SCHEMA)
    return sorted(map(tuple, simhash.near_duplicates(frame, simhash.Near(**settings)).collect()), key=repr)


def signed(values):
    return np.array(list(values), np.uint64).view(np.int64).tolist()


def classes_of(spark, prints, **settings):
    """Classes that the links give to distinct fingerprints."""
    frame = spark.createDataFrame([(fp,) for fp in signed(set(prints))], "fp long")
    parent = {fp: fp for fp in set(prints)}

    def root(fp):
        while parent[fp] != fp:
            fp = parent[fp]
        return fp

    for a, b in simhash.links(frame, simhash.Near(**settings)).collect():
        a, b = a % 2**64, b % 2**64
        assert (a ^ b).bit_count() <= 3
        one, two = sorted((root(a), root(b)))
        parent[two] = one
    return {fp: root(fp) for fp in parent}


def clustered(rng, centres, members, flips):
    out = set()
    for _ in range(centres):
        centre = rng.getrandbits(64)
        out |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, flips))) for _ in range(members)}
    return out


def test_code_is_perfect():
    golay = simhash.Golay()
    words = np.arange(1 << 23)
    code = np.unique(words ^ golay.error[golay.syndrome(words)])
    assert len(code) == 4096 and not golay.syndrome(code).any()
    weights = np.bitwise_count(code)
    assert sorted(set(weights.tolist())) == [0, 7, 8, 11, 12, 15, 16, 23]


@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=3))
@settings(max_examples=300, deadline=None)
def test_close_fingerprints_meet(fp, flips):
    golay, other = simhash.Golay.__new__(simhash.Golay), fp ^ sum(1 << b for b in flips)
    golay.__dict__.update(GOLAY.__dict__)
    x, y = (simhash.segments(np.array([v], np.uint64)) for v in (fp, other))
    met = False
    for i, j in simhash.PAIRS:
        around = set(golay.messages_around(x[j], simhash.SEGMENTS[j])[1].tolist())
        assert len(around) <= 6
        met |= x[i] == y[i] and golay.message(y[j])[0] in around
    assert met


GOLAY = simhash.Golay()


@pytest.mark.parametrize("crowd", [4096, 10, 1])
def test_links_join_what_all_pairs_join(spark, crowd):
    rng = random.Random(crowd)
    prints = clustered(rng, 30, 20, 4) | clustered(rng, 3, 200, 2) | {rng.getrandbits(64) for _ in range(300)} | {0, 2**64 - 1, 1, 7}
    assert classes_of(spark, prints, crowd=crowd) == plain_classes(prints)


def test_crowded_buckets_of_unlike_fingerprints(spark):
    """All share their upper 44 bits, so they meet in one bucket, but few are linked."""
    rng = random.Random(4)
    prints = {(0xABCDE << 44) | rng.getrandbits(20) << 3 for _ in range(400)}
    classes = plain_classes(prints)
    assert classes_of(spark, prints, crowd=50) == classes


def test_texts(spark):
    rng = random.Random(1)
    base = [f"w{rng.randint(0, 400)}" for _ in range(300)]
    rows = [(i, " ".join(base[: 100 + i] + [f"x{i}"] + base[100 + i :])) for i in range(40)]
    rows += [(100, "One two"), (101, "one\ttwo"), (102, "one two three"), (103, "ONE  two\nthree"), (104, "É one two"), (105, "é one two")]
    rows += [(200, None), (201, ""), (202, " \n"), (203, "a b c " * 30_000), (103, "another text of one id"), (None, "one two"), (None, "no id here")]
    assert found(spark, rows) == expected(rows)
    assert len({c for i, _, c in expected(rows) if i is not None and i < 40}) < 40


def test_no_rows_one_row_repeated_rows_and_other_columns(spark):
    assert found(spark, []) == []
    assert found(spark, [(5, "a b")]) == [(5, f"{plain_fingerprint('a b'):016x}", 5)]
    rows = [(5, "a b c d")] * 3
    assert found(spark, rows) == expected(rows)
    frame = spark.createDataFrame([(1, "a b c", 2, 3, "x")], SCHEMA + ", fp long, bucket long, fingerprint string")
    assert [tuple(r) for r in simhash.near_duplicates(frame).collect()] == expected([(1, "a b c")])


def test_given_documents(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall()
    wanted = expected(rows)
    assert found(spark, rows) == wanted
    assert any(c != i for i, _, c in wanted)


def test_spanning_links_are_few():
    prints = np.array([1 << b for b in range(40)], np.uint64)
    links = simhash.spanning_links(prints, np.full(40, 2))
    assert len(links) == 39 and all((a ^ b).bit_count() <= 3 for a, b in links)
    assert list(itertools.chain(*links))
