"""The Merkle manifest against a plain version: trees of every shape, proofs, tampered rows."""

import hashlib
import random
import zlib

import duckdb
import pytest

from newsmart.llm import merkle

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    values = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row]
    return digest(*values)


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def path(levels, place):
    """(siblings left, siblings right) from the leaf up."""
    for level in levels[:-1]:
        first = place // 2 * 2
        yield level[first:place], level[place + 1 : first + 2]
        place //= 2


def expected(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = {}
    for lang in names:
        ordered = sorted(groups[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[lang] = (ordered, tree([leaf(r) for r in ordered]))
    top = tree([trees[lang][1][-1][0] for lang in names])
    out = []
    for place, lang in enumerate(names):
        ordered, levels = trees[lang]
        for i, row in enumerate(ordered):
            steps = [*path(levels, i), *path(top, place)]
            node = leaf(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[3] is not None:
                node = leaf((*row[:3], row[3] + 1, row[4]))
            for left, right in steps:
                node = digest(*left, node, *right)
            proof = digest(*[s for left, right in steps for s in (*left, *right)])
            out.append((row[0], leaf(row), levels[-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(out, key=repr)


def found(spark, rows, height, schema=SCHEMA):
    return sorted(map(tuple, merkle.manifest(spark.createDataFrame(rows, schema), merkle.Tree(height)).collect()), key=repr)


@pytest.mark.parametrize("height", [1, 2, 12])
def test_trees_of_every_shape(spark, height):
    rng = random.Random(height)
    sizes = {"a": 1, "b": 2, "c": 3, "é": 5, None: 17, "zz": 34, "": 8}
    rows = [(n * 100 + i, f"s{i}", lang, i, f"text {i} ü") for n, (lang, size) in enumerate(sizes.items()) for i in range(size)]
    rng.shuffle(rows)
    assert found(spark, rows, height) == expected(rows)


def test_nulls_ties_repeats_and_extremes(spark):
    tampered = next(i for i in range(2**62, 2**63) if zlib.crc32(str(i).encode()) % 7 == 0)
    rows = [
        (None, None, None, None, None), (None, None, None, None, None), (3, "s", "x", 1, ""), (3, "s", "x", 1, ""), (3, "t", "x", 2, "b"),
        (11, None, "x", None, None), (tampered, "s", "x", 2**63 - 1, "größe" * 50_000), (-5, "s", "x", -1, "\n"),
    ]
    assert found(spark, rows, 2) == expected(rows)
    assert not all(row[-1] for row in expected(rows))


def test_one_group_one_row_and_no_row(spark):
    assert found(spark, [], 12) == []
    rows = [(1, "s", "x", 1, "a")]
    assert found(spark, rows, 12) == expected(rows)
    assert found(spark, rows * 9, 1) == expected(rows * 9)


def test_other_columns_change_nothing(spark):
    rows = [(i, "s", "x", i, "a", "t", "n", 4) for i in range(5)]
    assert found(spark, rows, 12, SCHEMA + ", tree string, node string, size int") == expected([r[:5] for r in rows])


def test_given_documents(spark):
    rows = duckdb.sql(f"SELECT doc_id, source, lang, n_chars, text FROM '{FOLDER}/documents.parquet'").fetchall()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert sorted(map(tuple, merkle.manifest(docs, merkle.Tree(3)).collect()), key=repr) == expected(rows)


def test_parents_resume_the_state_of_a_slot():
    children = [digest(str(i)).encode() for i in range(2)]
    parent = merkle.Parent(children)
    assert parent.digest == digest(*[c.decode() for c in children]).encode()
    other = digest("other").encode()
    assert merkle.resumed(parent.states[0], other, children[1:]).decode() == digest(other.decode(), children[1].decode())
    assert merkle.resumed(parent.states[1], other, []).decode() == digest(children[0].decode(), other.decode())
    assert merkle.resumed(parent.states[1], children[1], []) == parent.digest  # the state is still that from before the slot
