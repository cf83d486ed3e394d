"""Near-duplicate marking against a plain nested loop."""

import datetime as dt
import random
import subprocess
import sys
from difflib import SequenceMatcher

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark import cloudpickle
from pyspark.sql import functions as F

from newsmart.config import Dedup
from newsmart.functions import similarity
from newsmart.operators import dedup
from newsmart.operators.dedup import band_edges, candidates, mark_duplicates, mark_equal_titles
from newsmart.operators.ordering import placed

WORDS = "fed signals rate hike hold bank japan raises rates boj yen profit rises slowly indonesia growth".split()


def brute_force(keys, threshold):
    primary = [-1] * len(keys)
    for i, a in enumerate(keys):
        if primary[i] >= 0:
            continue
        for j in range(i + 1, len(keys)):
            same = keys[j] and a and SequenceMatcher(None, a, keys[j]).ratio() >= threshold
            if primary[j] < 0 and same:
                primary[j] = i
    return primary


@given(st.lists(st.text("abcde 12", max_size=24), max_size=25), st.sampled_from([0.5, 0.75, 0.9]))
@settings(max_examples=150, deadline=None)
def test_bounds_never_change_the_greedy_result(keys, threshold):
    assert similarity.resolve(keys, threshold).tolist() == brute_force(keys, threshold)


@pytest.mark.parametrize("size", [1, 40, 64, 65, 130, 300])
def test_vector_subsequences_equal_the_integer_form(size):
    rng = random.Random(size)
    draw = lambda n: "".join(rng.choice("abc d1") for _ in range(n))
    primary, others = draw(size), [draw(rng.randint(1, 2 * size)) for _ in range(50)]
    positions = {}
    for place, char in enumerate(primary):
        positions[char] = positions.get(char, 0) | (1 << place)
    titles = similarity.TitleSet(others)
    got = similarity._common_subsequences(similarity._codes(primary), titles.codes)
    assert got.tolist() == [similarity._common_subsequence(positions, size, other) for other in others]


def test_large_sets_use_the_vector_form_with_the_same_result():
    rng = random.Random(8)
    keys = [" ".join(rng.choice(WORDS) for _ in range(rng.randint(2, 12))) for _ in range(300)]
    expected = brute_force(keys, 0.75)
    assert similarity.resolve(keys, 0.75).tolist() == expected
    primaries = [key for key, first in zip(keys, expected) if first < 0]
    found = similarity.assign(primaries, keys, 0.75)
    assert all(
        found[place] == next((n for n, p in enumerate(primaries) if SequenceMatcher(None, p, key).ratio() >= 0.75), -1)
        for place, key in enumerate(keys[:60])
    )


def test_long_titles_follow_the_popular_character_rule():
    rng = random.Random(5)
    keys = ["".join(rng.choice("abcdefgh ") for _ in range(n)) for n in (190, 205, 260)]
    keys += [key[: len(key) // 2] + "x" + key[len(key) // 2 :] for key in keys]
    assert similarity.resolve(keys, 0.75).tolist() == brute_force(keys, 0.75)


@pytest.mark.parametrize(
    "a, b, expected",
    [
        ("fed signals rate hike", "fed signals rate hold", 0.8571),
        ("bank indonesia holds rate", "bank indonesia holds rates steady", 0.8621),
        ("bank of japan raises rates", "boj raises rates", 0.7619),
        ("", "", 0.0),
    ],
)
def test_golden_ratios(a, b, expected):
    assert round(similarity.ratio(a, b), 4) == expected


def _articles(spark, count=400, seed=3, hot=0.5):
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1, 3, 0)
    rows = []
    for article_id in range(count):
        title = " ".join(rng.choice(WORDS) for _ in range(rng.randint(2, 4)))
        title = rng.choice([title, title, title.upper(), "금리 인상", title + "!"])
        published = None if rng.random() < 0.1 else start + dt.timedelta(minutes=rng.randint(0, 300))
        country = "KR" if rng.random() < hot else rng.choice(["US", "JP", "", None])
        decision = "passed" if rng.random() < 0.9 else "rejected"
        rows.append((article_id, title, published, start, country, rng.randint(0, 2), decision))
    rng.shuffle(rows)
    return rows, spark.createDataFrame(
        rows,
        "article_id long, title string, published_at timestamp, fetched_at timestamp,"
        "primary_country_code string, tier int, filter_decision string",
    )


def expected_marks(rows, threshold=0.75):
    import re

    blocks = {}
    for article_id, title, published, fetched, country, tier, decision in rows:
        if decision != "passed":
            continue
        day = ((published or fetched) + dt.timedelta(hours=9)).date()
        order = (tier, published is None, -published.timestamp() if published else 0, article_id)
        key = re.sub(r"[^a-z0-9 ]", "", title.lower()).strip()
        blocks.setdefault((country or "GLOBAL", day), []).append((order, key, article_id))
    marks = {}
    for block in blocks.values():
        block.sort()
        primary = brute_force([key for _, key, _ in block], threshold)
        for place, (_, _, article_id) in enumerate(block):
            marks[article_id] = block[primary[place]][2] if primary[place] >= 0 else None
    return marks


@pytest.mark.parametrize(
    "limits",
    [
        Dedup(),
        Dedup(chunk_rows=7, slot_rows=11),
        Dedup(chunk_rows=40, slot_rows=25, hot_copies=2),
        Dedup(hot_copies=1, hot_titles_broadcast=0),
    ],
)
def test_marks_equal_the_nested_loop_for_any_chunking(spark, limits):
    rows, frame = _articles(spark)
    marked = mark_duplicates(frame, settings=limits).collect()
    assert len(marked) == len({row.article_id for row in marked})
    assert {row.article_id: row.duplicate_of for row in marked} == expected_marks(rows)


def test_greedy_order_matters_and_recheck_controls_marked_rows(spark):
    day = dt.datetime(2024, 1, 1)
    titles = ["alpha beta gamma delta", "alpha beta gamma del xx", "alpha beta gam xx yyy zz"]
    rows = [(n, title, day, day, "KR", n, "passed", None if n < 2 else 0) for n, title in enumerate(titles)]
    frame = spark.createDataFrame(
        rows,
        "article_id long, title string, published_at timestamp, fetched_at timestamp,"
        "primary_country_code string, tier int, filter_decision string, duplicate_of long",
    )
    fresh = {row.article_id: row.duplicate_of for row in mark_duplicates(frame).collect()}
    assert fresh == {0: None, 1: 0}
    again = {row.article_id: row.duplicate_of for row in mark_duplicates(frame, recheck=True).collect()}
    assert set(again) == {0, 1, 2} and again[1] == 0


def test_equal_titles(spark):
    rows, frame = _articles(spark, count=150, seed=9)
    got = {row.article_id: row.duplicate_of for row in mark_equal_titles(candidates(frame)).collect()}
    assert got == expected_marks(rows, threshold=1.0)


def test_workers_need_no_copy_of_the_package():
    code = "import pickle, sys; f = pickle.load(sys.stdin.buffer); print(f(['rate hike up', 'rate hike ups'], 0.75))"
    pickled = cloudpickle.dumps(similarity.resolve)
    done = subprocess.run([sys.executable, "-c", code], input=pickled, capture_output=True, cwd="/", check=True)
    assert done.stdout.split() == [b"[-1", b"0]"]


def test_new_articles_meet_the_stored_ones_of_their_blocks(spark):
    day = dt.datetime(2024, 1, 5, 3)
    rows = [
        (1, "KR", 1, "Fed signals a rate hike", day, "passed", None),
        (2, "KR", 1, "Bank of Japan holds rates", day, "passed", 9),
        (3, "US", 1, "Fed signals a rate hike", day, "passed", None),
        (10, "KR", 2, "Fed signals a rate hike!", day, "passed", None),
        (11, "KR", 2, "", day, "passed", None),
    ]
    columns = "article_id long, primary_country_code string, tier int, title string, published_at timestamp,"
    frame = spark.createDataFrame(rows, f"{columns} filter_decision string, duplicate_of long").withColumn(
        "fetched_at", F.col("published_at")
    )
    fresh = spark.createDataFrame([(10,), (11,)], "article_id long")
    marks = {r.article_id: r.duplicate_of for r in mark_duplicates(frame, touched_by=fresh).collect()}
    assert marks == {1: None, 10: 1, 11: None}


@pytest.mark.parametrize("threshold", [0.5, 0.75, 0.8, 0.9, 1.0])
def test_titles_two_length_bands_apart_are_never_similar(threshold):
    edges = band_edges(threshold, 400)
    band = [sum(edge <= length for edge in edges) for length in range(401)]
    for a in range(1, 401):
        for b in range(a, 401):
            assert band[b] - band[a] <= 1 or 2.0 * a / (a + b) < threshold


def test_places_of_a_hot_group_come_from_several_partitions(spark):
    rng = random.Random(6)
    rows = [("hot" if rng.random() < 0.9 else rng.choice("abc"), rng.random(), n) for n in range(4000)]
    frame = spark.createDataFrame(rows, "k string, v double, n long").repartition(7)
    groups = {}
    for k, v, n in sorted(rows):
        groups.setdefault(k, []).append(n)
    expected = {(k, i): n for k, ns in groups.items() for i, n in enumerate(ns)}
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    try:
        for merged in ("true", "false"):  # such small partitions would all be merged
            spark.conf.set(merging, merged)
            assert {(r.k, r.place): r.n for r in placed(frame, ["k"], ["v", "n"]).collect()} == expected
        by_range = frame.repartitionByRange(F.col("k"), F.col("v")).select("k", F.spark_partition_id().alias("p"))
        assert by_range.where("k = 'hot'").select("p").distinct().count() > 1
    finally:
        spark.conf.set(merging, "true")


def test_marking_leaves_the_session_as_it_was(spark):
    limit = "spark.sql.optimizer.windowGroupLimitThreshold"
    before = spark.conf.get(limit)
    mark_duplicates(_articles(spark, count=60)[1], settings=Dedup(chunk_rows=5, slot_rows=4)).count()
    assert spark.conf.get(limit) == before


def test_long_titles_of_one_language_are_told_apart_before_any_subsequence():
    rng = random.Random(11)
    syllables = "an at en er es he in is it le nd on or ou re st te th ti ka".split()
    words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(400)]
    keys = [" ".join(rng.choice(words) for _ in range(rng.randint(70, 130))) for _ in range(60)]
    titles = similarity.TitleSet(keys)
    left = [titles.possible(key, np.arange(place + 1, 60), 0.75) for place, key in enumerate(keys)]
    assert sum(map(len, left)) < 0.02 * 60 * 59 / 2
    near = [key[: len(key) // 2] + rng.choice(["", " x7 ", "k" * 40]) + key[len(key) // 2 + rng.randint(0, 60) :] for key in keys]
    mixed = rng.sample(keys + near, 120)
    expected = brute_force(mixed, 0.75)
    assert max(expected) >= 0 and similarity.resolve(mixed, 0.75).tolist() == expected


@given(st.lists(st.text("abqxz 7é", min_size=150, max_size=420), max_size=6), st.sampled_from([0.5, 0.75]))
@settings(max_examples=60, deadline=None)
def test_the_block_bound_never_changes_the_result(keys, threshold):
    keys += [key[::-1] for key in keys[:2]] + [key[7:] + key[:90] for key in keys]
    assert similarity.resolve(keys, threshold).tolist() == brute_force(keys, threshold)


def test_equal_titles_are_joined_without_reading_the_articles_again(spark, tmp_path):
    path = str(tmp_path / "articles")
    _articles(spark, count=60)[1].write.parquet(path)
    assert not any(path in name for name in mark_equal_titles(candidates(spark.read.parquet(path))).inputFiles())


def test_small_chunks_take_few_waves(spark, monkeypatch):
    """Chunks double with every wave, so the waves of a block grow with the logarithm of its titles."""
    waves = []
    compare_rest = dedup._compare_rest
    monkeypatch.setattr(dedup, "_compare_rest", lambda *given: waves.append(given) or compare_rest(*given))
    rng = random.Random(5)
    day = dt.datetime(2024, 1, 1)
    titles = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(12)) for _ in range(160)]
    rows = [(n, title, day, day, "KR", 1, "passed") for n, title in enumerate(titles + titles[:20])]
    frame = spark.createDataFrame(
        rows,
        "article_id long, title string, published_at timestamp, fetched_at timestamp,"
        "primary_country_code string, tier int, filter_decision string",
    )
    marked = {r.article_id: r.duplicate_of for r in mark_duplicates(frame, settings=Dedup(chunk_rows=8, slot_rows=8)).collect()}
    assert marked == {n: n - 160 if n >= 160 else None for n in range(180)}
    assert 3 <= len(waves) <= 5


def _invented(rng, count, least, most):
    syllables = "an at en er he in is le nd on ou re st th ti ka bo cy mu we gi pal fro dev juk qua".split()
    words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(400)]
    return [" ".join(rng.choice(words) for _ in range(rng.randint(least, most))) for _ in range(count)]


def test_subsequences_of_short_titles_leave_out_frequent_characters_first(monkeypatch):
    """Characters times pairs that the subsequences go through; whole titles would take every character of every pair."""
    work = []
    pairs = similarity._pair_subsequences
    monkeypatch.setattr(similarity, "_pair_subsequences", lambda *given: work.append(given[-1].shape) or pairs(*given))
    keys = [key[:190] for key in _invented(random.Random(21), 700, 25, 40)]
    assert similarity.resolve(keys, 0.75).tolist() == brute_force(keys[:60], 0.75) + [-1] * 640
    assert sum(rows * columns for rows, columns in work) < 0.5 * sum(map(len, keys)) * len(keys) / 2


def test_many_titles_of_mixed_lengths_equal_the_nested_loop():
    """Several tiles and steps, with titles of both kinds and near copies of them."""
    rng = random.Random(22)
    base = _invented(rng, 60, 3, 90)
    near = [key[: len(key) // 2] + rng.choice(["", "é", " x7 "]) + key[len(key) // 2 + rng.randint(0, 20) :] for key in base]
    keys = rng.sample(base + near + ["", "a", "ab"], 123)
    with pytest.MonkeyPatch.context() as patch:
        for name, value in (("_TILE", 16), ("_GROUP", 5), ("_STEP", 8), ("_PAIRS", 64)):
            patch.setattr(similarity, name, value)
        assert similarity.resolve(keys, 0.75).tolist() == brute_force(keys, 0.75)
        found = similarity.assign(base, near, 0.75)
    expected = [next((n for n, p in enumerate(base) if p and SequenceMatcher(None, p, key).ratio() >= 0.75), -1) for key in near]
    assert found.tolist() == expected


def test_blocks_of_unequal_size_take_several_tasks_a_core(spark):
    blocks = spark.range(1000).selectExpr("string(id % 300) AS cc", "'2024-01-01' AS art_date")
    assert dedup._tasks(blocks, dedup.BLOCK).rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism
