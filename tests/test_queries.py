"""Every registered query against its DuckDB SQL, and the rows-only ones against other results."""

import compare
import pytest

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.01"
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return compare.connect(FOLDER)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    left = compare.spark_side(QUERIES[name](spark, FOLDER))
    assert compare.differences(left, compare.duck_side(duck, ORACLES[name])) is None
    assert left[1]


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["country", "total", "passed", "rejected", "dups", "pass_rate"] and frame.count() == 12


def test_marks_equal_the_nested_loop(spark, duck):
    from test_dedup import expected_marks

    rows = duck.execute("""
        SELECT d.doc_id, left(split_part(d.text, chr(10), 1), 1000), e.ts, e.ts + INTERVAL 1 HOUR,
               (['KR','US','CN','JP','ID','VN','KH','MM','IN','GB','HK','SG'])[n % 12 + 1], n % 3, 'passed'
        FROM (SELECT *, CAST(replace(source, 'src', '') AS INTEGER) AS n FROM documents) d
        JOIN events e ON e.event_id = d.doc_id""").fetchall()
    expected = expected_marks(rows)
    marked = QUERIES["dedup_all_titles"](spark, FOLDER).collect()
    assert {r.article_id: r.duplicate_of for r in marked} == expected
    streamed = QUERIES["stream_dedup"](spark, FOLDER).collect()
    assert {r.article_id: r.duplicate_of for r in streamed} == expected
    assert any(value is not None for value in expected.values())


def test_near_duplicates_include_equal_titles(spark):
    near = {r.article_id: r.duplicate_of for r in QUERIES["dedup_marks"](spark, FOLDER).collect()}
    equal = {r.article_id: r.duplicate_of for r in QUERIES["dedup_equal_titles"](spark, FOLDER).collect()}
    assert set(near) == set(equal)
    assert all(near[article] is not None for article, first in equal.items() if first is not None)


def test_rejected_sample_draws_rejected_rows(spark):
    rows = QUERIES["rejected_sample"](spark, FOLDER).collect()
    assert len(rows) == 15 and all(r.filter_reason.startswith(("score:", "excl:")) for r in rows)


def test_chains(spark, duck):
    collected = QUERIES["collect_chain_rows"](spark, FOLDER).collect()
    assert len({r.content_hash for r in collected}) == len(collected) > 0
    assert min(r.article_id for r in collected) > duck.execute("SELECT max(doc_id) FROM labels").fetchall()[0][0]
    briefed = QUERIES["enrich_chain_rows"](spark, FOLDER).collect()
    assert briefed and all(r.summary == "weekly" and 0 < r.article_count <= 25 for r in briefed)


def test_collect_chain_goes_on_across_runs(spark):
    """Two runs store and score what one run does."""
    single = {r.content_hash: (r.filter_reason, r.filter_score) for r in QUERIES["collect_chain_rows"](spark, FOLDER).collect()}
    rows = QUERIES["collect_chain_second_run"](spark, FOLDER).collect()
    assert len({r.content_hash for r in rows}) == len({r.article_id for r in rows}) == len(rows)
    assert {r.content_hash: (r.filter_reason, r.filter_score) for r in rows} == single
    run = {r.article_id: r.run for r in rows}
    assert set(run.values()) == {1, 2}
    assert all(r.duplicate_of is None or r.duplicate_of in run for r in rows)


def test_stage_counters_mark_once(spark, monkeypatch):
    """Both stages read the marks of one run."""
    from newsmart.plans import registered

    calls = []
    marked = registered._marked
    monkeypatch.setattr(registered, "_marked", lambda *given: calls.append(given) or marked(*given))
    assert QUERIES["stage_counters"](spark, FOLDER).count() == 2 and len(calls) == 1
