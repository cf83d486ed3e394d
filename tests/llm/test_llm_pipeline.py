"""The corpus pipeline: its stages keep the columns and take effect."""

import brute
import duckdb
from test_llm_passages import spans

import corpus_pipeline
from newsmart.llm.tables import read, stage

FOLDER = "/root/testdata/sf0.001"


def test_stages_follow_each_other(spark):
    docs, rows = read(spark, FOLDER, "documents"), []
    columns = docs.columns
    for name, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, FOLDER), name)
        rows.append({r.doc_id: r for r in docs.collect()})
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    clean, single, cut, kept, encoded = rows
    assert len(clean) > 0.8 * 200
    expected, _ = brute.components([(i, r.text) for i, r in clean.items()], 5)
    assert set(single) == {i for i, c in expected.items() if i == c}
    left = spans([(i, r.text) for i, r in single.items()], 51, size=400)
    assert {i: r.text for i, r in cut.items()} == {i: left[i].decode("utf-8", "replace") for i in single}
    assert any(r.text != single[i].text for i, r in cut.items())
    items = duckdb.sql(f"SELECT item_id, text FROM '{FOLDER}/benchmark.parquet'").fetchall()
    found = brute.contamination([(i, r.text) for i, r in cut.items()], [(str(i), t) for i, t in items])
    assert set(kept) == {i for i, x in found.items() if not x[4]} == set(encoded)
