"""Reply fields, topics, offices, queues and briefings."""

import pytest
from pyspark.sql import functions as F

from newsmart.functions import offices, replies, taxonomy
from newsmart.operators import enrich, export, queues, reports

REPLIES = [
    ('{"keep": true, "ai_score": 85, "summary_ko": "s"}', True, 85, "s"),
    ('```json\n{"keep": false, "ai_score": 120}\n```', False, 100, ""),
    ('Answer: {"keep": true, "ai_score": "42"} done', True, 42, ""),
    ("oops", True, 50, ""),
    ("", True, 50, ""),
    (None, True, 50, ""),
    ('{"keep": null, "ai_score": 85.7}', False, 85, ""),
    ('{"keep": "false", "ai_score": "85.7"}', True, 50, ""),
    ('[{"keep": false}]', True, 50, ""),
    ('{"keep": 0, "ai_score": -3, "summary_ko": 7}', False, 0, "7"),
    ('{"keep": 0.0, "ai_score": true, "summary_ko": false}', False, 1, ""),
    ('{"keep": "", "ai_score": 1e20, "summary_ko": true}', False, 100, "True"),
    ('{"keep": [], "ai_score": []}', False, 50, ""),
    ('{"keep": [0], "ai_score": " 1_0 "}', True, 10, ""),
    ('{"keep": {}, "ai_score": null}', False, 50, ""),
    ('x {"keep": {"a": 1}} y } z', True, 50, ""),
]


def test_reply_fields(spark):
    frame = spark.createDataFrame([(n, row[0]) for n, row in enumerate(REPLIES)], "n int, t string").select(
        "n", replies.reply_object(F.col("t")).alias("v")
    )
    v = F.col("v")
    got = frame.orderBy("n").select(
        replies.keep_flag(v), replies.score_value(v), replies.text_or_empty(v, "summary_ko")
    ).collect()
    assert [tuple(row) for row in got] == [row[1:] for row in REPLIES]


def test_reason_is_kept_only_on_drop_and_cut(spark):
    queue = spark.createDataFrame([(n,) for n in range(4)], "article_id long")
    stored = spark.createDataFrame(
        [("triage", "0", '{"keep": false, "reason": "%s"}' % ("x" * 400), "m"),
         ("triage", "1", '{"keep": true, "reason": "y"}', "m"), ("triage", "2", '{"keep": false, "reason": null}', "m"),
         ("rank", "3", '{"keep": false}', "m")],
        "stage string, key string, raw_text string, model string",
    )
    got = {row.article_id: (row.decision, row.reject_reason) for row in enrich.triage(queue, stored).collect()}
    assert got == {0: ("drop", "x" * 300), 1: ("keep", None), 2: ("drop", "None"), 3: ("keep", None)}


def test_topics(spark):
    row = spark.range(1).select(
        taxonomy.validate(F.array(*map(F.lit, [" esg ", "x", "RISK", "Esg", "MARKET", "BANKING"]))),
        taxonomy.seed_topics(F.lit("The AI wallet; green bond fraud at a Bank, GDP")),
        taxonomy.seed_topics(F.lit("banks and regulations")),
        taxonomy.ui_string(F.array(*map(F.lit, ["MARKET", "BANKING", "ESG", "OTHER"]))),
        taxonomy.label(F.lit("RISK"), "en"), taxonomy.label(F.lit("NEW"), "en"), taxonomy.label(F.lit("RISK"), "fr"),
    ).first()
    assert tuple(row) == (
        ["ESG", "RISK", "MARKET"], ["MARKET", "BANKING", "DIGITAL"], [], "finance esg other",
        "Regulation·Risk", "NEW", "RISK",
    )
    assert taxonomy.codes() == ["MARKET", "BANKING", "DIGITAL", "ESG", "RISK"]
    assert taxonomy.prompt_reference().splitlines()[4].startswith("- RISK (규제·리스크): regulation, supervision")


def test_offices(spark):
    row = spark.range(1).select(
        offices.context_for(F.lit("gb"), owner="Bank"), offices.context_for(F.lit(None).cast("string")),
        offices.context_for(F.lit("ZZ"), owner="Bank"),
    ).first()
    assert row[0] == "Bank 런던지점 — 런던 소재 지점"
    assert row[1] == "글로벌 본점 관점(특정 거점 없음)" and row[2].startswith("Bank 글로벌")
    assert offices.subsidiary_countries() == ["ID", "KH"]
    assert offices.all_context().startswith("GB=런던지점(지점); US=")
    assert offices.to_frame(spark).count() == 11


def test_completer_choice_and_stub(spark):
    model, completer = enrich.get_completer("fast", "stub")
    assert (model, completer("s", "u")) == ("stub:fast", "{}")
    with pytest.raises(ValueError):
        enrich.get_completer("fast", "nobody")
    requests = spark.createDataFrame([("triage", "1", "p")], "stage string, key string, prompt string")
    assert enrich.complete(requests, completer, model).collect() == [("triage", "1", "{}", "stub:fast")]


ARTICLES = (
    "article_id long, title string, summary string, link string, media_name string, primary_country_code string,"
    " published_at timestamp, filter_decision string, filter_score int, duplicate_of long, triage_decision string,"
    " ai_score int, summary_ko string, topics array<string>, implication string"
)


def _articles(spark):
    rows = [
        (n, f"t{n}", None, f"u{n}", "m", ["GB", "US", "KR"][n % 3], None, "passed", [5, None, 7][n % 3],
         0 if n == 6 else None, "keep" if n < 8 else None, 90 - n if n < 7 else None, "k" * 200, ["ESG"], None)
        for n in range(10)
    ]
    return spark.createDataFrame(rows, ARTICLES)


def test_queues(spark):
    articles = _articles(spark)
    assert [r.article_id for r in queues.triage_queue(articles).collect()] == [8, 9]
    assert [r.article_id for r in queues.rank_queue(articles).collect()] == [7]
    assert queues.rank_queue(articles, limit=0).count() == 1
    marked = articles.withColumn("duplicate_of", F.lit(1))
    assert queues.triage_queue(marked).count() == 0 and queues.rank_queue(marked).count() == 1


def test_briefing_inputs_and_export(spark):
    articles = _articles(spark)
    inputs = {row.cc: row for row in enrich.briefing_inputs(articles, limit=2).collect()}
    assert inputs["GB"].source_articles == ["u0", "u3"] and inputs["GB"].article_count == 2
    assert inputs["GB"].prompt.endswith("- (90) t0 :: " + "k" * 160 + "\n- (87) t3 :: " + "k" * 160)
    assert [r.cc for r in enrich.briefing_inputs(articles, countries=["US"]).collect()] == ["US"]
    nested = export.export_countries(articles).orderBy("ord").collect()
    assert [row.cc for row in nested] == [cc for cc, _ in export.EXPORT_COUNTRIES]
    assert nested[0].status == "ACTIVE" and [a.u for a in nested[0].articles] == ["u0", "u3"]
    assert nested[2].status == "SOURCE WATCH" and nested[2]["count"] == 0 and nested[2].articles == []
    only = nested[0].articles[0]
    assert (only.c, only.d, only.k, only.score) == ("esg", "", "", 90)


def test_briefings_skip_empty_replies_and_upsert_is_idempotent(spark):
    inputs = enrich.briefing_inputs(_articles(spark))
    stored = spark.createDataFrame(
        [("briefing", "GB", '{"summary": "x", "issues": ["a"], "key_stat": 5}', "m"), ("briefing", "US", "{}", "m")],
        "stage string, key string, raw_text string, model string",
    )
    new = enrich.briefings(inputs, stored, "2024-02-01", F.lit(None).cast("timestamp"))
    row = new.collect()
    assert [(r.cc, r.summary, r.issues, r.keywords, r.key_stat, r.outlook) for r in row] == [("GB", "x", ["a"], [], "5", "")]
    once = enrich.upsert_briefings(new, new)
    assert once.collect() == row
    counted = reports.briefing_counters(enrich.ranked_countries(_articles(spark)), new).first()
    assert tuple(counted) == (3, 1)


def test_counters_are_read_from_the_run_itself(spark):
    from newsmart.session import Counters, counted, cut

    counters = Counters()
    frame = spark.range(100).repartition(4)
    even = counted(frame, "numbers", counters, total=F.count(F.lit(1)), even=F.count_if(F.col("id") % 2 == 0))
    none = counted(frame.limit(0), "none", counters, total=F.count(F.lit(1)), most=F.max("id"))
    stored = cut(even.filter("id < 10"))
    cut(none)
    assert stored.count() == 10 and counters.of("numbers") == {"total": 100, "even": 50}
    rows = {tuple(r) for r in counters.to_frame(spark).collect()}
    assert rows == {("numbers", "total", 100), ("numbers", "even", 50), ("none", "total", 0), ("none", "most", 0)}
    with pytest.raises(ValueError, match="counted already"):
        counted(frame, "numbers", counters, total=F.count(F.lit(1)))


def test_queues_of_the_chain_carry_no_texts(spark, monkeypatch):
    """What is sorted for a queue is narrow; texts are read for the few articles that are in it."""
    from newsmart.plans import registered

    seen = []
    for name in ("triage_queue", "rank_queue"):
        take = getattr(queues, name)
        monkeypatch.setattr(queues, name, lambda rows, take=take: seen.append(rows.columns) or take(rows))
    registered.QUERIES["enrich_chain_second_run"](spark, "/root/testdata/sf0.001")
    assert len(seen) == 4 and not any({"summary", "title"} & set(columns) for columns in seen)


def test_bodies_come_from_the_documents_alone(spark):
    from newsmart.plans import registered

    rows = spark.range(50).withColumnRenamed("id", "article_id")
    bodies = registered._with_body(rows, spark, "/root/testdata/sf0.001", 5)
    assert all("documents" in name for name in bodies.inputFiles())
    assert sorted(len(row.summary) for row in bodies.collect())[-1] == 5
