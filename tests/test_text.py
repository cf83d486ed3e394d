"""Golden rows and properties of the text, time and identity functions."""

import html
import random
import re

import pytest
from pyspark.sql import functions as F

from newsmart.functions import text as X


def values(spark, texts, column):
    rows = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, t string")
    return [row[0] for row in rows.orderBy("n").select(column(F.col("t"))).collect()]


CLEAN = {
    "Rate hike in Seoul - Khmer Times": "Rate hike in Seoul",
    "&lt;b&gt;Rates&lt;/b&gt; up": "Rates  up",
    "Rate cut - analysts say": "Rate cut",
    "Rate cut - 24 Hours": "Rate cut - 24 Hours",
    "Rate cut - Reuters.com": "Rate cut - Reuters.com",
    "Growth slows  Khmer Times": "Growth slows",
    "Growth slows \xa0\xa0 Khmer Times": "Growth slows",
    "Growth - Name\n": "Growth",
    " 　x ": "x",
    "": "",
}


def test_clean_text_golden(spark):
    assert values(spark, [*CLEAN, None], X.clean_text) == [*CLEAN.values(), ""]


def test_strip_html_golden(spark):
    given = ["<p>A &amp; B</p>", "a \xa0 b", "&amp;lt;", "&#8217;&eacute;&hellip;", "x &foo; & y", "&nbsp;a&nbsp;", None]
    expected = ["A & B", "a b", "&lt;", "’é…", "x &foo; & y", "a", ""]
    assert values(spark, given, X.strip_html) == expected


def test_entities_equal_the_standard_decoder(spark):
    rng = random.Random(1)
    parts = ["&amp;", "&lt;", "&#39;", "&#x1F600;", "&copy", "&notit;", "&", "&;", "a", " ", "&nbsp;", "&quot", "&#128;", "&apos;"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 8))) for _ in range(300)]
    assert values(spark, texts, X.decode_entities) == [html.unescape(t) for t in texts]


def _noise(rng, size):
    parts = ["Khmer", "times", "A", "é", "금리", "²", "_", "-", " - ", " ", "  ", "\n", "\xa0", " ", "\x1c", ".", "9",
             "<b>", "&amp;", "İ", "x" * 30, " " * 31]
    return "".join(rng.choice(parts) for _ in range(rng.randint(0, size)))


STEPS = [
    (r"<[^>]+>", " "), (r"\xa0+", " "), (r"\s+-\s+[A-Za-z][\w\s]{1,60}$", ""), (r"\s{2,}[A-Z][A-Za-z][\w\s]{1,60}$", ""),
]


def _cleaned(text):
    out = html.unescape(text)
    for pattern, replacement in STEPS:
        out = re.sub(pattern, replacement, out)
    return out.strip()


@pytest.mark.parametrize("size", [6, 40, 120])
def test_cleaning_equals_the_rule_on_noise(spark, size):
    rng = random.Random(size)
    texts = [_noise(rng, size) for _ in range(400)]
    expected = [_cleaned(t) for t in texts]
    assert values(spark, texts, X.clean_text) == expected
    normal = [re.sub(r"\s+", " ", t.lower()) for t in expected]
    assert values(spark, texts, lambda c: X.normalize(X.clean_text(c))) == normal
    assert values(spark, texts, X.scoring_text) == normal


def test_content_hash_and_title_key(spark):
    row = spark.range(1).select(
        X.content_hash(F.lit("a"), F.lit("b")), X.title_key(F.lit(" Fed's 25-bp Hike! ")), X.title_key(F.lit("금리 인상"))
    ).first()
    assert row[0] == "f04cdced9736a69da6103f08a4daaf8c485dd481217d218a1b4993c8c3968e13"
    assert row[1:] == ("feds 25bp hike", "")


DATES = {
    "Mon, 01 Jan 2024 10:00:00 +0900": "2024-01-01 01:00:00",
    "1 Jan 2024 10:00 GMT": "2024-01-01 10:00:00",
    "Mon, 1 Jan 24 10:00:00 EST": "2024-01-01 15:00:00",
    "Mon, 1 Jan 99 10:00:00": "1999-01-01 10:00:00",
    "2024-01-01T10:00:00Z": "2024-01-01 10:00:00",
    "2024-01-01T10:00:00+09:00": "2024-01-01 01:00:00",
    "2024-01-01": "2024-01-01 00:00:00",
    "31 Feb 2024 10:00:00 GMT": None,
    "yesterday": None,
    "T10:00": None,
    "": None,
}


def test_feed_dates(spark):
    got = values(spark, list(DATES), lambda c: F.date_format(X.feed_time(c), "yyyy-MM-dd HH:mm:ss"))
    assert dict(zip(DATES, got)) == DATES


def test_korean_day(spark):
    day = X.kst_day(F.lit("2024-01-01 15:30:00").cast("timestamp"), F.lit(None).cast("timestamp"))
    assert str(spark.range(1).select(day).first()[0]) == "2024-01-02"


def test_csv_and_percent(spark):
    row = spark.range(1).select(
        X.csv_decode(F.lit("A,,B,")), X.csv_decode(F.lit(None).cast("string")), X.csv_encode(F.array(F.lit("A"), F.lit("B"))),
        X.percent(F.lit(1), F.lit(3)), X.percent(F.lit(0), F.lit(0)), X.percent(F.lit(2), F.lit(None).cast("int")),
    ).first()
    assert tuple(row) == (["A", "B"], [], "A,B", "33.3%", "-", "-")


def test_guarded_classes_match_what_the_plain_ones_do(spark):
    """One range stands before each class that every character of a body meets, and changes no result."""
    from newsmart.functions.lexicon import _scan_pattern

    guarded = {
        X._ANY_WIDE_BLANK: rf"[\x{{a0}}{X._WIDE_BLANKS}]",
        X._BLANK_RUNS: rf"[{X._BLANKS}]{{2,}}|[\t-\r\x1c-\x1f]",
        X._NO_KEY: "[^a-z0-9 ]",
        _scan_pattern(["that"]): _scan_pattern(["that"]).replace("(?![a-z])", "", 1),
    }
    assert all(pattern.startswith("(?") and pattern != plain for pattern, plain in guarded.items())
    chars = spark.range(1, 0x3100).select(F.decode(F.unhex(F.lpad(F.hex("id"), 4, "0")), "UTF-16BE").alias("c"))
    texts = chars.select(F.explode(F.array("c", F.concat("c", "c"), F.concat(F.lit("x"), "c", F.lit("that"), "c", F.lit(" ")))).alias("t"))
    for pattern, plain in guarded.items():
        changed = texts.filter(F.regexp_replace("t", pattern, "|") != F.regexp_replace("t", plain, "|"))
        assert changed.count() == 0
        assert texts.filter(F.col("t").rlike(pattern)).count() > 0
