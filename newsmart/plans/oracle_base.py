"""Shared pieces of the DuckDB comparison SQL: the pipeline views and the scoring rule.

Written independently of the Spark side: keywords are tested one by one with regular expressions.
"""

from __future__ import annotations

from newsmart.sources.sample_views import COUNTRY_CODES, TEST_LEXICON

SPACE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WORD = r"\p{L}\p{N}_"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _country(number: str) -> str:
    return f"([{', '.join(map(quoted, COUNTRY_CODES))}])[{number} % 12 + 1]"


SOURCES = f"""f_sources AS (
  SELECT DISTINCT CAST(replace(source, 'src', '') AS BIGINT) AS source_id, source AS media_name,
         {_country("CAST(replace(source, 'src', '') AS BIGINT)")} AS primary_country_code,
         CAST(CAST(replace(source, 'src', '') AS BIGINT) % 3 AS INTEGER) AS tier
  FROM documents)"""

CATEGORIES = """f_categories AS (
  SELECT source_id, primary_country_code AS category_code FROM f_sources
  UNION ALL SELECT source_id, 'GLOBAL_GENERAL' FROM f_sources WHERE source_id % 4 = 0
  UNION ALL SELECT source_id, 'GLOBAL_ECONOMY' FROM f_sources WHERE source_id % 4 = 1)"""

FEEDS = """f_feeds AS (
  SELECT source_id * 2 + n AS feed_id, source_id,
         'https://src' || source_id || '.example.com/feed/' || n AS feed_url,
         CASE WHEN n = 0 THEN 'world' ELSE 'business' END AS feed_section,
         (source_id * 2 + n) % 10 <> 9 AS is_active,
         CAST(CASE (source_id * 2 + n) % 5 WHEN 0 THEN 200 WHEN 1 THEN 404 WHEN 2 THEN 503 WHEN 3 THEN -1 END
              AS INTEGER) AS last_status,
         CASE (source_id * 2 + n) % 5 WHEN 1 THEN 'http 404' WHEN 2 THEN 'http 503'
              WHEN 3 THEN 'request_error' END AS last_error
  FROM f_sources, (VALUES (0), (1)) v(n))"""

ARTICLES = """f_articles AS (
  SELECT d.doc_id AS article_id,
         CAST(replace(d.source, 'src', '') AS BIGINT) * 2 + (d.doc_id // 20) % 2 AS feed_id,
         CAST(replace(d.source, 'src', '') AS BIGINT) AS source_id,
         left(split_part(d.text, chr(10), 1), 1000) AS title,
         'https://' || d.source || '.example.com/a/' || d.doc_id AS link,
         d.text AS summary, d.lang AS language,
         e.ts AS published_at, e.ts + INTERVAL 1 HOUR AS fetched_at
  FROM documents d JOIN events e ON e.event_id = d.doc_id)"""


def decoded(text: str) -> str:
    out = text
    for entity, char in (
        ("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "'\"'"), ("&apos;", "chr(39)"), ("&#39;", "chr(39)"),
        ("&nbsp;", "chr(160)"), ("&middot;", "'·'"), ("&copy;", "'©'"), ("&amp;", "'&'"),
    ):
        out = f"replace({out}, '{entity}', {char})"
    return out


def stripped(text: str) -> str:
    return f"regexp_replace({text}, '^[{SPACE}]+|[{SPACE}]+$', '', 'g')"


def cleaned(text: str) -> str:
    out = f"regexp_replace({decoded(text)}, '<[^>]+>', ' ', 'g')"
    out = rf"regexp_replace({out}, '\x{{a0}}+', ' ', 'g')"
    out = f"regexp_replace({out}, '[{SPACE}]+-[{SPACE}]+[A-Za-z][{WORD}{SPACE}]{{1,60}}$', '')"
    out = f"regexp_replace({out}, '[{SPACE}]{{2,}}[A-Z][A-Za-z][{WORD}{SPACE}]{{1,60}}$', '')"
    return stripped(out)


def normalized(text: str) -> str:
    return f"regexp_replace(lower({text}), '[{SPACE}]+', ' ', 'g')"


def matches(text: str, keyword: str) -> str:
    if all(c.isascii() and (c.isdigit() or c.islower() or c == " ") for c in keyword):
        return f"regexp_matches({text}, '(^|[^a-z0-9]){keyword}($|[^a-z0-9])')"
    return f"contains({text}, {quoted(keyword)})"


def first_match(text: str, keywords) -> str:
    cases = " ".join(f"WHEN {matches(text, keyword)} THEN {quoted(keyword)}" for keyword in keywords)
    return f"CASE {cases} END"


def _any_match(text: str, keywords) -> str:
    return "(" + " OR ".join(matches(text, keyword) for keyword in keywords) + ")"


def scored(lexicon=TEST_LEXICON) -> str:
    """CTEs f_texts, f_hits, f_points and f_scored (filter results plus tier and source columns)."""
    extra_title = " ".join(
        f"WHEN '{code}' THEN {first_match('t', keywords)}" for code, keywords in lexicon.extra.items()
    )
    extra_body = " ".join(
        f"WHEN '{code}' THEN {first_match('b', keywords)}" for code, keywords in lexicon.extra.items()
    )
    own_title = " ".join(
        f"WHEN '{code}' THEN {first_match('t', lists.finance)}" for code, lists in lexicon.own.items()
    )
    own_body = " ".join(
        f"WHEN '{code}' THEN {first_match('b', lists.finance)}" for code, lists in lexicon.own.items()
    )
    own_codes = ", ".join(quoted(code) for code in lexicon.own)
    country_points = " + ".join(
        f"CASE WHEN {_any_match('t', keywords)} THEN 2 WHEN {_any_match('b', keywords)} THEN 1 ELSE 0 END"
        for _, keywords in lexicon.countries
    )
    country_reason = ", ".join(
        f"CASE WHEN {_any_match('t', keywords)} THEN 'country_title:{cc}' "
        f"WHEN {_any_match('b', keywords)} THEN 'country_body:{cc}' END"
        for cc, keywords in lexicon.countries
    )
    return f"""f_texts AS MATERIALIZED (
  SELECT a.article_id, s.tier, coalesce(nullif(a.language, ''), 'en') AS lang,
         {normalized(cleaned("coalesce(a.title, '')"))} AS t,
         {normalized(cleaned("coalesce(a.summary, '')"))} AS b
  FROM f_articles a JOIN f_sources s ON s.source_id = a.source_id),
f_hits AS MATERIALIZED (
  SELECT article_id, tier, lang,
         {first_match("(t || ' ' || b)", lexicon.exclusion)} AS excluded,
         CASE lang {own_title} ELSE {first_match('t', lexicon.finance)} END AS main_t,
         CASE lang {own_body} ELSE {first_match('b', lexicon.finance)} END AS main_b,
         CASE lang {extra_title} END AS extra_t,
         CASE lang {extra_body} END AS extra_b,
         {country_points} AS country_points,
         coalesce({country_reason}) AS country_reason
  FROM f_texts),
f_points AS (
  SELECT *,
         (CASE WHEN excluded IS NOT NULL THEN -4 ELSE 0 END)
         + (CASE WHEN main_t IS NOT NULL THEN 5 WHEN main_b IS NOT NULL THEN 3 ELSE 0 END)
         + (CASE WHEN extra_t IS NOT NULL THEN 5 WHEN extra_b IS NOT NULL THEN 3 ELSE 0 END)
         + country_points AS score,
         coalesce(
           CASE WHEN main_t IS NOT NULL THEN CASE WHEN lang IN ({own_codes}) THEN lang || '_' ELSE '' END
                     || 'fin_title:' || main_t
                WHEN main_b IS NOT NULL THEN CASE WHEN lang IN ({own_codes}) THEN lang || '_' ELSE '' END
                     || 'fin_body:' || main_b END,
           CASE WHEN extra_t IS NOT NULL THEN lang || '_fin_title:' || extra_t
                WHEN extra_b IS NOT NULL THEN lang || '_fin_body:' || extra_b END,
           country_reason) AS reason,
         CASE WHEN main_t IS NOT NULL THEN 3 ELSE 5 END AS mark
  FROM f_hits),
f_scored AS (
  SELECT article_id,
         CAST(CASE WHEN tier = 0 THEN 1 ELSE 2 END AS INTEGER) AS filter_stage,
         CASE WHEN tier = 0 OR score >= mark THEN 'passed' ELSE 'rejected' END AS filter_decision,
         CASE WHEN tier = 0 THEN 'official_source'
              WHEN score >= mark THEN coalesce(reason, 'passed')
              WHEN excluded IS NOT NULL THEN 'excl:' || excluded || '(score:' || score || ')'
              ELSE 'score:' || score || '|' || coalesce(reason, 'no_match') END AS filter_reason,
         CAST(CASE WHEN tier = 0 THEN 99 ELSE score END AS INTEGER) AS filter_score
  FROM f_points)"""


def with_views(*views: str, body: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(views) + "\n" + body.strip()
