"""DuckDB SQL for the registered queries, one statement per key."""

from __future__ import annotations

from newsmart.functions.offices import NO_OFFICE, OFFICES, SUBSIDIARY
from newsmart.functions.taxonomy import TOPICS
from newsmart.operators.export import EXPORT_COUNTRIES
from newsmart.plans.oracle_base import (
    ARTICLES, CATEGORIES, COUNTRY_CODES, FEEDS, SOURCES, cleaned, decoded, matches, normalized, quoted, scored,
    stripped, with_views,
)
from newsmart.sources.sample_views import published_sample, sample_topics

ORACLES: dict[str, str] = {}

SCORED = (SOURCES, ARTICLES, scored())


def _stamp(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


def _title_key(column: str) -> str:
    return f"trim(regexp_replace(lower({column}), '[^a-z0-9 ]', '', 'g'))"


def _pct(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} = 0 THEN '-' ELSE printf('%.1f%%', {part} * 100.0 / {whole}) END"


# Articles with filter results and near-duplicate marks.
CANDIDATES = f"""f_candidates AS (
  SELECT a.article_id, s.primary_country_code AS cc,
         CAST(CAST(coalesce(a.published_at, a.fetched_at) + INTERVAL 9 HOUR AS DATE) AS VARCHAR) AS art_date,
         {_title_key('a.title')} AS title_key, s.tier, a.published_at
  FROM f_articles a JOIN f_sources s USING (source_id) JOIN f_scored r USING (article_id)
  WHERE r.filter_decision = 'passed')"""
FIRSTS = """f_firsts AS (
  SELECT *, first_value(article_id) OVER block AS first_id, row_number() OVER block AS nth,
         count(*) OVER (PARTITION BY cc, art_date, title_key) AS copies
  FROM f_candidates
  WINDOW block AS (PARTITION BY cc, art_date, title_key
                   ORDER BY tier, published_at DESC NULLS LAST, article_id))"""
# Near duplicates: matching blocks as relations. Every maximal run of equal characters on a diagonal of two titles is a row; the
# longest match of a range is the best run clipped to it, and the ranges on either side of it come next. Frequent characters of
# a second title of 200 and more do not begin a match, they only extend one.
NEAR = """f_ordered AS MATERIALIZED (
  SELECT cc, art_date, title_key, first_id,
         row_number() OVER (PARTITION BY cc, art_date ORDER BY tier, published_at DESC NULLS LAST, first_id) AS n
  FROM f_firsts WHERE nth = 1 AND title_key <> ''),
f_pairs AS MATERIALIZED (
  SELECT row_number() OVER () AS p, a, b, length(a) AS size_a, length(b) AS size_b
  FROM (SELECT DISTINCT x.title_key AS a, y.title_key AS b FROM f_ordered x JOIN f_ordered y USING (cc, art_date)
        WHERE x.n < y.n AND 2.0 * least(length(x.title_key), length(y.title_key))
              / (length(x.title_key) + length(y.title_key)) >= 0.75)),
f_chars AS MATERIALIZED (
  SELECT title_key, i, substr(title_key, i + 1, 1) AS ch
  FROM (SELECT DISTINCT title_key, unnest(range(CAST(length(title_key) AS BIGINT))) AS i FROM f_ordered)),
f_frequent AS (
  SELECT title_key, ch FROM f_chars GROUP BY ALL
  HAVING length(title_key) >= 200 AND count(*) > length(title_key) // 100 + 1),
f_cells AS MATERIALIZED (
  SELECT p, x.i, y.i AS j, x.i - y.i AS d, f.ch IS NULL AS begins
  FROM f_pairs JOIN f_chars x ON x.title_key = a JOIN f_chars y ON y.title_key = b AND y.ch = x.ch
  LEFT JOIN f_frequent f ON f.title_key = b AND f.ch = y.ch),
f_runs AS MATERIALIZED (
  SELECT p, d, min(i) AS s, max(i) + 1 AS e
  FROM (SELECT p, d, i, i - row_number() OVER (PARTITION BY p, d ORDER BY i) AS island FROM f_cells)
  GROUP BY p, d, island),
f_cores AS MATERIALIZED (
  SELECT c.p, c.d, c.s, c.e, r.s AS run_s, r.e AS run_e
  FROM (SELECT p, d, min(i) AS s, max(i) + 1 AS e
        FROM (SELECT p, d, i, i - row_number() OVER (PARTITION BY p, d ORDER BY i) AS island FROM f_cells WHERE begins)
        GROUP BY p, d, island) c
  JOIN f_runs r ON r.p = c.p AND r.d = c.d AND r.s <= c.s AND r.e >= c.e),
f_ranges AS (
  SELECT p, 0::BIGINT AS alo, size_a::BIGINT AS ahi, 0::BIGINT AS blo, size_b::BIGINT AS bhi, 0::BIGINT AS k FROM f_pairs
  UNION ALL
  SELECT p, part.alo, part.ahi, part.blo, part.bhi, part.k
  FROM (
    SELECT p, unnest([{'alo': alo, 'ahi': m, 'blo': blo, 'bhi': m - d, 'k': e - m},
                      {'alo': e, 'ahi': ahi, 'blo': e - d, 'bhi': bhi, 'k': 0::BIGINT}]) AS part
    FROM (
      SELECT q.p, alo, ahi, blo, bhi, coalesce(best.d, r.d) AS d,
             CASE WHEN best.d IS NULL THEN alo ELSE greatest(best.run_s, alo, blo + best.d) END AS m,
             least(coalesce(best.run_e, r.e), ahi, bhi + coalesce(best.d, r.d)) AS e
      FROM (
        SELECT w.p, w.alo, w.ahi, w.blo, w.bhi,
               arg_max({'d': c.d, 'run_s': c.run_s, 'run_e': c.run_e},
                       ROW(least(c.e, w.ahi, w.bhi + c.d) - greatest(c.s, w.alo, w.blo + c.d),
                           -greatest(c.s, w.alo, w.blo + c.d), c.d)) AS best
        FROM f_ranges w LEFT JOIN f_cores c
          ON c.p = w.p AND least(c.e, w.ahi, w.bhi + c.d) > greatest(c.s, w.alo, w.blo + c.d)
        WHERE w.alo < w.ahi AND w.blo < w.bhi
        GROUP BY ALL) q
      LEFT JOIN f_runs r ON best.d IS NULL AND r.p = q.p AND r.d = q.alo - q.blo AND r.s <= q.alo AND r.e > q.alo)
    WHERE d IS NOT NULL AND e > m)),
f_similar AS MATERIALIZED (
  SELECT a, b FROM f_pairs JOIN (SELECT p, sum(k) AS matched FROM f_ranges GROUP BY p) USING (p)
  WHERE 2.0 * matched / (size_a + size_b) >= 0.75),
f_earlier AS MATERIALIZED (
  SELECT y.cc, y.art_date, y.n, list(x.n) FILTER (s.a IS NOT NULL) AS alike
  FROM f_ordered y LEFT JOIN f_ordered x ON x.cc = y.cc AND x.art_date = y.art_date AND x.n < y.n
  LEFT JOIN f_similar s ON s.a = x.title_key AND s.b = y.title_key
  GROUP BY ALL),
f_greedy AS (
  SELECT cc, art_date, n, [n] AS primaries, NULL::BIGINT AS found FROM f_earlier WHERE n = 1
  UNION ALL
  SELECT cc, art_date, n, CASE WHEN found IS NULL THEN list_append(primaries, n) ELSE primaries END, found
  FROM (SELECT e.cc, e.art_date, e.n, g.primaries, list_min(list_intersect(g.primaries, coalesce(e.alike, []))) AS found
        FROM f_greedy g JOIN f_earlier e ON e.cc = g.cc AND e.art_date = g.art_date AND e.n = g.n + 1)),
f_near AS (
  SELECT f.article_id, f.cc, f.art_date, nullif(coalesce(p.first_id, f.first_id), f.article_id) AS duplicate_of
  FROM f_firsts f JOIN f_ordered t USING (cc, art_date, title_key)
  JOIN f_greedy g ON g.cc = t.cc AND g.art_date = t.art_date AND g.n = t.n
  LEFT JOIN f_ordered p ON p.cc = g.cc AND p.art_date = g.art_date AND p.n = g.found
  UNION ALL SELECT article_id, cc, art_date, NULL FROM f_firsts WHERE title_key = '')"""
EQUAL = """f_equal AS (
  SELECT article_id, CASE WHEN title_key <> '' AND first_id <> article_id THEN first_id END AS duplicate_of
  FROM f_firsts)"""
MARKS = "f_marks AS MATERIALIZED (SELECT article_id, duplicate_of FROM f_near)"
MARKED_ROWS = """f_marked AS (
  SELECT a.*, s.media_name, s.primary_country_code, s.tier, r.filter_stage, r.filter_decision, r.filter_reason,
         r.filter_score, m.duplicate_of
  FROM f_articles a JOIN f_sources s USING (source_id) JOIN f_scored r USING (article_id)
  LEFT JOIN f_marks m USING (article_id))"""
MARKED = (*SCORED, CANDIDATES, FIRSTS, NEAR, MARKS, MARKED_ROWS)

# Stored replies, parsed with DuckDB's JSON functions.
REPLIES = """f_texts_of_replies AS (
  SELECT article_id, CASE article_id % 8
    WHEN 0 THEN '{"keep": true, "ai_score": 85, "topics": ["esg","RISK","esg"], "summary_ko": "s"}'
    WHEN 1 THEN '```json' || chr(10) || '{"keep": false, "reason": "noise", "ai_score": 120}' || chr(10) || '```'
    WHEN 2 THEN 'Answer: {"keep": true, "ai_score": "42"} done'
    WHEN 3 THEN 'oops'
    WHEN 4 THEN '{"keep": null, "ai_score": 85.7}'
    WHEN 5 THEN '{"keep": "false", "ai_score": "85.7"}'
    WHEN 6 THEN '[1]' END AS raw_text
  FROM f_articles),
f_bare AS (
  SELECT article_id, raw_text,
         trim(regexp_replace(raw_text, '(?m)^```(?:json)?\\s*|\\s*```$', '', 'g')) AS bare
  FROM f_texts_of_replies),
f_json AS (
  SELECT article_id, raw_text IS NOT NULL AS answered,
         CASE WHEN json_valid(bare) THEN bare
              WHEN json_valid(regexp_extract(bare, '(?s)\\{.*\\}')) THEN regexp_extract(bare, '(?s)\\{.*\\}') END AS whole
  FROM f_bare),
f_replies AS (
  SELECT article_id, answered,
         CASE WHEN json_type(CASE WHEN whole IS NOT NULL THEN CAST(whole AS JSON) END) = 'OBJECT'
              THEN CAST(whole AS JSON) END AS reply
  FROM f_json)"""
TRIAGE = """f_triage AS (
  SELECT article_id, CASE WHEN keep THEN 'keep' ELSE 'drop' END AS decision,
         CASE WHEN NOT keep THEN left(coalesce(reply ->> '$.reason', ''), 300) END AS reject_reason
  FROM (SELECT m.article_id, reply,
               CASE json_type(reply, '$.keep')
                 WHEN 'NULL' THEN false WHEN 'BOOLEAN' THEN (reply ->> '$.keep') = 'true'
                 WHEN 'VARCHAR' THEN (reply ->> '$.keep') <> '' ELSE true END AS keep
        FROM f_marked m LEFT JOIN f_replies USING (article_id)
        WHERE m.filter_decision = 'passed' AND m.duplicate_of IS NULL))"""
KEPT = """f_kept AS (
  SELECT m.*, t.decision AS triage_decision FROM f_marked m LEFT JOIN f_triage t USING (article_id))"""

_TOPICS = sample_topics()
_SEEDED = ", ".join(
    "CASE WHEN " + " OR ".join(matches("low", seed) for seed in topic.seeds) + f" THEN {quoted(topic.code)} END"
    for topic in _TOPICS
)


def _seed_list(text: str) -> str:
    return (
        f"(SELECT list_slice(list_filter([{_SEEDED}], lambda code: code IS NOT NULL), 1, 3)"
        f" FROM (SELECT lower({text}) AS low))"
    )


RANK = f"""f_rank AS (
  SELECT article_id, ai_score, summary_ko,
         CASE WHEN len(named) > 0 THEN named ELSE seeded END AS topics, '' AS implication, model
  FROM (SELECT k.article_id,
               CAST(greatest(0, least(100, coalesce(
                 CASE json_type(reply, '$.ai_score')
                   WHEN 'VARCHAR' THEN CASE WHEN regexp_matches(reply ->> '$.ai_score', '^[0-9]+$')
                                            THEN CAST(reply ->> '$.ai_score' AS DOUBLE) END
                   ELSE trunc(TRY_CAST(reply ->> '$.ai_score' AS DOUBLE)) END, 50))) AS INTEGER) AS ai_score,
               left(coalesce(reply ->> '$.summary_ko', ''), 1500) AS summary_ko,
               CASE WHEN json_type(reply, '$.topics') = 'ARRAY' THEN ['ESG', 'RISK'] ELSE [] END AS named,
               {_seed_list("k.title || ' ' || k.summary")} AS seeded,
               CASE WHEN answered THEN 'stored:sample' ELSE 'stub:smart' END AS model
        FROM f_kept k LEFT JOIN f_replies USING (article_id)
        WHERE k.triage_decision = 'keep'))"""
FINAL = """f_final AS (
  SELECT k.*, r.ai_score, r.summary_ko, r.topics, r.implication
  FROM f_kept k LEFT JOIN f_rank r USING (article_id))"""
TRIAGED = (*MARKED, REPLIES, TRIAGE)
KEPT_ROWS = (*TRIAGED, KEPT)
RANKED = (*KEPT_ROWS, RANK)
FINAL_ROWS = (*RANKED, FINAL)


def _oracle(name: str, *views: str, body: str) -> None:
    ORACLES[name] = with_views(*views, body=body) if views else body.strip()


# -- filter ---------------------------------------------------------------------------------------------
_RESULTS = "article_id, filter_stage, filter_decision, filter_reason, filter_score"
_oracle("score_articles", *SCORED, body=f"SELECT {_RESULTS} FROM f_scored")
_oracle(
    "score_published_lexicon", SOURCES, ARTICLES, scored(published_sample()), body=f"SELECT {_RESULTS} FROM f_scored"
)
_oracle("refilter_pending", *SCORED, body=f"SELECT {_RESULTS} FROM f_scored WHERE filter_stage = 2")
_oracle("filter_totals", *MARKED, body=f"""
SELECT *, {_pct('passed', 'total')} AS passed_pct, {_pct('rejected', 'total')} AS rejected_pct,
       {_pct('pending', 'total')} AS pending_pct
FROM (SELECT count(*) AS total, count(*) FILTER (filter_decision = 'passed') AS passed,
             count(*) FILTER (filter_decision = 'rejected') AS rejected,
             count(*) FILTER (filter_decision = 'pending') AS pending, count(duplicate_of) AS total_dups
      FROM f_marked)""")
_oracle("filter_global_categories", *SCORED, CATEGORIES, body="""
SELECT count(*) AS total, count(*) FILTER (filter_decision = 'passed') AS passed,
       count(*) FILTER (filter_decision = 'rejected') AS rejected
FROM f_articles a JOIN f_scored USING (article_id)
WHERE EXISTS (SELECT 1 FROM f_categories c WHERE c.source_id = a.source_id
              AND c.category_code IN ('GLOBAL_GENERAL', 'GLOBAL_ECONOMY'))""")
_oracle("filter_by_country", *MARKED, body=f"""
SELECT *, {_pct('passed', 'total')} AS pass_rate
FROM (SELECT primary_country_code AS country, count(*) AS total,
             count(*) FILTER (filter_decision = 'passed') AS passed,
             count(*) FILTER (filter_decision = 'rejected') AS rejected, count(duplicate_of) AS dups
      FROM f_marked GROUP BY 1)
ORDER BY passed DESC, country""")
_oracle("top_pass_reasons", *SCORED, body="""
SELECT filter_reason, count(*) AS cnt FROM f_scored WHERE filter_decision = 'passed' AND filter_stage = 2
GROUP BY 1 ORDER BY cnt DESC, filter_reason LIMIT 20""")
_oracle("top_exclusions", *SCORED, body="""
SELECT filter_reason, count(*) AS cnt FROM f_scored
WHERE filter_decision = 'rejected' AND filter_reason LIKE 'excl:%'
GROUP BY 1 ORDER BY cnt DESC, filter_reason LIMIT 10""")
_oracle("rejected_sample", *SCORED, body="""
SELECT s.media_name, left(a.title, 70) AS title, left(r.filter_reason, 40) AS filter_reason
FROM f_scored r JOIN f_articles a USING (article_id) JOIN f_sources s USING (source_id)
WHERE r.filter_decision = 'rejected' ORDER BY md5('7:' || article_id) LIMIT 15""")
_oracle("filter_counters", *SCORED, body="""
SELECT count(*) AS total, count(*) FILTER (filter_decision = 'passed') AS passed,
       count(*) FILTER (filter_decision = 'rejected') AS rejected FROM f_scored""")

# -- near duplicates --------------------------------------------------------------------------------------
_oracle("dedup_blocks", *SCORED, CANDIDATES, FIRSTS, body="""
SELECT cc, art_date, title_key, copies, first_id FROM f_firsts WHERE nth = 1 AND title_key <> ''""")
_oracle("dedup_equal_titles", *SCORED, CANDIDATES, FIRSTS, EQUAL, body="SELECT article_id, duplicate_of FROM f_equal")
ALL_CANDIDATES = CANDIDATES.replace(" JOIN f_scored r USING (article_id)", "").replace(
    "WHERE r.filter_decision = 'passed'", "")
_oracle("dedup_marks", *SCORED, CANDIDATES, FIRSTS, NEAR, body="SELECT * FROM f_near")
for _name in ("dedup_all_titles", "dedup_in_waves", "stream_dedup"):
    _oracle(_name, SOURCES, ARTICLES, ALL_CANDIDATES, FIRSTS, NEAR, body="SELECT * FROM f_near")

# -- text, time and identity --------------------------------------------------------------------------------
_oracle("strip_html_pages", body=f"""
SELECT page_id, {stripped(rf"regexp_replace(regexp_replace({decoded('html')}, '<[^>]+>', ' ', 'g'), '[ \x{{a0}}]{{2,}}', ' ', 'g')")}
       AS plain FROM pages""")
_oracle("clean_text_docs", body=f"""
SELECT doc_id, {cleaned('text')} AS clean, {normalized(cleaned("split_part(text, chr(10), 1)"))} AS first_line
FROM documents""")
_oracle("clean_text_pages", body=f"SELECT page_id, {cleaned('html')} AS clean FROM pages")
_oracle("scoring_text_docs", body=f"SELECT doc_id, {normalized(cleaned('text'))} AS scored FROM documents")
_oracle("title_keys", ARTICLES, body=f"SELECT article_id, {_title_key('title')} AS title_key FROM f_articles")
_oracle("content_hashes", ARTICLES, body="""
SELECT article_id, sha256(title || chr(31) || link) AS content_hash FROM f_articles""")
_oracle("kst_day", ARTICLES, body="""
SELECT article_id, strftime(coalesce(published_at, fetched_at) + INTERVAL 9 HOUR, '%Y-%m-%d') AS kst_day,
       strftime(published_at, '%Y-%m-%d') AS utc_day FROM f_articles""")

ENTRIES = """f_entries AS (
  SELECT article_id, feed_id, source_id, article_id AS pos, title AS padded, summary, published_at AS ts,
         'https://src' || source_id || '.example.com/' || sha256(title) AS link,
         CASE article_id % 6
           WHEN 0 THEN strftime(published_at + INTERVAL 9 HOUR, '%a, %d %b %Y %H:%M:%S +0900')
           WHEN 1 THEN strftime(published_at, '%a, %d %b %Y %H:%M:%S GMT')
           WHEN 2 THEN strftime(published_at, '%Y-%m-%dT%H:%M:%SZ')
           WHEN 3 THEN strftime(published_at + INTERVAL 9 HOUR, '%Y-%m-%dT%H:%M:%S+09:00')
           WHEN 4 THEN 'n/a'
           WHEN 5 THEN strftime(published_at - INTERVAL 5 HOUR, '%d %b %Y %H:%M:%S EST') END AS dated,
         fetched_at
  FROM f_articles),
f_dated AS (
  SELECT *, coalesce(
      CASE WHEN dated LIKE '%+0900' THEN try_strptime(dated, '%a, %d %b %Y %H:%M:%S +0900') - INTERVAL 9 HOUR
           WHEN dated LIKE '%GMT' THEN try_strptime(dated, '%a, %d %b %Y %H:%M:%S GMT')
           WHEN dated LIKE '%EST' THEN try_strptime(dated, '%d %b %Y %H:%M:%S EST') + INTERVAL 5 HOUR
           WHEN dated LIKE '%+09:00' THEN try_strptime(dated, '%Y-%m-%dT%H:%M:%S+09:00') - INTERVAL 9 HOUR
           ELSE try_strptime(dated, '%Y-%m-%dT%H:%M:%SZ') END, fetched_at) AS parsed
  FROM f_entries)"""
_oracle("published_parse", ARTICLES, ENTRIES,
        body=f"SELECT article_id, {_stamp('parsed')} AS published_at FROM f_dated")

# -- registry ------------------------------------------------------------------------------------------------
_CODES = f"[{', '.join(map(quoted, COUNTRY_CODES))}]"
REGISTRY = f"""r_old AS (
  SELECT c_custkey AS source_id, c_name AS media_name, {_CODES}[c_nationkey % 12 + 1] AS country,
         c_custkey % 3 AS tier, c_nationkey
  FROM customer WHERE c_mktsegment <> 'BUILDING'),
r_new AS (
  SELECT c_custkey AS pos, c_name AS media_name, {_CODES}[(c_nationkey + 1) % 12 + 1] AS country,
         CASE WHEN c_nationkey % 3 = 0 THEN 'ko' ELSE 'en' END AS language, (c_custkey + 1) % 3 AS tier,
         c_acctbal >= 0 AS active, c_nationkey, c_acctbal
  FROM customer WHERE c_mktsegment <> 'MACHINERY'),
r_ids AS (
  SELECT media_name, source_id FROM r_old
  UNION ALL
  SELECT media_name, (SELECT max(source_id) FROM r_old) + row_number() OVER (ORDER BY pos)
  FROM r_new WHERE media_name NOT IN (SELECT media_name FROM r_old)),
r_sources AS (
  SELECT i.source_id, i.media_name, coalesce(n.country, o.country) AS primary_country_code,
         coalesce(n.language, 'en') AS language, CAST(coalesce(n.tier, o.tier) AS INTEGER) AS tier
  FROM r_ids i LEFT JOIN r_new n USING (media_name) LEFT JOIN r_old o USING (media_name)),
r_listed AS (
  SELECT pos, media_name, v.n, v.section,
         CASE v.n WHEN 2 THEN 'https://hub.example.com/' || c_nationkey
                  ELSE 'https://m' || pos || '.example.com/' || v.section END AS feed_url
  FROM r_new, (VALUES (0, 'world'), (1, 'business'), (2, 'hub')) v(n, section)
  WHERE active AND (c_acctbal < 8000 OR c_acctbal > 8500)
    AND (v.n = 0 OR (v.n = 1 AND c_nationkey % 2 = 0) OR (v.n = 2 AND c_acctbal > 5000))),
r_owned AS (
  SELECT feed_url, arg_max(media_name, pos) AS media_name, arg_max(section, pos) AS section,
         min(pos * 10 + n) AS first_place
  FROM r_listed GROUP BY feed_url),
r_old_feeds AS (
  SELECT source_id * 2 + n AS feed_id, source_id,
         'https://m' || source_id || '.example.com/' || v.section AS feed_url, v.section AS feed_section
  FROM r_old, (VALUES (0, 'world'), (1, 'sport')) v(n, section)),
r_feeds AS (
  SELECT o.feed_id, coalesce(i.source_id, o.source_id) AS source_id, o.feed_url,
         coalesce(w.section, o.feed_section) AS feed_section, w.feed_url IS NOT NULL AS is_active,
         200 AS last_status
  FROM r_old_feeds o LEFT JOIN r_owned w USING (feed_url) LEFT JOIN r_ids i ON i.media_name = w.media_name
  UNION ALL
  SELECT (SELECT max(feed_id) FROM r_old_feeds) + row_number() OVER (ORDER BY w.first_place), i.source_id,
         w.feed_url, w.section, true, NULL
  FROM r_owned w JOIN r_ids i USING (media_name)
  WHERE w.feed_url NOT IN (SELECT feed_url FROM r_old_feeds))"""
_oracle("registry_sync_sources", REGISTRY, body="SELECT * FROM r_sources")
_oracle("registry_sync_categories", REGISTRY, body="""
SELECT source_id, unnest([country, 'GLOBAL_ECONOMY']) AS category_code FROM r_old
WHERE media_name NOT IN (SELECT media_name FROM r_new)
UNION ALL
SELECT source_id, country FROM r_new JOIN r_ids USING (media_name)
UNION ALL
SELECT source_id, 'GLOBAL_GENERAL' FROM r_new JOIN r_ids USING (media_name) WHERE c_nationkey % 4 = 0""")
_oracle("registry_sync_feeds", REGISTRY, body="SELECT * FROM r_feeds")
_oracle("registry_counts", REGISTRY, body="""
SELECT (SELECT count(*) FROM r_sources) AS sources, (SELECT count(*) FROM r_feeds) AS feeds""")
_oracle("active_feeds", SOURCES, FEEDS, body="SELECT feed_id, source_id, feed_url FROM f_feeds WHERE is_active")

# -- ingest --------------------------------------------------------------------------------------------------
_oracle("parse_feed_xml", ARTICLES, body=rf"""
SELECT article_id AS feed_id, source_id, 0 AS pos,
       {stripped(r"regexp_replace(title, '[\x00-\x08\x0b-\x1f\x{fffe}\x{ffff}]', '', 'g')")} AS title, link,
       {stripped(r"regexp_replace(summary, '[\x00-\x08\x0b-\x1f\x{fffe}\x{ffff}]', '', 'g')")} AS summary,
       CASE WHEN article_id % 10 = 6 THEN strftime(published_at, '%Y-%m-%dT%H:%M:%SZ')
            ELSE strftime(published_at, '%a, %d %b %Y %H:%M:%S GMT') END AS published
FROM f_articles WHERE article_id % 10 < 8""")
_oracle("parse_feed_status", ARTICLES, body="""
SELECT article_id AS feed_id, CASE article_id % 10 WHEN 9 THEN 404 ELSE 200 END AS status,
       CASE article_id % 10 WHEN 8 THEN 'unparsable body' WHEN 9 THEN 'http 404' END AS error,
       CASE WHEN article_id % 10 < 8 THEN 1 ELSE 0 END AS entry_count
FROM f_articles""")
_PLAIN = rf"regexp_replace(regexp_replace({decoded('summary')}, '<[^>]+>', ' ', 'g'), '[ \x{{a0}}]{{2,}}', ' ', 'g')"
INGEST = f"""f_rows AS (
  SELECT feed_id, source_id, pos, {stripped('padded')} AS title, link, parsed,
         left({stripped(_PLAIN)}, 4000) AS summary, sha256({stripped('padded')} || chr(31) || link) AS content_hash
  FROM f_dated WHERE {stripped('padded')} <> ''),
f_stored AS (
  SELECT article_id, sha256({stripped('padded')} || chr(31) || link) AS content_hash
  FROM f_entries WHERE article_id IN (SELECT doc_id FROM labels)),
f_new AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY content_hash ORDER BY feed_id, pos) AS nth FROM f_rows)
  WHERE nth = 1 AND content_hash NOT IN (SELECT content_hash FROM f_stored))"""
_oracle("ingest_insert_ignore", ARTICLES, ENTRIES, INGEST, body=f"""
SELECT (SELECT coalesce(max(article_id), 0) FROM f_stored) + row_number() OVER (ORDER BY content_hash) AS article_id,
       feed_id, source_id, title, link, summary, {_stamp('parsed')} AS published_at, content_hash,
       0 AS filter_stage, 'pending' AS filter_decision
FROM f_new""")
COUNTS = """f_once AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY content_hash ORDER BY feed_id, pos % 2, pos) AS nth FROM f_rows)
  WHERE nth = 1 AND content_hash NOT IN (SELECT content_hash FROM f_stored)),
f_counts AS (
  SELECT f.feed_id, CAST(k AS INTEGER) AS fetch, f.last_status AS status, f.last_error AS error,
         (SELECT count(*) FROM f_once n WHERE n.feed_id = f.feed_id AND n.pos % 2 = k) AS new_articles,
         (SELECT count(*) FROM f_rows r WHERE r.feed_id = f.feed_id AND r.pos % 2 = k)
         - (SELECT count(*) FROM f_once n WHERE n.feed_id = f.feed_id AND n.pos % 2 = k) AS dup_articles
  FROM f_feeds f, (VALUES (0), (1)) v(k))"""
_oracle("ingest_feed_counts", ARTICLES, SOURCES, FEEDS, ENTRIES, INGEST, COUNTS, body="SELECT * FROM f_counts")
_oracle("ingest_run_metrics", ARTICLES, SOURCES, FEEDS, ENTRIES, INGEST, COUNTS, body="""
SELECT count(*) AS feeds_total, count(*) FILTER (error IS NULL) AS feeds_ok,
       count(*) FILTER (error IS NOT NULL) AS feeds_failed,
       CAST(sum(new_articles) AS BIGINT) AS new_articles, CAST(sum(dup_articles) AS BIGINT) AS dup_articles
FROM f_counts""")
_oracle("sink_fetch_runs", ARTICLES, SOURCES, FEEDS, ENTRIES, INGEST, COUNTS, body="""
SELECT CAST(run AS BIGINT) AS run_id, '2024-02-01 00:00:00' AS started_at, '2024-02-01 00:10:00' AS finished_at, t.*
FROM (VALUES (1), (2)) r(run), (
  SELECT count(*) AS feeds_total, count(*) FILTER (error IS NULL) AS feeds_ok,
         count(*) FILTER (error IS NOT NULL) AS feeds_failed,
         CAST(sum(new_articles) AS BIGINT) AS new_articles, CAST(sum(dup_articles) AS BIGINT) AS dup_articles
  FROM f_counts) t""")
_oracle("sink_articles", ARTICLES, body="""
SELECT article_id, title,
       CAST(CAST(coalesce(published_at, fetched_at) + INTERVAL 9 HOUR AS DATE) AS VARCHAR) AS art_date FROM f_articles""")
_oracle("sink_report_csv", *MARKED, body=f"""
SELECT *, {_pct('passed', 'total')} AS pass_rate
FROM (SELECT primary_country_code AS country, count(*) AS total,
             count(*) FILTER (filter_decision = 'passed') AS passed,
             count(*) FILTER (filter_decision = 'rejected') AS rejected, count(duplicate_of) AS dups
      FROM f_marked GROUP BY 1)""")
_oracle("feed_health", SOURCES, FEEDS, ARTICLES, """f_latest AS (
  SELECT source_id * 2 AS feed_id, max(fetched_at) AS fetched, arg_max(article_id % 10, fetched_at) AS kind
  FROM f_articles GROUP BY 1)""", body=f"""
SELECT f.feed_id, f.source_id, f.feed_url, f.feed_section, f.is_active,
       CASE WHEN fetched IS NULL THEN f.last_status WHEN kind = 9 THEN 404 ELSE 200 END AS last_status,
       {_stamp("coalesce(fetched, TIMESTAMP '2024-01-01 00:00:00')")} AS last_fetched,
       CASE WHEN fetched IS NULL THEN f.last_error WHEN kind = 9 THEN 'http 404'
            WHEN kind = 8 THEN 'unparsable body' END AS last_error
FROM f_feeds f LEFT JOIN f_latest USING (feed_id)""")
_oracle("resolve_links", body="""
SELECT page_id AS article_id,
       CASE WHEN url LIKE 'http://%?%' THEN replace(split_part(url, '?', 1), 'http://', 'https://') ELSE url END AS link
FROM pages""")

# -- enrichment ----------------------------------------------------------------------------------------------
_WAITING = "FROM f_marked WHERE filter_decision = 'passed' AND duplicate_of IS NULL"
_oracle("triage_queue", *MARKED, body=f"""
SELECT article_id, filter_score {_WAITING} ORDER BY filter_score DESC NULLS LAST, article_id LIMIT 300""")
_oracle("triage_requests", *MARKED, body=f"""
SELECT 'triage' AS stage, CAST(article_id AS VARCHAR) AS key,
       '[국가:' || primary_country_code || '] 제목: ' || title || chr(10) || '요약: ' || left(summary, 600) AS prompt
{_WAITING}""")
_oracle("triage_decisions", *TRIAGED, body="SELECT article_id, decision, reject_reason FROM f_triage")
_oracle("enrich_chain_second_run", *TRIAGED, body=f"""
SELECT CAST(1 + (n - 1) // 300 AS INTEGER) AS run, article_id, decision, reject_reason
FROM (SELECT article_id, row_number() OVER (ORDER BY filter_score DESC NULLS LAST, article_id) AS n {_WAITING})
JOIN f_triage USING (article_id) WHERE n <= 600""")
_oracle("triage_without_replies", *MARKED, body=f"""
SELECT article_id, 'keep' AS decision, CAST(NULL AS VARCHAR) AS reject_reason {_WAITING}""")
_oracle("rank_queue", *KEPT_ROWS, body="""
SELECT article_id, filter_score FROM f_kept WHERE triage_decision = 'keep'
ORDER BY filter_score DESC NULLS LAST, article_id LIMIT 150""")


def _context(cc: str) -> str:
    cases = " ".join(
        f"WHEN {quoted(o.cc)} THEN {quoted(f'{o.entity} — {o.city} 소재 {o.type}')}" for o in OFFICES
    )
    return f"CASE {cc} {cases} ELSE {quoted(NO_OFFICE)} END"


_oracle("rank_requests", *KEPT_ROWS, body=f"""
SELECT 'rank' AS stage, CAST(article_id AS VARCHAR) AS key,
       '[거점 맥락: ' || {_context('primary_country_code')} || ']' || chr(10) || '매체: ' || media_name || '  국가: '
       || primary_country_code || chr(10) || '제목: ' || title || chr(10) || '요약: ' || left(summary, 1200) AS prompt
FROM f_kept WHERE triage_decision = 'keep'""")
_oracle("rank_fields", *RANKED, body="""
SELECT article_id, ai_score, summary_ko, array_to_string(topics, ',') AS topics, implication, model FROM f_rank""")
_oracle("seed_topics", ARTICLES, body=f"""
SELECT article_id, coalesce(array_to_string({_seed_list("title || ' ' || summary")}, ','), '') AS topics
FROM f_articles""")


def _topic_case(value: str, pick) -> str:
    return f"CASE {value} " + " ".join(
        f"WHEN {quoted(topic.code)} THEN {quoted(pick(topic))}" for topic in TOPICS
    )


_oracle("topic_ui_strings", *RANKED, body=f"""
SELECT article_id,
       coalesce((SELECT string_agg(ui, ' ' ORDER BY place) FROM (
          SELECT {_topic_case('code', lambda t: t.ui)} END AS ui, min(place) AS place
          FROM (SELECT unnest(topics) AS code, generate_subscripts(topics, 1) AS place) GROUP BY 1)), '') AS ui,
       {_topic_case("coalesce(topics[1], 'NONE')", lambda t: t.label_ko)} ELSE 'NONE' END AS label_ko,
       {_topic_case("coalesce(topics[1], 'NONE')", lambda t: t.label_en)} ELSE 'NONE' END AS label_en,
       {_topic_case("coalesce(topics[1], 'NONE')", lambda t: t.ui)} ELSE 'none' END AS first_ui
FROM f_rank""")
_oracle("office_context", ARTICLES, SOURCES, body=f"""
SELECT article_id, {_context('primary_country_code')} AS context,
       primary_country_code IN ({', '.join(quoted(o.cc) for o in OFFICES if o.type == SUBSIDIARY)}) AS subsidiary
FROM f_articles JOIN f_sources USING (source_id)""")
_oracle("stage_counters", *RANKED, body="""
SELECT 'triage' AS stage, count(*) AS total, count(*) FILTER (decision = 'keep') AS good,
       count(*) FILTER (decision = 'drop') AS rest FROM f_triage
UNION ALL
SELECT 'rank', count(*), count(*) FILTER (ai_score >= 60), count(*) FILTER (ai_score < 60) FROM f_rank""")

# -- briefing and export -------------------------------------------------------------------------------------
_oracle("ranked_countries", *FINAL_ROWS, body="""
SELECT DISTINCT primary_country_code AS cc FROM f_final WHERE ai_score IS NOT NULL""")
INPUTS = f"""f_best AS (
  SELECT primary_country_code AS cc, title, summary_ko, ai_score, link,
         row_number() OVER (PARTITION BY primary_country_code ORDER BY ai_score DESC, article_id) AS rn
  FROM f_final WHERE ai_score IS NOT NULL AND duplicate_of IS NULL),
f_inputs AS (
  SELECT cc, '국가: ' || cc || ' (' || {_context('cc')} || ')' || chr(10) || '기사 목록:' || chr(10)
         || string_agg('- (' || ai_score || ') ' || title || ' :: ' || left(coalesce(summary_ko, ''), 160), chr(10)
                       ORDER BY rn) AS prompt,
         CAST(count(*) AS INTEGER) AS article_count,
         '[' || string_agg('"' || link || '"', ',' ORDER BY rn) || ']' AS source_articles
  FROM f_best WHERE rn <= 25 GROUP BY cc),
f_briefings AS (
  SELECT cc, '2024-02-01' AS briefing_date, 'weekly' AS briefing_type, cc || ' 요약' AS summary,
         '["a","' || article_count || '"]' AS issues, 'o' AS outlook, '["k"]' AS keywords, '5' AS key_stat,
         'stored:sample' AS model, article_count
  FROM f_inputs WHERE cc < 'S' AND cc <> 'IN')"""
_oracle("briefing_inputs", *FINAL_ROWS, INPUTS, body="SELECT * FROM f_inputs")
_oracle("briefing_rows", *FINAL_ROWS, INPUTS, body="SELECT * FROM f_briefings")
_COUNTED = [
    ("filter", "f_scored", {
        "total": "count(*)", "passed": "count(*) FILTER (filter_decision = 'passed')",
        "rejected": "count(*) FILTER (filter_decision = 'rejected')",
    }),
    ("dedup", "f_near", {"checked": "count(*)", "duplicates": "count(duplicate_of)"}),
    ("triage", "f_triage", {
        "total": "count(*)", "keep": "count(*) FILTER (decision = 'keep')", "drop": "count(*) FILTER (decision = 'drop')",
    }),
    ("rank", "f_rank", {"ranked": "count(*)", "active": "count(*) FILTER (ai_score >= 60)"}),
    ("briefing", "f_briefings", {"written": "count(*)", "articles": "sum(article_count)"}),
]
_oracle("run_counters", *FINAL_ROWS, INPUTS, body=" UNION ALL ".join(
    f"SELECT '{stage}' AS stage, '{name}' AS counter, CAST({value} AS BIGINT) AS value FROM {table}"
    for stage, table, counters in _COUNTED for name, value in counters.items()
))
_oracle("briefing_upsert", *FINAL_ROWS, INPUTS, body="""
SELECT cc, briefing_date, briefing_type, summary, article_count FROM f_briefings
UNION ALL
SELECT c.cc, v.d, 'weekly', 'old', 0
FROM (SELECT DISTINCT primary_country_code AS cc FROM f_sources) c, (VALUES ('2024-01-25'), ('2024-02-01')) v(d)
WHERE (c.cc, v.d) NOT IN (SELECT (cc, briefing_date) FROM f_briefings)""")

_LISTED = ", ".join(f"({n}, {quoted(cc)}, {quoted(flag)})" for n, (cc, flag) in enumerate(EXPORT_COUNTRIES))
EXPORT = f"""f_listed(ord, cc, flag) AS (VALUES {_LISTED}),
f_active AS (
  SELECT primary_country_code AS cc,
         CAST(row_number() OVER (PARTITION BY primary_country_code
                                 ORDER BY ai_score DESC, published_at DESC NULLS LAST, article_id) AS INTEGER) AS rn,
         media_name AS src, strftime(published_at, '%Y-%m-%d') AS d, title AS t, coalesce(summary_ko, '') AS q,
         coalesce(implication, '') AS k, link AS u, ai_score AS score,
         coalesce((SELECT string_agg(ui, ' ' ORDER BY place) FROM (
            SELECT {_topic_case('code', lambda t: t.ui)} END AS ui, min(place) AS place
            FROM (SELECT unnest(topics) AS code, generate_subscripts(topics, 1) AS place) GROUP BY 1)), '') AS c
  FROM f_final
  WHERE ai_score >= 60 AND duplicate_of IS NULL AND primary_country_code IN (SELECT cc FROM f_listed)),
f_cards AS (SELECT * FROM f_active WHERE rn <= 20),
f_export AS (
  SELECT l.ord, l.cc, l.flag, CASE WHEN count(u) > 0 THEN 'ACTIVE' ELSE 'SOURCE WATCH' END AS status,
         CAST(count(u) AS INTEGER) AS count, coalesce(string_agg(u, chr(10) ORDER BY rn), '') AS links
  FROM f_listed l LEFT JOIN f_cards c USING (cc) GROUP BY ALL)"""
_oracle("export_articles", *FINAL_ROWS, EXPORT, body="SELECT * FROM f_cards")
_oracle("export_countries", *FINAL_ROWS, EXPORT, body="SELECT * FROM f_export ORDER BY ord")
_oracle("export_document", *FINAL_ROWS, EXPORT, body="""
SELECT '2024-02-01 00:00:00' AS generated_at, 60 AS active_threshold, CAST(count(*) AS INTEGER) AS countries,
       CAST(sum(count) AS INTEGER) AS articles, string_agg(cc || '=' || status, ';' ORDER BY ord) AS states
FROM f_export""")

# -- availability and lists ----------------------------------------------------------------------------------
AVAILABILITY = f"""f_availability AS (
  SELECT f.feed_id, s.media_name, s.primary_country_code, s.tier, f.feed_section, f.feed_url, f.last_status,
         f.last_error, coalesce(n.article_count, 0) AS article_count, {_stamp('n.last_published')} AS last_published
  FROM f_feeds f JOIN f_sources s USING (source_id)
  LEFT JOIN (SELECT feed_id, count(*) AS article_count, max(published_at) AS last_published
             FROM f_articles GROUP BY 1) n USING (feed_id)
  WHERE f.is_active)"""
_oracle("feed_availability", SOURCES, FEEDS, ARTICLES, AVAILABILITY, body="""
SELECT * FROM f_availability ORDER BY primary_country_code, media_name, feed_section, feed_url""")
_oracle("feed_availability_display", SOURCES, FEEDS, ARTICLES, AVAILABILITY, body="""
SELECT * REPLACE (coalesce(CAST(nullif(last_status, 0) AS VARCHAR), '-') AS last_status,
                  coalesce(last_published, '-') AS last_published, left(coalesce(last_error, ''), 60) AS last_error)
FROM f_availability""")
_oracle("country_availability", SOURCES, FEEDS, ARTICLES, body="""
SELECT s.primary_country_code AS country, count(DISTINCT s.source_id) AS media_count,
       count(DISTINCT f.feed_id) AS feed_count,
       CAST(sum(CASE WHEN f.last_status BETWEEN 200 AND 299 THEN 1 ELSE 0 END) AS BIGINT) AS feeds_ok,
       CAST(sum(CASE WHEN f.last_status BETWEEN 200 AND 299 THEN 0 ELSE 1 END) AS BIGINT) AS feeds_bad,
       CAST(coalesce(sum(n.article_count), 0) AS BIGINT) AS articles
FROM f_sources s LEFT JOIN f_feeds f ON f.source_id = s.source_id AND f.is_active
LEFT JOIN (SELECT feed_id, count(*) AS article_count FROM f_articles GROUP BY 1) n ON n.feed_id = f.feed_id
GROUP BY 1 ORDER BY 1""")
_oracle("recent_articles", *SCORED, body=f"""
SELECT article_id, filter_decision, media_name, {_stamp('published_at')} AS published_at, left(title, 70) AS title
FROM f_articles JOIN f_sources USING (source_id) JOIN f_scored USING (article_id)
ORDER BY fetched_at DESC, article_id LIMIT 20""")

# -- streaming -----------------------------------------------------------------------------------------------
_oracle("stream_ingest", ARTICLES, body=rf"""
SELECT feed_id, source_id, title, link, published_at, sha256(title || chr(31) || link) AS content_hash
FROM (SELECT article_id AS feed_id, source_id,
             {stripped(r"regexp_replace(title, '[\x00-\x08\x0b-\x1f\x{fffe}\x{ffff}]', '', 'g')")} AS title, link,
             {_stamp('published_at')} AS published_at
      FROM f_articles WHERE article_id % 10 < 8)
WHERE title <> ''""")
_oracle("stream_score", *SCORED, body=f"SELECT {_RESULTS} FROM f_scored")
