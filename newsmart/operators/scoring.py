"""Keyword relevance filter: title and body scored against ordered keyword lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmart.config import WEIGHTS, Weights
from newsmart.functions import text as X
from newsmart.functions.lexicon import (
    Lexicon, Lists, country_array, has_boundaries, hits, phrase_hits, seam_hits, token_hits,
)
from newsmart.session import Counters, counted

RESULT_COLUMNS = ("article_id", "filter_stage", "filter_decision", "filter_reason", "filter_score")


def _country_keywords(countries) -> list[str]:
    return [keyword for _, keywords in countries for keyword in keywords]


def _by_language(language: Column, cases: dict, default: Column) -> Column:
    chosen = reduce(lambda acc, item: acc.when(language == item[0], item[1]), cases.items(), F)
    return chosen.otherwise(default) if cases else default


def _text_hits(text: Column, language: Column, lexicon: Lexicon) -> Column:
    """Keywords found in a text, for any list that its language may ask for, and exclusions with word boundaries.

    All languages without lists of their own share one scan: a word of another language's additional
    list is found too, but no list of this language looks it up.
    """
    shared = [*lexicon.finance, *_country_keywords(lexicon.countries)]
    additional = [keyword for keywords in lexicon.extra.values() for keyword in keywords]
    excluding = [keyword for keyword in lexicon.exclusion if has_boundaries(keyword)]
    none = F.expr("cast(array() as array<string>)")
    phrases = {code: phrase_hits(text, keywords) for code, keywords in lexicon.extra.items()}
    found = F.concat(
        token_hits(text, [*shared, *additional, *excluding]), phrase_hits(text, shared), _by_language(language, phrases, none)
    )
    own = {
        code: hits(text, [*lists.finance, *_country_keywords(lists.countries), *excluding])
        for code, lists in lexicon.own.items()
    }
    return _by_language(language, own, found)


def _country_places(numbered, in_title: Column, in_body: Column) -> Column:
    """Countries found, in list order, each with the place ('title' before 'body') it was found in.

    ``numbered`` pairs each country with the number of its list; the columns hold the numbers of the lists found.
    """
    if not numbered:
        return F.expr("cast(array() as array<struct<cc: string, place: string>>)")

    def place(country: Column) -> Column:
        found = F.when(F.array_contains(in_title, country["number"]), "title").when(
            F.array_contains(in_body, country["number"]), "body"
        )
        return F.struct(country["cc"].alias("cc"), found.alias("place"))

    return F.filter(F.transform(country_array(numbered), place), lambda country: country["place"].isNotNull())


def _list_result(in_title: Column, in_body: Column, label: str, weights: Weights) -> Column:
    """Struct (points, reason, in_title) of one finance list; the body counts only if the title missed."""
    points = (
        F.when(in_title.isNotNull(), weights.title_finance)
        .when(in_body.isNotNull(), weights.body_finance)
        .otherwise(0)
    )
    reason = F.coalesce(
        F.concat(F.lit(f"{label}_title:"), in_title), F.concat(F.lit(f"{label}_body:"), in_body)
    )
    return F.struct(points.alias("points"), reason.alias("reason"), in_title.isNotNull().alias("in_title"))


def score_text(df: DataFrame, lexicon: Lexicon, weights: Weights = WEIGHTS, skip: Column | None = None) -> DataFrame:
    """Add ``decision``, ``reason`` and ``score`` to rows holding ``title``, ``summary`` and ``language``.

    Row-local and free of shuffles. ``skip`` marks rows whose text need not be looked at; their
    result is meaningless. Intermediate columns live in separate projections so that each text is
    cleaned and scanned once.
    """
    skip = F.lit(False) if skip is None else skip
    language = F.coalesce(F.nullif(F.col("language"), F.lit("")), F.lit("en"))
    carried = df.columns

    def cleaned(name: str) -> Column:
        return F.when(~skip, X.scoring_text(F.col(name)))

    texts = df.select(
        *carried, language.alias("_language"), cleaned("title").alias("_title"), cleaned("summary").alias("_body")
    )
    # Exclusions are looked for in title, blank and body as one text: words in the scans of both, only phrases across the blank.
    full = F.concat_ws(" ", "_title", "_body")
    across = F.concat(
        seam_hits(F.col("_title"), F.col("_body"), lexicon.exclusion), phrase_hits(full, lexicon.exclusion)
    )
    lists, excluding = Lists(), Lists()
    exclusion = excluding.add(lexicon.exclusion)
    main_list = lists.add(lexicon.finance)
    own_list = {code: lists.add(own.finance) for code, own in lexicon.own.items()}
    extra_list = {code: lists.add(keywords) for code, keywords in lexicon.extra.items()}

    def numbered(countries) -> list[tuple[str, int]]:
        return [(cc, lists.add(keywords)) for cc, keywords in countries]

    countries, own_countries = numbered(lexicon.countries), {c: numbered(own.countries) for c, own in lexicon.own.items()}
    scanned = texts.select(
        *carried,
        "_language",
        _text_hits(F.col("_title"), F.col("_language"), lexicon).alias("_title_hits"),
        _text_hits(F.col("_body"), F.col("_language"), lexicon).alias("_body_hits"),
        F.when(F.col("_title").isNotNull(), across).alias("_across"),
    )
    placed = scanned.select(
        *carried,
        "_language",
        lists.places(F.col("_title_hits")).alias("_in_title"),
        lists.places(F.col("_body_hits")).alias("_in_body"),
        excluding.places(F.concat("_title_hits", "_body_hits", "_across")).alias("_excluding"),
    )
    in_title, in_body = F.col("_in_title"), F.col("_in_body")
    found = placed.select(
        "*", lists.numbers(in_title).alias("_title_lists"), lists.numbers(in_body).alias("_body_lists")
    )
    spoken = F.col("_language")

    def finance(label: str, number: int) -> Column:
        return _list_result(lists.first(in_title, number), lists.first(in_body, number), label, weights)

    def placed_countries(pairs) -> Column:
        return _country_places(pairs, F.col("_title_lists"), F.col("_body_lists"))

    main = {code: finance(f"{code}_fin", number) for code, number in own_list.items()}
    extra = {code: finance(f"{code}_fin", number) for code, number in extra_list.items()}
    nothing = F.struct(
        F.lit(0).alias("points"), F.lit(None).cast("string").alias("reason"), F.lit(False).alias("in_title")
    )
    places = {code: placed_countries(pairs) for code, pairs in own_countries.items()}
    matched = found.select(
        *carried,
        excluding.first(F.col("_excluding"), exclusion).alias("_excluded"),
        _by_language(spoken, main, finance("fin", main_list)).alias("_main"),
        _by_language(spoken, extra, nothing).alias("_extra"),
        _by_language(spoken, places, placed_countries(countries)).alias("_places"),
    )
    titled = F.size(F.filter("_places", lambda country: country["place"] == "title"))
    score = (
        F.when(F.col("_excluded").isNotNull(), weights.exclusion).otherwise(0)
        + F.col("_main.points")
        + F.col("_extra.points")
        + titled * weights.title_country
        + (F.size("_places") - titled) * weights.body_country
    )
    first_country = F.get(F.col("_places"), F.lit(0))
    totals = matched.select(
        *carried,
        "_excluded",
        score.cast("int").alias("score"),
        F.coalesce(
            F.col("_main.reason"),
            F.col("_extra.reason"),
            F.concat(F.lit("country_"), first_country["place"], F.lit(":"), first_country["cc"]),
        ).alias("_reason"),
        F.when(F.col("_main.in_title"), weights.pass_mark).otherwise(weights.body_only_pass_mark).alias("_mark"),
    )
    passed = F.col("score") >= F.col("_mark")
    reason = (
        F.when(passed, F.coalesce("_reason", F.lit("passed")))
        .when(
            F.col("_excluded").isNotNull(),
            F.concat(F.lit("excl:"), "_excluded", F.lit("(score:"), F.col("score"), F.lit(")")),
        )
        .otherwise(F.concat(F.lit("score:"), F.col("score"), F.lit("|"), F.coalesce("_reason", F.lit("no_match"))))
    )
    return totals.select(
        *carried, F.when(passed, "passed").otherwise("rejected").alias("decision"), reason.alias("reason"), "score"
    )


def score_articles(
    articles: DataFrame,
    sources: DataFrame,
    lexicon: Lexicon,
    refilter_all: bool = False,
    weights: Weights = WEIGHTS,
    counters: Counters | None = None,
) -> DataFrame:
    """Filter results of the pending articles (all of them with ``refilter_all``).

    Only the five needed columns are read. The source side is a plain equi-join: Spark broadcasts it
    when its measured size is small and otherwise sorts both sides with skew handling.
    """
    if not refilter_all and "filter_decision" in articles.columns:
        articles = articles.filter(F.col("filter_decision") == "pending")
    own_language = "language" in articles.columns
    wanted = ["article_id", "source_id", "title", "summary", *(["language"] if own_language else [])]
    dimension = sources.select("source_id", "tier", *([] if own_language else ["language"]))
    rows = articles.select(*wanted).join(dimension, "source_id")
    official = F.coalesce(F.col("tier") == 0, F.lit(False))
    scored = score_text(rows, lexicon, weights, skip=official)
    results = scored.select(
        "article_id",
        F.when(official, 1).otherwise(2).alias("filter_stage"),
        F.when(official, "passed").otherwise(F.col("decision")).alias("filter_decision"),
        F.when(official, "official_source").otherwise(F.col("reason")).alias("filter_reason"),
        F.when(official, weights.official).otherwise(F.col("score")).alias("filter_score"),
    )
    decision = F.col("filter_decision")
    return counted(
        results, "filter", counters, total=F.count(F.lit(1)), passed=F.count_if(decision == "passed"),
        rejected=F.count_if(decision == "rejected"),
    )
