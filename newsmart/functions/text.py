"""Text, time and identity functions as Column expressions.

Whitespace and word classes are spelled out so that every engine agrees on them: whitespace is the
Unicode set including the four ASCII separators, a word character is any letter, number or ``_``.
"""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from newsmart.functions.binding import let, let_both

_BLANKS = r"\t-\r\x1c-\x20"
_WIDE_BLANKS = r"\x{85}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
# A class of several ranges is a chain of calls for every character. One range before it, which holds all that it
# matches, ends the test for most characters; a class of single Latin-1 characters is one table.
_LISTED_BLANKS = r"\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20"
_ANY_WIDE_BLANK = rf"(?=[\x{{85}}-\x{{3000}}])[\x{{a0}}{_WIDE_BLANKS}]"
_BLANK_RUNS = rf"(?=[\t-\x20])(?:[{_LISTED_BLANKS}]{{2,}}|[{_LISTED_BLANKS[:-4]}])"
_NO_KEY = "(?![a-z])[^a-z0-9 ]"
SPACE = rf"{_BLANKS}\x{{a0}}{_WIDE_BLANKS}"
SPACE_CHARS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 " + "".join(
    map(chr, [*range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)
WORD = r"\p{L}\p{N}_"
UNIT_SEPARATOR = "\x1f"

# Entities decoded by plain replacement; "&amp;" comes last so nothing is decoded twice.
PLAIN_ENTITIES = {
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&apos;": "'",
    "&#39;": "'",
    "&nbsp;": " ",
    "&middot;": "·",
    "&copy;": "©",
    "&amp;": "&",
}
_PLAIN_NAMES = "|".join(name[1:-1] for name in PLAIN_ENTITIES)
_RARE_ENTITY = rf"&(?!(?:{_PLAIN_NAMES});)[#A-Za-z]"


@F.pandas_udf(StringType())
def _unescape(text: pd.Series) -> pd.Series:
    return text.map(html.unescape, na_action="ignore")


def decode_entities(text: Column) -> Column:
    """Decode HTML entities.

    The common entities are replaced inside the JVM. Only texts holding any other entity travel to
    the Arrow UDF; for all other rows it receives NULL.
    """
    rare = F.contains(text, F.lit("&")) & text.rlike(_RARE_ENTITY)

    def choose(text: Column, unescaped: Column) -> Column:
        plain = text
        for entity, char in PLAIN_ENTITIES.items():
            plain = F.replace(plain, F.lit(entity), F.lit(char))
        return (
            F.when(unescaped.isNotNull(), unescaped).when(F.contains(text, F.lit("&")), plain).otherwise(text)
        )

    return let_both(text, _unescape(F.when(rare, text)), choose)


def strip(text: Column) -> Column:
    """Remove leading and trailing Unicode whitespace."""
    return F.trim(text, F.lit(SPACE_CHARS))


def _drop_tags(text: Column) -> Column:
    return let(
        text, lambda t: F.when(F.contains(t, F.lit("<")), F.regexp_replace(t, "<[^>]+>", " ")).otherwise(t)
    )


def strip_html(text: Column) -> Column:
    """Plain text of a feed summary: entities, then tags, then runs of blanks."""
    plain = _drop_tags(decode_entities(F.coalesce(text, F.lit(""))))
    return strip(F.regexp_replace(plain, r"[ \x{a0}]{2,}", " "))


TAIL_WINDOW = 256


def _drop_tails(text: Column, space: str) -> Column:
    """Drop a publisher name after a dash, then one after a wide gap.

    Both tails need the text to end in a word character or blank; other texts skip the scans. In a
    text without long blank runs near its end both tails lie inside the last ``TAIL_WINDOW``
    characters (a tail is at most 62 characters plus its blanks), so only that window is scanned.
    """
    dashed = rf"(?d)[{space}]+-[{space}]+[A-Za-z][{WORD}{space}]{{1,60}}$"
    spaced = rf"(?d)[{space}]{{2,}}[A-Z][A-Za-z][{WORD}{space}]{{1,60}}$"
    open_end = rf"(?d)[{WORD}{SPACE}]$"

    def drop(part: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(part, dashed, ""), spaced, "")

    def choose(text: Column, window: Column) -> Column:
        size = F.char_length(text)
        inside = (size > TAIL_WINDOW) & ~window.rlike(rf"^[{space}]|[{space}]{{30}}")
        short = F.concat(F.left(text, size - TAIL_WINDOW), drop(window))
        return F.when(~window.rlike(open_end), text).when(inside, short).otherwise(drop(text))

    return let(text, lambda t: let_both(t, F.right(t, F.lit(TAIL_WINDOW)), choose))


def _untagged(text: Column) -> Column:
    plain = _drop_tags(decode_entities(F.coalesce(text, F.lit(""))))
    return F.regexp_replace(plain, r"\x{a0}+", " ")


def clean_text(text: Column) -> Column:
    """Entities and tags removed, publisher tail dropped, outer whitespace stripped."""
    return strip(_drop_tails(_untagged(text), SPACE))


def normalize(text: Column) -> Column:
    """Lower case with every whitespace run reduced to one blank."""
    return F.regexp_replace(F.lower(text), rf"[{SPACE}]+", " ")


def scoring_text(text: Column) -> Column:
    """``normalize(clean_text(text))`` with fewer passes over wide character classes.

    Rare Unicode blanks become plain ones first, which changes nothing after normalisation, so the
    later patterns only test ASCII blanks; single blanks are left in place.
    """
    plain = _drop_tags(decode_entities(F.coalesce(text, F.lit(""))))

    def narrow(t: Column) -> Column:
        narrowed = F.regexp_replace(F.regexp_replace(t, r"\x{a0}+", " "), f"[{_WIDE_BLANKS}]", " ")
        return F.when(F.octet_length(t) == F.char_length(t), t).when(t.rlike(_ANY_WIDE_BLANK), narrowed).otherwise(t)

    cleaned = F.trim(_drop_tails(let(plain, narrow), _BLANKS), F.lit("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "))
    return F.regexp_replace(F.lower(cleaned), _BLANK_RUNS, " ")


def content_hash(title: Column, link: Column) -> Column:
    """Natural key of an article: SHA-256 over the untruncated title and link."""
    return F.sha2(F.concat(title, F.lit(UNIT_SEPARATOR), link), 256)


def title_key(title: Column) -> Column:
    """Title as it is compared: ASCII letters, digits and blanks only."""
    return F.trim(F.regexp_replace(F.lower(title), _NO_KEY, ""))


def article_time(published: Column, fetched: Column) -> Column:
    """Event time: publication, or the fetch time when it is missing."""
    return F.coalesce(published, fetched)


def kst_day(published: Column, fetched: Column) -> Column:
    """Calendar day in Korea (UTC+9, no daylight saving)."""
    return F.to_date(article_time(published, fetched) + F.expr("INTERVAL 9 HOURS"))


def utc_day(published: Column) -> Column:
    """First ten characters of the UTC timestamp, '' when missing."""
    return F.coalesce(F.date_format(published, "yyyy-MM-dd"), F.lit(""))


# Offsets of the zone names a mail-style date may carry.
ZONE_OFFSETS = {
    "UT": "+0000",
    "UTC": "+0000",
    "GMT": "+0000",
    "Z": "+0000",
    "EST": "-0500",
    "EDT": "-0400",
    "CST": "-0600",
    "CDT": "-0500",
    "MST": "-0700",
    "MDT": "-0600",
    "PST": "-0800",
    "PDT": "-0700",
}
_MAIL_DATE = (
    r"(?i)^\s*(?:[a-z]{3,9}\s*,?\s+)?(\d{1,2})[\s-]+([a-z]{3})[a-z]*[\s-]+(\d{4}|\d{2})"
    r"\s+(\d{1,2}):(\d{2})(?::(\d{2}))?\s*([+-]\d{4}|[a-z]{1,5})?\s*$"
)
_ISO_DATE = r"^\s*\d{4}(-\d{2}){0,2}([T ]\d{2}:\d{2}.*)?\s*$"


def _mail_time(text: Column) -> Column:
    parts = F.split(F.regexp_replace(text, _MAIL_DATE, "$1|$2|$3|$4|$5|$6|$7"), r"\|", -1)

    def canonical(part: Column) -> Column:
        year, zone = part[2], F.upper(part[6])
        offset = F.when(zone.rlike("^[+-]"), zone)
        for name, value in ZONE_OFFSETS.items():
            offset = offset.when(zone == name, value)
        century = F.when(F.length(year) == 4, "").when(year < "69", "20").otherwise("19")
        return F.concat(
            F.lpad(part[0], 2, "0"), F.lit(" "), F.initcap(part[1]), F.lit(" "), century, year, F.lit(" "),
            F.lpad(part[3], 2, "0"), F.lit(":"), part[4], F.lit(":"), F.when(part[5] == "", "00").otherwise(part[5]),
            F.lit(" "), offset.otherwise(F.lit("+0000")),
        )

    date = F.when(text.rlike(_MAIL_DATE), let(parts, canonical))
    return F.try_to_timestamp(date, F.lit("dd MMM yyyy HH:mm:ss Z"))


def feed_time(text: Column) -> Column:
    """Timestamp of a feed date in mail style or ISO 8601; NULL when it is neither."""
    iso = F.when(text.rlike(_ISO_DATE), F.trim(text).try_cast("timestamp"))
    return F.coalesce(_mail_time(text), iso)


def parse_published(published: Column, updated: Column, fetched: Column) -> Column:
    """Publication time of an entry: published, else updated, else the fetch time."""
    return F.coalesce(feed_time(published), feed_time(updated), fetched)


def csv_encode(items: Column) -> Column:
    return F.array_join(items, ",")


def csv_decode(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), ","), lambda item: item != "")


def percent(part: Column, whole: Column) -> Column:
    """One-decimal percentage, '-' when there is nothing to divide by."""
    return F.when(F.coalesce(whole, F.lit(0)) == 0, "-").otherwise(
        F.format_string("%.1f%%", part / whole * F.lit(100.0))
    )


def or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))
