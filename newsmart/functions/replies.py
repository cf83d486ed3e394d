"""Fields of stored model replies: the JSON object in a free text and its typed values.

A reply that holds no JSON object is NULL here and behaves like an empty object.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsmart.functions.binding import let
from newsmart.functions.text import SPACE, strip


def reply_object(text: Column) -> Column:
    """VARIANT object of a reply: the whole text, else the part from the first '{' to the last '}'."""
    fences = rf"(?md)^```(?:json)?[{SPACE}]*|[{SPACE}]*```$"
    bare = strip(F.regexp_replace(strip(text), fences, ""))

    def parse(bare: Column) -> Column:
        inner = F.try_parse_json(F.nullif(F.regexp_extract(bare, r"(?s)\{.*\}", 0), F.lit("")))
        return F.coalesce(F.try_parse_json(bare), inner)

    parsed = let(bare, parse)
    return let(parsed, lambda v: F.when(F.schema_of_variant(v).startswith("OBJECT"), v))


def _field(reply: Column, name: str) -> Column:
    return F.try_variant_get(reply, f"$.{name}", "variant")


def _kind(reply: Column, name: str) -> Column:
    """Type name of a field; NULL when the field is absent."""
    return F.schema_of_variant(_field(reply, name))


def _json(reply: Column, name: str) -> Column:
    return F.to_json(_field(reply, name))


def is_falsy(reply: Column, name: str) -> Column:
    """Null, false, zero, empty string, list or object. NULL when the field is absent."""
    text = _json(reply, name)
    zero = text.rlike(r"^-?0+(\.0+)?([eE].*)?$")
    return text.isin("null", "false", '""', "[]", "{}") | zero


def text_of(reply: Column, name: str) -> Column:
    """Text form of a field, NULL when absent: strings as they are, True/False/None for the constants."""
    kind = _kind(reply, name)
    raw = F.try_variant_get(reply, f"$.{name}", "string")
    return (
        F.when(kind == "STRING", raw)
        .when(kind == "VOID", "None")
        .when(kind == "BOOLEAN", F.initcap(raw))
        .otherwise(_json(reply, name))
    )


def text_or_empty(reply: Column, name: str) -> Column:
    """Text form of a field; '' when it is absent or falsy."""
    return F.when(F.coalesce(is_falsy(reply, name), F.lit(True)), "").otherwise(text_of(reply, name))


def keep_flag(reply: Column) -> Column:
    """Truthiness of ``keep``; an absent field keeps the article."""
    return F.coalesce(~is_falsy(reply, "keep"), F.lit(True))


def score_value(reply: Column) -> Column:
    """``ai_score`` as an integer in 0..100; 50 when it cannot be read as one.

    Numbers and booleans are truncated, strings must spell an integer.
    """
    kind = _kind(reply, "ai_score")
    number = F.try_variant_get(reply, "$.ai_score", "double")
    spelled = strip(F.try_variant_get(reply, "$.ai_score", "string"))
    integer = F.when(spelled.rlike(r"^[+-]?[0-9]+(_[0-9]+)*$"), F.replace(spelled, F.lit("_"), F.lit("")))
    value = F.when(kind == "STRING", integer.try_cast("double")).when(~F.isnan(number), number)
    clamped = F.greatest(F.lit(0.0), F.least(F.lit(100.0), value)).cast("int")
    return F.when(value.isNull(), 50).otherwise(clamped)


def stored_list(reply: Column, name: str) -> Column:
    """A field that should be a list, as it came: items in text form (NULL items stay), any other value as its only item."""
    items = F.try_variant_get(reply, f"$.{name}", "array<variant>")
    texts = F.transform(items, lambda item: F.coalesce(F.try_variant_get(item, "$", "string"), F.to_json(item)))
    texts = F.transform(texts, lambda text: F.nullif(text, F.lit("null")))
    single = F.array(text_of(reply, name))
    given = F.when(items.isNotNull(), texts).when(text_of(reply, name).isNotNull(), single)
    return F.coalesce(given, F.array().cast("array<string>"))


def string_list(reply: Column, name: str) -> Column:
    """A list field as strings; empty when it is absent or no list."""
    items = F.try_variant_get(reply, f"$.{name}", "array<string>")
    return F.coalesce(F.filter(items, lambda item: item.isNotNull()), F.array().cast("array<string>"))
