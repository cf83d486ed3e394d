"""Topic taxonomy: codes, labels, screen keys and seed words."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmart.config import LIMITS
from newsmart.functions.binding import let
from newsmart.functions.lexicon import hits
from newsmart.functions.text import strip


@dataclass(frozen=True)
class Topic:
    code: str
    ui: str | None
    label_ko: str
    label_en: str
    seeds: tuple[str, ...]


# ---- Fixed values: the published taxonomy, in order --------------------------------------------
TOPICS = (
    Topic("MARKET", "finance", "시장·경제", "Market·Economy",
          ("interest rate", "exchange rate", "bond", "yield", "gdp", "inflation", "monetary policy",
           "central bank", "fx", "treasury", "rate hike", "rate cut")),
    Topic("BANKING", "finance", "금융산업", "Banking",
          ("bank", "banking", "lending", "loan", "deposit", "npl", "capital ratio", "basel",
           "net interest margin", "syndicated loan", "microfinance")),
    Topic("DIGITAL", "digital", "디지털", "Digital",
          ("fintech", "digital banking", "payment", "mobile banking", "upi", "wallet", "blockchain",
           "ai", "super app", "open banking")),
    Topic("ESG", "esg", "ESG", "ESG",
          ("esg", "sustainable finance", "green bond", "carbon", "net zero", "climate",
           "supply chain due diligence", "transition finance")),
    Topic("RISK", "risk", "규제·리스크", "Regulation·Risk",
          ("regulation", "supervision", "compliance", "sanction", "fine", "fraud", "default",
           "money laundering", "aml", "stress test", "bank failure")),
)
# ---- End of fixed values -----------------------------------------------------------------------


def codes(topics: Sequence[Topic] = TOPICS) -> list[str]:
    return [topic.code for topic in topics]


def to_frame(spark: SparkSession, topics: Sequence[Topic] = TOPICS) -> DataFrame:
    rows = [(n, t.code, t.ui, t.label_ko, t.label_en, list(t.seeds)) for n, t in enumerate(topics)]
    return spark.createDataFrame(
        rows, "seq int, code string, ui string, label_ko string, label_en string, seeds array<string>"
    )


def validate(given: Column, topics: Sequence[Topic] = TOPICS, limit: int = LIMITS.topics) -> Column:
    """Known codes, upper-cased, without repeats, in the given order, at most ``limit``."""
    upper = F.transform(given, lambda code: F.upper(strip(code)))
    known = F.filter(upper, lambda code: code.isin(codes(topics)))
    return F.slice(F.array_distinct(known), 1, limit)


def seed_topics(text: Column, topics: Sequence[Topic] = TOPICS, limit: int = LIMITS.topics) -> Column:
    """Codes of the topics with a seed word in the text, in taxonomy order, at most ``limit``."""
    seeds = [seed.lower() for topic in topics for seed in topic.seeds]
    listed = F.array(
        *[F.struct(F.lit(t.code).alias("code"), F.lit([s.lower() for s in t.seeds]).alias("seeds")) for t in topics]
    )

    def pick(found: Column) -> Column:
        matched = F.filter(listed, lambda topic: F.arrays_overlap(topic["seeds"], found))
        return F.slice(F.transform(matched, lambda topic: topic["code"]), 1, limit)

    return let(hits(F.lower(text), seeds), pick)


def _lookup(code: Column, values: dict[str, str], default: Column) -> Column:
    if not values:
        return default
    pairs = [F.lit(part) for pair in values.items() for part in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), code), default)


def ui_key(code: Column, topics: Sequence[Topic] = TOPICS) -> Column:
    """Screen key of a code; an unknown code or a topic without key gives the lower-cased code."""
    return _lookup(code, {topic.code: topic.ui for topic in topics if topic.ui}, F.lower(code))


def ui_string(given: Column, topics: Sequence[Topic] = TOPICS) -> Column:
    """Distinct screen keys of the codes, in order, joined by blanks."""
    return F.array_join(F.array_distinct(F.transform(given, lambda code: ui_key(code, topics))), " ")


def label(code: Column, language: str = "ko", topics: Sequence[Topic] = TOPICS) -> Column:
    values = {topic.code: {"ko": topic.label_ko, "en": topic.label_en}.get(language) for topic in topics}
    return _lookup(code, {k: v for k, v in values.items() if v}, code)


def prompt_reference(topics: Sequence[Topic] = TOPICS) -> str:
    """Topic block of a rank request: code, Korean label and the first six seeds."""
    return "\n".join(f"- {t.code} ({t.label_ko}): {', '.join(t.seeds[:6])}" for t in topics)
