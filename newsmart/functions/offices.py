"""Office network: where the institution reading the news has offices, by country.

The institution's name (``owner``) and its offices are parameters; the name leads every office name.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Office:
    cc: str
    city: str
    type: str
    entity: str


# A sample network. A caller with offices of its own passes them to every function here.
OFFICES = (
    Office("GB", "런던", "지점", "런던지점"),
    Office("US", "뉴욕", "지점", "뉴욕지점"),
    Office("HK", "홍콩", "지점", "홍콩지점"),
    Office("CN", "베이징", "법인", "중국법인"),
    Office("JP", "도쿄", "지점", "도쿄지점"),
    Office("SG", "싱가포르", "지점", "싱가포르지점"),
    Office("IN", "구르구람", "지점", "구르구람지점"),
    Office("VN", "하노이", "법인", "베트남법인"),
    Office("MM", "양곤", "사무소", "양곤사무소"),
    Office("ID", "자카르타", "자회사", "인도네시아은행"),
    Office("KH", "프놈펜", "자회사", "캄보디아은행"),
)
# ---- Fixed values: the kind that counts as a subsidiary, and the text for countries without an office
SUBSIDIARY = "자회사"
NO_OFFICE = "글로벌 본점 관점(특정 거점 없음)"
# ---- End of fixed values -----------------------------------------------------------------------


def _named(owner: str, text: str) -> str:
    return f"{owner} {text}".strip()


def to_frame(spark: SparkSession, offices: Sequence[Office] = OFFICES, owner: str = "") -> DataFrame:
    rows = [(o.cc, o.city, o.type, _named(owner, o.entity), n) for n, o in enumerate(offices)]
    return spark.createDataFrame(rows, "cc string, city string, type string, entity string, ord int")


def context_for(cc: Column, offices: Sequence[Office] = OFFICES, owner: str = "") -> Column:
    """One sentence about the office of a country; unknown or missing countries get the head office.

    The network is a handful of constants, so it is a literal map inside the plan, not a join.
    """
    pairs = [F.lit(part) for o in offices
             for part in (o.cc, f"{_named(owner, o.entity)} — {o.city} 소재 {o.type}")]
    known = F.try_element_at(F.create_map(*pairs), F.upper(F.coalesce(cc, F.lit(""))))
    return F.coalesce(known, F.lit(_named(owner, NO_OFFICE)))


def all_context(offices: Sequence[Office] = OFFICES, owner: str = "") -> str:
    return "; ".join(f"{o.cc}={_named(owner, o.entity)}({o.type})" for o in offices)


def subsidiary_countries(offices: Sequence[Office] = OFFICES) -> list[str]:
    return [o.cc for o in offices if o.type == SUBSIDIARY]
