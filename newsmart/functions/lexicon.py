"""Ordered keyword lists and their matching.

A keyword made of ``[a-z0-9 ]`` only matches between characters outside ``[a-z0-9]``; any other
keyword matches as a plain substring. All boundary keywords of a vocabulary are found in ONE regex
pass over the text: a look-ahead captures the longest keyword after each separator, and the shorter
keywords it begins with are added from a small constant map. List order is applied on the few hits
through a constant map from keyword to list and position, so neither the text nor a list is scanned
again per list.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_BOUNDARY_KEYWORD = re.compile(r"[a-z0-9 ]+")
_LISTED_WORD = "abcdefghijklmnopqrstuvwxyz0123456789"


def quoted(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def text_array(texts: Iterable[str]) -> Column:
    """Constant array of strings, built as one expression however long the list is."""
    return F.expr(f"array({', '.join(map(quoted, texts))})")


def country_array(numbered: Iterable[tuple[str, int]]) -> Column:
    """Constant array of (cc, number of its list) in list order."""
    structs = (f"named_struct('cc', {quoted(cc)}, 'number', {number})" for cc, number in numbered)
    return F.expr(f"array({', '.join(structs)})")


def has_boundaries(keyword: str) -> bool:
    return _BOUNDARY_KEYWORD.fullmatch(keyword) is not None


def match_kind(keyword: str) -> str:
    return "token" if has_boundaries(keyword) else "substring"


def _unique(keywords: Iterable[str]) -> list[str]:
    return list(dict.fromkeys(keywords))


def _scan_pattern(keywords: Sequence[str]) -> str:
    by_first = defaultdict(list)
    for keyword in keywords:
        by_first[keyword[0]].append(keyword[1:])
    branches = []
    for first in sorted(by_first):
        tails = sorted(by_first[first], key=lambda tail: (-len(tail), tail))
        branches.append(f"{first}(?:{'|'.join(tails)})")
    # Most characters are letters: one range rules them out before the class, which is one table for single Latin-1 characters,
    # is tested; and first letters are tested before any keyword.
    return f"(?![a-z])[^{_LISTED_WORD}](?=[{''.join(sorted(by_first))}])(?=({'|'.join(branches)})(?![a-z0-9]))"


def _contained_starts(keywords: Sequence[str]) -> dict[str, list[str]]:
    """Keywords that necessarily match wherever a longer keyword matches, at the same start."""
    known = set(keywords)
    starts = {}
    for keyword in keywords:
        shorter = [keyword[:n] for n in range(1, len(keyword)) if keyword[n] == " " and keyword[:n] in known]
        if shorter:
            starts[keyword] = shorter
    return starts


def _boundary_hits(text: Column, keywords: Sequence[str]) -> Column:
    found = F.regexp_extract_all(F.concat(F.lit(" "), text), F.lit(_scan_pattern(keywords)), F.lit(1))
    starts = _contained_starts(keywords)
    if not starts:
        return found
    pairs = (f"{quoted(key)}, array({', '.join(map(quoted, [key, *shorter]))})" for key, shorter in starts.items())
    all_of = F.expr(f"map({', '.join(pairs)})")
    return F.flatten(F.transform(found, lambda hit: F.coalesce(F.try_element_at(all_of, hit), F.array(hit))))


def phrase_hits(text: Column, keywords: Iterable[str]) -> Column:
    """Those keywords without word boundaries that ``text`` contains."""
    phrases = [keyword for keyword in _unique(keywords) if not has_boundaries(keyword)]
    if not phrases:
        return F.expr("cast(array() as array<string>)")
    return F.filter(text_array(phrases), lambda phrase: F.contains(text, phrase))


def token_hits(text: Column, keywords: Iterable[str]) -> Column:
    """Those keywords with word boundaries that match ``text``, possibly repeated."""
    tokens = [keyword for keyword in _unique(keywords) if has_boundaries(keyword)]
    return _boundary_hits(text, tokens) if tokens else F.expr("cast(array() as array<string>)")


def seam_hits(before: Column, after: Column, keywords: Iterable[str]) -> Column:
    """Those keywords with word boundaries and a blank that match ``before``, a blank and ``after`` across that blank.

    Keywords inside one of the texts may be among them. Only the ends that a keyword can reach are scanned: one character more
    than the longest keyword has, without the word that the cut may have divided.
    """
    phrases = [keyword for keyword in _unique(keywords) if has_boundaries(keyword) and " " in keyword]
    if not phrases:
        return F.expr("cast(array() as array<string>)")
    reach = F.lit(max(map(len, phrases)) + 1)

    def end(text: Column, part: Column, divided: str) -> Column:
        return F.when(F.char_length(text) > reach, F.regexp_replace(part, divided, "")).otherwise(text)

    tail, head = end(before, F.right(before, reach), r"^[a-z0-9]+"), end(after, F.left(after, reach), r"[a-z0-9]+\z")
    return token_hits(F.concat(tail, F.lit(" "), head), phrases)


def hits(text: Column, keywords: Iterable[str]) -> Column:
    """Keywords of the vocabulary that match ``text``, unordered and possibly repeated."""
    vocabulary = _unique(keywords)
    return F.concat(token_hits(text, vocabulary), phrase_hits(text, vocabulary))


class Lists:
    """Numbered keyword lists behind one constant map from keyword to its places.

    A place is an int: the number of a list and the position in it. Lists are looked up by the few hits of a text, so the
    work per row does not grow with the lists.
    """

    _WIDTH = 16

    def __init__(self) -> None:
        self._lists: list[list[str]] = []
        self._places: dict[str, list[int]] = defaultdict(list)

    def add(self, keywords: Iterable[str]) -> int:
        """Number of a new list."""
        unique = _unique(keywords)
        if len(unique) >= 1 << self._WIDTH:
            raise ValueError(f"a list has {len(unique)} keywords, {(1 << self._WIDTH) - 1} at most can be numbered")
        number = len(self._lists)
        for position, keyword in enumerate(unique):
            self._places[keyword].append((number << self._WIDTH) + position)
        self._lists.append(unique)
        return number

    def places(self, found: Column) -> Column:
        """Places of the keywords found, on every list that has them; NULL where ``found`` is."""
        none = F.expr("cast(array() as array<int>)")
        if not self._places:
            return F.when(found.isNotNull(), none)
        pairs = (f"{quoted(key)}, array({', '.join(map(str, places))})" for key, places in self._places.items())
        known = F.expr(f"map({', '.join(pairs)})")
        return F.flatten(F.transform(F.array_distinct(found), lambda hit: F.coalesce(F.try_element_at(known, hit), none)))

    def first(self, places: Column, number: int) -> Column:
        """First keyword of a list, in list order, among the places; else NULL."""
        if not self._lists[number]:
            return F.lit(None).cast("string")
        low = number << self._WIDTH
        own = F.filter(places, lambda place: place.between(low, low + len(self._lists[number]) - 1))
        return F.get(text_array(self._lists[number]), F.array_min(own) - low)

    def numbers(self, places: Column) -> Column:
        """Numbers of the lists that have any of the places."""
        return F.array_distinct(F.transform(places, lambda place: F.shiftright(place, self._WIDTH)))


@dataclass(frozen=True)
class LanguageLists:
    """Own lists of a language that is not scored with the main list."""

    finance: tuple[str, ...]
    countries: tuple[tuple[str, tuple[str, ...]], ...]


@dataclass(frozen=True)
class Lexicon:
    """All keyword lists of one scoring run; every list is ordered."""

    finance: tuple[str, ...]
    countries: tuple[tuple[str, tuple[str, ...]], ...]
    exclusion: tuple[str, ...]
    own: dict[str, LanguageLists] = field(default_factory=dict)
    extra: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def rows(self) -> list[tuple]:
        """Relational form: (list, seq, keyword, country, country_seq, match_kind)."""
        out: list[tuple] = []

        def add(name: str, keywords: Iterable[str], country=None, country_seq=None) -> None:
            for seq, keyword in enumerate(_unique(keywords)):
                out.append((name, seq, keyword, country, country_seq, match_kind(keyword)))

        add("finance", self.finance)
        add("exclusion", self.exclusion)
        for seq, (country, keywords) in enumerate(self.countries):
            add("country", keywords, country, seq)
        for language, lists in self.own.items():
            add(f"own:{language}", lists.finance)
            for seq, (country, keywords) in enumerate(lists.countries):
                add(f"own_country:{language}", keywords, country, seq)
        for language, keywords in self.extra.items():
            add(f"extra:{language}", keywords)
        return out

    def to_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            self.rows(),
            "list string, seq int, keyword string, country string, country_seq int, match_kind string",
        )

    @classmethod
    def from_rows(cls, rows: Iterable) -> "Lexicon":
        """Inverse of :meth:`rows`; ``rows`` are tuples or Rows in that column order."""
        flat: dict[str, list[tuple[int, str]]] = defaultdict(list)
        nested: dict[str, dict[tuple[int, str], list[tuple[int, str]]]] = defaultdict(lambda: defaultdict(list))
        for name, seq, keyword, country, country_seq, _kind in rows:
            if country is None:
                flat[name].append((seq, keyword))
            else:
                nested[name][(country_seq, country)].append((seq, keyword))

        def ordered(pairs) -> tuple[str, ...]:
            return tuple(keyword for _, keyword in sorted(pairs))

        def by_country(name: str):
            return tuple((cc, ordered(pairs)) for (_, cc), pairs in sorted(nested[name].items()))

        own = {
            name.split(":", 1)[1]: LanguageLists(
                ordered(pairs), by_country("own_country:" + name.split(":", 1)[1])
            )
            for name, pairs in flat.items()
            if name.startswith("own:")
        }
        extra = {
            name.split(":", 1)[1]: ordered(pairs) for name, pairs in flat.items() if name.startswith("extra:")
        }
        return cls(ordered(flat["finance"]), by_country("country"), ordered(flat["exclusion"]), own, extra)
