"""Language identification by rank-order profiles of n-grams.

A profile is the list of the most frequent letter n-grams (one to three, words padded with a space) in order of frequency. A
text's profile is compared with every language's by the out-of-place distance: for every n-gram of the text how many
places its rank differs, or the greatest difference if the language does not list it. The nearest language wins.

Profiles are learned from about ``sample`` texts of each language, chosen by a hash of the id; all learning is
aggregation, and what is sent to the tasks is ``places`` n-grams for each language.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsmart.llm.tables import annotate, small_batches
from newsmart.llm.toxicity import held_out


@dataclass(frozen=True)
class Profiles:
    """``places`` per profile, about ``sample`` texts per language, and at most ``languages``; more is an error."""

    places: int = 300
    sample: int = 3000
    languages: int = 500
    seed: int = 5


NO_LETTER = re.compile(r"[\W\d_]+")
UNKNOWN = "und"
SPACE = 32


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams (as numbers, ascending) of a text and how often each occurs; none without a letter."""
    letters = NO_LETTER.sub(" ", text.lower()).strip()
    if not any(map(str.isalpha, letters)):  # other numbers, like fractions, are left but are no letters
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    codes = np.frombuffer(f" {letters} ".encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    pairs = (codes[:-1] << 21) | codes[1:]
    triples = (pairs[:-1] << 21) | codes[2:]
    found = np.concatenate([codes[codes != SPACE], pairs, triples[codes[1:-1] != SPACE]])
    found.sort()
    first = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
    return found[first], np.diff(np.append(first, len(found)))


def _ranked(values: np.ndarray, times: np.ndarray, places: int) -> np.ndarray:
    """The most frequent n-grams in order, equally frequent ones by number."""
    return values[np.argsort(-times, kind="stable")[:places]]


def learn(docs: DataFrame, settings: Profiles = Profiles()) -> dict[str, list[int]]:  # noqa: B008
    """Profiles by language from ``docs`` (doc_id, text, lang); rows with a NULL lang or doc_id teach nothing."""
    small_batches(docs.sparkSession)
    given = docs.where("lang is not null and doc_id is not null")
    sizes = given.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(settings.languages + 1).collect()
    if len(sizes) > settings.languages:
        raise ValueError("there are more languages than profiles may be broadcast: raise the bound")
    if not sizes:
        return {}
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], min(1.0, settings.sample / r["count"]))])
    place = F.pmod(F.xxhash64("doc_id", F.lit(settings.seed)), F.lit(1 << 20)) / float(1 << 20)
    chosen = given.where(place < F.coalesce(share[F.col("lang")], F.lit(0.0))).select("lang", "text")

    def count(batches):
        for batch in batches:
            by_lang: dict[str, list] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                by_lang.setdefault(lang, []).append(grams(text.as_py() or ""))
            for lang, found in by_lang.items():
                values, inverse = np.unique(np.concatenate([v for v, _ in found]), return_inverse=True)
                times = np.bincount(inverse, np.concatenate([n for _, n in found]), len(values)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(values), pa.string()), pa.array(values), pa.array(times)], ["lang", "gram", "n"]
                )

    counted = chosen.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    listed = counted.withColumn("place", F.row_number().over(order)).where(F.col("place") <= settings.places)
    profiles: dict[str, list[int]] = {r["lang"]: [] for r in sizes}
    for row in sorted(listed.collect(), key=lambda r: (r["lang"], r["place"])):
        profiles[row["lang"]].append(row["gram"])
    return {lang: listed for lang, listed in sorted(profiles.items()) if listed}


class Distances:
    """Out-of-place distances of texts to the profiles."""

    def __init__(self, profiles: dict[str, list[int]], places: int):
        self.langs, self.places = list(profiles), places
        self.values = np.unique(np.array([g for p in profiles.values() for g in p], np.int64))
        self.ranks = np.full((len(self.values) + 1, len(self.langs)), -1, np.int64)
        for n, profile in enumerate(profiles.values()):
            self.ranks[np.searchsorted(self.values, profile), n] = np.arange(len(profile))

    def nearest(self, text: str) -> tuple[str, float]:
        """The language at the least distance (the first by name of equals) and how much nearer it is than the second."""
        values, times = grams(text)
        if not len(values) or not self.langs:
            return UNKNOWN, 0.0
        own = _ranked(values, times, self.places)
        at = np.searchsorted(self.values, own)
        at[(at < len(self.values)) & (self.values[np.minimum(at, len(self.values) - 1)] != own)] = len(self.values)
        ranks = self.ranks[at]
        away = np.where(ranks < 0, self.places, np.abs(ranks - np.arange(len(own))[:, None])).sum(axis=0)
        best = int(away.argmin())
        others = np.delete(away, best)
        rival = others.min() if len(others) else len(own) * self.places
        return self.langs[best], float(1 - away[best] / rival) if rival else 0.0


def identify(docs: DataFrame, profiles: dict[str, list[int]], settings: Profiles = Profiles(), keep: list[str] | None = None) -> DataFrame:  # noqa: B008,E501
    """``docs`` as column ``row`` and in ``found`` lang_pred and score for every whole text.

    NULL texts and texts without a letter are ``und`` with score 0, and so is every text if nothing was learned. The score
    is 1 - distance / second distance: 0 for a tie. Rows are independent; repeated rows and extra columns change nothing.
    """

    def look(column: pa.Array) -> list[pa.Array]:
        distances = Distances(profiles, settings.places)
        found = [distances.nearest(text.as_py() or "") for text in column]
        return [pa.array([lang for lang, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())]

    return annotate(docs, look, "lang_pred string, score double", "text", keep)


def predicted(docs: DataFrame, settings: Profiles = Profiles()) -> DataFrame:  # noqa: B008
    """(doc_id, held_out, lang_pred, score) of every row; learned from the rows that are not held out."""
    profiles = learn(docs.where(~held_out(3, 1)), settings)
    found = identify(docs.select("doc_id", "text"), profiles, settings, ["doc_id"]).select("row.doc_id", "found.*")
    return found.select("doc_id", held_out(3, 1).alias("held_out"), "lang_pred", "score")
