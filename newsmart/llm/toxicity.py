"""Toxicity by gradient-boosted trees over dense features of a text, with isotonic calibration.

Learning uses a bounded sample of labelled rows (a documented parameter), dealt by a hash of the id: seven tenths give the
lexicon (words and word beginnings that occur far more often in toxic texts, by a likelihood-ratio test), the
others, which the lexicon has not seen, grow the trees and fit the calibration. Only the text feeds a score. Scoring is row-local: one pass over the texts, nothing is shuffled.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmart.llm.tables import annotate, small_batches, stage, worker_state


@dataclass(frozen=True)
class Toxicity:
    """``sample`` bounds the labelled rows that are learned from; ``threshold`` makes a score a rejection. A lexicon entry
    needs a likelihood ratio statistic of ``evidence`` and ``odds`` times the share of toxic texts; at most ``entries`` are
    kept, the strongest first. ``near`` is how many words away a second person counts as near a lexicon word."""

    sample: int = 24_000
    threshold: float = 0.3
    evidence: float = 20.0
    odds: float = 6.0
    entries: int = 20_000
    beginnings: tuple[int, ...] = (4, 5, 6, 7, 8)
    near: int = 6
    trees: int = 20
    depth: int = 3
    seed: int = 11


TOKEN = re.compile(r"[^\W_]+(?:[@$!*0-9.'-]*[^\W_]+)*")
DISGUISED = re.compile(r"[^\W\d_][@$!*0-9.'-]+[^\W\d_]")
DRAWN_OUT = re.compile(r"([^\W\d_])\1\1")
#: Signs that stand for letters in disguised words. Fixed values.
STANDS_FOR = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i",
                            "*": None, ".": None, "'": None, "-": None})
#: Second-person words of some languages. Fixed values.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre vos "
    "tú ti tus usted ustedes vosotros vuestro".split()
)
UPPER = bytes(range(0x41, 0x5B))
MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
FEATURES = (
    "words", "letters_per_word", "word_hits", "word_density", "start_hits", "start_density", "distinct_hits",
    "strongest", "strength", "person_density", "near_person", "capitals", "shouted", "marks", "calls",
    "disguised", "drawn_out", "digits",
)


def _tokens(text: str) -> list[str]:
    """Lower-cased words; a word with signs or digits inside counts as the word it stands for."""
    words = TOKEN.findall(text.lower())
    return [w if w.isalpha() else (w.translate(STANDS_FOR) or w) for w in words]


class Lexicon(dict):
    """Strength by word, computed where missing: above 0 for a lexicon word, below for a beginning, 0 for other words."""

    def __init__(self, words: dict[str, float], starts: dict[str, float], lengths: tuple[int, ...]):
        super().__init__()
        self.words, self.starts, self.lengths = words, starts, lengths

    def __missing__(self, word: str) -> float:
        found = self.words.get(word)
        if found is None:
            found = -max((self.starts.get(word[:n], 0.0) for n in self.lengths), default=0.0)
        if len(self) > 60_000:
            self.clear()
        self[word] = found
        return found


def features(text: str, lexicon: Lexicon, near: int) -> list[float]:
    """The dense features of one text, in the order of ``FEATURES``; all zero for a text without words."""
    words = _tokens(text)
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    raw = text.encode("utf-8", "replace")
    size = len(raw)
    strengths = list(map(lexicon.__getitem__, words))
    hits = [i for i, s in enumerate(strengths) if s]
    whole = sum(strengths[i] > 0 for i in hits)
    people = sum(map(SECOND_PERSON.__contains__, words))
    close = 0
    for i in hits:
        close += not SECOND_PERSON.isdisjoint(words[max(0, i - near) : i + near + 1])
    capitals = size - len(raw.translate(None, UPPER))
    digits = size - len(raw.translate(None, b"0123456789"))
    marks = size - len(raw.translate(None, MARKS))
    calls = raw.count(b"!") + raw.count(b"?")
    letters = sum(map(len, words))
    return [
        math.log1p(n), letters / n, math.log1p(whole), 100 * whole / n, math.log1p(len(hits) - whole),
        100 * (len(hits) - whole) / n, math.log1p(len({words[i] for i in hits})),
        max((abs(strengths[i]) for i in hits), default=0.0), math.log1p(sum(abs(strengths[i]) for i in hits)),
        100 * people / n, float(close), capitals / size, float(capitals > 0.5 * letters), marks / size, calls / size,
        100 * len(DISGUISED.findall(text)) / n, 100 * len(DRAWN_OUT.findall(text)) / n, digits / size,
    ]


def _candidates(texts: DataFrame, settings: Toxicity) -> DataFrame:
    """(entry, toxic, clean): in how many toxic and clean texts a word (or beginning, marked by a star) occurs."""

    def count(batches):
        seen = ({}, Counter()), ({}, Counter())
        for batch in batches:
            for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist(), strict=True):
                words = set(_tokens(text.as_py() or ""))
                starts = {w[:n] + "*" for w in words for n in settings.beginnings if len(w) >= n}
                seen[toxic][1].update(words)
                seen[toxic][1].update(starts)
            if len(seen[0][1]) + len(seen[1][1]) > 400_000:
                yield given(seen[0][1], seen[1][1])
                seen[0][1].clear()
                seen[1][1].clear()
        yield given(seen[0][1], seen[1][1])

    def given(clean: Counter, toxic: Counter) -> pa.RecordBatch:
        entries = list({*clean, *toxic})
        return pa.RecordBatch.from_arrays(
            [
                pa.array(entries, pa.string()), pa.array([toxic[e] for e in entries], pa.int64()),
                pa.array([clean[e] for e in entries], pa.int64()),
            ],
            ["entry", "toxic", "clean"],
        )

    found = texts.select("text", "toxic").mapInArrow(count, "entry string, toxic long, clean long")
    return found.groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _lexicon(texts: DataFrame, settings: Toxicity) -> tuple[dict[str, float], dict[str, float]]:
    """Strengths (log odds) of toxic words and beginnings; bounded by ``entries``."""
    totals = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not clean:
        return {}, {}
    a, b, share = F.col("toxic"), F.col("clean"), toxic / (toxic + clean)
    odds = (a + 0.5) / (toxic + 1.0) / ((b + 0.5) / (clean + 1.0))

    def part(x: Column, p: float) -> Column:
        return F.when(x > 0, x * F.log(x / ((a + b) * p))).otherwise(0.0)

    told = (
        _candidates(texts, settings)
        .select("entry", F.log(odds).alias("strength"), (2 * (part(a, share) + part(b, 1 - share))).alias("evidence"))
        .where((F.col("evidence") >= settings.evidence) & (F.col("strength") >= math.log(settings.odds)))
        .orderBy(F.desc("evidence"), "entry")
        .limit(settings.entries)
        .collect()
    )
    words = {r["entry"]: r["strength"] for r in told if not r["entry"].endswith("*")}
    return words, {r["entry"][:-1]: r["strength"] for r in told if r["entry"].endswith("*")}


@dataclass(frozen=True)
class Model:
    """What has been learned; ``trees`` and ``calibration`` are None if the labels had only one class."""

    settings: Toxicity
    words: dict[str, float]
    starts: dict[str, float]
    trees: object
    calibration: object
    share: float


def fit(docs: DataFrame, labels: DataFrame, settings: Toxicity = Toxicity()) -> Model:  # noqa: B008
    """Learn from ``docs`` (doc_id, text) with ``labels`` (doc_id, toxic 0 or 1).

    The sample is the ``sample`` labelled ids with the smallest hash, whatever the layout. Labels that are NULL, not 0 or 1 or
    contradictory for an id are left out. Without labels of both classes every text scores the share of toxic ones (0 if
    there are none).
    """
    small_batches(docs.sparkSession)
    one = labels.where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(
        F.min("toxic").alias("toxic"), F.max("toxic").alias("other")
    )
    order = F.xxhash64("doc_id", F.lit(settings.seed))
    chosen = one.where("toxic = other").select("doc_id", F.col("toxic").cast("int").alias("toxic"), order.alias("o"))
    chosen = stage(chosen.orderBy("o").limit(settings.sample).withColumn("part", F.expr("pmod(o, 10)")), "labels")
    if chosen.select("toxic").distinct().count() < 2:
        share = chosen.agg(F.avg("toxic")).first()[0]
        return Model(settings, {}, {}, None, None, float(share or 0.0))
    # At most ``sample`` narrow rows are broadcast.
    texts = stage(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic", "part"), "texts")
    words, starts = _lexicon(texts.where("part < 7"), settings)
    model = Model(settings, words, starts, None, None, 0.0)
    given = annotate(texts.where("part >= 7"), _reader(model), _fields(), "text", ["toxic"])
    rows = stage(_assembled(given).select("row.toxic", "features"), "features")
    if rows.select("toxic").distinct().count() < 2:
        return Model(settings, words, starts, None, None, float(chosen.agg(F.avg("toxic")).first()[0]))
    # Two partitions: the sample is bounded, and every tree level is a job of its own.
    rows = rows.coalesce(2)
    trees = GBTClassifier(
        featuresCol="features", labelCol="toxic", maxIter=settings.trees, maxDepth=settings.depth, stepSize=0.2,
        seed=settings.seed, minInstancesPerNode=5,
    ).fit(rows)
    graded = trees.transform(rows).select(vector_to_array("rawPrediction")[1].alias("margin"), F.col("toxic").cast("double"))
    calibration = IsotonicRegression(featuresCol="margin", labelCol="toxic", predictionCol="score").fit(graded)
    return Model(settings, words, starts, trees, calibration, 0.0)


def _fields() -> str:
    return "values array<double>"


def _reader(model: Model):
    words, starts, settings, key = model.words, model.starts, model.settings, uuid.uuid4().hex

    def read(column: pa.Array) -> list[pa.Array]:
        lexicon = worker_state("toxicity", key, lambda: Lexicon(words, starts, settings.beginnings))
        values = np.array([features(t.as_py() or "", lexicon, settings.near) for t in column], float)
        offsets = np.arange(len(column) + 1, dtype=np.int32) * len(FEATURES)
        return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel(), pa.float64()))]

    return read


def _assembled(given: DataFrame) -> DataFrame:
    named = given.select("row", *[F.col("found.values")[i].alias(name) for i, name in enumerate(FEATURES)])
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(named)


def score(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """``docs`` as column ``row`` and the ``score`` of every whole text (0 to 1, higher: more likely toxic).

    NULL texts count as empty; texts without words have all features zero and get the score the model gives to that. Equal texts
    score alike, repeated rows and extra columns change nothing.
    """
    if model.trees is None:
        names = docs.columns if keep is None else keep
        row = F.struct(*[F.col(f"`{n}`").alias(n) for n in names])
        return docs.select(row.alias("row"), F.lit(model.share).alias("score"))
    given = _assembled(annotate(docs, _reader(model), _fields(), "text", keep)).select("row", "features")
    graded = model.trees.transform(given).withColumn("margin", vector_to_array("rawPrediction")[1])
    return model.calibration.transform(graded).select("row", F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0)).alias("score"))


def held_out(parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves the remainder ``part``."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % parts == part, F.lit(False))


def judged(docs: DataFrame, labels: DataFrame, settings: Toxicity = Toxicity()) -> DataFrame:  # noqa: B008
    """(doc_id, held_out, score, predicted) of every row; learned from the labelled rows that are not held out."""
    model = fit(docs, labels.where(~held_out(4, 2)), settings)
    scored = score(docs.select("doc_id", "text"), model, ["doc_id"]).select("row.doc_id", "score")
    return scored.select(
        "doc_id", held_out(4, 2).alias("held_out"), "score", (F.col("score") >= settings.threshold).cast("int").alias("predicted")
    )


def without_toxic(docs: DataFrame, labels: DataFrame, settings: Toxicity = Toxicity()) -> DataFrame:  # noqa: B008
    """The rows of ``docs`` whose score stays below the threshold, with all their columns."""
    model = fit(docs, labels.where(~held_out(4, 2)), settings)
    return score(docs, model).where(F.col("score") < settings.threshold).select("row.*")
