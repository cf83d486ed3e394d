"""I-Match document fingerprints over randomised lexicon subsets.

Terms are runs of letters and digits (A-Z lower-cased, all characters beyond ASCII as they are), known by a 64-bit hash. The
lexicon has the terms whose inverse document frequency ln(documents / document frequency) lies in a band. A fingerprint
hashes the sorted distinct terms of a text that the lexicon has, and does so again for random subsets of the lexicon. If
two texts have the same terms in a subset, that hash is equal: the share of equal hashes tells how alike they are. A subset
says most when it holds about one of a text's terms, so every text uses the subsets of three densities near
1 / (number of its terms), and two texts are compared by the densities they share.

The lexicon is broadcast: its size is at most (mean number of distinct terms of a text) / (least share of documents),
whatever the number of documents.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmart.llm import text_arrays as A
from newsmart.llm.tables import small_batches


@dataclass(frozen=True)
class IMatch:
    """The band of inverse document frequencies, ``subsets`` per density and ``densities`` per text. A text with fewer than
    ``least`` lexicon terms uses all its terms. ``most`` bounds the lexicon that is broadcast; beyond it is an error."""

    low: float = 2.3
    high: float = 6.9
    subsets: int = 32
    densities: int = 3
    least: int = 4
    most: int = 4_000_000
    seed: int = 3


PIECE = 2 << 20


def distinct_terms(texts: list[bytes]) -> list[np.ndarray]:
    """The sorted distinct term hashes of every text."""
    out = []
    for _, piece in A.Texts.of(pa.array(texts, pa.large_binary())).pieces(PIECE):
        found = A.words(piece, A.ALNUM)
        out += [np.unique(found.hashes[a:b]) for a, b in zip(found.bounds[:-1].tolist(), found.bounds[1:].tolist(), strict=True)]
    return out


def lexicon(docs: DataFrame, settings: IMatch) -> np.ndarray:
    """Sorted hashes of the terms in the band, counted over all documents."""

    def count(batches):
        for batch in batches:
            texts = [t.as_py() or b"" for t in batch.column("text").cast(pa.large_binary())]
            terms, times = np.unique(np.concatenate([np.zeros(0, np.uint64), *distinct_terms(texts)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(times)], ["term", "n"])

    total = docs.count()
    counted = docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    idf = F.log(F.lit(float(max(total, 1))) / F.col("n"))
    band = counted.where((idf >= settings.low) & (idf <= settings.high)).select("term")
    found = band.limit(settings.most + 1).toArrow().column("term").to_numpy()
    if len(found) > settings.most:
        raise ValueError("the lexicon is too large to broadcast: lower the greatest inverse document frequency")
    return np.sort(found.view(np.uint64))


class Fingerprints:
    """Fingerprints under one lexicon, and how alike two of them are."""

    def __init__(self, terms: np.ndarray, settings: IMatch):
        self.lexicon, self.settings = terms, settings
        self.seeds = np.random.default_rng(settings.seed).integers(1, 1 << 63, settings.subsets, np.uint64)[:, None]

    def of(self, terms: np.ndarray) -> tuple[int, bytes, str]:
        """(level, subset hashes, text form) for the distinct terms of a text."""
        if not len(terms):
            return -1, b"", "empty"
        if len(self.lexicon):
            at = np.minimum(np.searchsorted(self.lexicon, terms), len(self.lexicon) - 1)
            inside = terms[self.lexicon[at] == terms]
            terms = inside if len(inside) >= self.settings.least else terms
        level = max(math.ceil(math.log2(len(terms))), 0)
        draws = A.mix(terms ^ self.seeds)
        values = A.mix(terms)
        hashes = np.zeros((self.settings.densities, self.settings.subsets), np.uint16)
        for n in range(self.settings.densities):
            member = draws < np.uint64((1 << 64 - level - n) - 1)
            sums = (values * member).sum(axis=1)  # of sorted distinct terms: equal sets, equal sums
            hashes[n] = np.where(member.any(axis=1), np.maximum(A.mix(sums) >> np.uint64(48), np.uint64(1)), 0)
        packed = hashes.tobytes()
        return level, packed, f"{xxhash.xxh3_128_hexdigest(terms.tobytes())}-{level:02x}-{packed.hex()}"

    def likeness(self, x: tuple[int, bytes, str], y: tuple[int, bytes, str]) -> float:
        """0 to 1: 1 for equal fingerprints, else the share of equal hashes of the subsets that hold terms of either text."""
        if x[2] == y[2]:
            return 1.0
        first = max(x[0], y[0])
        shared = min(x[0], y[0]) + self.settings.densities - first
        if min(x[0], y[0]) < 0 or shared <= 0:
            return 0.0
        sides = [
            np.frombuffer(z[1], np.uint16).reshape(self.settings.densities, -1)[first - z[0] : first - z[0] + shared] for z in (x, y)
        ]
        used = (sides[0] > 0) | (sides[1] > 0)
        equal = (sides[0] == sides[1]) & used
        return float(equal.sum() / used.sum()) if used.any() else 0.0


def edited(text: str, following: str) -> str:
    """The last half of ``text`` (rounded down) replaced by as many first characters of ``following``, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _in_order(docs: DataFrame) -> DataFrame:
    """Rows (key, doc_id, text, halo) in partitions by descending key; the halo row at a partition's end is what follows it.

    An approximate percentile aggregate cuts the ids into ranges. It counts in doubles, which do not hold every 64-bit id, so
    the bounds are the greatest ids that a second aggregate finds in each range: each bound is the first row of its
    partition; it is also sent to the partition before it, and the very first one to the last partition.
    """
    spark = docs.sparkSession
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("key"), "doc_id", "text")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = F.array(*[F.lit((n + 1) / parts) for n in range(parts)])
    cuts = keyed.agg(F.percentile_approx("key", shares, F.lit(max(20 * parts, 10_000))).alias("cuts")).first()["cuts"]
    ends = np.unique(np.array(cuts or [], np.int64))

    @F.pandas_udf("int")
    def ranges(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(ends, keys.to_numpy(np.int64)).astype(np.int32))

    tops = keyed.select("key", ranges("key").alias("range")).groupBy("range").agg(F.max("key").alias("top"))
    bounds = sorted(row["top"] for row in tops.collect())

    @F.pandas_udf("array<struct<part: int, halo: boolean>>")
    def places(keys: pd.Series) -> pd.Series:
        out = []
        for key in keys.tolist():
            own = bisect_left(bounds, key)
            both = [(own, False)]
            if bounds[own] == key:
                both.append(((own + 1) % len(bounds), True))
            out.append([{"part": p, "halo": h} for p, h in both])
        return pd.Series(out)

    placed = keyed.select("key", "doc_id", "text", F.explode(places("key")).alias("place")).select("*", "place.*").drop("place")
    return placed.repartitionById(max(len(bounds), 1), F.col("part")).sortWithinPartitions("halo", F.desc("key"), "text")


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def fingerprints(docs: DataFrame, settings: IMatch = IMatch()) -> DataFrame:  # noqa: B008
    """A row for every row of ``docs`` (doc_id, text) with the columns of ``SCHEMA``.

    The next document has the next smaller doc_id, after the last comes the first; a NULL doc_id is the smallest, and rows of one
    doc_id stand in the order of their texts (NULL first). NULL texts count as empty: their fingerprint is ``empty``, as
    that of texts without a term. The only row of a table is its own next one. An empty table gives no rows. Other columns
    are ignored.
    """
    small_batches(docs.sparkSession)
    terms = lexicon(docs, settings)

    def rows(batches):
        prints = Fingerprints(terms, settings)
        waiting = None  # the last row seen: (doc_id, text, fingerprint), which needs the one that follows
        over = False
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column("text")]
            halos, ids = batch.column("halo").to_pylist(), batch.column("doc_id").to_pylist()
            here = [prints.of(t) for t in distinct_terms([t.encode() for t in texts])]
            pairs = []
            for i, text in enumerate(texts):
                if waiting is not None and not over:
                    pairs.append((*waiting, text, here[i]))
                over |= halos[i]
                waiting = (ids[i], text, here[i])
            changed = [edited(p[1], p[3]).encode() for p in pairs]
            after = [prints.of(t) for t in distinct_terms(changed)]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": [p[0] for p in pairs],
                    "n_chars": [len(p[1]) for p in pairs],
                    "edited_sha256": [hashlib.sha256(c).hexdigest() for c in changed],
                    "fingerprint": [p[2][2] for p in pairs],
                    "edited_fingerprint": [a[2] for a in after],
                    "near_edited": [prints.likeness(p[2], a) for p, a in zip(pairs, after, strict=True)],
                    "near_next": [prints.likeness(p[2], p[4]) for p in pairs],
                },
                schema=pa.schema([
                    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
                ]),
            )

    return _in_order(docs).select("doc_id", "text", "halo").mapInArrow(rows, SCHEMA)
