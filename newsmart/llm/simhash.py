"""Near-duplicate texts by SimHash fingerprints, found with Golay codes as a fuzzy hash.

The binary Golay code of 23 bits is perfect: every word lies within 3 errors of exactly one of its 4,096 codewords. A word and all
words one bit away decode to one codeword or to six, depending on the word. So if two words differ in one bit at most, the codeword of
either is among the one or six codewords around the other.

1. One pass over the texts gives every text's fingerprint: a bit is set if it is set in more than half of the shingles' hashes.
2. Equal fingerprints collapse to one row.
3. A fingerprint is cut into four segments of 16 bits. However 3 differing bits fall, one of the pairs (1, 2), (2, 3), (3, 4) and
   (4, 1) has none in its first segment and at most one in its second (pigeonhole). For each pair a fingerprint is filed once
   under its first segment with every codeword around the second, and once under its first segment with the codeword of the
   second: fingerprints that such a pair links meet, one filed in the first way and the other in the second.
4. Fingerprints that meet are verified as matrices inside tasks, and only links that join two parts of a bucket leave it, so links grow
   with members and not with pairs.
5. A bucket with more than ``crowd`` rows is not compared at once: its fingerprints are filed again under exact pieces of
   their bits, all but three of which are equal in linked fingerprints. Pieces get smaller until no bucket can be crowded.
6. Links become components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmart.llm import text_arrays as A
from newsmart.llm.components import components
from newsmart.llm.tables import small_batches, stage, whole_groups, worker_state


@dataclass(frozen=True)
class Near:
    """``words`` per shingle, hashes with ``seed``. ``crowd`` rows of a bucket are compared at once; results do not depend on it."""

    words: int = 3
    seed: int = 42
    crowd: int = 4096


#: Most differing bits of a link; segments and pieces follow from it.
BITS = 3
SEGMENTS = (16, 16, 16, 16)
PAIRS = ((0, 1), (1, 2), (2, 3), (3, 0))
#: Pieces of the finer buckets, step by step: all but BITS of them are equal. In the last step what is free is 12 bits, so
#: a bucket has 4,096 fingerprints at most.
PIECES = (8, 12, 16)
#: Hashes whose bits are counted in one step.
SLICE = 1 << 15


# -- fingerprints --------------------------------------------------------------------------------------
def shingle_hashes(text: bytes, length: int, seed: int) -> Iterator[np.ndarray]:
    """XXH64 of every shingle of a text, in slices; a text of fewer words has all its words as one shingle."""
    words = text.lower().split()  # bytes: A-Z only, and the six ASCII white spaces
    if not words:
        return
    line, count = b" ".join(words), max(len(words) - length + 1, 1)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts, ends = (ends - sizes)[:count].tolist(), ends[min(length, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    for low in range(0, count, SLICE):
        pairs = zip(starts[low : low + SLICE], ends[low : low + SLICE], strict=True)
        yield np.array([digest(line[a:b], seed) for a, b in pairs], np.uint64)


def fingerprint(text: bytes, settings: Near) -> int:
    """Bits set in more than half of the hashes; 0 without words."""
    ones, total = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text, settings.words, settings.seed):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        total += len(hashes)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, settings: Near = Near()) -> DataFrame:  # noqa: B008
    """(doc_id, fingerprint as a signed long) of every row of ``docs`` (columns doc_id, text)."""
    small_batches(docs.sparkSession)

    def rows(batches):
        for batch in batches:
            texts = A.Texts.of(batch.column("text"))
            found = np.array([fingerprint(texts.one(i).tobytes(), settings) for i in range(len(texts))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rows, "doc_id long, fingerprint long")


# -- the code ------------------------------------------------------------------------------------------
#: x**11 + x**10 + x**6 + x**5 + x**4 + x**2 + 1 generates the code. Fixed value.
GENERATOR = 0b110001110101


class Golay:
    """Decoding tables of the binary Golay code: 12 message bits above 11 check bits."""

    def __init__(self) -> None:
        remainder = [1]
        for _ in range(22):
            x = remainder[-1] << 1
            remainder.append(x ^ GENERATOR if x >> 11 else x)
        self.low = self._linear(remainder[:12])
        self.high = self._linear(remainder[12:])
        #: The error of up to 3 bits that leaves a syndrome.
        self.error = np.zeros(1 << 11, np.int64)
        for count in range(4):
            for places in combinations(range(23), count):
                self.error[reduce(lambda x, p: x ^ remainder[p], places, 0)] = sum(1 << p for p in places)
        self.around = {width: self._around(width) for width in set(SEGMENTS)}

    @staticmethod
    def _linear(values: list[int]) -> np.ndarray:
        """The syndrome of every combination of bits with these syndromes."""
        out = np.zeros(1, np.int64)
        for value in values:
            out = np.concatenate([out, out ^ value])
        return out

    def syndrome(self, words: np.ndarray) -> np.ndarray:
        return self.low[words & 0xFFF] ^ self.high[words >> 12]

    def message(self, words: np.ndarray) -> np.ndarray:
        """The message bits of the codeword nearest to each word."""
        return (words ^ self.error[self.syndrome(words)]) >> 11

    def _around(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """For every syndrome: how many codewords are nearest to a word or one of its neighbours, and their distances as bit masks.

        Neighbours differ in one of the upper ``width`` bits.
        """
        flips = [0, *(1 << p for p in range(23 - width, 23))]
        masks = [set() for _ in range(1 << 11)]
        for flip in flips:
            for syndrome, error in enumerate(self.error[np.arange(1 << 11) ^ int(self.syndrome(np.array([flip]))[0])].tolist()):
                masks[syndrome].add(flip ^ error)
        counts = np.array([len(m) for m in masks])
        table = np.zeros((1 << 11, counts.max()), np.int64)
        for syndrome, found in enumerate(masks):
            table[syndrome, : len(found)] = sorted(found)
        return counts, table

    def messages_around(self, words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(place of the word, message) for the codewords nearest to each word and its neighbours."""
        counts, table = self.around[width]
        syndromes = self.syndrome(words)
        rows = np.repeat(np.arange(len(words)), counts[syndromes])
        nth = np.arange(len(rows)) - np.repeat(np.cumsum(counts[syndromes]) - counts[syndromes], counts[syndromes])
        return rows, (words[rows] ^ table[syndromes[rows], nth]) >> 11


def segments(prints: np.ndarray) -> list[np.ndarray]:
    """The segments of fingerprints as words of 23 bits, padded at the right."""
    out, at = [], 64
    for width in SEGMENTS:
        at -= width
        out.append(((prints >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64) << (23 - width))
    return out


FILED = "bucket long, side int, fp long"


def filed(prints: DataFrame) -> DataFrame:
    """(bucket, side, fp): ``prints`` (column fp) under the keys of step 3."""

    def rows(batches):
        golay = worker_state("simhash", "golay", Golay)
        for batch in batches:
            fps = batch.column("fp").to_numpy()
            words = segments(fps.view(np.uint64))
            for number, (x, y) in enumerate(PAIRS):
                ways = golay.messages_around(words[y], SEGMENTS[y]), (np.arange(len(fps)), golay.message(words[y]))
                for side, (at, message) in enumerate(ways):
                    bucket = (((number << 23) | words[x][at]) << 12) | message
                    columns = [bucket.astype(np.int64), np.full(len(at), side, np.int32), fps[at]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["bucket", "side", "fp"])

    return prints.select("fp").mapInArrow(rows, FILED)


def pieces(prints: DataFrame, count: int) -> DataFrame:
    """(bucket, side, fp): ``prints`` under all choices of count - 3 of ``count`` pieces of their bits. All have side 2.

    Buckets are hashes; those of unlike pieces that fall together only cost comparisons.
    """
    edges = np.linspace(0, 64, count + 1).astype(int)
    masks = [((1 << int(b - a)) - 1) << int(a) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    chosen = [sum(masks[i] for i in picked) for picked in combinations(range(count), count - BITS)]
    signed = np.array(chosen, np.uint64).view(np.int64).tolist()
    keys = F.explode(F.array(*[F.xxhash64(F.lit(n), F.col("fp").bitwiseAND(F.lit(mask))) for n, mask in enumerate(signed)]))
    return prints.select(keys.alias("bucket"), F.lit(2).alias("side"), "fp")


# -- links ---------------------------------------------------------------------------------------------
def spanning_links(prints: np.ndarray, sides: np.ndarray) -> list[tuple[int, int]]:
    """Links between fingerprints of one bucket that join its linked ones, one for each two parts joined.

    Rows of side 0 meet those of side 1; rows of side 2 meet each other.
    """
    whole = sides[0] == 2
    left, right = (prints, prints) if whole else (prints[sides == 0], prints[sides == 1])
    known, places = np.unique(np.concatenate([left, right]), return_inverse=True)
    at_left, at_right = places[: len(left)], places[len(left) :]
    labels, out = np.arange(len(known)), []
    for i, fp in zip(at_left.tolist(), left, strict=True):
        close = at_right[np.bitwise_count(right ^ fp) <= BITS]
        for j in close[labels[close] != labels[i]].tolist():
            one, two = labels[i], labels[j]
            if one != two:
                labels[labels == max(one, two)] = min(one, two)
                out.append((int(known[min(i, j)]), int(known[max(i, j)])))
    return out


def _met(rows: DataFrame, settings: Near) -> tuple[DataFrame, DataFrame]:
    """(rows of the buckets in which fingerprints can meet, the fingerprints of crowded buckets)."""
    counts = rows.groupBy("bucket").agg(
        F.count("*").alias("n"), F.min("fp").alias("low"), F.max("fp").alias("high"),
        F.min("side").alias("first"), F.max("side").alias("last"),
    )
    several = counts.where("low <> high and (first <> last or first = 2)").select("bucket", (F.col("n") > settings.crowd).alias("crowded"))
    met = stage(rows.join(stage(several, "buckets"), "bucket"), "met")
    return met.where("not crowded"), stage(met.where("crowded").select("fp").distinct(), "crowded")


def _links(rows: DataFrame) -> DataFrame:
    """(a, b): links inside the buckets of ``rows``."""

    def linked(batches):
        for table in whole_groups(batches, ["bucket"]):
            edges = np.append(np.flatnonzero(table.column("edge").to_numpy()), len(table)).tolist()
            fps = table.column("fp").to_numpy().view(np.uint64)
            sides = table.column("side").to_numpy()
            found = [link for a, b in zip(edges[:-1], edges[1:], strict=True) for link in spanning_links(fps[a:b], sides[a:b])]
            ends = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])

    dealt = rows.select("bucket", "side", "fp").repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(linked, "a long, b long").distinct()


def links(prints: DataFrame, settings: Near = Near()) -> DataFrame:  # noqa: B008
    """(a, b): links between the distinct fingerprints ``prints`` (column fp) that join all that 3 or fewer bits link.

    Not every link is there, but every two fingerprints that links join are joined by these.
    """
    rows, crowded = _met(stage(filed(prints), "filed"), settings)
    found = [stage(_links(rows), "links")]
    for count in PIECES:
        if crowded.isEmpty():
            break
        rows = stage(pieces(crowded, count), "pieces")
        if count != PIECES[-1]:
            rows, crowded = _met(rows, settings)
        found.append(stage(_links(rows), "links"))
    return reduce(DataFrame.unionAll, found)


def near_duplicates(docs: DataFrame, settings: Near = Near()) -> DataFrame:  # noqa: B008
    """(doc_id, fingerprint, component_id) of every row of ``docs`` (columns doc_id, text).

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; fingerprints are shown as 16 hex digits and linked at 3 or fewer
    differing bits. ``component_id`` is the smallest doc_id of the rows whose fingerprints can be reached. NULL texts and texts without
    words have the fingerprint zero and are linked like any other. Rows with equal or NULL doc_ids are rows of their own; a
    component of NULL doc_ids alone has a NULL component_id. Other columns are ignored. An empty table gives no rows.
    """
    rows = stage(fingerprints(docs, settings), "fingerprints")
    prints = stage(rows.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("doc_id").alias("least")), "prints")
    labels = components(links(prints, settings))
    named = prints.join(labels.toDF("fp", "label"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    least = stage(named.groupBy("label").agg(F.min("least").alias("component_id")), "components")
    classes = stage(named.join(least, "label").select("fp", "component_id"), "classes")
    return rows.join(classes, F.col("fingerprint") == F.col("fp")).select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )
