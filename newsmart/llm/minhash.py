"""Near-duplicate texts by MinHash bands, confirmed on full shingle sets and joined to components.

Steps: (1) one pass over the texts gives every text's distinct shingles as hashes, and from them a digest of the set,
``bands * rows`` universal hash minima (of which a byte is kept) and one key per band; (2) equal sets collapse to one
representative; (3) in each band bucket every member is paired with a few centres, so a hot bucket gives as many pairs as
members and centre; (4) pairs whose signatures agree too little to reach the threshold go, the rest are confirmed on full
sets; (5) links become components; (6) only buckets that still hold several components are compared member by
member, in blocks inside the tasks, and only confirmed links across components leave a task.
Together (3) and (6) look at every pair of a bucket that could change a component.

A pair of similarity 0.8 shares no bucket with probability (1 - 0.8**4)**32 < 5e-8.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsmart.llm import text_arrays as A
from newsmart.llm.components import components
from newsmart.llm.tables import mapped, small_batches, stage, whole_groups


@dataclass(frozen=True)
class Near:
    """``words`` per shingle; similarity at least ``percent`` / 100; ``bands`` of ``rows`` minima.

    ``agree`` is the share of equal minima below which a pair is not confirmed on full sets; 0.6 lies 5.6 standard
    deviations of 128 minima below 0.8. ``block`` is the number of bucket members compared at a time; ``centres``
    and ``links`` only move work from (6) to (3), results do not depend on them.
    """

    words: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 4
    agree: float = 0.6
    block: int = 1024
    centres: int = 6
    links: int = 4
    seed: int = 7

    @property
    def minima(self) -> int:
        return self.bands * self.rows


PIECE = 2 << 20


def shingle_sets(texts: A.Texts, length: int):
    """Sorted distinct shingle hashes of every text; a text of fewer words has all its words as one shingle."""
    found = A.words(texts, A.NOT_SPACE)
    shingles = A.runs(found.hashes, length)
    for first, last in zip(found.bounds[:-1].tolist(), found.bounds[1:].tolist(), strict=True):
        count = last - first
        if count >= length:
            yield np.unique(shingles[first : last - length + 1])
        elif count:
            yield A.runs(found.hashes[first:last], count)
        else:
            yield np.zeros(0, np.uint64)


def _signatures(settings: Near):
    rng = np.random.default_rng(settings.seed)
    factor = rng.integers(0, 1 << 32, settings.minima, np.uint32) | np.uint32(1)
    shift = rng.integers(0, 1 << 32, settings.minima, np.uint32)
    mark = rng.integers(0, 1 << 63, settings.bands, np.uint64)

    def minima(shingles: np.ndarray) -> np.ndarray:
        keys = (shingles >> np.uint64(32)).astype(np.uint32)
        best = np.full(settings.minima, np.uint32(0xFFFFFFFF))
        for low in range(0, len(keys), 256):
            grid = keys[low : low + 256, None] * factor
            grid += shift
            np.minimum(best, grid.min(axis=0), out=best)
        return best

    def bands(best: np.ndarray) -> np.ndarray:
        key = mark.copy()
        for column in (best & np.uint32(0xFF)).astype(np.uint64).reshape(settings.bands, settings.rows).T:
            key = A.mix(key * A.BASE + column)
        return key.view(np.int64)

    return minima, bands


def signed(docs: DataFrame, settings: Near) -> DataFrame:
    """(doc_id, n_shingles, digest, bands, minima) per row; digest, bands and minima are NULL for an empty set."""

    def rows(batches):
        minima, bands = _signatures(settings)
        for batch in batches:
            sizes, digests, keys, signs = [], [], [], []
            for _, piece in A.Texts.of(batch.column("text")).pieces(PIECE):
                for shingles in shingle_sets(piece, settings.words):
                    sizes.append(len(shingles))
                    if len(shingles):
                        best = minima(shingles)
                        digests.append(xxhash.xxh3_128_digest(shingles.tobytes()))
                        keys.append(bands(best))
                        signs.append(best.astype(np.uint8).tobytes())
                    else:
                        digests.append(None)
                        keys.append(None)
                        signs.append(None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())), pa.array(signs, pa.binary()),
                ],
                ["doc_id", "n_shingles", "digest", "bands", "minima"],
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return mapped(texts, rows, "doc_id long, n_shingles long, digest binary, bands array<long>, minima binary")


def _agreeing(pairs: DataFrame, representatives: DataFrame, settings: Near) -> DataFrame:
    """Pairs whose signatures agree enough to be worth the full comparison."""
    signs = representatives.select("id", "minima")

    def kept(batches):
        for batch in batches:
            left, right = (
                np.frombuffer(b"".join(batch.column(name).to_pylist()), np.uint8).reshape(-1, settings.minima)
                for name in ("x", "y")
            )
            keep = (left == right).mean(axis=1) >= settings.agree
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    both = pairs.join(signs.toDF("a", "x"), "a").join(signs.toDF("b", "y"), "b")
    return both.select("a", "b", "x", "y").mapInArrow(kept, "a long, b long")


def _sets(ids: DataFrame, docs: DataFrame, digests: DataFrame, settings: Near) -> DataFrame:
    """(id, shingles): the full shingle sets of the texts named in ``ids``; only these texts are read again as sets."""

    def sets(batches):
        for batch in batches:
            ids, wanted, out = batch.column("id"), batch.column("digest").to_pylist(), []
            for _, piece in A.Texts.of(batch.column("text")).pieces(PIECE):
                out += [shingles.tobytes() for shingles in shingle_sets(piece, settings.words)]
            same = [xxhash.xxh3_128_digest(x) == y for x, y in zip(out, wanted, strict=True)]
            full = pa.RecordBatch.from_arrays([ids, pa.array(out, pa.binary())], ["id", "shingles"])
            yield full.filter(pa.array(same, pa.bool_()))

    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(ids.join(digests, "id"), "id")
    found = mapped(texts.select("id", "digest", "text"), sets, "id long, shingles binary")
    return stage(found.dropDuplicates(["id"]), "sets")


def similar(left: np.ndarray, right: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union for two sorted sets."""
    short, long = (left, right) if len(left) <= len(right) else (right, left)
    if 100 * len(short) < percent * len(long):
        return False
    at = np.minimum(np.searchsorted(long, short), len(long) - 1)
    common = int(np.count_nonzero(long[at] == short))
    return 100 * common >= percent * (len(left) + len(right) - common)


def _as_sets(column: pa.Array | pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(value.as_buffer(), np.uint64) for value in column]


def _confirmed(pairs: DataFrame, docs: DataFrame, digests: DataFrame, settings: Near) -> DataFrame:
    """Pairs whose full shingle sets are similar enough."""

    def kept(batches):
        for batch in batches:
            both = zip(_as_sets(batch.column("x")), _as_sets(batch.column("y")), strict=True)
            keep = [similar(x, y, settings.percent) for x, y in both]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    full = _sets(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), docs, digests, settings)
    both = pairs.join(full.toDF("a", "x"), "a").join(full.toDF("b", "y"), "b")
    return both.select("a", "b", "x", "y").mapInArrow(kept, "a long, b long")


def _hits(table: pa.Table, settings: Near):
    """(row, rows of other labels whose signatures agree enough) inside the groups of a table of bucket members.

    A pair counts only in the first bucket that both ends share.
    """
    part, low, high, labels, ids, numbers, edges = (
        table.column(name).to_numpy() for name in ("part", "low", "high", "label", "id", "number", "edge")
    )
    signs = np.frombuffer(b"".join(table.column("minima").to_pylist()), np.uint8).reshape(-1, settings.minima)
    need = int(np.ceil(settings.agree * settings.minima))
    starts = np.append(np.flatnonzero(edges), len(edges))
    for first, last in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        inside = low[first] == high[first]
        here = np.arange(first, last)
        rows, columns = here[part[here] == low[first]], here[part[here] == high[first]]
        for i in rows.tolist():
            other = columns[(labels[columns] != labels[i]) & ((ids[columns] > ids[i]) | (not inside))]
            equal = signs[other] == signs[i]
            close = equal.sum(axis=1) >= need
            shared = equal[close].reshape(-1, settings.bands, settings.rows).all(axis=2)
            hit = other[close][shared.argmax(axis=1) == numbers[i]]
            if len(hit):
                yield i, hit


MEMBER = "band long, number int, low int, high int, part int, label long, id long, minima binary"
GROUP = ["band", "low", "high"]


def _across(members: DataFrame, docs: DataFrame, digests: DataFrame, settings: Near) -> DataFrame:
    """Links between bucket members (band, its number, label, id, minima) of different labels.

    A bucket is cut into blocks of about ``block`` members by a hash of the id, and a task compares one block with another
    (or itself) as matrices. A member is sent once per block of its bucket, so rows grow by members / block. A first pass
    finds the members that agree enough with one of another label; these few meet again with their full sets, and
    only confirmed links leave the task, none between texts that links of the group have joined before.
    """
    sizes = members.groupBy("band").agg(F.ceil(F.count("*") / settings.block).cast("int").alias("parts"))
    placed = members.join(sizes, "band").withColumn("part", F.expr("pmod(xxhash64(id, band), parts)").cast("int"))
    sent = placed.withColumn("other", F.explode(F.expr("sequence(0, parts - 1)"))).select(
        "band", "number", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part",
        "label", "id", "minima",
    )

    def agreeing(batches):
        for table in whole_groups(batches, GROUP):
            seen = np.zeros(len(table), bool)
            for i, hit in _hits(table, settings):
                seen[i] = True
                seen[hit] = True
            yield from table.drop_columns(["edge"]).filter(pa.array(seen)).to_batches()

    def linked(batches):
        for table in whole_groups(batches, GROUP):
            sets, ids, labels = _as_sets(table.column("shingles")), table.column("id").to_pylist(), table.column("label").to_pylist()
            joined: dict[int, int] = {}

            def root(label: int) -> int:
                while label in joined:
                    label = joined[label]
                return label

            found = []
            for i, hit in _hits(table, settings):
                for j in hit.tolist():
                    one, two = root(labels[i]), root(labels[j])
                    if one != two and similar(sets[i], sets[j], settings.percent):
                        joined[max(one, two)] = min(one, two)
                        found.append((ids[i], ids[j]))
            ends = [pa.array([f(pair) for pair in found], pa.int64()) for f in (min, max)]
            yield pa.RecordBatch.from_arrays(ends, ["a", "b"])

    close = stage(mapped(sent.repartition(*GROUP).sortWithinPartitions(*GROUP), agreeing, MEMBER), "close")
    full = _sets(close.select("id").distinct(), docs, digests, settings)
    again = close.join(full, "id").repartition(*GROUP).sortWithinPartitions(*GROUP)
    return mapped(again, linked, "a long, b long").distinct()


def _stars(crowded: DataFrame, settings: Near) -> DataFrame:
    """Distinct pairs of every bucket member with the bucket's centres: the least id, and the least under other orders.

    An order is the same in all buckets, so most pairs of a group are the same in many bands. Of a member's centres
    those that share most buckets with it are taken, ``links`` at most: the others are left to (6).
    """
    orders = np.random.default_rng(settings.seed).integers(1 << 62, size=settings.centres)
    masks = [F.lit(int(mask) if turn else 0) for turn, mask in enumerate(orders)]
    least = [F.min(F.col("id").bitwiseXOR(mask)).alias(f"c{turn}") for turn, mask in enumerate(masks)]
    centres = crowded.groupBy("band").agg(*least)
    chosen = F.array_distinct(F.array(*[F.col(f"c{turn}").bitwiseXOR(mask) for turn, mask in enumerate(masks)]))
    star = crowded.join(centres, "band").select("id", F.explode(chosen).alias("centre")).where("id <> centre")
    best = Window.partitionBy("id").orderBy(F.desc("shared"), "centre")
    counted = star.groupBy("id", "centre").agg(F.count("*").alias("shared"))
    nearest = counted.withColumn("place", F.row_number().over(best)).where(F.col("place") <= settings.links)
    return nearest.select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")).distinct()


def _open(crowded: DataFrame, labels: DataFrame) -> DataFrame:
    """Members (band, number, id, label) of the buckets that hold more than one component."""
    named = crowded.join(labels.toDF("id", "label"), "id", "left").withColumn("label", F.coalesce("label", "id"))
    several = named.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    return named.join(several.select("band"), "band")


def near_duplicates(docs: DataFrame, settings: Near = Near()) -> DataFrame:  # noqa: B008
    """Rows (doc_id, n_shingles, component_id, kept), one for every row of ``docs`` (columns doc_id, text).

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased. The component is the smallest doc_id reachable over links of
    ``percent`` similarity and more, ``kept`` says whether it is the row's own. NULL texts and texts without words have no
    shingles, are linked with nothing and are kept. Rows that share a doc_id count as one document: a link of
    one is a link of all. A row with a NULL doc_id takes the component of the texts with its set and is not kept; if there is none its
    component is NULL and it is kept. Other columns are ignored. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    signs = stage(signed(docs, settings), "signatures")
    representatives = stage(
        signs.where("digest is not null and doc_id is not null").groupBy("digest").agg(
            F.min("doc_id").alias("id"), F.first("bands").alias("bands"), F.first("minima").alias("minima")
        ),
        "representatives",
    )
    digests = representatives.select("id", "digest")
    banded = representatives.select("id", F.posexplode("bands").alias("number", "band"))
    crowds = banded.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band")
    crowded = stage(banded.join(crowds, "band"), "crowded")

    pairs = stage(_agreeing(_stars(crowded, settings), representatives, settings), "pairs")
    links = stage(_confirmed(pairs, docs, digests, settings), "confirmed")
    labels = components(links)

    members = _open(crowded, labels).join(representatives.select("id", "minima"), "id")
    missed = stage(_across(members, docs, digests, settings), "across")
    if not missed.isEmpty():
        labels = components(links.union(missed))

    classes = digests.join(labels.toDF("id", "label"), "id", "left").select(
        "digest", F.coalesce("label", "id").alias("component")
    )
    return (
        signs.select("doc_id", "n_shingles", "digest")
        .join(classes, "digest", "left")
        .select(
            "doc_id", "n_shingles",
            F.coalesce("component", "doc_id").alias("component_id"),
            F.col("doc_id").eqNullSafe(F.coalesce("component", "doc_id")).alias("kept"),
        )
    )


def keep_one(docs: DataFrame, settings: Near = Near()) -> DataFrame:  # noqa: B008
    """The rows of ``docs`` without near copies: of each component the document with the smallest doc_id.

    All columns stay. Of rows that share a doc_id one stays; rows with a NULL doc_id all stay.
    """
    found = near_duplicates(docs, settings)
    gone = found.where("not kept").select("doc_id").distinct()
    named = docs.where("doc_id is not null").join(gone, "doc_id", "left_anti").dropDuplicates(["doc_id"])
    return named.select(docs.columns).union(docs.where("doc_id is null"))
