"""Removal of repeated byte strings with suffix arrays and longest-previous-factor arrays.

A string of ``length`` bytes is repeated if it starts at two places. To bring equal strings together without sorting all
suffixes of the corpus, every start is filed under its anchor: the place inside its string where a hash of ``gram`` bytes
is smallest (the leftmost of equals). Equal strings have equal anchors, and neighbouring starts mostly share one,
so a text falls into runs of starts with one anchor, about 2 / (length - gram) of its bytes. Then:

1. One pass over the texts gives every run (place, hash of the anchor, digest of the bytes that its strings cover).
2. An anchor hash that occurs once repeats nothing. If all its runs cover equal bytes, all their strings are repeated.
3. The other anchors' runs, one of each digest, are read as bytes and dealt by anchor into shards. A shard's suffix array
   (sorted as deep as ``length``) is searched for the longest previous factor of every start: in suffix order, the
   previous and the next smaller position give the longest earlier match; a factor of ``length`` or more is an earlier copy.
   Runs of one very frequent anchor are dealt to several shards, which then exchange digests: first of what neighbouring
   strings have in common, the wide neighbourhood before the narrow one, then of the single strings where that occurs in another shard.
4. Removed starts become byte spans of their texts.

``copies="later"`` removes copies of an earlier string and keeps the first; ``copies="all"`` removes the first one too.
With ``words`` the same is done over the words of the texts, as 64-bit hashes, instead of their bytes. Several settings
may be given at once: each looks at the whole texts, and what any of them finds goes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmart.llm import text_arrays as A
from newsmart.llm.tables import annotate, mapped, small_batches, stage, whole_groups, worker_state


@dataclass(frozen=True)
class Repeats:
    """``length`` bytes make a repeated string; ``gram`` bytes are hashed for anchors. ``shard`` bounds the bytes of small
    groups of runs that share one suffix array, ``runs_per_shard`` the runs of one anchor in it. With ``words`` all of them
    count words (``[^\\x20\\x09-\\x0D]+`` as they are written) instead of bytes."""

    length: int = 400
    gram: int = 48
    shard: int = 1 << 15
    runs_per_shard: int = 700
    words: bool = False


#: Passages of over fifty words, however short the words are.
PASSAGES = Repeats(length=51, gram=8, words=True)

PIECE = 1 << 20
#: Bytes of whole texts, or bytes whose words, go through one vector step; longer texts go alone.
GROUP = 1 << 16
WORD_PIECE = 1 << 18
AS_WRITTEN = np.arange(256, dtype=np.uint8)


# -- units ---------------------------------------------------------------------------------------------
def _units(texts: A.Texts, settings: Repeats) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The bytes of consecutive texts, or the hashes of their words, with the bounds of the texts; about ``GROUP`` at once."""
    for _, piece in texts.pieces(WORD_PIECE if settings.words else GROUP):
        if settings.words:
            found = A.words(piece, A.NOT_SPACE, AS_WRITTEN)
            yield found.hashes, found.bounds
        else:
            yield piece.data, piece.bounds


def _unit_type(settings: Repeats) -> np.dtype:
    return np.dtype(np.uint64 if settings.words else np.uint8)


# -- anchors -------------------------------------------------------------------------------------------
def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A mixed hash of every ``gram`` bytes or words."""
    n = len(data) - gram + 1
    up, down = _powers(len(data) + 1)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return A.mix((sums[gram:] - sums[:n]) * down[:n])


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, ``count`` at least; a worker keeps one pair, for the longest text so far."""
    kept = worker_state("arrays", "byte-powers", dict)
    if len(kept.get("up", ())) < count:
        size = max(1 << (count - 1).bit_length(), 1 << 16)
        kept["up"], kept["down"] = A.powers(A.BASE, size), A.powers(A.INVERSE, size)
    return kept["up"], kept["down"]


def window_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values: least so far and least to come inside blocks of that width."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    grid = np.full(blocks * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    grid[: len(values)] = values
    grid = grid.reshape(blocks, width)
    so_far = np.minimum.accumulate(grid, axis=1).ravel()
    to_come = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(to_come[:n], so_far[width - 1 : width - 1 + n])


def _least_places(data: np.ndarray, settings: Repeats) -> tuple[np.ndarray, np.ndarray]:
    """The anchor place of every start, and the hashes of all places.

    The place rides in the low bits of the hashes, so the least value of a window names its leftmost least place.
    """
    low_bits = np.uint64((1 << 22) - 1)
    grams = gram_hashes(data, settings.gram)
    marked = (grams & ~low_bits) | np.arange(len(grams), dtype=np.uint64)
    place = (window_least(marked, settings.length - settings.gram + 1) & low_bits).astype(np.int64)
    return place, grams.view(np.int64)


def anchored_runs(data: np.ndarray, settings: Repeats) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first start, last start, anchor hash) of the runs of starts that share an anchor place, for one text.

    Long texts are handled in overlapping parts; a run that a part's end divides is joined again.
    """
    starts = len(data) - settings.length + 1
    if starts <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    places, firsts, hashes = [], [], []
    for low in range(0, starts, PIECE):
        count = min(PIECE, starts - low)
        place, grams = _least_places(data[low : low + count + settings.length - 1], settings)
        edges = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1])
        places.append(place[edges] + low)
        firsts.append(edges + low)
        hashes.append(grams[place[edges]])
    places, firsts, hashes = (np.concatenate(x) for x in (places, firsts, hashes))
    fresh = np.concatenate([[True], places[1:] != places[:-1]])
    firsts, hashes = firsts[fresh], hashes[fresh]
    return firsts, np.append(firsts[1:] - 1, starts - 1), hashes


def runs_of_texts(
    data: np.ndarray, bounds: np.ndarray, settings: Repeats
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``anchored_runs`` of consecutive texts in one step: (text, first start, last start, anchor hash), starts counted in ``data``.

    Places whose window leaves its text take part in the arithmetic and are no starts.
    """
    ends = bounds[1:] - settings.length + 1  # past the last start of each text
    if len(data) > PIECE or len(data) < settings.length:
        found = [anchored_runs(data[a:b], settings) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        text = np.repeat(np.arange(len(found)), [len(x[0]) for x in found])
        first, last, anchor = (np.concatenate(x) for x in zip(*found, strict=True))
        return text, first + bounds[text], last + bounds[text], anchor
    place, grams = _least_places(data, settings)
    some = ends > bounds[:-1]
    change = np.zeros(len(place) + 1, np.int64)
    change[bounds[:-1][some]] += 1
    change[ends[some]] -= 1
    starts = np.cumsum(change[:-1]) > 0
    fresh = np.concatenate([[True], place[1:] != place[:-1]])
    fresh[bounds[:-1][some]] = True
    first = np.flatnonzero(starts & fresh)
    text = np.searchsorted(bounds, first, "right") - 1
    last = np.minimum(np.append(first[1:], len(data)), ends[text]) - 1
    return text, first, last, grams[place[first]]


RUNS = "runs array<struct<first: int, last: int, anchor: long, cover: long>>"
RUN = pa.struct([("first", pa.int32()), ("last", pa.int32()), ("anchor", pa.int64()), ("cover", pa.int64())])


def _runs(docs: DataFrame, settings: Repeats) -> DataFrame:
    """(id, tag, first, last, anchor, cover) of every run of every text."""

    def find(column: pa.Array) -> list[pa.Array]:
        counts, parts = [np.zeros(1, np.int64)], []
        for data, bounds in _units(A.Texts.of(column), settings):
            with np.errstate(over="ignore"):
                text, first, last, anchor = runs_of_texts(data, bounds, settings)
            counts.append(np.bincount(text, minlength=len(bounds) - 1))
            raw, width = memoryview(np.ascontiguousarray(data).view(np.uint8)), data.itemsize
            cuts = zip((first * width).tolist(), ((last + settings.length) * width).tolist(), strict=True)
            cover = np.array([xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in cuts], np.uint64)
            parts.append((first - bounds[text], last - bounds[text], anchor, cover.view(np.int64)))
        offsets = pa.array(np.cumsum(np.concatenate(counts)), pa.int32())
        columns = [np.concatenate(x) for x in zip(*parts, strict=True)] or [np.zeros(0, np.int64)] * 4
        flat = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, RUN, strict=True)], fields=list(RUN))
        return [pa.ListArray.from_arrays(offsets, flat)]

    found = annotate(docs, find, RUNS, "text", ["id", "tag"])
    return found.select("row.id", "row.tag", F.explode("found.runs").alias("run")).select("id", "tag", "run.*")


# -- suffix arrays -------------------------------------------------------------------------------------
def suffix_order(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, rank) of codes compared as deep as ``depth``: equal so far, equal rank.

    Ranks of twice the depth come from pairs of ranks, starting with as many codes at a time as one key holds.
    """
    n = len(data)
    bits = (int(data.max(initial=0)) + 1).bit_length()
    reach = min(63 // bits, depth)
    padded = np.zeros(n + reach, np.int64)
    padded[:n] = data.astype(np.int64) + 1
    key = padded[:n]
    for i in range(1, reach):
        key = (key << bits) | padded[i : n + i]
    order, rank = _ranked(key, reach >= depth)
    while reach < depth:
        step = min(reach, depth - reach)
        ahead = np.zeros(n, np.int64)
        ahead[: n - step] = rank[step:] + 1
        reach += step
        order, rank = _ranked(rank * (n + 1) + ahead, reach >= depth)
    return order, rank


def _ranked(key: np.ndarray, last: bool) -> tuple[np.ndarray, np.ndarray]:
    """Only the last order needs equal keys in the order of their places; the plain sort is faster."""
    order = np.argsort(key, kind="stable" if last else None)
    ordered = key[order]
    rank = np.empty(len(key), np.int64)
    rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])]) if len(key) else 0
    return order, rank


def earlier_copies(order: np.ndarray, rank: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every position: is its longest previous factor as deep as the order, and is there such a match on either side.

    Positions of equal rank stand side by side in the suffix array in the order of the text, so the previous smaller
    position of equal rank is the neighbour before. Only ``starts`` (a mask) count as places of a string.
    """
    line = order[starts[order]]
    ranks = rank[line]
    same = ranks[1:] == ranks[:-1]
    before, beside = np.zeros(len(order), bool), np.zeros(len(order), bool)
    before[line[1:]] = same
    beside[line[1:]] |= same
    beside[line[:-1]] |= same
    return before, beside


def previous_factors(data: bytes) -> list[int]:
    """The longest previous factor of every position of a short text: the longest match that starts earlier.

    In suffix order, the nearest smaller positions on both sides give the two candidates.
    """
    codes = np.frombuffer(data, np.uint8)
    order = suffix_order(codes, max(len(data), 1))[0].tolist() if data else []
    n, stack = len(data), []
    previous, following = [-1] * n, [-1] * n
    for position in order:
        while stack and stack[-1] > position:
            following[stack.pop()] = position
        previous[position] = stack[-1] if stack else -1
        stack.append(position)

    def common(i: int, j: int) -> int:
        k = 0
        while j >= 0 and i + k < n and data[i + k] == data[j + k]:
            k += 1
        return k

    return [max(common(i, previous[i]), common(i, following[i])) for i in range(n)]


def _intervals(mask: np.ndarray, begins: np.ndarray) -> pa.ListArray:
    """First and last positions of the true runs of each block, one after the other, counted from where the block begins."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
    edges[1::2] -= 1
    block = np.searchsorted(begins, edges, "right") - 1
    offsets = np.searchsorted(block, np.arange(len(begins)))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(edges - begins[block], pa.int32()))


SHARD_ROW = (
    "anchor long, cover long, later array<int>, any array<int>, "
    "cores array<struct<slot: int, core: binary, parts: array<struct<part: int, inner: binary, "
    "strings: array<struct<cover: long, at: int, text: binary>>>>>>"
)
STRING = pa.struct([("cover", pa.int64()), ("at", pa.int32()), ("text", pa.binary())])
PART = pa.struct([("part", pa.int32()), ("inner", pa.binary()), ("strings", pa.list_(STRING))])
CORE = pa.struct([("slot", pa.int32()), ("core", pa.binary()), ("parts", pa.list_(PART))])


def _cores(raw: bytes, fresh: np.ndarray, settings: Repeats) -> Iterator[tuple[int, bytes, list[tuple[int, bytes, list[int]]]]]:
    """The strings that start at ``fresh`` (not empty) in slots of their distance to the anchor, and in parts of the slots: slot,
    digest of what the slot's strings have in common, and for each part its number, the same digest and the starts.

    Equal strings have their anchor at equal distances, so they share slot, part and both digests; one that no other shard has
    settles all strings below it at once. A slot has about as many parts as a part has strings.
    """
    data = np.frombuffer(raw, _unit_type(settings))
    width, slots = data.itemsize, max(settings.length // 6, 1)
    parts = max(round(slots**0.5), 1)
    with np.errstate(over="ignore"):
        place = int(_least_places(data[: settings.length], settings)[0][0])
    distance = place - fresh

    def common(least: int, most: int) -> bytes:  # strings of these distances share what the last one has of the first one
        return xxhash.xxh3_128_digest(raw[(place - least) * width : (place - most + settings.length) * width])

    slot = distance // slots
    for one in np.unique(slot).tolist():
        low, high = one * slots, (one + 1) * slots - 1
        own = fresh[slot == one]
        part = (place - own - low) // parts
        inner = [
            (k, common(low + k * parts, min(low + (k + 1) * parts - 1, high)), own[part == k].tolist())
            for k in np.unique(part).tolist()
        ]
        yield one, common(low, high), inner


def _factors(blocks: DataFrame, settings: Repeats) -> DataFrame:
    """Per block (anchor, cover, salt, id, tag, first, bytes, parts, copies): starts with an earlier copy, starts with any copy.

    Starts are counted from the block's first. Of an anchor dealt to several shards, each shard also returns the strings without
    an earlier copy in it, as digests under its distinct cores and their parts (see ``_cores``); they stand with the core's first block.
    """
    length, unit = settings.length, _unit_type(settings)
    width = unit.itemsize

    def search(batches):
        for table in whole_groups(batches, ["anchor", "salt"]):
            sizes = np.array([len(x) // width for x in table.column("bytes").to_pylist()])
            edges = np.append(np.flatnonzero(table.column("edge").to_numpy()), len(table))
            groups = np.add.reduceat(sizes + 1, edges[:-1])
            first = 0
            while first < len(groups):  # several small groups share one suffix array
                last = first + 1
                total = groups[first]
                while last < len(groups) and total + groups[last] <= settings.shard:
                    total += groups[last]
                    last += 1
                yield one(table.slice(edges[first], edges[last] - edges[first]))
                first = last

    def one(table: pa.Table) -> pa.RecordBatch:
        # Groups of one anchor may have come together: what is earlier is decided by the places alone.
        table = table.sort_by([(name, "ascending") for name in ("id", "tag", "first")])
        raw = table.column("bytes").to_pylist()
        shared = [p > 1 for p in table.column("parts").to_pylist()]
        sizes = np.array([len(x) // width for x in raw])
        begins = np.concatenate([[0], np.cumsum(sizes + 1)])
        data = np.zeros(begins[-1], np.int64)
        starts = np.zeros(begins[-1], bool)
        codes, end = np.frombuffer(b"".join(raw), unit), 256
        if settings.words:
            known, codes = np.unique(codes, return_inverse=True)
            end = len(known)
        for i, (size, at) in enumerate(zip(sizes.tolist(), begins.tolist(), strict=False)):
            data[at : at + size] = codes[at - i : at - i + size]
            data[at + size] = end  # strings end before it
            starts[at : at + size - length + 1] = True
        order, rank = suffix_order(data, length)
        before, beside = earlier_copies(order, rank, starts)
        cores, known_cores = [], {}
        anchors, covers = table.column("anchor").to_pylist(), table.column("cover").to_pylist()
        for i, at in enumerate(begins[:-1].tolist()):
            count = int(sizes[i]) - length + 1
            cores.append([])
            fresh = np.flatnonzero(~before[at : at + count]) if shared[i] else ()
            for slot, core, parts in _cores(raw[i], fresh, settings) if len(fresh) else ():
                held = known_cores.get((anchors[i], slot, core))
                if held is None:
                    held = known_cores[anchors[i], slot, core] = {}
                    cores[i].append({"slot": slot, "core": core, "parts": held})
                for part, inner, found in parts:
                    strings = held.setdefault((part, inner), [])
                    for s in found:
                        text = xxhash.xxh3_128_digest(raw[i][s * width : (s + length) * width])
                        strings.append({"cover": covers[i], "at": s, "text": text})
        for core in (core for block in cores for core in block):
            core["parts"] = [{"part": part, "inner": inner, "strings": strings} for (part, inner), strings in core["parts"].items()]
        return pa.RecordBatch.from_arrays(
            [
                table.column("anchor").combine_chunks(), table.column("cover").combine_chunks(),
                _intervals(before, begins), _intervals(beside, begins),
                pa.array(cores, pa.list_(CORE)),
            ],
            ["anchor", "cover", "later", "any", "cores"],
        )

    dealt = blocks.repartition("anchor", "salt").sortWithinPartitions("anchor", "salt", "id", "tag", "first")
    return mapped(dealt, search, SHARD_ROW)


def _blocks(kinds: DataFrame, texts: DataFrame, settings: Repeats) -> DataFrame:
    """The bytes of one run of each (anchor, cover), read from the first text that has it."""
    length = settings.length
    wanted = kinds.groupBy("id", "tag").agg(
        F.sort_array(F.collect_list(F.struct("first", "last", "anchor", "cover", "salt", "parts"))).alias("runs")
    )
    slices = pa.list_(pa.binary())

    def cut(batches):
        for batch in batches:
            raw, wanted = [], iter(batch.column("runs").to_pylist())
            for data, bounds in _units(A.Texts.of(batch.column("text")), settings):
                for low, runs in zip(bounds[:-1].tolist(), wanted, strict=False):
                    raw.append([data[low + r["first"] : low + r["last"] + length].tobytes() for r in runs])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("tag"), batch.column("runs"), pa.array(raw, slices)],
                ["id", "tag", "runs", "raw"],
            )

    joined = texts.dropDuplicates(["id", "tag"]).join(wanted, ["id", "tag"]).select("id", "tag", "runs", "text")
    run = "array<struct<first: int, last: int, anchor: long, cover: long, salt: int, parts: int>>"
    out = mapped(joined, cut, f"id long, tag long, runs {run}, raw array<binary>")
    pairs = out.select("id", "tag", F.explode(F.arrays_zip("runs", "raw")).alias("x"))
    return pairs.select("id", "tag", "x.runs.*", F.col("x.raw").alias("bytes"))


# -- the operator --------------------------------------------------------------------------------------
def _removals(docs: DataFrame, settings: tuple[Repeats, ...], copies: str) -> DataFrame:
    """Columns of ``docs`` as ``row`` and the removed starts of its runs, as pairs of first and last start.

    ``kind`` is the number of the settings that a run belongs to.
    """
    if copies not in ("later", "all"):
        raise ValueError("copies is 'later' or 'all'")
    small_batches(docs.sparkSession)
    keyed = docs.select(F.struct("*").alias("row")).select(
        "row",
        F.coalesce(F.col("row.doc_id").cast("long"), F.lit(-(1 << 63))).alias("id"),
        F.xxhash64("row.text").alias("tag"),
    )
    texts = keyed.select("id", "tag", F.col("row.text").alias("text"))
    marked = [_marked(texts, one, copies == "all").select(F.lit(kind).alias("kind"), "*") for kind, one in enumerate(settings)]
    together = reduce(DataFrame.unionAll, marked)
    by_text = together.groupBy("id", "tag").agg(F.collect_list(F.struct("kind", "first", "starts")).alias("removed"))

    return keyed.join(by_text, ["id", "tag"], "left").select("row", "removed")


def _marked(texts: DataFrame, settings: Repeats, every: bool) -> DataFrame:
    """(id, tag, first, starts) of the runs of ``texts`` (id, tag, text) that have starts to remove."""
    least = 2 * settings.length - 1 if settings.words else settings.length
    runs = stage(_runs(texts.where(f"octet_length(text) >= {least}"), settings), "runs")

    anchors = runs.groupBy("anchor").agg(
        F.count("*").alias("times"), F.min("cover").alias("low"), F.max("cover").alias("high")
    ).where("times > 1")
    # A stored side keeps the aggregate out of the join's stage, so that a hot anchor's rows can be split.
    known = stage(anchors.select("anchor", F.expr("low <> high").alias("mixed")), "anchors")
    repeated = stage(runs.join(known, "anchor"), "repeated")
    place = F.struct("id", "tag", "first", "last")
    kinds = repeated.groupBy("anchor", "cover", "mixed").agg(F.min(place).alias("least"), F.count("*").alias("times"))
    kinds = stage(kinds.select("anchor", "cover", "mixed", "times", "least.*"), "kinds")

    mixed = kinds.where("mixed")
    parts = mixed.groupBy("anchor").agg(F.ceil(F.count("*") / settings.runs_per_shard).cast("int").alias("parts"))
    dealt = mixed.join(parts, "anchor").withColumn("salt", F.expr("pmod(cover, parts)").cast("int"))
    blocks = _blocks(dealt, texts, settings)
    factors = stage(_factors(blocks, settings), "factors")

    # Strings of the anchors that several shards hold: which of them occur in another shard, and where first. Only strings
    # whose core another shard has too are compared: first by parts of the core's slot, then one by one.
    def met(rows: DataFrame, *keys: str) -> DataFrame:
        return rows.join(rows.groupBy(*keys).agg(F.count("*").alias("shards")).where("shards > 1").drop("shards"), list(keys))

    split = factors.where("size(cores) > 0").select("anchor", F.explode("cores").alias("c")).select("anchor", "c.*")
    parts = met(split, "anchor", "slot", "core").select("anchor", "slot", F.explode("parts").alias("p"))
    near = met(stage(parts.select("anchor", "slot", "p.*"), "parts"), "anchor", "slot", "part", "inner")
    near = near.select("anchor", F.explode("strings").alias("s")).select("anchor", "s.*")
    place = F.struct("id", "tag", F.col("first") + F.col("at"))
    strings = near.join(kinds, ["anchor", "cover"]).select("anchor", "cover", "at", "text", place.alias("place"))
    strings = stage(strings, "strings")
    held = strings.groupBy("anchor", "text").agg(F.count("*").alias("shards"), F.min("place").alias("least"))
    crossing = strings.join(held.where("shards > 1"), ["anchor", "text"])
    crossing = crossing if every else crossing.where("place <> least")
    crossed = crossing.groupBy("anchor", "cover").agg(F.flatten(F.collect_list(F.array("at", "at"))).alias("more"))

    # Starts to remove, as pairs of first and last counted from the run's first start.
    whole = F.array(F.lit(0), F.col("last") - F.col("first"))
    none = F.expr("cast(array() as array<int>)")
    found = (
        kinds.join(factors.select("anchor", "cover", F.col("any" if every else "later").alias("starts")), ["anchor", "cover"], "left")
        .join(crossed, ["anchor", "cover"], "left")
        .select(
            "anchor", "cover", F.struct("id", "tag", "first").alias("least"),
            F.when(F.lit(every) & (F.col("times") > 1), whole)
            .otherwise(F.concat(F.coalesce("starts", none), F.coalesce("more", none))).alias("starts"),
        )
    )
    where = repeated.join(stage(found, "found"), ["anchor", "cover"])
    first = F.struct("id", "tag", "first") == F.col("least")
    starts = F.col("starts") if every else F.when(first, F.col("starts")).otherwise(whole)
    return where.select("id", "tag", "first", starts.alias("starts")).where("size(starts) > 0")


def _spans(removed: list[dict] | None, data: np.ndarray, settings: tuple[Repeats, ...]) -> list[list[int]]:
    """Byte spans that the strings at the removed starts cover, in order, joined where they touch.

    ``data`` has the bytes of the text; spans of words go from the first byte of the first one to the end of the last.
    """
    covered: list[tuple[int, int]] = []
    words = None
    for r in removed or []:
        length = settings[r["kind"]].length
        for a, b in zip(r["starts"][::2], r["starts"][1::2], strict=True):
            low, high = r["first"] + a, r["first"] + b + length
            if settings[r["kind"]].words:
                words = words or A.words(A.Texts(data, np.array([0, len(data)])), A.NOT_SPACE, AS_WRITTEN)
                low, high = int(words.starts[low]), int(words.ends[high - 1])
            covered.append((low, high))
    spans: list[list[int]] = []
    for low, high in sorted(covered):
        if spans and low <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], high)
        else:
            spans.append([low, high])
    return spans


SPAN = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))


def _several(settings: Repeats | tuple[Repeats, ...]) -> tuple[Repeats, ...]:
    return (settings,) if isinstance(settings, Repeats) else tuple(settings)


def repeated_spans(docs: DataFrame, settings: Repeats | tuple[Repeats, ...] = Repeats(), copies: str = "later") -> DataFrame:  # noqa: B008
    """Columns of ``docs`` as ``row`` and ``found.spans``: the removed byte spans (from, to) in order, never touching.

    ``docs`` has doc_id and text. Texts are taken in the order of doc_id (NULL first), texts of one doc_id in the order of a
    hash; NULL and short texts have no spans. Rows equal in doc_id and text are two copies for ``copies="all"`` and one
    document for ``copies="later"``. Extra columns stay in ``row`` and clash with nothing.
    """
    every = _several(settings)

    def spans(column: pa.Array) -> list[pa.Array]:
        texts = A.Texts.of(column.field("text"))
        found = [_spans(removed, texts.one(i), every) for i, removed in enumerate(column.field("removed").to_pylist())]
        return [pa.array([[{"from": a, "to": b} for a, b in x] for x in found], SPAN)]

    joined = _removals(docs, every, copies)
    both = joined.select("row", F.struct(F.col("row.text").alias("text"), "removed").alias("x"))
    done = annotate(both, spans, "spans array<struct<`from`: long, `to`: long>>", "x", ["row"])
    return done.select("row.row", "found")


KEPT = "text string, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_beside long"


def _kept(
    docs: DataFrame, settings: tuple[Repeats, ...], copies: str, keep: list[str] | None = None, beside: tuple[Repeats, ...] = ()
) -> DataFrame:
    """``docs`` as ``row`` and what is left of every text as ``found``; its text is NULL where nothing is removed.

    A character cut in two leaves U+FFFD in the text. ``n_beside`` counts the bytes that repeats by the settings ``beside`` cover;
    these are reported and not removed.
    """
    every = (*settings, *beside)

    def cut(column: pa.Array) -> list[pa.Array]:
        texts = A.Texts.of(column.field("text"))
        left, sizes, gone, counts, digests, reported = [], [], [], [], [], []
        for i, removed in enumerate(column.field("removed").to_pylist()):
            data, at, parts = texts.one(i).tobytes(), 0, []
            spans = _spans([r for r in removed or [] if r["kind"] < len(settings)], texts.one(i), every)
            others = _spans([r for r in removed or [] if r["kind"] >= len(settings)], texts.one(i), every)
            reported.append(sum(last - first for first, last in others))
            for first, last in spans:
                parts.append(data[at:first])
                at = last
            rest = b"".join([*parts, data[at:]])
            left.append(rest.decode("utf-8", "replace") if spans else None)
            sizes.append(len(data))
            gone.append(len(data) - len(rest))
            counts.append(len(spans))
            digests.append(hashlib.sha256(rest).hexdigest())
        numbers = [pa.array(x, pa.int64()) for x in (sizes, gone, counts)]
        return [pa.array(left, pa.large_string()), *numbers, pa.array(digests, pa.string()), pa.array(reported, pa.int64())]

    joined = _removals(docs, every, copies)
    kept = F.struct(*[F.col(f"row.`{name}`").alias(name) for name in keep]) if keep else F.col("row")
    both = joined.select(kept.alias("row"), F.struct(F.col("row.text").alias("text"), "removed").alias("x"))
    return annotate(both, cut, KEPT, "x", ["row"]).select("row.row", "found")


def removed(
    docs: DataFrame,
    settings: Repeats | tuple[Repeats, ...] = Repeats(),  # noqa: B008
    copies: str = "all",
    beside: Repeats | None = None,
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row of ``docs``; see ``repeated_spans``.

    With ``beside`` the column ``n_passage_bytes`` counts the bytes that repeats by these other settings cover; they are not removed.
    """
    others = () if beside is None else (beside,)
    found = _kept(docs.select("doc_id", "text"), _several(settings), copies, ["doc_id"], others)
    more = [F.col("found.n_beside").alias("n_passage_bytes")] if others else []
    return found.select("row.doc_id", "found.n_bytes", "found.n_removed", "found.n_spans", "found.kept_sha256", *more)


def without_repeats(
    docs: DataFrame,
    settings: Repeats | tuple[Repeats, ...] = Repeats(),  # noqa: B008
    copies: str = "later",
) -> DataFrame:
    """``docs`` with the repeated strings cut out of ``text`` and ``n_chars`` (if there) counted anew.

    Texts without a span stay as they are; rows whose whole text goes stay with an empty text.
    """
    found = _kept(docs, _several(settings), copies)
    columns = [
        F.coalesce("found.text", "row.text").alias(name) if name == "text"
        else F.coalesce(F.length("found.text").cast("long"), F.col("row.n_chars")).alias(name) if name == "n_chars"
        else F.col(f"row.`{name}`")
        for name in docs.columns
    ]
    return found.select(*columns)
