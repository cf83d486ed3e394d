"""Benchmark decontamination with suffix arrays over the training texts.

The training side is cut into shards (a few megabytes of consecutive texts inside a task). A shard's words become
numbers of the benchmark's vocabulary, and its suffix array holds the word positions from which a verbatim match could start
(all words that follow, as far as the shortest window, are in the vocabulary; other suffixes can match nothing), sorted by
the words that follow. Every suffix of every benchmark item is binary-searched in it, and each range found gives the
verbatim matches and their places. Overlapping matches of an item join to its longest ones.

Only the benchmark is sent to the tasks, in blocks of bounded size; training rows are neither shuffled nor collected.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmart.llm import text_arrays as A
from newsmart.llm.tables import annotate, stage

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER_CASE = {c: c + 32 for c in range(0x41, 0x5B)}
SHARD = 4 << 20


@dataclass(frozen=True)
class Contamination:
    """``window`` consecutive item words make a window. A document with hit words is contaminated if ``share`` times
    the number of hit words reaches the number of its words. ``block`` bounds the characters of benchmark text that are
    sent to the tasks at once; a larger benchmark is worked off in several passes."""

    window: int = 13
    share: int = 20
    block: int = 8_000_000


class Suffixes:
    """The windows of a block of benchmark items, by length, ready for binary search."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.names = [name for name, _ in items]
        texts = [text.translate(LOWER_CASE) for _, text in items]
        found = [[w.encode() for w in WORD.findall(text)] for text in texts]
        vocabulary = sorted({w for ws in found for w in ws})
        hashed = A.words(A.Texts.of(pa.array([" ".join(w.decode() for w in vocabulary)])), A.ALNUM).hashes
        order = np.argsort(hashed)
        self.vocabulary = hashed[order]
        self.spelled = [vocabulary[i] for i in order.tolist()]
        number = {w: n + 1 for n, w in enumerate(self.spelled)}
        windows: dict[int, dict[tuple, set[int]]] = {}
        for item, ws in enumerate(found):
            ids = tuple(number[w] for w in ws)
            length = min(window, len(ids))
            for i in range(len(ids) - length + 1 if length else 0):
                windows.setdefault(length, {}).setdefault(ids[i : i + length], set()).add(item)
        self.windows = {}
        for length, known in windows.items():
            keys = np.array(sorted(known), ">u4").reshape(-1, length)
            owners = [sorted(known[tuple(k)]) for k in keys.tolist()]
            self.windows[length] = (_packed(keys), keys, owners, np.unique(keys[:, 0]))


def _packed(keys: np.ndarray) -> np.ndarray:
    """Rows of word numbers as byte strings that sort alike."""
    return np.ascontiguousarray(keys, ">u4").view(f"S{4 * keys.shape[1]}").ravel()


def _matches(shard: A.Texts, found: A.Words, suffixes: Suffixes) -> list[tuple[int, int, list[int]]]:
    """(first word, number of words, items) of every window that occurs in the shard."""
    at = np.minimum(np.searchsorted(suffixes.vocabulary, found.hashes), max(len(suffixes.vocabulary) - 1, 0))
    ids = np.where(suffixes.vocabulary[at] == found.hashes, at + 1, 0).astype(np.uint32)
    known = np.concatenate([[0], np.cumsum(ids > 0)])
    end = np.repeat(found.bounds[1:], np.diff(found.bounds))
    out = []
    for length, (wanted, keys, owners, firsts) in suffixes.windows.items():
        starts = np.flatnonzero(ids[: len(ids) - length + 1]) if len(ids) >= length else np.zeros(0, np.int64)
        starts = starts[(known[starts + length] - known[starts] == length) & (starts + length <= end[starts])]
        if length < 3:  # hardly any other word follows, so look at the first one
            place = np.minimum(np.searchsorted(firsts, ids[starts]), len(firsts) - 1)
            starts = starts[firsts[place] == ids[starts]]
        if not len(starts):
            continue
        following = _packed(ids[starts[:, None] + np.arange(length)])
        order = np.argsort(following, kind="stable")
        array, following = starts[order], following[order]
        low, high = np.searchsorted(following, wanted, "left"), np.searchsorted(following, wanted, "right")
        for n in np.flatnonzero(high > low).tolist():
            words = [suffixes.spelled[i - 1] for i in keys[n].tolist()]
            for start in array[low[n] : high[n]].tolist():
                spans = zip(found.starts[start : start + length], found.ends[start : start + length], strict=True)
                if [A.LOWER[shard.data[s:e]].tobytes() for s, e in spans] == words:
                    out.append((start, length, owners[n]))
    return out


def _longest(matches: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(item, first word, number of words) with the overlapping and adjoining windows of an item joined."""
    out: list[list[int]] = []
    for item, start, length in sorted(matches):
        if out and out[-1][0] == item and start <= out[-1][1] + out[-1][2]:
            out[-1][2] = max(out[-1][2], start + length - out[-1][1])
        else:
            out.append([item, start, length])
    return [tuple(x) for x in out]


def _blocks(benchmark: DataFrame, settings: Contamination) -> Iterator[list[tuple[str, str]]]:
    """Benchmark items in blocks of at most ``block`` characters (or one longer item)."""
    block, size = [], 0
    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), "text").orderBy("item", "text")
    for row in rows.toLocalIterator():
        text = row["text"] or ""
        if block and size + len(text) > settings.block:
            yield block
            block, size = [], 0
        block.append((row["item"] or "", text))
        size += len(text)
    if block:
        yield block


FIELDS = "n_words long, matches array<struct<item: string, first: long, words: long>>"
MATCH = pa.struct([("item", pa.string()), ("first", pa.int64()), ("words", pa.int64())])


def _search(docs: DataFrame, items: list[tuple[str, str]], settings: Contamination, keep: list[str] | None) -> DataFrame:
    suffixes = Suffixes(items, settings.window)

    def look(column: pa.Array) -> list[pa.Array]:
        counts, places = [], []
        for _, shard in A.Texts.of(column).pieces(SHARD):
            found = A.words(shard, A.ALNUM)
            counts += np.diff(found.bounds).tolist()
            here: list[list] = [[] for _ in range(len(shard))]
            for start, length, owners in _matches(shard, found, suffixes) if len(suffixes.vocabulary) else []:
                text = int(np.searchsorted(found.bounds, start, "right")) - 1
                here[text] += [(item, start - int(found.bounds[text]), length) for item in owners]
            places += [
                [{"item": suffixes.names[i], "first": s, "words": n} for i, s, n in _longest(x)] if x else [] for x in here
            ]
        return [pa.array(counts, pa.int64()), pa.array(places, pa.list_(MATCH))]

    return annotate(docs, look, FIELDS, "text", keep)


def matches(docs: DataFrame, benchmark: DataFrame, settings: Contamination = Contamination(), keep: list[str] | None = None) -> DataFrame:  # noqa: B008,E501
    """``docs`` as ``row`` and in ``found`` the number of words and the longest verbatim matches of benchmark items.

    A match has the item, the number of its first word in the document (from 0) and its length in words. Benchmark rows with
    a NULL or wordless text have no windows; a NULL item_id reads as the empty name; rows of one item_id are one item.
    """
    blocks = _blocks(benchmark, settings)
    out = _search(docs, next(blocks, []), settings, keep)
    for block in blocks:
        rest = ["row", "found"]
        again = _search(stage(out.withColumn("text", F.col("row.text")), "matches"), block, settings, [*rest, "text"])
        out = again.select(
            F.col("row.row").alias("row"),
            F.struct(
                F.col("found.n_words").alias("n_words"), F.concat("row.found.matches", "found.matches").alias("matches")
            ).alias("found"),
        )
    return out


def _verdict(found: pa.Array, share: int) -> list[pa.Array]:
    hits, names, digests, bad = [], [], [], []
    total = found.field("n_words").to_pylist()
    for n, places in zip(total, found.field("matches").to_pylist(), strict=True):
        reach = hit = 0
        for first, last in sorted((p["first"], p["first"] + p["words"]) for p in places):
            hit += max(0, last - max(first, reach))
            reach = max(reach, last)
        items = sorted({p["item"] for p in places})
        hits.append(hit)
        names.append(items)
        digests.append(hashlib.sha256(",".join(items).encode()).hexdigest())
        bad.append(hit > 0 and share * hit >= n)
    return [pa.array(total, pa.int64()), pa.array(hits, pa.int64()), pa.array(names, pa.list_(pa.string())),
            pa.array(digests, pa.string()), pa.array(bad, pa.bool_())]


VERDICT = "n_words long, n_hit long, items array<string>, items_sha256 string, contaminated boolean"


def judge(docs: DataFrame, benchmark: DataFrame, settings: Contamination = Contamination(), keep: list[str] | None = None) -> DataFrame:  # noqa: B008,E501
    """``docs`` as ``row`` and in ``found``: n_words, n_hit, items, items_sha256, contaminated.

    A word is hit if it lies in an occurrence of a window. NULL texts, empty texts and texts without a word have no
    words and are not contaminated; an empty benchmark hits nothing. Rows are judged one by one, so repeated rows and ids and
    extra columns change nothing. ``keep`` names the columns of ``row`` (all by default; text is needed for more than one block).
    """
    found = matches(docs, benchmark, settings, keep)
    judged = annotate(found, lambda column: _verdict(column, settings.share), VERDICT, "found", ["row"])
    return judged.select(F.col("row.row").alias("row"), "found")


def contamination(docs: DataFrame, benchmark: DataFrame, settings: Contamination = Contamination()) -> DataFrame:  # noqa: B008
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every row of ``docs``; see ``judge``."""
    return judge(docs.select("doc_id", "text"), benchmark, settings).select(
        "row.doc_id", "found.n_words", "found.n_hit", F.size("found.items").cast("long").alias("n_items"),
        "found.items_sha256", "found.contaminated",
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, settings: Contamination = Contamination()) -> DataFrame:  # noqa: B008
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    return judge(docs, benchmark, settings).where("not found.contaminated").select("row.*")
