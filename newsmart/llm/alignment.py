"""Alignment of two tokenizers over a corpus, as column steps over Arrow batches.

Every text is encoded twice. Token lengths in bytes, summed up inside each text, give the byte at which every token ends. Ends that
both encodings share (a hash join on text and end) cut the tokens into groups; the ends of either cut a text into stretches,
each inside one token of both, and so each a link of these two.

The count of a pair of ids is the number of texts that link it, over the whole corpus: partial counts of each task
(Arrow's group-by) are added up by Spark. Pairs with more than 1 / ``HOT`` of all counted links are at most ``HOT`` and go to every
task; links of the other pairs, none of which is frequent, meet their counts in a shuffle.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmart.llm import text_arrays as A
from newsmart.llm.bpe import _byte_alphabet
from newsmart.llm.tables import annotate, mapped, small_batches, stage, worker_state

#: Bytes of texts that are encoded in one step, or one longer text.
PIECE = 1 << 19
#: Rows of partial counts that a task holds.
HELD = 1 << 20
HOT = 1 << 15
SPACE = "▁"


class Tokenizers:
    """A byte-level BPE file (A) and a piece model with byte fallback (B), as bytes that travel with the functions."""

    def __init__(self, path_a: str, path_b: str):
        self.file_a, self.file_b = Path(path_a).read_text(), Path(path_b).read_bytes()
        self.key = hashlib.sha256(self.file_a.encode() + self.file_b).hexdigest()

    def loaded(self) -> Loaded:
        return worker_state("alignment", self.key, lambda: Loaded(self.file_a, self.file_b))


class Loaded:
    """Both tokenizers in a Python worker, and what their ids stand for."""

    def __init__(self, file_a: str, file_b: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(file_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = SentencePieceProcessor(model_proto=file_b)
        alphabet, told = _byte_alphabet(), json.loads(file_a)
        plain = {t["content"] for t in told["added_tokens"]}
        vocabulary = {i: t.encode() if t in plain else bytes(alphabet[c] for c in t) for t, i in told["model"]["vocab"].items()}
        self.bytes_a = pa.array([vocabulary.get(i, b"") for i in range(max(vocabulary) + 1)], pa.large_binary())
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = pa.array(
            [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)],
            pa.large_binary(),
        )
        self.size_a, self.size_b = (pc.binary_length(x).to_numpy() for x in (self.bytes_a, self.bytes_b))
        #: Every id as decimal text with each of the signs that may follow it.
        self.shown = pa.array([f"{i}{sign}" for i in range(max(len(self.size_a), len(self.size_b))) for sign in ",|;"], pa.large_binary())

    def ids(self, texts: list[str]) -> tuple[pa.ListArray, pa.ListArray]:
        encoded = self.a.encode_batch_fast([" " + text for text in texts], add_special_tokens=False)
        kind = pa.list_(pa.int32())
        return pa.array([x.ids for x in encoded], kind), pa.array(self.b.encode(texts, num_threads=1), kind)


def _data(values: pa.Array) -> np.ndarray:
    """The bytes of all values one after the other."""
    return A.Texts.of(values).data


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of integers over each part of an array."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _bounds(lists: pa.ListArray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)


@dataclass
class Side:
    """The tokens of some texts by one tokenizer."""

    lists: pa.ListArray
    size: np.ndarray
    spelled: pa.Array

    @cached_property
    def ids(self) -> np.ndarray:
        return pc.list_flatten(self.lists).to_numpy()

    @cached_property
    def text(self) -> np.ndarray:
        """The number of every token's text."""
        return pc.list_parent_indices(self.lists).to_numpy()

    @cached_property
    def bounds(self) -> np.ndarray:
        return _bounds(self.lists)

    @cached_property
    def all_ends(self) -> np.ndarray:
        """The byte after every token, counted over all texts."""
        return np.cumsum(self.size[self.ids], dtype=np.int64)

    @cached_property
    def ends(self) -> np.ndarray:
        """The byte after every token, counted inside its text."""
        before = np.concatenate([[0], self.all_ends])[self.bounds[:-1]]
        return self.all_ends - before[self.text]

    @property
    def lengths(self) -> np.ndarray:
        """Bytes of all tokens of each text."""
        return _sums(self.size[self.ids], self.bounds)

    @property
    def data(self) -> np.ndarray:
        return _data(self.spelled.take(pa.array(self.ids)))

    def only(self, mask: np.ndarray) -> Side:
        return Side(self.lists.filter(pa.array(mask)), self.size, self.spelled)


class Aligned:
    """Groups and links of the texts that both tokenizers spell out byte by byte; ``valid`` says which these are."""

    def __init__(self, texts: list[str | None], loaded: Loaded):
        filled = [text or "" for text in texts]
        lists = loaded.ids(filled)
        a, b = Side(lists[0], loaded.size_a, loaded.bytes_a), Side(lists[1], loaded.size_b, loaded.bytes_b)
        spaced = pa.array([" " + text for text in filled], pa.large_string())
        sizes = pc.binary_length(spaced).to_numpy()
        valid = (sizes > 1) & (a.lengths == sizes) & (b.lengths == sizes)
        wanted, ends = _data(spaced.filter(pa.array(valid))), np.cumsum(sizes[valid])
        wrong = np.zeros(len(ends), bool)
        for side in (a, b):
            wrong[np.searchsorted(ends, np.flatnonzero(side.only(valid).data != wanted), "right")] = True
        valid[np.flatnonzero(valid)[wrong]] = False
        self.valid, self.a, self.b, self.loaded = valid, a.only(valid), b.only(valid), loaded
        self.n_bytes = int(sizes[valid].sum())

    @cached_property
    def shared(self) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of either side that end a group, as masks."""
        tables = [
            pa.table({"text": side.text, "end": side.ends, name: np.arange(len(side.ids))}) for name, side in (("a", self.a), ("b", self.b))
        ]
        both = tables[0].join(tables[1], ["text", "end"], join_type="inner", use_threads=False)
        masks = []
        for name, side in (("a", self.a), ("b", self.b)):
            mask = np.zeros(len(side.ids), bool)
            mask[both.column(name).to_numpy()] = True
            masks.append(mask)
        return masks[0], masks[1]

    def group_lists(self) -> pa.ListArray:
        """The groups of every text, each with the ids of both sides."""
        parts = []
        for side, ended in zip((self.a, self.b), self.shared, strict=True):
            cuts = np.concatenate([[0], np.flatnonzero(ended) + 1])
            parts.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(side.ids, pa.int32())))
        groups = pa.StructArray.from_arrays(parts, ["a", "b"])
        cuts = np.concatenate([[0], np.cumsum(_sums(self.shared[0], self.a.bounds))])
        return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), groups)

    def group_digests(self) -> list[str]:
        """SHA-256 of the groups as text: ``a1,a2|b1;a3|b2,b3``."""
        ended_a, ended_b = self.shared
        group_a, group_b = np.cumsum(ended_a) - ended_a, np.cumsum(ended_b) - ended_b
        ends_a, begins_b = np.flatnonzero(ended_a) + 1, np.concatenate([[0], np.flatnonzero(ended_b) + 1])
        signs = np.empty(len(group_a) + len(group_b), np.int64)
        signs[np.arange(len(group_a)) + begins_b[group_a]] = self.a.ids.astype(np.int64) * 3 + ended_a
        signs[np.arange(len(group_b)) + ends_a[group_b]] = self.b.ids.astype(np.int64) * 3 + 2 * ended_b
        shown = A.Texts.of(self.loaded.shown.take(pa.array(signs)))
        raw, cuts = shown.data, shown.bounds[self.a.bounds + self.b.bounds].tolist()
        return [hashlib.sha256(raw[x : y - 1]).hexdigest() for x, y in zip(cuts[:-1], cuts[1:], strict=True)]

    def pairs(self) -> tuple[np.ndarray, pa.Table]:
        """(links of every text, table of its distinct pairs): ``text``, ``pair`` (A id above B id) and ``times``."""
        ended = np.zeros((2, self.n_bytes + 1), bool)
        for marks, side in zip(ended, (self.a, self.b), strict=True):
            marks[side.all_ends] = True
        ends = np.flatnonzero(ended.any(axis=0))
        at_a, at_b = (np.cumsum(marks, dtype=np.int64)[ends] - marks[ends] for marks in ended)
        text = self.a.text[at_a]
        pair = (self.a.ids[at_a].astype(np.int64) << 32) | self.b.ids[at_b]
        counted = pa.table({"text": text, "pair": pair}).group_by(["text", "pair"], use_threads=False).aggregate([([], "count_all")])
        counted = counted.rename_columns(["text", "pair", "times"]).sort_by([("text", "ascending"), ("pair", "ascending")])
        return np.bincount(text, minlength=len(self.a.lists)), counted


def _placed(values: pa.Array, valid: np.ndarray, missing: pa.Scalar) -> pa.Array:
    """``values`` of the valid texts at their places, ``missing`` at the others."""
    place = np.where(valid, np.cumsum(valid) - 1, len(values))
    return pa.concat_arrays([values, pa.array([missing.as_py()], values.type)]).take(pa.array(place))


def _by_pieces(column: pa.Array, function: Callable[[list[str | None]], list[pa.Array]]) -> list[pa.Array]:
    """``function`` over runs of texts of bounded size, its columns joined again."""
    parts = [function([])]
    for first, piece in A.Texts.of(column).pieces(PIECE):
        parts.append(function(column.slice(first, len(piece)).to_pylist()))
    return [pa.concat_arrays(columns) for columns in zip(*parts, strict=True)]


def groups(docs: DataFrame, tokenizers: Tokenizers) -> DataFrame:
    """``docs`` as column ``row`` and the groups of every whole text as ``found.groups``: the ids of both sides, in order.

    Texts that are NULL, empty, or not spelled out byte by byte by both tokenizers have no groups.
    """

    def find(texts: list[str | None]) -> list[pa.Array]:
        aligned = Aligned(texts, tokenizers.loaded())
        found = aligned.group_lists()
        return [_placed(found, aligned.valid, pa.scalar([], found.type))]

    fields = "groups array<struct<a: array<int>, b: array<int>>>"
    return annotate(docs, lambda column: _by_pieces(column, find), fields)


FOUND = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"


def aligned(docs: DataFrame, tokenizers: Tokenizers) -> DataFrame:
    """(row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times) of every row of ``docs``; ``row`` numbers the rows.

    ``pairs`` are the distinct linked pairs of the text (A id * 2**32 + B id) in order, ``times`` how often each is linked.
    """

    def find(texts: list[str | None]) -> list[pa.Array]:
        found = Aligned(texts, tokenizers.loaded())
        n_links, pairs = found.pairs()
        cuts = pa.array(np.searchsorted(pairs.column("text").to_numpy(), np.arange(len(n_links) + 1)), pa.int32())
        numbers = [np.diff(found.a.bounds), np.diff(found.b.bounds), _sums(found.shared[0], found.a.bounds), n_links]
        columns = [pa.array(n, pa.int64()) for n in numbers]
        lists = [
            pa.ListArray.from_arrays(cuts, pairs.column(name).combine_chunks().cast(kind))
            for name, kind in (("pair", pa.int64()), ("times", pa.int32()))
        ]
        return [
            *(_placed(column, found.valid, pa.scalar(0)) for column in columns),
            _placed(pa.array(found.group_digests(), pa.string()), found.valid, pa.scalar("")),
            *(_placed(column, found.valid, pa.scalar([], column.type)) for column in lists),
        ]

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = annotate(numbered, lambda column: _by_pieces(column, find), FOUND, "text", ["row", "doc_id"])
    return found.select("row.*", "found.*")


def pair_counts(found: DataFrame) -> DataFrame:
    """(pair, n, best): the number of texts that link each pair, and whether no pair of the same A id has more."""

    def partial(batches):
        held: list[pa.Table] = []

        def added() -> pa.Table:
            summed = pa.concat_tables(held).group_by("pair", use_threads=False).aggregate([("n", "sum")])
            return summed.select(["pair", "n_sum"]).rename_columns(["pair", "n"])

        for batch in batches:
            flat = pa.table({"pair": pc.list_flatten(batch.column("pairs"))})
            counted = flat.group_by("pair", use_threads=False).aggregate([([], "count_all")])
            held.append(counted.select(["pair", "count_all"]).rename_columns(["pair", "n"]))
            if sum(map(len, held)) > HELD:
                held = [added()]
                if len(held[0]) > HELD // 2:
                    yield from held.pop().to_batches()
        if held:
            yield from added().to_batches()

    counts = mapped(found.select("pairs"), partial, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = stage(counts, "counts")
    a = F.shiftright("pair", 32)
    most = counts.groupBy(a.alias("a")).agg(F.max("n").alias("most"))
    # One row for each id of A: its vocabulary bounds the size.
    return counts.join(F.broadcast(most), a == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _with_hot(found: DataFrame, hot: pa.Table) -> DataFrame:
    """``found`` with ``hot_sum`` and ``hot_best`` over the links of the frequent pairs, and ``rest``, its other links."""
    pair, n, best = (hot.column(name).to_numpy() for name in ("pair", "n", "best"))

    def split(batches):
        for batch in batches:
            lists = batch.column("pairs")
            bounds, flat = _bounds(lists), pc.list_flatten(lists).to_numpy()
            times = pc.list_flatten(batch.column("times")).to_numpy().astype(np.int64)
            at = np.minimum(np.searchsorted(pair, flat), max(len(pair) - 1, 0))
            hit = pair[at] == flat if len(pair) else np.zeros(len(flat), bool)
            known, worth = (n[at], best[at]) if len(pair) else (np.zeros(len(flat), np.int64), hit)
            cuts = np.concatenate([[0], np.cumsum(_sums(~hit, bounds))])
            rest = pa.StructArray.from_arrays([pa.array(flat[~hit]), pa.array(times[~hit])], ["pair", "times"])
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(name) for name in names), pa.array(_sums(times * known * hit, bounds)),
                    pa.array(_sums(times * worth * hit, bounds)), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), rest),
                ],
                [*names, "hot_sum", "hot_best", "rest"],
            )

    names = [name for name in found.columns if name not in ("pairs", "times")]
    kept = ", ".join(f"{name} {kind}" for name, kind in found.dtypes if name in names)
    return found.mapInArrow(split, f"{kept}, hot_sum long, hot_best long, rest array<struct<pair: long, times: long>>")


def alignment(docs: DataFrame, tokenizers: Tokenizers) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of ``docs`` (columns doc_id, text).

    ``n_best`` counts the links whose pair no other pair of the same A id exceeds in count, ``count_sum`` adds up the counts of all
    links. Every row counts as a text of its own, so repeated rows and equal or NULL doc_ids change nothing else. Texts that
    are NULL, empty, or not spelled out byte by byte by both tokenizers have zeros and an empty ``groups_sha256``. Strings of special
    tokens are plain text. Other columns are ignored. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    found = stage(aligned(docs, tokenizers), "aligned")
    counts = stage(pair_counts(found), "pairs")
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = counts.where(F.col("n") * HOT > total).orderBy("pair").toArrow()
    scored = stage(_with_hot(found, hot), "scored")
    links = scored.select("row", F.explode("rest").alias("x")).select("row", "x.*")
    rest = links.join(counts, "pair").groupBy("row").agg(
        F.sum(F.col("times") * F.col("n")).alias("more"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("better")
    )
    sums = stage(rest, "sums")
    return scored.join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("hot_best") + F.coalesce("better", F.lit(0))).alias("n_best"),
        (F.col("hot_sum") + F.coalesce("more", F.lit(0))).alias("count_sum"), "groups_sha256",
    )
