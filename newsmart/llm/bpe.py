"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

A text is cut into pieces by the byte-level rule (contractions; letters, digits or other signs with one leading space; white
space). For every prefix of a piece there is exactly one token that ends its encoding. It is found among the vocabulary
entries that end there (all suffix matches come from an automaton over the vocabulary): the entry fits if the prefix before
it is empty, or if the last token of that prefix and the entry may stand side by side. Following the last tokens back
gives the ids. Two tokens may stand side by side if no merge across their border would come first; this is decided from
the tokens that stood at the border while each of the two was built.

The tokenizer file is read on the driver from the path given and is never copied elsewhere.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import unicodedata
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmart.llm.tables import annotate, worker_state

#: Pieces whose ids a worker remembers from recent texts, and as many from those before; also pairs of tokens. Results do
#: not depend on it.
REMEMBERED = 80_000
#: White space as the byte-level rule sees it (Unicode property White_Space). Fixed values.
SPACES = "".join(map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def _ranges(kind: str, last: int) -> str:
    """The characters of a general category (first letter) up to ``last``, as ranges of a character class."""
    marks = np.array([unicodedata.category(chr(c))[0] == kind for c in range(last + 1)])
    edges = np.flatnonzero(np.diff(np.concatenate([[False], marks, [False]]).astype(np.int8)))
    return "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def piece_pattern(last: int) -> str:
    """The byte-level rule for texts without characters above ``last``; short classes are much faster."""
    letters, digits, spaces = _ranges("L", last), _ranges("N", last), re.escape(SPACES)
    return (
        f" [{letters}]+|[{letters}]+|'(?:[stmd]|re|ve|ll)|[{digits}]+| [{digits}]+"
        f"|[^{spaces}{letters}{digits}]+| [^{spaces}{letters}{digits}]+|[{spaces}]+(?![^{spaces}])|[{spaces}]+"
    )


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-in of every byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Tokens, their building pairs and special tokens of a byte-level BPE file."""

    def __init__(self, path: str):
        raw = Path(path).read_bytes()
        told = json.loads(raw)
        model, alphabet = told["model"], _byte_alphabet()
        if model["type"] != "BPE" or told.get("normalizer") or (told.get("pre_tokenizer") or {}).get("type") != "ByteLevel":
            raise ValueError("not a byte-level BPE file without a normalizer")
        if told["pre_tokenizer"].get("add_prefix_space"):
            raise ValueError("files that add a leading space are not supported")
        self.key = hashlib.sha256(raw).hexdigest()
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        self.tokens = {i: bytes(alphabet[c] for c in t) for t, i in model["vocab"].items() if t not in self.special}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merges = [(model["vocab"][x], model["vocab"][y], model["vocab"][x + y]) for x, y in pairs]
        if len({m for _, _, m in self.merges}) != len(self.merges):
            raise ValueError("a token that two merges build has no unique last token per prefix")
        self.patterns = piece_pattern(0xFFFF), piece_pattern(sys.maxunicode)


    def spelled(self) -> dict[int, bytes]:
        """The bytes of every id, special tokens included."""
        return self.tokens | {i: t.encode() for t, i in self.special.items()}


def _ids(column: pa.Array, vocabulary: Vocabulary) -> pa.Array:
    encoder = worker_state("bpe", vocabulary.key, lambda: Encoder(vocabulary))
    return pa.array([encoder.encode(value.as_py() or "") for value in column], pa.large_binary())


def _texts(column: pa.Array, spelled: dict[int, bytes]) -> pa.Array:
    ids = (np.frombuffer(value.as_py() or b"", "<u4").tolist() for value in column)
    return pa.array([b"".join(map(spelled.__getitem__, x)).decode("utf-8", "replace") for x in ids], pa.large_string())


class Encoder(dict):
    """Ids of a piece (as little-endian 32-bit bytes) by the piece; computed where missing."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        super().__init__()
        self.basic, self.full = (re.compile(pattern).findall for pattern in vocabulary.patterns)
        self.beyond = re.compile("[\U00010000-\U0010ffff]").search
        self.rank = {(x, y): n for n, (x, y, _) in enumerate(vocabulary.merges)}
        self.built = {m: (x, y, n) for n, (x, y, m) in enumerate(vocabulary.merges)}
        self.fits: dict[int, bool] = {}
        self.before: dict[str, bytes] = {}
        self.borders: dict[int, tuple[list, list]] = {}
        self.suffixes = ahocorasick.Automaton()
        for token, raw in vocabulary.tokens.items():
            self.suffixes.add_word(raw.decode("latin-1"), (len(raw), token))
        self.suffixes.make_automaton()
        self.packed = {i: i.to_bytes(4, "little") for i in vocabulary.tokens}
        self.special = {t: i.to_bytes(4, "little") for t, i in vocabulary.special.items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def _border(self, token: int) -> tuple[list, list]:
        """What stood at the token's right and left edge while it was built, with the rank of the merge that ended it."""
        known = self.borders.get(token)
        if known is None:
            sides = []
            for side in (1, 0):
                edge, ended, stood = token, len(self.rank), []
                while True:
                    stood.append((edge, ended))
                    made = self.built.get(edge)
                    if made is None:
                        break
                    edge, ended = made[side], made[2]
                sides.append(stood)
            known = self.borders[token] = (sides[0], sides[1])
        return known

    def _fit(self, left: int, right: int) -> bool:
        for x, x_ended in self._border(left)[0]:
            for y, y_ended in self._border(right)[1]:
                rank = self.rank.get((x, y))
                # Of equal merges that overlap the leftmost is made first: it ends x, but y only after this one.
                if rank is not None and rank < x_ended and rank <= y_ended:
                    return False
        return True

    def __missing__(self, piece: str) -> bytes:
        packed = self.before.get(piece) or self._packed(piece)
        if len(self) >= REMEMBERED:
            self.before = dict(self)
            self.clear()
        self[piece] = packed
        return packed

    def _packed(self, piece: str) -> bytes:
        text = piece.encode().decode("latin-1")
        last: list = [None] * (len(text) + 1)
        fits = self.fits
        for end, (length, token) in self.suffixes.iter(text):
            end += 1
            if last[end] is None:
                start = end - length
                if not start:
                    last[end] = (0, token)
                elif last[start] is not None:
                    pair = (last[start][1] << 32) | token
                    good = fits.get(pair)
                    if good is None:
                        good = fits[pair] = self._fit(last[start][1], token)
                    if good:
                        last[end] = (start, token)
        ids, at = [], len(text)
        while at:
            at, token = last[at]
            ids.append(self.packed[token])
        ids.reverse()
        if len(fits) >= 2 * REMEMBERED:
            fits.clear()
        return b"".join(ids)

    def encode(self, text: str) -> bytes:
        find = self.full if self.beyond(text) else self.basic
        if self.cut is None or not any(t in text for t in self.special):
            return b"".join(map(self.__getitem__, find(text)))
        return b"".join(
            self.special[part] if n % 2 else b"".join(map(self.__getitem__, find(part)))
            for n, part in enumerate(self.cut.split(text))
        )


def encode(docs: DataFrame, path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` as column ``row`` and the ids of every whole text as ``found.ids``: little-endian unsigned 32-bit integers.

    NULL and empty texts have no ids (an empty value). ``keep`` names the columns that ``row`` keeps (all by default).
    Special tokens that are spelled out in a text become their ids; none are added.
    """
    vocabulary = Vocabulary(path)

    def ids(column: pa.Array) -> list[pa.Array]:
        return [_ids(column, vocabulary)]

    return annotate(docs, ids, "ids binary", text, keep)


def decode(encoded: DataFrame, path: str, ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """``encoded`` as column ``row`` and the text of every ``ids`` value as ``found.text``.

    Special tokens are spelled out. Bytes that are not UTF-8 become U+FFFD. NULL ids read as none: an empty text.
    """
    vocabulary = Vocabulary(path)
    spelled = vocabulary.spelled()

    def texts(column: pa.Array) -> list[pa.Array]:
        return [_texts(column, spelled)]

    return annotate(encoded, texts, "text string", ids, keep)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row of ``docs`` (columns doc_id, text).

    NULL texts count as empty: no tokens, digests of the empty value. Rows are independent, so repeated rows and
    doc_ids, NULL doc_ids and extra columns change nothing; an empty table gives no rows.
    """
    vocabulary = Vocabulary(path)

    def both(column: pa.Array) -> list[pa.Array]:
        spelled = worker_state("bpe", f"spelled-{vocabulary.key}", vocabulary.spelled)
        ids = _ids(column, vocabulary)
        return [ids, _texts(ids, spelled)]

    # Both ways in one pass: the ids need not leave the task in between.
    found = annotate(docs.select("doc_id", "text"), both, "ids binary, text string", "text", ["doc_id"])
    return found.select("row.doc_id", "found.*").select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
