"""URL rules in a sorted array of 64-bit digests that tasks memory-map and probe by binary search.

The rules are sorted by the xxhash of their full string and written, with the strings, to one file in the shared
folder, which Spark hands to every executor. A task maps it (pages are read as they are touched, so the size of the list does
not matter for memory), digests every host suffix with every path beginning that a rule could have, finds them all with one
vectorised binary search, and compares the stored strings, so that a collision of digests never decides.
"""

from __future__ import annotations

import re
import struct
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmart.llm.tables import annotate, new_folder, worker_state

VERDICTS = ("allow", "block")
ENDS = re.compile(r"[/?#]")
ENDS_PATH = re.compile(r"[?#]")
LOWER_CASE = {c: c + 32 for c in range(0x41, 0x5B)}
#: Numbers of keys, path lengths and string bytes at the head of the file.
HEADER = "<4q"
#: Rules in one index; the driver holds them while it writes the file.
MOST_RULES = 20_000_000


def digest(text: bytes) -> int:
    return xxhash.xxh64_intdigest(text)


def host_and_path(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a url; both empty for NULL and without ``://``."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    end = ENDS.search(rest)
    at = end.start() if end else len(rest)
    return rest[:at].translate(LOWER_CASE), ENDS_PATH.split(rest[at:], maxsplit=1)[0]


def _key(host: str, path: str) -> bytes:
    return f"{host}\0{path}".encode()


def write_index(spark: SparkSession, rules: DataFrame | Iterable[tuple[str, str, str]], digest=digest) -> str:
    """Write the index of ``rules`` (host, path, verdict) to the shared folder and hand it to the executors; its name.

    Of contradictory rules ``block`` holds; rules with a NULL or with another verdict are left out. The driver
    holds the rules while it writes them, so there may be ``MOST_RULES`` of them; more are an error.
    """
    if isinstance(rules, DataFrame):
        rows: Iterator = rules.dropna(subset=["host", "path", "verdict"]).select("host", "path", "verdict").toLocalIterator()
    else:
        rows = iter(rules)
    best: dict[bytes, int] = {}
    for host, path, verdict in rows:
        if verdict in VERDICTS:
            key = _key(host.translate(LOWER_CASE), path)
            best[key] = max(best.get(key, 0), VERDICTS.index(verdict))
            if len(best) > MOST_RULES:
                raise ValueError(f"more than {MOST_RULES} rules")
    order = sorted((digest(key), key) for key in best)
    keys = np.array([d for d, _ in order], "<u8")
    strings = b"".join(key for _, key in order)
    bounds = np.cumsum([0, *(len(key) for _, key in order)]).astype("<i8")
    verdicts = np.array([best[key] for _, key in order], np.uint8)
    lengths = np.array(sorted({len(key.split(b"\0", 1)[1].decode()) for key in best}), "<i8")
    parts = [struct.pack(HEADER, len(keys), len(lengths), len(strings), 0), *(x.tobytes() for x in (keys, bounds, lengths, verdicts)), strings]

    name = f"url-rules-{uuid.uuid4().hex[:12]}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{new_folder(spark, 'urls')}/{name}")
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
    for part in parts:
        for low in range(0, len(part), 1 << 22):
            out.write(part[low : low + (1 << 22)])
    out.close()
    spark.sparkContext.addFile(str(path.toString()))
    return name


class Index:
    """A memory-mapped index file."""

    def __init__(self, file: str):
        raw = np.memmap(file, np.uint8, "r")
        keys, lengths, strings, _ = struct.unpack(HEADER, raw[: struct.calcsize(HEADER)].tobytes())
        at = struct.calcsize(HEADER)

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            size = np.dtype(kind).itemsize * count
            part, at = raw[at : at + size].view(kind), at + size
            return part

        self.keys, self.bounds, self.lengths = take("<u8", keys), take("<i8", keys + 1), take("<i8", lengths).tolist()
        self.verdicts, self.strings = take("u1", keys), take("u1", strings)

    def find(self, wanted: list[bytes], digest=digest) -> list[int | None]:
        """The verdict of every string that is a rule."""
        probes = np.array([digest(w) for w in wanted], np.uint64)
        low, high = np.searchsorted(self.keys, probes, "left"), np.searchsorted(self.keys, probes, "right")
        out: list[int | None] = [None] * len(wanted)
        for n in np.flatnonzero(high > low).tolist():
            for i in range(low[n], high[n]):  # rules of one digest
                if self.strings[self.bounds[i] : self.bounds[i + 1]].tobytes() == wanted[n]:
                    out[n] = int(self.verdicts[i])
        return out


def _candidates(host: str, path: str, lengths: list[int]) -> list[tuple[str, str]]:
    """Host suffixes at dots with path beginnings of the given lengths, longest first (then the longest host)."""
    suffixes, at = [host], host.find(".")
    while at >= 0:
        suffixes.append(host[at + 1 :])
        at = host.find(".", at + 1)
    pairs = [(s, path[:n]) for s in suffixes if s for n in lengths if n <= len(path)]
    return sorted(pairs, key=lambda p: (len(p[0]) + len(p[1]), len(p[0])), reverse=True)


FIELDS = "host string, path string, rule string, verdict string"


def judge(pages: DataFrame, rules: DataFrame | Iterable[tuple[str, str, str]], otherwise: str = "allow", keep: list[str] | None = None) -> DataFrame:  # noqa: E501
    """``pages`` as column ``row`` and in ``found`` host, path, the rule that decides (or NULL) and the verdict.

    A rule fits its host and all subdomains if the path starts with the rule's; the longest rule (host and path together)
    wins. ``otherwise`` is the verdict where none fits, as for NULL urls and urls without ``://``. Rows are judged one by
    one: repeated rows and extra columns change nothing, an empty table or rule list is no special case.
    """
    name = write_index(pages.sparkSession, rules)

    def look(column: pa.Array) -> list[pa.Array]:
        index = worker_state("urls", name, lambda: Index(SparkFiles.get(name)))
        parts = [host_and_path(url) for url in column.to_pylist()]
        pairs = [_candidates(host, path, index.lengths) for host, path in parts]
        found = index.find([_key(*p) for ps in pairs for p in ps])
        rules, verdicts, at = [], [], 0
        for ps in pairs:
            hit = next((i for i in range(len(ps)) if found[at + i] is not None), None)
            rules.append(None if hit is None else "".join(ps[hit]))
            verdicts.append(otherwise if hit is None else VERDICTS[found[at + hit]])
            at += len(ps)
        return [pa.array(x, pa.string()) for x in ([h for h, _ in parts], [p for _, p in parts], rules, verdicts)]

    return annotate(pages, look, FIELDS, "url", keep)


def verdicts(pages: DataFrame, rules: DataFrame | Iterable[tuple[str, str, str]]) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of ``pages``; see ``judge``."""
    return judge(pages.select("page_id", "url"), rules, keep=["page_id"]).select("row.page_id", F.col("found.*"))
