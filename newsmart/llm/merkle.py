"""Merkle manifest of a dataset: a digest per row, a tree over every group of rows, and proofs that can be folded again.

The digest H is the lower-case hex SHA-256 of its inputs, digests going in as hex text. The rows of a group, in the order of
their ids, are the leaves of its tree; every ``ARITY`` consecutive nodes (the last run may be shorter) become their H until one
node is left. The nodes left of all groups are the leaves of a last tree, whose node is the root.

A parent keeps a copy of its hash state from before each child slot. To fold a changed child, the copy of its slot is resumed
with the replacement and the siblings right of it; what lies left of the slot is never hashed again.

A tree is built in steps of ``height`` levels. In each step a task gets whole blocks of 2 ** height neighbouring nodes, so no group
is gathered in one task, however large. States cannot leave a process: a task folds the leaves of its block with the states of
that block, and for the levels above, which all leaves of the block share, it takes the state of every slot once from the
siblings on its left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsmart.llm.tables import small_batches, stage, whole_groups

ARITY = 2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


@dataclass(frozen=True)
class Tree:
    """``height`` levels of a tree are built in one step, over blocks of 2 ** height nodes; results do not depend on it."""

    height: int = 12

    def __post_init__(self) -> None:
        if self.height < 1:
            raise ValueError("a step has one level at least")


# -- leaves --------------------------------------------------------------------------------------------
def field(value: Column) -> Column:
    """``-`` for NULL, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: dict[str, Column]) -> Column:
    """H of the fields in their fixed order."""
    return F.sha2(F.concat(*[field(columns[name]) for name in FIELDS]), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, node, changed): the digest of every row, and that of its tampered form where there is one.

    Trees are named so that they sort as lang does, NULL first. Rows whose crc32 of the decimal doc_id is a multiple of 7 are
    tampered with: 1 is added to n_chars; NULL doc_ids and NULL counts are left as they are.
    """
    columns = {name: F.col(f"`{name}`") for name in FIELDS}
    more = {**columns, "n_chars": columns["n_chars"].cast("decimal(20,0)") + 1}
    tampered = (F.crc32(columns["doc_id"].cast("string").cast("binary")) % 7 == 0) & columns["n_chars"].isNotNull()
    tree = F.coalesce(F.concat(F.lit("="), columns["lang"]), F.lit(""))
    return docs.select(
        tree.alias("tree"), columns["doc_id"].cast("long").alias("doc_id"), leaf(columns).alias("node"),
        F.when(tampered, leaf(more)).alias("changed"),
    )


# -- order ---------------------------------------------------------------------------------------------
def _numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``place`` (0, 1, ... by ``order`` inside each ``tree``) and ``size``, the number of rows of the tree.

    Rows are sorted over ranges, so a tree may take any number of partitions; only row counts, one for each range and tree,
    are summed up across ranges.
    """
    by = [F.col(c).asc_nulls_first() for c in ("tree", *order)]
    ranged = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    # The number holds the partition in its upper bits and the row inside it in the others.
    placed = stage(ranged.withColumn("row", F.monotonically_increasing_id()), name)
    placed = placed.withColumn("part", F.shiftright("row", 33))
    counts = placed.groupBy("tree", "part").agg(F.count("*").alias("n"), F.min("row").alias("first"))
    whole = Window.partitionBy("tree")
    begins = counts.select(
        "tree", "part", F.sum("n").over(whole).alias("size"),
        (F.sum("n").over(whole.orderBy("part")) - F.col("n") - F.col("first")).alias("shift"),
    )
    found = placed.join(begins, ["tree", "part"])
    return found.select(*rows.columns, (F.col("row") + F.col("shift")).alias("place"), "size")


# -- hash states ---------------------------------------------------------------------------------------
class Parent:
    """A node over some children: its digest and a copied hash state from before each child slot."""

    __slots__ = ("digest", "states")

    def __init__(self, children: list[bytes]):
        state = hashlib.sha256()
        self.states = []
        for child in children:
            self.states.append(state.copy())
            state.update(child)
        self.digest = state.hexdigest().encode()


def resumed(state, replacement: bytes, right: list[bytes]) -> bytes:
    """The parent's digest with another child in the slot of ``state``: only that child and those right of it are hashed."""
    state = state.copy()
    state.update(replacement)
    for sibling in right:
        state.update(sibling)
    return state.hexdigest().encode()


class Block:
    """``levels`` levels of parents over neighbouring nodes."""

    def __init__(self, nodes: list[bytes], levels: int):
        self.nodes, self.parents = [nodes], []
        for _ in range(levels):
            below = self.nodes[-1]
            self.parents.append([Parent(below[i : i + ARITY]) for i in range(0, len(below), ARITY)])
            self.nodes.append([parent.digest for parent in self.parents[-1]])
        self.top = self.nodes[-1][0]

    def path(self, place: int) -> list[tuple[list[bytes], list[bytes]]]:
        """The siblings left and right of the nodes over ``place``, level by level."""
        out = []
        for level in self.nodes[: len(self.parents)]:
            first = place - place % ARITY
            out.append((level[first:place], level[place + 1 : first + ARITY]))
            place //= ARITY
        return out

    def folded(self, place: int, replacement: bytes) -> bytes:
        """The block's top with another leaf at ``place``."""
        for level, parents in zip(self.nodes, self.parents, strict=False):
            first = place - place % ARITY
            replacement = resumed(parents[place // ARITY].states[place - first], replacement, level[place + 1 : first + ARITY])
            place //= ARITY
        return replacement


class Path:
    """Levels that all leaves of a block share: a hash state before each slot and the siblings right of it."""

    def __init__(self, levels: list[tuple[list[bytes], list[bytes]]]):
        self.siblings = [sibling for left, right in levels for sibling in (*left, *right)]
        self.slots = [(hashlib.sha256(b"".join(left)), right) for left, right in levels]

    def folded(self, replacement: bytes) -> bytes:
        for state, right in self.slots:
            replacement = resumed(state, replacement, right)
        return replacement


# -- steps ---------------------------------------------------------------------------------------------
NODE = "tree string, place long, size long, node string"
LEVEL = pa.struct([("l", pa.list_(pa.binary())), ("r", pa.list_(pa.binary()))])
#: What lies above a node: the siblings of every level, the top of its tree and that of the last tree.
ABOVE = "path array<struct<l: array<binary>, r: array<binary>>>, subroot string, root string"
ABOVE_NAMES = ["path", "subroot", "root"]


def _levels(size: int, height: int) -> int:
    """Levels that a step builds over a tree of ``size`` nodes: no more than lead to one node."""
    levels = 0
    while size > 1 and levels < height:
        size, levels = -(-size // ARITY), levels + 1
    return levels


def _dealt(nodes: DataFrame, height: int) -> DataFrame:
    """Whole blocks of ``nodes`` in one partition each and in order."""
    known = nodes if "block" in nodes.columns else nodes.withColumn("block", F.expr(f"place div {ARITY**height}"))
    return known.repartition("tree", "block").sortWithinPartitions("tree", "block", "place")


def _grouped(table: pa.Table) -> Iterator[tuple[int, int]]:
    """First and end of each block in a table of whole blocks."""
    edges = np.append(np.flatnonzero(table.column("edge").to_numpy()), len(table)).tolist()
    return zip(edges[:-1], edges[1:], strict=True)


def _climb(nodes: DataFrame, height: int) -> DataFrame:
    """The nodes that one step builds over ``nodes``."""

    def build(batches) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["tree", "block"]):
            values = table.column("node").cast(pa.binary()).to_pylist()
            rows = []
            for a, b in _grouped(table):
                size = table.column("size")[a].as_py()
                top = Block(values[a:b], _levels(size, height)).top.decode()
                rows.append((table.column("tree")[a].as_py(), table.column("block")[a].as_py(), -(-size // ARITY**height), top))
            columns = zip(*rows, strict=True)
            types = [pa.string(), pa.int64(), pa.int64(), pa.string()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["tree", "place", "size", "node"])

    return _dealt(nodes.select("tree", "place", "size", "node"), height).mapInArrow(build, NODE)


def _steps(nodes: DataFrame, height: int, name: str) -> list[DataFrame]:
    """``nodes`` and what each step builds over them; the last has one node for each tree."""
    steps = [nodes]
    while len(steps) == 1 or (steps[-1].agg(F.max("size")).first()[0] or 0) > 1:
        steps.append(stage(_climb(steps[-1], height), name))
    return steps


def _below(nodes: DataFrame, above: DataFrame, height: int) -> DataFrame:
    """Whole blocks of ``nodes``, before each a row (its place is -1) with what lies above the block.

    ``above`` (tree, place, path, subroot, root) has a row for each node that the step builds over ``nodes``.
    """
    heads = above.select("tree", F.col("place").alias("block"), F.lit(-1).cast("long").alias("place"), *ABOVE_NAMES)
    blocks = nodes.withColumn("block", F.expr(f"place div {ARITY**height}"))
    return _dealt(heads.unionByName(blocks, allowMissingColumns=True), height)


def _opened(table: pa.Table, height: int) -> Iterator[tuple[int, int, Block, dict]]:
    """(first node, end, the block's parents, what lies above) of each block of a table as ``_below`` gives it."""
    values = table.column("node").cast(pa.binary()).to_pylist()
    for a, b in _grouped(table):
        above = {name: table.column(name)[a].as_py() for name in ABOVE_NAMES}
        yield a + 1, b, Block(values[a + 1 : b], _levels(table.column("size")[a + 1].as_py(), height)), above


def _down(nodes: DataFrame, above: DataFrame, height: int) -> DataFrame:
    """(tree, place, path, subroot, root) of ``nodes``, from those of the nodes that the step builds over them."""

    def walk(batches) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["tree", "block"]):
            rows = []
            for a, b, block, known in _opened(table, height):
                for i in range(b - a):
                    path = [{"l": left, "r": right} for left, right in block.path(i)] + known["path"]
                    rows.append((table.column("tree")[a + i].as_py(), i + table.column("place")[a].as_py(), path, known["subroot"], known["root"]))
            columns = zip(*rows, strict=True)
            types = [pa.string(), pa.int64(), pa.list_(LEVEL), pa.string(), pa.string()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["tree", "place", *ABOVE_NAMES])

    return _below(nodes, above, height).mapInArrow(walk, f"tree string, place long, {ABOVE}")


# -- the operator --------------------------------------------------------------------------------------
PROVED = "doc_id long, leaf string, subroot string, root string, siblings array<binary>, folded_root string"


def _folded(leaf_rows: DataFrame, above: DataFrame, height: int) -> DataFrame:
    """Every leaf with its proof, and the root folded from its changed (if any, else its own) digest."""

    def fold(batches) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["tree", "block"]):
            values, changed = (table.column(c).cast(pa.binary()).to_pylist() for c in ("node", "changed"))
            picked, siblings, folded, subroots, roots = [], [], [], [], []
            for a, b, block, known in _opened(table, height):
                upper = Path([(x["l"], x["r"]) for x in known["path"]])
                for i in range(b - a):
                    own = [sibling for left, right in block.path(i) for sibling in (*left, *right)]
                    siblings.append([*own, *upper.siblings])
                    folded.append(upper.folded(block.folded(i, changed[a + i] or values[a + i])).decode())
                picked += range(a, b)
                subroots += [known["subroot"]] * (b - a)
                roots += [known["root"]] * (b - a)
            rows = table.select(["doc_id", "node"]).take(pa.array(picked, pa.int64())).combine_chunks()
            arrays = [rows.column(0).combine_chunks(), rows.column(1).combine_chunks(), pa.array(subroots), pa.array(roots)]
            arrays += [pa.array(siblings, pa.list_(pa.binary())), pa.array(folded, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "leaf", "subroot", "root", "siblings", "folded_root"])

    return _below(leaf_rows, above, height).mapInArrow(fold, PROVED)


def proofs(docs: DataFrame, settings: Tree = Tree()) -> DataFrame:  # noqa: B008
    """(doc_id, leaf, subroot, root, siblings, folded_root) of every row of ``docs``.

    ``docs`` has doc_id, source, lang, n_chars and text, each of which may be NULL; other columns are ignored. There is a tree for
    every lang (NULL is one), its leaves in the order of doc_id (NULL first), those of one doc_id in the order of their digests;
    equal rows are leaves of their own. ``siblings`` holds the other nodes of the runs from the leaf up to the root.
    ``folded_root`` is what the root becomes with the row as ``leaves`` tampers with it. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    height = settings.height
    rows = stage(_numbered(stage(leaves(docs), "leaves"), ["doc_id", "node"], "leaves"), "places")
    steps = _steps(rows, height, "nodes")
    tops = steps[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "node")
    last = stage(_numbered(tops, ["name"], "tops"), "tops")
    top_steps = _steps(last, height, "top-nodes")

    none = F.expr("cast(array() as array<struct<l: array<binary>, r: array<binary>>>)").alias("path")
    above = top_steps[-1].select("tree", "place", none, F.lit(None).cast("string").alias("subroot"), F.col("node").alias("root"))
    for nodes in reversed(top_steps[1:-1]):
        above = stage(_down(nodes.select("tree", "place", "size", "node"), above, height), "top-paths")
    above = stage(_down(last.select("tree", "place", "size", "node"), above, height), "top-paths")
    above = last.join(above.select("place", "path", "root"), "place").select(
        F.col("name").alias("tree"), F.lit(0).cast("long").alias("place"), "path", F.col("node").alias("subroot"), "root"
    )
    for nodes in reversed(steps[1:-1]):
        above = stage(_down(nodes, above, height), "paths")
    return _folded(rows, above, height)


def manifest(docs: DataFrame, settings: Tree = Tree()) -> DataFrame:  # noqa: B008
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row of ``docs``; see ``proofs``.

    ``proof_sha256`` is H of the siblings, level by level and left to right.
    """
    found = proofs(docs, settings)
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.array_join(F.col("siblings").cast("array<string>"), ""), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )
