"""Reading the given tables, stage tables in the shared folder, and state of a Python worker."""

from __future__ import annotations

import ctypes
import gc
import sys
import types
import uuid
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsmart.session import checkpoint_dir

#: Rows of one Arrow batch; bounds what a Python worker holds at once with long texts.
BATCH_ROWS = 1000


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One of the given tables; also sets the batch size all operators here rely on."""
    small_batches(spark)
    return spark.read.parquet(f"{folder}/{table}.parquet")


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back: lineage ends there."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release() -> None:
    """Give memory that is free inside a Python worker back to the system.

    Workers outlive a stage; what one stage needed would otherwise stay with them beside what the next one needs.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def mapped(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: Any) -> DataFrame:
    """``df.mapInArrow(function, schema)`` that leaves no free memory in the worker at the end of a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            release()

    return df.mapInArrow(run, schema)


def worker_state(kind: str, key: str, build: Callable[[], Any]) -> Any:
    """What a Python worker keeps between its tasks (functions travel by value, so globals do not last).

    Only one kind is kept: a worker that goes on with another operator frees what the last one needed.
    """
    held = sys.modules.setdefault("newsmart_worker_state", types.ModuleType("newsmart_worker_state")).__dict__
    if held.get("kind") != kind:
        held["kind"], held["state"] = kind, {}
        release()
    state = held["state"]
    if key not in state:
        state[key] = build()
    return state[key]


def whole_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Batches of rows sorted by ``keys``, cut anew so that no group of equal keys is split.

    The added column ``edge`` is true at the first row of each group. What is held is one batch and one group.
    """
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        rest = table if rest is None else pa.concat_tables([rest, table])
        edge = _edges(rest, keys)
        last = int(np.flatnonzero(edge)[-1]) if len(edge) else 0
        if last:
            yield rest.slice(0, last).append_column("edge", pa.array(edge[:last])).combine_chunks()
            rest = rest.slice(last)
    if rest is not None and len(rest):
        yield rest.append_column("edge", pa.array(_edges(rest, keys))).combine_chunks()


def _edges(table: pa.Table, keys: list[str]) -> np.ndarray:
    edge = np.zeros(len(table), bool)
    edge[:1] = True
    for key in keys:
        values = table.column(key).to_numpy()
        edge[1:] |= values[1:] != values[:-1]
    return edge


def annotate(
    docs: DataFrame,
    function: Callable[[pa.Array], list[pa.Array]],
    fields: str,
    source: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """Rows of ``docs`` with what ``function`` finds in column ``source``, as struct columns ``row`` and ``found``.

    ``function`` gets the column of one Arrow batch and returns an array for each of ``fields``. ``keep`` names the columns
    that ``row`` has (all by default); as they stay inside ``row``, their names clash with nothing.
    """
    small_batches(docs.sparkSession)
    names = docs.columns if keep is None else keep
    inside = [f"c{i}" for i in range(len(names))]
    columns = [F.col(f"`{n}`").alias(c) for n, c in zip(names, inside, strict=True)]
    target = T.StructType(
        [T.StructField(c, docs.schema[n].dataType) for n, c in zip(names, inside, strict=True)]
        + [T.StructField("found", T._parse_datatype_string(fields))]
    )
    found_names = [field.name for field in target["found"].dataType]

    def rows(batches):
        for batch in batches:
            found = pa.StructArray.from_arrays(function(batch.column("source")), found_names)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in inside), found], [*inside, "found"])

    if source in names:
        place = inside[names.index(source)]
        full = docs.select(*columns)

        def rows(batches):  # noqa: F811  the source is one of the kept columns and travels once
            for batch in batches:
                found = pa.StructArray.from_arrays(function(batch.column(place)), found_names)
                yield pa.RecordBatch.from_arrays([*batch.columns, found], [*inside, "found"])

    else:
        full = docs.select(*columns, F.col(f"`{source}`").alias("source"))
    out = mapped(full, rows, target)
    row = F.struct(*[F.col(c).alias(n) for n, c in zip(names, inside, strict=True)])
    return out.select(row.alias("row"), "found")
