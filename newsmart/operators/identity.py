"""Dense surrogate ids without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def next_id(table: DataFrame, column: str) -> Column:
    """Highest id in use (0 for an empty table) as a scalar subquery."""
    return table.select(F.coalesce(F.max(column), F.lit(0)).cast("long")).scalar()


def number_rows(rows: DataFrame, name: str, start: Column, bucket: Column, *order: str) -> DataFrame:
    """Add ids ``start + 1 .. start + n`` in the order (``bucket``, ``order``).

    Rows are numbered inside their bucket in parallel and shifted by the sizes of the buckets before
    it; only the bucket sizes, one row per bucket, are summed in one place.
    """
    keyed = rows.withColumn("_bucket", bucket)
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = keyed.groupBy("_bucket").count().select(
        "_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset")
    )
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy(*order))
    numbered = keyed.withColumn("_inside", inside).join(offsets, "_bucket")
    return numbered.withColumn(name, start + F.col("_offset") + F.col("_inside")).drop(
        "_bucket", "_offset", "_inside"
    )
