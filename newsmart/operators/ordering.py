"""Places of rows inside ordered groups, without bringing a group into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsmart.session import cut


def placed(rows: DataFrame, keys: list[str], order: list[str], name: str = "place") -> DataFrame:
    """``rows`` with their place (0, 1, ...) by ``order`` inside the group of equal ``keys`` (which are never NULL).

    Rows are sorted over ranges of keys and order, so a large group takes as many partitions as it needs. Only one row count
    for each range and group crosses partitions. Rows that ``order`` leaves tied follow each other in any order.
    """
    by = [F.col(column).asc_nulls_first() for column in (*keys, *order)]
    ranged = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    # The number has the partition in its upper bits and the row in the lower ones; once stored it stays as it is.
    stored = cut(ranged.withColumn("_row", F.monotonically_increasing_id())).withColumn("_part", F.shiftright("_row", 33))
    counts = stored.groupBy(*keys, "_part").agg(F.count("*").alias("_count"), F.min("_row").alias("_first"))
    before = Window.partitionBy(*keys).orderBy("_part")
    shifts = counts.select(*keys, "_part", (F.sum("_count").over(before) - F.col("_count") - F.col("_first")).alias("_shift"))
    joined = stored.join(shifts, [*keys, "_part"])
    return joined.select(*[F.col(f"`{column}`") for column in rows.columns], (F.col("_row") + F.col("_shift")).alias(name))
