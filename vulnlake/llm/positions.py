"""Positions in a sorted order without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vulnlake.llm.tables import cut_lineage

# Rows of one task's range are numbered in the lower bits.
RANGE_BITS = 33


def in_order(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """The columns of `rows` and `at`, a number that grows with `order` over the whole table (with gaps).

    `order` must tell every two rows apart, so that a hot key is split between ranges. The numbers are stored.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return cut_lineage(ranged.withColumn("at", F.monotonically_increasing_id()), name)


def numbered(placed: DataFrame, group: Column | None = None) -> DataFrame:
    """The columns of the result of `in_order` and `position`, gapless from 0 within each group (null is one).

    Only the sizes of the pieces of a group in each range are summed up: at most as many rows as ranges and groups.
    """
    group = F.lit(0) if group is None else group
    keyed = placed.withColumn("range_", F.shiftright("at", RANGE_BITS)).withColumn("group_", group)
    pieces = keyed.groupBy("group_", "range_").agg(F.min("at").alias("first_"), F.count("*").alias("rows_"))
    before = F.sum("rows_").over(Window.partitionBy("group_").orderBy("range_").rowsBetween(Window.unboundedPreceding, -1))
    pieces = pieces.select(
        F.col("group_").alias("of_"), F.col("range_").alias("in_"), "first_", F.coalesce(before, F.lit(0)).alias("before_")
    )
    joined = keyed.join(pieces, F.col("group_").eqNullSafe(F.col("of_")) & (F.col("range_") == F.col("in_")))
    return joined.withColumn("position", F.col("before_") + F.col("at") - F.col("first_")).drop(
        "group_", "range_", "of_", "in_", "first_", "before_"
    )
