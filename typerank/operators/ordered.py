"""Running totals and row numbers over groups of any size.

A group may hold a third of all rows, so it is never sorted by one task. Rows carry a
``block`` (a file split or a key range) whose size is bounded; totals run first over
the blocks of a group, one row each, and then inside each block.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def block_starts(rows: DataFrame, group: list[str], block: str, value: Column) -> DataFrame:
    """Total of ``value`` before each block of each group."""
    totals = rows.groupBy(*group, block).agg(F.sum(value).alias("total"))
    before = W.partitionBy(*group).orderBy(block).rowsBetween(W.unboundedPreceding, -1)
    return totals.select(
        *group, block, F.coalesce(F.sum("total").over(before), F.lit(0)).alias("block_start")
    )


def add_start(
    rows: DataFrame,
    starts: DataFrame,
    group: list[str],
    block: str,
    order: str,
    value: Column,
    name: str,
) -> DataFrame:
    """Rows of the blocks in ``starts`` with the total of ``value`` before each row."""
    inside = (
        W.partitionBy(*group, block).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    )
    return (
        rows.join(starts, [*group, block])
        .withColumn(name, F.col("block_start") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .drop("block_start")
    )


def positions(rows: DataFrame, group: list[str], block: str, order: str) -> DataFrame:
    """Zero-based position ``pos`` of each row of a group, in (block, order) order."""
    one = F.lit(1).cast("bigint")
    starts = block_starts(rows, group, block, one)
    return add_start(rows, starts, group, block, order, one, "pos")
