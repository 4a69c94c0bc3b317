"""Positions of rows within large groups, without a task that sees a whole group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnguard.session import materialise

_WITHIN = 33  # monotonically_increasing_id: the partition above these bits, the row below


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``pos``, the place in the group from 0 on, and ``n``, the rows in the group; as a table.

    Rows are sorted by range, so a group of any size is spread over tasks; what is ranked by group is
    one narrow row per range. ``group`` must not be null. Nulls in ``order`` come first. Equal rows are
    told apart by their place in the input, so that a row repeated without end is spread as well.
    ``rows`` is read twice: give a stored table. An empty table gives no rows.
    """
    keys = [group, *order, "_tie"]
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    laid = tied.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    stored = materialise(laid.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", _WITHIN).alias("_part")
    runs = stored.groupBy(group, part).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        group,
        "_part",
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(Window.partitionBy(group)).alias("n"),
    )
    placed = stored.withColumn("_part", part).join(materialise(runs), [group, "_part"])
    return placed.withColumn("pos", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")
