"""Places of rows inside ordered groups, without bringing a group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lendmill.llm.common import written

#: ``monotonically_increasing_id`` counts from so many bits on for each part.
PART_BITS = 33


def placed(rows: DataFrame, group: Sequence[str], order: Sequence[str], label: str) -> DataFrame:
    """The rows (of columns without nulls in ``group``) with ``pos``, their place from 0 in the
    order of their group, and ``n``, the rows of the group.

    The rows are dealt over ranges of group and order, so a group of any size spans as many
    tasks as it needs; rows that are equal in both are told apart by a number that is written
    with them. Each task numbers its rows. What stands before a group in earlier ranges is
    summed over one row per range and group, of which there are as many as groups and tasks.
    """
    numbered = written(rows.withColumn("__salt", F.monotonically_increasing_id()), f"{label}-rows")
    keys = [*group, *order, "__salt"]
    ordered = numbered.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("__salt")
    ordered = written(ordered.withColumn("__at", F.monotonically_increasing_id()), f"{label}-ordered").withColumn("__part", F.shiftright("__at", PART_BITS))
    parts = ordered.groupBy(*group, "__part").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = W.partitionBy(*group).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    starts = parts.select(*group, "__part", (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__shift"), F.sum("__n").over(W.partitionBy(*group)).alias("n"))
    return ordered.join(starts, [*group, "__part"]).withColumn("pos", F.col("__at") + F.col("__shift")).drop("__at", "__part", "__shift")
