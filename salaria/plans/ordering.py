"""Running sums and order parts from exact counts, without sampling rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BEFORE = "_before"
_RANGE = "_range"

Stage = Callable[[DataFrame, str], DataFrame]


def running_sums(df: DataFrame, order_by: list[str], value: str, parts: int, stage: Stage, name: str) -> DataFrame:
    """``df`` with ``_before``: the sum of ``value`` over the rows ahead of it in ``order_by``, which must be unique.

    The rows are range-partitioned into ``parts`` (one part: sorted in one task), written as ``name``, and summed part by
    part; a part's offset is the sum of those ahead, of which there are ``parts`` only. For tables of one row per key or
    split, not for the rows that they describe.
    """
    within = Window.partitionBy(_RANGE).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)
    if parts <= 1:
        ranged, offset = df.withColumn(_RANGE, F.lit(0)), F.lit(0).cast("bigint")
    else:
        ranged = stage(df.repartitionByRange(parts, *order_by).withColumn(_RANGE, F.spark_partition_id()), name)
        sums = dict(ranged.groupBy(_RANGE).agg(F.sum(value)).collect())
        ahead = [0]
        for part in range(max(sums, default=0)):
            ahead.append(ahead[-1] + (sums.get(part) or 0))
        offset = F.element_at(F.array(*(F.lit(a).cast("bigint") for a in ahead)), F.col(_RANGE) + 1)
    return ranged.withColumn(BEFORE, offset + F.coalesce(F.sum(value).over(within), F.lit(0))).drop(_RANGE)


def part_at(before: Column, total: int, parts: int) -> Column:
    """Which of ``parts`` equal parts of ``total`` ordered rows holds the row with ``before`` rows ahead of it."""
    return F.call_function("div", before * F.lit(parts).cast("bigint"), F.lit(max(1, total)).cast("bigint")).cast("int")
