"""Gapless row numbers and running sums over a whole table, without a single-task window.

Two passes: rows are range-partitioned and sorted by the order columns and
written with their partition and place in it; then one number per partition
(its rows, or its sum of weights) is added up on the driver and joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textsieve.session import write_scratch

#: monotonically_increasing_id() is partition * 2^33 + place in the partition
PLACE_BITS = 33


def _sorted_places(df: DataFrame, order) -> DataFrame:
    """The rows as a written table with ``_part`` and ``_place``, both from 0, in the order's order."""
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    at = F.col("_at")
    placed = rows.withColumns({"_part": F.shiftright(at, PLACE_BITS), "_place": at.bitwiseAND(F.lit((1 << PLACE_BITS) - 1))}).drop("_at")
    return write_scratch(placed, "places")


def _before(df: DataFrame, total: Column, start) -> DataFrame:
    """(_p, _before): what the partitions before each one add up to; one row per partition reaches the driver."""
    out, sum_ = [], start
    for r in df.groupBy("_part").agg(total.alias("t")).orderBy("_part").collect():
        out.append((r["_part"], sum_))
        sum_ += r["t"]
    return df.sparkSession.createDataFrame(out, "_p long, _before long")


def with_row_index(df: DataFrame, *order, name: str = "row_id", start: int = 0) -> DataFrame:
    """Adds ``name``: start, start + 1, ... in the given order (nulls first; rows equal in it in any order).

    An empty table stays empty.  The result reads the written table, so it numbers the same every time.
    """
    placed = _sorted_places(df, order)
    offsets = _before(placed, F.count("*"), start)
    numbered = placed.join(F.broadcast(offsets), F.col("_part") == F.col("_p"))  # a row per partition
    return numbered.withColumn(name, F.col("_before") + F.col("_place")).drop("_part", "_place", "_p", "_before")


def with_running_sum(df: DataFrame, weight, *order, name: str = "running") -> DataFrame:
    """Adds ``name``: the sum of ``weight`` (long) over the rows before this one in the given order; null weights count 0."""
    placed = _sorted_places(df.withColumn("_weight", F.coalesce(F.col(weight) if isinstance(weight, str) else weight, F.lit(0)).cast("long")), order)
    offsets = _before(placed, F.sum("_weight"), 0)
    # windows over one range partition each
    inside = F.sum("_weight").over(Window.partitionBy("_part").orderBy("_place")) - F.col("_weight")
    summed = placed.join(F.broadcast(offsets), F.col("_part") == F.col("_p")).withColumn(name, F.col("_before") + inside)
    return summed.drop("_part", "_place", "_weight", "_p", "_before")
