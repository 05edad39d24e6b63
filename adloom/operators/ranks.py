"""Ranks of rows inside their group, for groups of any size.

A window holds all rows of its group in one task. Here a group is cut into ranges of the ordinal until no range has more
than ``limit`` rows: ranges that are too full are counted again in narrower ones, a thousand at a time, and only
they. A row's rank is its place in its range plus the rows of its group's earlier ranges, so a window never sorts more
than ``limit`` rows of a group, and the running sum has one row per range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adloom.session import scratch_dir

LIMIT = 1_000_000  # rows of a group in one window
FANOUT = 1024
RANGE = "_range"


def _counted(rows: DataFrame, group: Sequence[str], order: str) -> DataFrame:
    return rows.groupBy(*group, RANGE).agg(F.count(F.lit(1)).alias("_n"), F.min(order).alias("_low"), F.max(order).alias("_high"))


def with_ranges(rows: DataFrame, group: Sequence[str], order: str, limit: int = LIMIT, fanout: int = FANOUT) -> tuple[DataFrame, DataFrame | None]:
    """Rows with the start of their range as ``_range`` (-1 where a group is one range), and the number of
    rows of each range as ``_n``; None instead of these if every group is one range.

    ``order`` is a non-negative bigint, and group columns are not null. A group has about as many ranges as its rows
    divided by ``limit``, times the fanout at most. More than ``limit`` rows with one ordinal stay in one range."""
    spark = rows.sparkSession
    placed = rows.withColumn(RANGE, F.lit(-1).cast("bigint"))
    several = F.col("_low") < F.col("_high")
    most = _counted(placed, group, order).agg(F.max(F.when(several, F.col("_n")))).first()[0]
    if most is None or most <= limit:
        return placed, None
    folder, step = scratch_dir(spark, "ranges"), 0
    while True:
        _counted(placed, group, order).write.parquet(f"{folder}/{step}")
        counts = spark.read.parquet(f"{folder}/{step}")
        full = counts.where((F.col("_n") > limit) & several)
        if full.isEmpty():
            return placed, counts.select(*group, RANGE, "_n")
        width = F.expr(f"(_high - _low) div {fanout} + 1")
        placed = placed.join(full.select(*group, RANGE, "_low", width.alias("_width")), [*group, RANGE], "left").withColumn(
            RANGE, F.coalesce(F.expr(f"_low + ((`{order}` - _low) div _width) * _width"), F.col(RANGE))).drop("_low", "_width")
        step += 1


def with_rank(rows: DataFrame, group: Sequence[str], order: str, into: str, limit: int = LIMIT, fanout: int = FANOUT,
              ties: Sequence[str] = ()) -> DataFrame:
    """Rows with their place 0, 1, 2, ... by ``order`` within their group as ``into``; rows of one ordinal
    follow the columns ``ties``."""
    placed, counts = with_ranges(rows, group, order, limit, fanout)
    if counts is None:  # each group fits one window
        inside = F.row_number().over(Window.partitionBy(*group).orderBy(order, *ties)) - 1
        return placed.drop(RANGE).withColumn(into, inside.cast("bigint"))
    earlier = Window.partitionBy(*group).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*group, RANGE, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy(*group, RANGE).orderBy(order, *ties)) - 1
    return (placed.withColumn("_inside", inside).join(starts, [*group, RANGE])
            .withColumn(into, (F.col("_start") + F.col("_inside")).cast("bigint")).drop("_start", "_inside", RANGE))
