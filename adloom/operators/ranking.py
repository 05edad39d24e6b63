"""Top rows, top rows per group, and the last row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_rows(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows of a total order. ``order`` must end in a unique key, so
    that ties at the cut are settled the same way on every run."""
    return df.orderBy(*order).limit(k)


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows of every group.

    The filter on ``row_number`` makes Spark cut each group to ``k`` rows in the
    map tasks already (WindowGroupLimit), so a group holding a third of the input
    sends ``k`` rows per task through the shuffle and no more.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= k).drop("_rank")


def latest_per_key(df: DataFrame, key: Sequence[str], written: Sequence[str], ranged: bool = False, buckets: int = 0) -> DataFrame:
    """Upsert semantics: of all rows with one primary key, the one written last.

    ``ranged`` deals the rows by ranges of the key, so a table that is laid out by its key needs no further shuffle. It is for
    keys that seldom repeat: the writes of one key are not cut in the map tasks then. ``buckets`` deals them into so many
    buckets by the key, which moves nothing where they lie in such buckets."""
    dealt = df.repartition(buckets, *key) if buckets else df.repartitionByRange(*key) if ranged else df
    return top_per_group(dealt, key, [F.col(c).desc() for c in written], 1)
