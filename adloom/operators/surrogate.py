"""Surrogate ids 1..n in the order values first appear."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.operators.ranks import LIMIT, with_rank


def first_appearance_ids(df: DataFrame, value: str, ordinal: str, id_name: str,
                         keep_null: bool = False, limit: int = LIMIT) -> DataFrame:
    """One row per distinct value with a dense id by first appearance; ``ordinal`` is a non-negative bigint.

    A dense id needs a global rank. It is worked out in ranges of at most ``limit`` values, in parallel, by
    :func:`~adloom.operators.ranks.with_rank`. Values that first appear at one ordinal follow their own order."""
    source = df if keep_null else df.filter(F.col(value).isNotNull())
    firsts = source.groupBy(value).agg(F.min(ordinal).alias("_first"))
    return with_rank(firsts, [], "_first", "_rank", limit=limit, ties=[value]).select((F.col("_rank") + 1).alias(id_name), value)
