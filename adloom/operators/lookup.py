"""Key resolution against dimensions, and the checks a database would enforce."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def resolve_key(facts: DataFrame, dim: DataFrame, text: str, dim_text: str, dim_id: str,
                out: str, missing: int | None = None, match_null: bool = False) -> DataFrame:
    """Left join that turns a text column into the dimension's id as ``out``.

    No hint is given: Spark broadcasts the dimension when its measured size allows
    and otherwise runs a sort-merge join, where skewed fact partitions are split.
    A name that occurs twice in the dimension repeats the fact row. With
    ``match_null`` a null text finds the dimension's null row.
    """
    names = dim.select(F.col(dim_text).alias("_text"), F.col(dim_id).alias("_id"))
    same = F.col(text).eqNullSafe(F.col("_text")) if match_null else F.col(text) == F.col("_text")
    found = F.col("_id") if missing is None else F.coalesce("_id", F.lit(missing))
    return facts.join(names, same, "left").withColumn(out, found).drop("_text", "_id")


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def orphan_keys(df: DataFrame, foreign: str, dim: DataFrame, primary: str) -> DataFrame:
    """Foreign-key values without a dimension row, and how many rows use them.
    Rows are counted per value before the join, so hot values cost one row each."""
    used = df.filter(F.col(foreign).isNotNull()).groupBy(foreign).agg(F.count(F.lit(1)).alias("rows"))
    return used.join(dim.select(F.col(primary).alias("_pk")), F.col(foreign) == F.col("_pk"), "left_anti")
