"""Parent rows with their child rows as an array, in pages of bounded size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.operators.ranks import LIMIT, with_rank

# A collecting task may hold 128 such arrays at once before Spark turns to sorting.
PAGE_SIZE = 10_000


def nest(parents: DataFrame, children: DataFrame, key: str, fields: Sequence[str], order: str,
         into: str, page_size: int = PAGE_SIZE, limit: int = LIMIT) -> DataFrame:
    """Every parent with its children as ``into: array<struct<order, fields>>``.

    A parent's children in order are cut into pages of ``page_size``: one row per page, numbered
    from 0, and one empty page for a parent without children. Page and content depend on
    the parent's own children only, and reading pages in turn gives them in order.

    No task holds all children of a hot key: a child's number is found in ranges of at most ``limit``
    children (:func:`~adloom.operators.ranks.with_rank`). ``order`` is a non-negative bigint.
    """
    rows = children.filter(F.col(key).isNotNull()).select(key, order, *fields)
    numbered = with_rank(rows, [key], order, "_number", limit=limit)
    pages = (
        numbered.groupBy(key, F.expr(f"_number div {page_size}").alias("page"))
        .agg(F.array_sort(F.collect_list(F.struct(order, *fields))).alias(into))
    )
    empty = F.array().cast(pages.schema[into].dataType)
    return (
        parents.join(pages, key, "left")
        .withColumn("page", F.coalesce("page", F.lit(0)))
        .withColumn(into, F.coalesce(into, empty))
    )


def unnest(parents: DataFrame, array: str, keep: Sequence[str]) -> DataFrame:
    """One row per array element, fields as columns; parents with no elements vanish."""
    return parents.select(*keep, F.explode(array).alias("_e")).select(*keep, "_e.*")
