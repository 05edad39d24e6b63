"""Bounded samples of labelled rows, for fitting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, grade_col: str, limit: int, columns: list) -> DataFrame:
    """At most ``limit`` rows: ``grade`` and ``columns`` of the documents whose ids have the least
    hashes among the labelled ones (the same rows on every run). The highest of several
    grades of an id counts, rows without id or grade don't; of repeated ids the row with the least columns is used."""
    graded = (labels.where(F.col(id_col).isNotNull() & F.col(grade_col).isNotNull())
              .groupBy(F.col(id_col).alias("_id")).agg(F.max(grade_col).cast("int").alias("grade"))
              .orderBy(F.xxhash64("_id"), "_id").limit(limit))
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), F.struct(*columns).alias("_row"))
    # The broadcast side is bounded by ``limit``.
    return rows.join(F.broadcast(graded), "_id").groupBy("_id", "grade").agg(F.min("_row").alias("_row")).select("_id", "grade", "_row.*")
