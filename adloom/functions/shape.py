"""Frame reshaping driven by the schema at hand."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def strip_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def rename_present(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Renames the columns that exist. Where several old names lead to one new
    name, the first one present wins and the others are left alone."""
    chosen: dict[str, str] = {}
    for old, new in names.items():
        if old in df.columns and new not in chosen.values():
            chosen[old] = new
    return df.withColumnsRenamed(chosen)


def keep_present(df: DataFrame, target: Iterable[str]) -> DataFrame:
    """Target columns in target order, without those the frame lacks."""
    return df.select(*[c for c in target if c in df.columns])


def drop_present(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*[n for n in names if n in df.columns])


def column_or(df: DataFrame, name: str, default: Column) -> Column:
    """The column, or a default when the frame has no such column."""
    return F.col(name) if name in df.columns else default


def within(ts: str, start: str, end: str) -> Column:
    """Half-open range, written so that it reaches the parquet scan."""
    return (F.col(ts) >= F.lit(start).cast("timestamp_ntz")) & (
        F.col(ts) < F.lit(end).cast("timestamp_ntz"))


def present(df: DataFrame, *columns: str) -> DataFrame:
    """Rows where all the columns are there. Plain IS NOT NULL tests reach the scan and turn outer
    joins into inner ones; ``dropna`` is planned as a function of all columns and does neither."""
    for c in columns:
        df = df.filter(F.col(c).isNotNull())
    return df
