"""Types of text columns, found from the cells themselves.

For every column the profile counts how many of its filled cells fit each kind of value. Counts of
different files or loads add up, so a profile is a mergeable aggregate: one scan of new files and
a sum with the stored profiles give the types of everything loaded so far. A column's type is the narrowest kind
that fits all its filled cells; kinds that exclude each other (a date here, a number there)
meet in string.

Cells are told by how they are written before they are cast, so no value is rounded or cut to fit. Blank
cells count as empty, whatever the kind; a column of nothing else is a string.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.functions.text import blank_to_null
from adloom.sources.files import read_csv

WHOLE = r"^[+-]?[0-9]+$"
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
MOMENT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?)?$"
INSTANT = MOMENT.removesuffix(")?$") + r"(Z|[+-][0-9]{2}:[0-9]{2})?)?$"

# Narrowest first. A kind below another in the same line of descent also counts for it.
WRITTEN: dict[str, str] = {
    "boolean": "(?i)^(true|false)$",
    "int": WHOLE,
    "bigint": WHOLE,
    "decimal(38,0)": WHOLE,
    "double": NUMBER,
    "date": DAY,
    "timestamp_ntz": MOMENT,
    "timestamp": INSTANT,
}


def cast_cell(cell: Column, kind: str) -> Column:
    """The cell as a value of this kind; null if it isn't written like one or is out of range."""
    bare = blank_to_null(cell)
    return cell if kind == "string" else F.when(bare.rlike(WRITTEN[kind]), bare.try_cast(kind))


def cell_profile(df: DataFrame) -> DataFrame:
    """One row per text column: place, cells, filled ones, and how many of them fit each kind.

    One scan; map tasks shrink their cells to a row per column before the shuffle."""
    cells = F.array(*(F.struct(F.lit(i).alias("place"), F.col(f"`{c}`").cast("string").alias("cell")) for i, c in enumerate(df.columns)))
    names = F.array(*map(F.lit, df.columns))
    bare = blank_to_null(F.col("cell"))
    return df.select(F.inline(cells)).groupBy("place").agg(
        F.count(F.lit(1)).alias("cells"), F.count(bare).alias("filled"),
        *(F.count(cast_cell(F.col("cell"), kind)).alias(kind) for kind in WRITTEN),
    ).select(F.get(names, F.col("place")).alias("column_name"), "*")


def merged(profile: DataFrame) -> DataFrame:
    """Profiles of several loads as one; a column that some loads lack counts where it is."""
    return profile.groupBy("column_name").agg(F.min("place").alias("place"), *(F.sum(f"`{c}`").alias(c) for c in ("cells", "filled", *WRITTEN)))


def column_types(profile: DataFrame) -> DataFrame:
    """(column_name, data_type, cells, filled) in the order of the columns."""
    narrowest = F.coalesce(*(F.when((F.col("filled") > 0) & (F.col(f"`{kind}`") == F.col("filled")), F.lit(kind)) for kind in WRITTEN), F.lit("string"))
    return profile.orderBy("place", "column_name").select("column_name", narrowest.alias("data_type"), "cells", "filled")


def types_of(profile: DataFrame) -> dict[str, str]:
    """Type by column; one row per column comes to the driver."""
    return {r.column_name: r.data_type for r in column_types(profile).collect()}


def with_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Text columns as values of the given types; cells that don't fit become null, other columns stay."""
    return df.select(*(cast_cell(F.col(f"`{c}`"), types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in df.columns))


def read_typed_csv(spark: SparkSession, path: str, sep: str = ",", header: bool = True, multi_line: bool = False) -> DataFrame:
    """CSV whose column types follow from all cells of all files: one scan finds them, the next reads."""
    text = read_csv(spark, path, sep=sep, header=header, multi_line=multi_line)
    return with_types(text, types_of(cell_profile(text)))


def store_profile(profile: DataFrame, path: str, load: int) -> None:
    """Keeps the profile of a numbered load; the same load again replaces it."""
    profile.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/load={load}")


def stored_profile(spark: SparkSession, path: str) -> DataFrame:
    """The profile of all loads kept so far, from their stored counts alone."""
    return merged(spark.read.parquet(path))
