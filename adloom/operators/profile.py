"""Column profile: type, filled, empty and distinct counts, exact or from sketches that add up."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Of the sketches: 2**14 registers, a standard error of 0.8 %.
SKETCH_BITS = 14
_ROWS = -1  # the place that counts rows


def _whole(c: Column, kind: T.DataType) -> Column | None:
    """Values of fixed width as whole numbers, one for each."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
        return c.cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("bigint")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    return None


def _typed(*frames: DataFrame) -> tuple[DataFrame, list[str]]:
    """One row (i, value of its class) per filled cell, and one per row at place -1; the names of the classes in use.

    Numbers, days and times stay as wide as they are; only what has no fixed width is text."""
    classes = {"whole": "bigint", "real": "double", "text": "string"}
    cells, used = [], set()
    for i, (at, field) in enumerate((at, f) for at, df in enumerate(frames) for f in df.schema.fields):
        c = F.col(f"`{field.name}`")
        whole = _whole(c, field.dataType)
        if whole is not None:
            name, value = "whole", whole
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            name, value = "real", c.cast("double")
        else:
            name, value = "text", c.cast("string")
        used.add(name)
        cells.append((at, i, name, value, c))
    used = [n for n in classes if n in used]
    cell = lambda i, name, value: F.struct(F.lit(i).alias("i"), *((value if n == name else F.lit(None)).cast(classes[n]).alias(n) for n in used))
    found = []
    for k, df in enumerate(frames):
        rows = [cell(_ROWS, None, None)] if k == 0 else []  # all frames have the same rows
        filled = [F.when(c.isNotNull(), cell(i, name, value)) for at, i, name, value, c in cells if at == k]
        found.append(df.select(F.explode(F.array_compact(F.array(*rows, *filled))).alias("e")).select("e.*"))
    return reduce(DataFrame.unionAll, found), used


def _named(counts: DataFrame, frames: Sequence[DataFrame], *more: str) -> DataFrame:
    """Counts per place, with names and types; columns without a filled cell included."""
    fields = [(_ROWS, None, None), *((i, f.name, f.dataType.simpleString()) for i, f in enumerate(f for df in frames for f in df.schema.fields))]
    columns = frames[0].sparkSession.createDataFrame(pa.Table.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*fields), (pa.int32(), pa.string(), pa.string()), strict=True)], ["i", "column_name", "data_type"]))
    filled = F.coalesce("filled", F.lit(0))
    rows = F.max(F.when(F.col("i") == _ROWS, filled)).over(Window.partitionBy())  # over a row per column
    return columns.join(counts, "i", "left").select("i", "column_name", "data_type", filled.alias("filled"), (rows - filled).alias("empty"), *more).where(
        F.col("i") != _ROWS).drop("i")


def column_profile(*frames: DataFrame, approx: bool = False) -> DataFrame:
    """One row per column. A wide table may come in several frames that hold the same rows and other columns:
    each then costs the joins of its own columns alone, and a task collapses the values of one frame at a time.

    Exact mode turns the table into (column, value) pairs of its filled cells, which map tasks collapse
    to one row per value before the single shuffle; a value filling a third of a
    column costs one row per task. ``approx`` keeps one sketch per column instead
    and shuffles next to nothing: use it where exact distinct counts are not needed.
    """
    if approx:
        return estimated(column_sketches(*frames))
    cells, used = _typed(*frames)
    values = cells.groupBy("i", *used).agg(F.count(F.lit(1)).alias("n"))
    counts = values.groupBy("i").agg(F.sum("n").alias("filled"), F.count(F.lit(1)).alias("distinct_values"))
    return _named(counts, frames, "distinct_values").withColumn("distinct_values", F.coalesce("distinct_values", F.lit(0)))


def column_sketches(*frames: DataFrame) -> DataFrame:
    """(column_name, data_type, filled, empty, sketch) in one pass over each frame of columns; rows of several loads add up."""
    cells, used = _typed(*frames)
    # Zero has one sign here, so that it is one value.
    value = F.coalesce(*((F.col(n) + F.lit(0.0) if n == "real" else F.col(n)).cast("string") for n in used))
    counts = cells.groupBy("i").agg(F.count(F.lit(1)).alias("filled"), F.hll_sketch_agg(value, SKETCH_BITS).alias("sketch"))
    return _named(counts, frames, "sketch")


def estimated(sketches: DataFrame) -> DataFrame:
    """The profile out of the sketches of any number of loads: filled and empty counts exact, distinct values estimated."""
    return sketches.groupBy("column_name", "data_type").agg(
        F.sum("filled").alias("filled"), F.sum("empty").alias("empty"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), F.lit(0)).alias("distinct_values"))


def store_sketches(frames: DataFrame | Sequence[DataFrame], path: str, load: int) -> None:
    """Keeps the sketches of a numbered load, whole or in frames of columns; the same load again replaces them."""
    column_sketches(*([frames] if isinstance(frames, DataFrame) else frames)).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/load={load}")


def profile_of_loads(spark: SparkSession, path: str) -> DataFrame:
    """The profile of all loads so far. Reads their sketches, a row per column and load, and none of their rows."""
    return estimated(spark.read.parquet(path))
