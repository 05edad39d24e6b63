"""JSON messages of unknown shape: every field is kept, whatever the sender adds.

A message is parsed once into a variant. Fields are listed with their kinds without naming any beforehand, and
messages are read as the columns one asks for plus all the rest as it came.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.session import scratch_dir

ROOT = "$"
UNREADABLE = "unreadable"
_PLAIN = r"^[A-Za-z_][A-Za-z0-9_]*$"


def parsed(messages: DataFrame) -> DataFrame:
    """Messages with their content as ``v``; null where the text is no JSON, or names a field of one object twice."""
    return messages.withColumn("v", F.try_parse_json("value"))


def kind_of(v: Column) -> Column:
    """object, array, string, boolean, bigint, decimal, double, null, or unreadable for no JSON at all."""
    name = F.lower(F.regexp_extract(F.schema_of_variant(v), "^[A-Za-z_]+", 0))
    return F.when(v.isNull(), F.lit(UNREADABLE)).when(name == "void", F.lit("null")).otherwise(name)


def _step(parent: Column, key: Column) -> Column:
    """The path of a member; elements of an array share one path."""
    named = F.when(key.rlike(_PLAIN), F.concat(F.lit("."), key)).otherwise(
        F.concat(F.lit('."'), F.replace(F.replace(key, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"')))
    return F.concat(parent, F.coalesce(named, F.lit("[*]")))


def message_fields(messages: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(path, kind, rows) of every field at every depth, per value of the columns ``by``.

    Works level by level: a level counts its values and writes those that have members, and
    the next reads only these. The number of levels is the depth of the deepest message. Elements
    of an array count one by one under one path; a message that is no JSON counts as unreadable at the root."""
    spark = messages.sparkSession
    folder = scratch_dir(spark, "message-fields")
    level, counts, depth = parsed(messages).select(*by, F.lit(ROOT).alias("path"), "v"), None, 0
    while True:
        seen = level.withColumn("kind", kind_of(F.col("v")))
        found = seen.groupBy(*by, "path", "kind").agg(F.count(F.lit(1)).alias("rows"))
        found.write.parquet(f"{folder}/counts-{depth}")
        seen.where(F.col("kind").isin("object", "array")).drop("kind").write.parquet(f"{folder}/nested-{depth}")
        counts = [*(counts or []), f"{folder}/counts-{depth}"]
        nested = spark.read.parquet(f"{folder}/nested-{depth}")
        if nested.isEmpty():
            return spark.read.parquet(*counts)
        members = nested.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
        level = members.select(*by, _step(F.col("path"), F.col("key")).alias("path"), F.col("value").alias("v"))
        depth += 1


def open_columns(messages: DataFrame, fields: Mapping[str, tuple[str, str]], rest: str = "rest") -> DataFrame:
    """Fields by name as (path, type), and all top-level fields that no path leads through as JSON text in ``rest``.

    A field that is missing or of another type is null; ``rest`` is null where nothing is left.
    Messages that are no JSON objects are left out (see :func:`unreadable`)."""
    members = F.expr("try_cast(v AS map<string, variant>)")
    known = {path.removeprefix("$.").split(".")[0].split("[")[0] for path, _ in fields.values()}
    others = F.map_filter("_members", lambda name, _: ~name.isin(*known))
    rows = parsed(messages).withColumn("_members", members).where(F.col("_members").isNotNull())
    return rows.select(*(F.try_variant_get("v", path, kind).alias(name) for name, (path, kind) in fields.items()),
                       F.when(F.size(others) > 0, F.to_json(others)).alias(rest))


def unreadable(messages: DataFrame) -> DataFrame:
    """Messages that are no JSON objects."""
    return parsed(messages).where(F.expr("try_cast(v AS map<string, variant>)").isNull()).select("value")
