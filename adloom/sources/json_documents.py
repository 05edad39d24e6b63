"""JSON documents that hold many records: a list, or one list per title, indented, written in parallel.

A document is a folder of text parts which, one after the other by name, are the text ``json.dumps`` gives for the same records.
Every record is written by the task that has it: the order comes from the frame, commas from the number of the
list's last record, and brackets are rows of their own before the first record and after the last.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.session import scratch_dir

INDENT = 4
CHUNK = 1 << 18  # characters of lines that a worker holds, or one record
_BEFORE, _AFTER = -1, (1 << 63) - 1


def _indented(batches: Iterator[pa.RecordBatch], step: int, depth: int, limit: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Records as the lines they take in the document, a chunk at a time: one record is parsed at once."""
    margin = " " * (step * depth)
    for batch in batches:
        part, at, records, commas = batch.columns
        lines, first, size = [], 0, 0
        for row in range(batch.num_rows):
            text = json.dumps(json.loads(records[row].as_py()), indent=step, ensure_ascii=False).replace("\n", f"\n{margin}")
            lines.append(margin + text + ("," if commas[row].as_py() else ""))
            size += len(lines[-1])
            if size >= limit or row == batch.num_rows - 1:
                done = slice(first, row + 1)
                yield pa.RecordBatch.from_arrays([part[done], at[done], pa.array(lines, pa.string())], ["part", "at", "value"])
                lines, first, size = [], row + 1, 0


def _write(lists: list[DataFrame], titles: list[str] | None, path: str, step: int) -> None:
    spark = lists[0].sparkSession
    staged = scratch_dir(spark, "json-document")
    for part, df in enumerate(lists):
        record = F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns)), {"ignoreNullFields": "false"})
        numbered = df.select(F.monotonically_increasing_id().alias("at"), record.alias("record"))  # grows along the order of the frame
        numbered.write.parquet(f"{staged}/part={part}")
    records = spark.read.schema("at long, record string, part int").parquet(staged)
    last = {r.part: r.at for r in records.groupBy("part").agg(F.max("at").alias("at")).collect()}  # one row per list
    depth = 1 if titles is None else 2
    brackets: list[tuple[int, int, str]] = []
    for part in range(len(lists)):
        margin, name = " " * (step * (depth - 1)), "" if titles is None else f"{json.dumps(titles[part], ensure_ascii=False)}: "
        comma = "," if part < len(lists) - 1 else ""
        if part in last:
            brackets += [(part, _BEFORE, f"{margin}{name}["), (part, _AFTER, f"{margin}]{comma}")]
        else:
            brackets.append((part, _BEFORE, f"{margin}{name}[]{comma}"))
    if titles is not None:
        brackets += [(-1, _BEFORE, "{"), (len(lists), _AFTER, "}")]
    ends = F.coalesce(*(F.when((F.col("part") == part) & (F.col("at") == at), F.lit(True)) for part, at in last.items()), F.lit(False))
    lines = records.select("part", "at", "record", (~ends).alias("comma")).mapInArrow(lambda b: _indented(b, step, depth), "part int, at long, value string")
    table = spark.createDataFrame(brackets, "part int, at long, value string")
    ordered = lines.unionByName(table).repartitionByRange("part", "at").sortWithinPartitions("part", "at")
    ordered.select("value").write.mode("overwrite").text(path)


def write_json_list(df: DataFrame, path: str, indent: int = INDENT) -> None:
    """The rows of a frame, in its order, as one JSON list; ``[]`` if there are none."""
    _write([df], None, path, indent)


def write_json_lists(results: Mapping[str, DataFrame], path: str, indent: int = INDENT) -> None:
    """One JSON object with a list of records per title, titles and records in order; ``[]`` for a result without rows."""
    _write(list(results.values()), list(results), path, indent)


def read_json_list(spark: SparkSession, path: str, schema: T.StructType | str, indent: int = INDENT) -> DataFrame:
    """The records of a written list, read in parallel: a record ends where a brace stands at its own depth."""
    end = f"\n{' ' * indent}}}"
    texts = spark.read.option("lineSep", f"{end},\n").text(path)
    bare = F.regexp_replace(F.regexp_replace("value", r"^\[(\]\s*$|\n)", ""), rf"{end}\n\]\s*$", "")
    return texts.select(bare.alias("value")).where(F.trim("value") != "").select(
        F.from_json(F.concat("value", F.lit("}")), schema).alias("r")).select("r.*")
