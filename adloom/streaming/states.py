"""Marts kept up to date from a stream by additive states.

A batch is brought down to one row per key: sums and counts. These rows are stored by batch and added up on read, so no
stored row is changed, a batch costs what it brings, and a batch that is run again after a failure
replaces its own rows instead of being counted twice. Folding adds states up for good. Whatever follows from sums
(rates, averages, roll-ups to coarser keys) is worked out on read.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from adloom.sources.tables import cluster_for_reads
from adloom.streaming import tiers
from adloom.streaming.tiers import BATCH


class Sums(NamedTuple):
    """Keys of a mart, and its additive columns: name -> (aggregate over input rows, stored type)."""

    keys: Mapping[str, str]
    columns: Mapping[str, tuple[Column, str]]

    @property
    def schema(self) -> str:
        return ", ".join(f"{name} {kind}" for name, kind in [*self.keys.items(), *((name, kind) for name, (_, kind) in self.columns.items())])

    def of(self, rows: DataFrame) -> DataFrame:
        """States of some input rows."""
        return rows.groupBy(*self.keys).agg(*(total.cast(kind).alias(name) for name, (total, kind) in self.columns.items()))

    def added(self, states: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
        """States added up per key, or per coarser key. A sum over nothing but nulls stays null."""
        return states.groupBy(*(self.keys if keys is None else keys)).agg(
            *(F.sum(name).cast(kind).alias(name) for name, (_, kind) in self.columns.items()))


def _layout(sums: Sums) -> tiers.Layout:
    def read(spark: SparkSession, folder: str, batched: bool) -> DataFrame:
        return spark.read.schema(f"{sums.schema}, {BATCH} bigint" if batched else sums.schema).parquet(folder)

    def write(rows: DataFrame, folder: str) -> None:
        cluster_for_reads(rows, list(sums.keys), []).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(folder)

    return tiers.Layout(read, write, sums.added)


def append_states(path: str, sums: Sums) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` body: the states of a batch, in a folder of its own."""

    def write(batch: DataFrame, batch_id: int) -> None:
        sums.of(batch).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/{BATCH}={batch_id}")

    return write


def state_stream(rows: DataFrame, path: str, checkpoint: str, sums: Sums) -> DataStreamWriter:
    return rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(append_states(path, sums))


def read_states(spark: SparkSession, path: str, sums: Sums, keys: Sequence[str] | None = None) -> DataFrame:
    """Sums over all batches so far, per key or per some of the keys."""
    return sums.added(tiers.stored(spark, path, _layout(sums)), keys)


def fold_states(spark: SparkSession, path: str, sums: Sums) -> int | None:
    return tiers.fold(spark, path, _layout(sums))
