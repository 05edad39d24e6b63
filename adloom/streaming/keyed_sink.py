"""A keyed table fed by numbered batches, of a stream or of repeated loads: each appended in its
own folder, read as last write per key, and folded into runs of growing size (:mod:`~adloom.streaming.tiers`)."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from adloom.operators.ranking import latest_per_key
from adloom.sources import folders
from adloom.sources.tables import cluster_for_reads, entry_name, read_buckets, write_buckets
from adloom.streaming import tiers
from adloom.streaming.tiers import BATCH


def append_batches(path: str, key: Sequence[str], written: Sequence[str], partition_key: Sequence[str],
                   clustering: Sequence[Column], ranged: bool = False, buckets: int = 0) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` body. Each micro-batch overwrites its own folder, so a
    batch replayed after a failure replaces itself and adds nothing. Older data is
    never rewritten, whatever keys the batch brings: the cost of a batch is the
    size of the batch. ``ranged`` (also of :func:`compact`) saves a shuffle where keys seldom repeat
    and begin with the partition key, see :func:`latest_per_key`.

    ``buckets`` of the first batch hold for the table from then on: batches and runs are dealt into so many by the whole key and sorted by it,
    so they are read together and folded without moving a row. A read by the partition key alone then looks into every bucket."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        dealt = _buckets(spark, path, buckets)
        if dealt:
            write_buckets(latest_per_key(batch, key, written, buckets=dealt), f"{path}/{BATCH}={batch_id}", key, dealt)
            return
        rows = latest_per_key(batch, key, written, ranged)
        cluster_for_reads(rows, partition_key, clustering, ranged).write.mode("overwrite").option(
            "partitionOverwriteMode", "static").parquet(f"{path}/{BATCH}={batch_id}")

    return write


def upsert_stream(rows: DataFrame, path: str, checkpoint: str, key: Sequence[str], written: Sequence[str],
                  partition_key: Sequence[str], clustering: Sequence[Column]) -> DataStreamWriter:
    return (
        rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
        .foreachBatch(append_batches(path, key, written, partition_key, clustering))
    )


def last_fold(spark: SparkSession, path: str) -> int | None:
    """The last batch id held by a folded run; None if nothing was folded."""
    return tiers.manifest(spark, path).upto


def _buckets(spark: SparkSession, path: str, wanted: int = 0) -> int:
    """Of the table, 0 if it has none. They are noted beside it by its first batch, as no number but that will do."""
    note = f"{path.rstrip('/')}-buckets"
    if folders.exists(spark, f"{note}/_SUCCESS"):
        found = spark.read.schema("buckets bigint").json(note).first().buckets
        if wanted and wanted != found:
            raise ValueError(f"{path} has {found} buckets, not {wanted}")
        return found
    if wanted:
        if tiers.batch_ids(spark, path) or tiers.manifest(spark, path).runs:
            raise ValueError(f"{path} has batches without buckets")
        spark.createDataFrame([(wanted,)], "buckets bigint").coalesce(1).write.mode("overwrite").json(note)
    return wanted


def _entries(path: str) -> str:
    """What the names of a table's entries in the catalog begin with, up to the generation."""
    return f"keyed_{hashlib.md5(path.rstrip('/').encode()).hexdigest()}"


def _layout(spark: SparkSession, path: str, schema: str, key: Sequence[str], written: Sequence[str], partition_key: Sequence[str] = (),
            clustering: Sequence[Column] = (), ranged: bool = False) -> tiers.Layout:
    dealt = _buckets(spark, path)

    def read(spark: SparkSession, folder: str, batched: bool) -> DataFrame:
        return spark.read.schema(f"{schema}, {BATCH} bigint" if batched else schema).parquet(folder)

    def write(rows: DataFrame, folder: str) -> None:
        if dealt:
            write_buckets(rows, folder, key, dealt)
            return
        cluster_for_reads(rows, partition_key, clustering, ranged).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(folder)

    def together(spark: SparkSession, places: dict[int, str], generation: int) -> DataFrame:
        return read_buckets(spark, entry_name(f"{_entries(path)}_{generation}"), schema, places, BATCH, key, dealt)

    return tiers.Layout(read, write, lambda rows: latest_per_key(rows, key, [BATCH, *written], ranged, dealt).drop(BATCH), together if dealt else None)


def read_upserted(spark: SparkSession, path: str, schema: str, key: Sequence[str],
                  written: Sequence[str], ranged: bool = False) -> DataFrame:
    """The table as of now: per key the row of the latest batch, out of the folded runs and the
    batches after them. ``ranged`` shuffles rows in the order they are stored in, which packs better, and samples them first."""
    return tiers.current(spark, path, _layout(spark, path, schema, key, written, ranged=ranged))


def compact(spark: SparkSession, path: str, schema: str, key: Sequence[str], written: Sequence[str],
            partition_key: Sequence[str], clustering: Sequence[Column], fanout: int = tiers.FANOUT, ranged: bool = False) -> int | None:
    """Folds the batches since the last fold, while a stream or further loads may go on; older runs are
    rewritten only when ``fanout`` of a size have come together. Returns the last batch id that is folded."""
    upto = tiers.fold(spark, path, _layout(spark, path, schema, key, written, partition_key, clustering, ranged), fanout)
    kept, label = tiers.manifest(spark, path).generation - 1, f"adloom_{_entries(path)}_"
    for entry in spark.sql(f"SHOW TABLES LIKE '{label}*'").collect():
        if int(entry.tableName.removeprefix(label).split("_")[0]) < kept:  # as with the files they lead to
            spark.sql(f"DROP TABLE IF EXISTS {entry.tableName}")
    return upto
