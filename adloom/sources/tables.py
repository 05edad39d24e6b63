"""Keyed tables: scans, loads, upserts, and layout for reads by key."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.operators.ranking import latest_per_key
from adloom.sources import folders as stored


def read_table(spark: SparkSession, path: str, columns: Sequence[str] = (), fmt: str = "parquet",
               **options: str) -> DataFrame:
    """Table scan with a column list. ``fmt`` may be any source on the class path;
    for jdbc the path is the table name."""
    reader = spark.read.format(fmt).options(**options)
    df = reader.option("dbtable", path).load() if fmt == "jdbc" else reader.load(path)
    return df.select(*columns) if columns else df


def run_sql(spark: SparkSession, text: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Spark SQL over named frames, written as ``{name}`` in the text; the session's own
    view names stay as they are."""
    return spark.sql(text, **tables)


def write_table(df: DataFrame, path: str, mode: str = "append", fmt: str = "parquet",
                **options: str) -> None:
    """``append`` adds to the table, ``overwrite`` is truncate and reload."""
    writer = df.write.format(fmt).mode(mode).options(**options)
    if fmt == "jdbc":
        writer.option("dbtable", path).option("truncate", True).save()
    else:
        writer.option("partitionOverwriteMode", "static").save(path)


def cluster_for_reads(df: DataFrame, partition_key: Sequence[str], clustering: Sequence[Column], ranged: bool = False) -> DataFrame:
    """Rows laid out by partition key and clustering order.

    Ranges are cut on key *and* clustering columns, so the rows of a hot key are
    spread over many sorted files, and the min/max statistics of each file let a
    read by key skip the others. Rows that are ``ranged`` by such columns already are only sorted.
    """
    order = [F.col(c) for c in partition_key] + list(clustering)
    return (df if ranged else df.repartitionByRange(*order)).sortWithinPartitions(*order)


def write_keyed(df: DataFrame, path: str, partition_key: Sequence[str], clustering: Sequence[Column],
                primary_key: Sequence[str] = (), written: Sequence[str] = (), mode: str = "overwrite",
                folders: bool = False, only_touched: bool = False, fmt: str = "parquet", lookups: Sequence[str] = (), ranged: bool = False) -> None:
    """Writes a query-first table. Given a primary key, only the last write per key
    is kept. ``folders`` makes one directory per partition key: for keys with few
    values, such as a month. With ``only_touched`` an overwrite replaces just the
    folders that the new rows belong to. ``lookups`` are columns other than the key that rows
    are looked up by (:func:`lookup`): each file gets a Bloom filter of their values. ``ranged`` says that the rows come
    from :func:`latest_per_key` by ranges of a key that starts with the partition key."""
    rows = latest_per_key(df, primary_key, written) if primary_key else df
    writer = cluster_for_reads(rows, partition_key, clustering, ranged).write.format(fmt).mode(mode).option(
        "partitionOverwriteMode", "dynamic" if only_touched else "static")
    for column in lookups:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    if fmt == "parquet":
        writer = writer.option("compression", "zstd")
    if folders:
        writer = writer.partitionBy(*partition_key)
    writer.save(path)


def read_by_key(table: DataFrame, key: Mapping[str, object], clustering: Sequence[Column] = (),
                limit: int | None = None) -> DataFrame:
    """Rows of one partition key in clustering order, optionally the first few."""
    rows = table
    for name, value in key.items():
        rows = rows.filter(F.col(name) == F.lit(value))
    if clustering:
        rows = rows.orderBy(*clustering)
    return rows.limit(limit) if limit is not None else rows


# Values a scan tests one by one against the filters and dictionaries of each row group.
PUSHED = 64


def lookup(table: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    """Rows with one of a few values of a column that the table is not sorted by.

    Equality tests reach the scan, which passes over row groups whose Bloom filter or dictionary has none of the values."""
    wanted = list(dict.fromkeys(v for v in values if v is not None))
    if len(wanted) > PUSHED:
        raise ValueError(f"more than {PUSHED} values: give them as a frame to lookup_batch")
    return table.filter(reduce(or_, (F.col(column) == F.lit(v) for v in wanted), F.lit(False)))


def lookup_batch(table: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """Rows whose value in ``column`` is among ``keys``, each once however often a key is listed.

    Few keys are tested in the scan, as in :func:`lookup`; more are joined, where Spark filters the scan at run time."""
    wanted = keys.select(column).where(F.col(column).isNotNull()).distinct()
    few = [r[0] for r in wanted.limit(PUSHED + 1).collect()]
    return lookup(table, column, few) if len(few) <= PUSHED else table.join(wanted, column, "left_semi")


def write_bucketed(df: DataFrame, name: str, path: str, key: Sequence[str], buckets: int) -> None:
    """A catalog table dealt into buckets by key. Tables with equal buckets are joined on that key, and
    grouped by it, without moving their rows again, however often that is done."""
    (df.repartition(buckets, *key).write.mode("overwrite").format("parquet").option("compression", "zstd").bucketBy(buckets, *key).sortBy(*key)
     .option("path", path).saveAsTable(name))


# Bytes of the files that rows come from, to a bucket.
BUCKET_BYTES = 16 << 20


def bucket_count(spark: SparkSession, path: str) -> int:
    """Buckets for rows read from the files at ``path``: one for a core at least, and so many that one task has room for a bucket."""
    return max(spark.sparkContext.defaultParallelism, -(-stored.stored_bytes(spark, path) // BUCKET_BYTES))


def entry_name(label: str) -> str:
    """A name of its own for an entry in the catalog."""
    return f"adloom_{label}_{uuid.uuid4().hex}"


def write_buckets(df: DataFrame, path: str, key: Sequence[str], buckets: int) -> None:
    """A folder of buckets without an entry in the catalog."""
    name = entry_name("write")
    write_bucketed(df, name, path, key, buckets)
    df.sparkSession.sql(f"DROP TABLE {name}")  # its files are no part of the warehouse and stay


def read_buckets(spark: SparkSession, name: str, schema: str, parts: Mapping[int, str], part: str, key: Sequence[str], buckets: int) -> DataFrame:
    """Several folders of equal buckets as one table, whose column ``part`` says which folder a row is from.

    Spark looks its files up in the catalog when a query over it is planned, so the entry has to stay as long as the frame is used."""
    if not parts:
        return spark.createDataFrame([], f"{schema}, {part} BIGINT")
    by, places = ", ".join(key), " ".join(f"PARTITION ({part} = {n}) LOCATION '{_quoted(path)}'" for n, path in parts.items())
    spark.sql(f"CREATE TABLE {name} ({schema}, {part} BIGINT) USING parquet PARTITIONED BY ({part}) CLUSTERED BY ({by}) SORTED BY ({by})"
              f" INTO {buckets} BUCKETS LOCATION '{_quoted(next(iter(parts.values())))}-{name}'")
    spark.sql(f"ALTER TABLE {name} ADD {places}")
    return spark.table(name)


def _quoted(path: str) -> str:
    return path.replace("\\", "\\\\").replace("'", "\\'")
