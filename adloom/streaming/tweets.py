"""Replay of a CSV as messages, and routing of messages to files by event minute."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from adloom import schemas
from adloom.functions import text
from adloom.functions.shape import column_or
from adloom.operators.ranks import with_rank
from adloom.sources.files import read_csv, write_csv
from adloom.sources.messages import message_writer, to_messages
from adloom.sources.tables import cluster_for_reads
from adloom.streaming import tiers
from adloom.streaming.tiers import BATCH

UNKNOWN_MINUTE = "unknown_time"
FIELDS = ("author_id", "created_at", "text")
ISO_DAY = r"^\d{4}-\d{2}-\d{2}"
BROKEN = "_broken"


def replay_payload(rows: DataFrame) -> DataFrame:
    """Rows as tweets created now. The defaults stand in for a missing column; an
    empty cell of a column that exists stays as it is."""
    return rows.select(
        column_or(rows, "author_id", F.lit("unknown")).alias("author_id"),
        column_or(rows, "text", F.lit("")).alias("text"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("created_at"))


def follow_csv(spark: SparkSession, path: str, max_files: int = 1, multi_line: bool = False,
               columns: tuple[str, ...] = FIELDS[::2]) -> DataFrame:
    """A folder of CSV files as a stream. ``max_files`` per trigger together with the
    trigger interval caps the replay speed (with a broker, maxOffsetsPerTrigger)."""
    return (
        spark.readStream.schema(schemas.text_schema(*columns)).option("header", True)
        .option("quote", '"').option("escape", '"').option("multiLine", multi_line)
        .option("maxFilesPerTrigger", max_files).csv(path)
    )


def replay_job(rows: DataFrame, checkpoint: str, fmt: str = "kafka", path: str | None = None,
               **options: str) -> DataStreamWriter:
    return message_writer(to_messages(replay_payload(rows)), checkpoint, fmt, path, **options)


def number_rows(rows: DataFrame, order: str, path: str, ties: tuple[str, ...] = ()) -> int:
    """Stores rows with their place 0, 1, 2, ... as ``number``, laid out by it; returns how many there are."""
    cluster_for_reads(with_rank(rows, [], order, "number", ties=ties), ["number"], []).write.parquet(path)
    return rows.sparkSession.read.parquet(path).count()


def paced_job(numbered: DataFrame, path: str, checkpoint: str, start: str, rate: int = 12, seconds: int = 1) -> DataStreamWriter:
    """Replays numbered rows at an exact rate: ``rate`` messages per second of a clock that starts at ``start``.

    The clock is a stream of numbers, ``rate * seconds`` per batch; a batch sends the rows of its numbers, each with the
    second it is due as ``created_at``. Its rows are found by their number, so a batch costs what it
    sends, and it owns a folder, so one that is run again sends nothing twice. Triggered every ``seconds``, the clock
    keeps the time of the wall."""
    spark = numbered.sparkSession
    per_batch = rate * seconds
    clock = (spark.readStream.format("rate-micro-batch").option("rowsPerBatch", per_batch).option("numPartitions", 1)
             .option("advanceMillisPerBatch", 1000 * seconds).option("startTimestamp", 0).load())
    begin = F.lit(start).cast("timestamp_ntz")

    def send(ticks: DataFrame, batch_id: int) -> None:
        first, last = ticks.agg(F.min("value"), F.max("value")).first()
        due = numbered.filter(F.col("number").between(first, last)).join(ticks.select(F.col("value").alias("number")), "number")
        at = begin + F.make_dt_interval(secs=F.expr(f"number div {rate}"))
        sent = due.withColumn("created_at", text.iso_text(at)).orderBy("number")
        to_messages(sent).write.mode("overwrite").text(f"{path}/{BATCH}={batch_id}")

    return clock.writeStream.option("checkpointLocation", checkpoint).foreachBatch(send)


def replay_paced(writer: DataStreamWriter, rows: int, rate: int, seconds: int, every: str = "0 seconds") -> None:
    """Runs a paced replay until all rows are sent."""
    batches = -(-rows // (rate * seconds))
    query = writer.trigger(processingTime=every).start()
    try:
        while batches and query.isActive and (query.lastProgress is None or query.lastProgress["batchId"] < batches - 1):
            query.awaitTermination(0.05)
    finally:
        query.stop()
    if query.exception() is not None:
        raise query.exception()


def _parsed(messages: DataFrame) -> DataFrame:
    """JSON fields as ``d``, and whether the text was a JSON object at all."""
    schema = T.StructType([*schemas.TWEET.fields, T.StructField(BROKEN, T.StringType())])
    data = messages.select("value", F.from_json("value", schema, {"columnNameOfCorruptRecord": BROKEN}).alias("d"))
    return data.withColumn("readable", F.col("d").isNotNull() & F.col(f"d.{BROKEN}").isNull())


def unreadable(messages: DataFrame) -> DataFrame:
    """Messages that are no JSON objects: the dead letters."""
    return _parsed(messages).filter(~F.col("readable")).select("value")


def dead_letter_job(messages: DataFrame, checkpoint: str, fmt: str = "kafka", path: str | None = None,
                    **options: str) -> DataStreamWriter:
    return message_writer(unreadable(messages), checkpoint, fmt, path, **options)


def minute_rows(messages: DataFrame) -> DataFrame:
    """Tweets with the minute they were created in; texts that are no time go to one
    bucket of their own. Missing fields become empty text."""
    fields = [F.coalesce(F.col(f"d.{name}"), F.lit("")).alias(name) for name in FIELDS]
    rows = _parsed(messages).filter(F.col("readable")).select(*fields)
    minute = F.when(F.col("created_at").rlike(ISO_DAY), text.minute_label(text.to_wall_clock(F.col("created_at"))))
    return rows.withColumn("time_key", F.coalesce(minute, F.lit(UNKNOWN_MINUTE)))


def append_minutes(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` body that files rows by minute, late rows under their old
    minute. Ranges are cut on minute and row hash: a minute fills few files, and one
    that holds most of the batch is still written by many tasks.

    Every batch owns a folder with the minutes inside. A replayed batch replaces its
    own folder and nothing else, and no existing file is opened again."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_csv(_by_minute(batch), f"{path}/batch_id={batch_id}", partition_by=("time_key",))

    return write


def _by_minute(rows: DataFrame) -> DataFrame:
    return rows.repartitionByRange("time_key", F.xxhash64(*FIELDS))


def minute_job(messages: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    return (
        minute_rows(messages).writeStream.outputMode("append").option("checkpointLocation", checkpoint)
        .foreachBatch(append_minutes(path))
    )


def _read_folder(spark: SparkSession, folder: str, batched: bool) -> DataFrame:
    batch = [T.StructField(BATCH, T.LongType())] if batched else []
    raw = read_csv(spark, folder, multi_line=True, schema=T.StructType([*schemas.text_schema(*FIELDS, "time_key").fields, *batch]))
    return raw.select(*[F.coalesce(c, F.lit("")).alias(c) for c in FIELDS], "time_key", *(f.name for f in batch))


# Rows have no key, so nothing of them is combined; what a fold changes is the number of files.
_LAYOUT = tiers.Layout(_read_folder, lambda rows, folder: write_csv(_by_minute(rows), folder, partition_by=("time_key",)), lambda rows: rows.drop(BATCH))


def read_minutes(spark: SparkSession, path: str) -> DataFrame:
    """All minutes written so far, folded or not, empty cells as empty text."""
    return tiers.current(spark, path, _LAYOUT)


def fold_minutes(spark: SparkSession, path: str, fanout: int = tiers.FANOUT) -> int | None:
    """Puts the files of the batches since the last fold together, few per minute, while batches go on
    arriving; late rows of a minute are folded like any other."""
    return tiers.fold(spark, path, _LAYOUT, fanout)


def compact_minutes(spark: SparkSession, path: str, target: str) -> None:
    """Rewrites the files of all batches into few per minute, at a new place."""
    write_csv(_by_minute(read_minutes(spark, path)), target, partition_by=("time_key",))
