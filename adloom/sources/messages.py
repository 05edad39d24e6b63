"""Message streams. A message is a row with a ``value`` column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter


def read_messages(spark: SparkSession, fmt: str = "kafka", path: str | None = None,
                  **options: str) -> DataFrame:
    """Unbounded stream with ``value`` as text.

    ``fmt="kafka"`` takes the broker's options (kafka.bootstrap.servers, subscribe,
    maxOffsetsPerTrigger) and starts at the earliest offset; progress is kept in the
    checkpoint of the query. ``fmt="text"`` follows a folder of JSON lines.
    """
    if fmt == "kafka":
        options = {"startingOffsets": "earliest"} | options
    stream = spark.readStream.format(fmt).options(**options)
    return (stream.load(path) if path else stream.load()).select(F.col("value").cast("string").alias("value"))


def to_messages(df: DataFrame) -> DataFrame:
    """All columns packed into one JSON ``value``; null fields are left out."""
    return df.select(F.to_json(F.struct("*")).alias("value"))


def message_writer(messages: DataFrame, checkpoint: str, fmt: str = "kafka", path: str | None = None,
                   **options: str) -> DataStreamWriter:
    """Append-mode writer of ``value`` rows with checkpointed progress."""
    writer = (
        messages.writeStream.format(fmt).outputMode("append").options(**options)
        .option("checkpointLocation", checkpoint)
    )
    return writer.option("path", path) if path else writer
