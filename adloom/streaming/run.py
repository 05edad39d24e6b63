"""Starting a stream: continuously, on an interval, or until its input is used up."""

from __future__ import annotations

from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def start(writer: DataStreamWriter, every: str | None = None) -> StreamingQuery:
    """Runs until stopped, batch after batch, or one batch per interval (``"60 seconds"``)."""
    return (writer.trigger(processingTime=every) if every else writer).start()


def drain(writer: DataStreamWriter) -> StreamingQuery:
    """Handles everything that has arrived, then stops; the final flush of a shutdown."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query
