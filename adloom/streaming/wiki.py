"""Two chained jobs on wiki change messages: keep human edits of some sites, then
type the messages and store them by site."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from adloom import schemas
from adloom.functions import text
from adloom.functions.shape import present
from adloom.sources.messages import message_writer, to_messages
from adloom.streaming.keyed_sink import compact, read_upserted, upsert_stream

# The sites that are kept.
ALLOWED_DOMAINS = ("en.wikipedia.org", "www.wikidata.org", "commons.wikimedia.org")

PAGE_KEY = ("domain", "created_at", "page_title")
PAGE_SCHEMA = "domain string, created_at timestamp, page_title string, user_id string"


def parse_changes(messages: DataFrame) -> DataFrame:
    """Message text to flat columns, the text itself kept as ``value``. A text that
    is no JSON, and a field that is missing or of another type, gives nulls."""
    data = messages.select("value", F.from_json("value", schemas.WIKI_INPUT).alias("d"))
    return data.select(
        "value",
        F.col("d.performer.user_text").alias("user_id"),
        F.col("d.meta.domain").alias("domain"),
        F.col("d.meta.dt").alias("created_at"),
        F.col("d.page_title").alias("page_title"),
        F.col("d.performer.user_is_bot").alias("user_is_bot"))


def human_edits(changes: DataFrame) -> DataFrame:
    """Edits on the allowed sites by users known not to be bots."""
    return changes.filter(
        F.col("domain").isin(*ALLOWED_DOMAINS) & (F.col("user_is_bot") == False)  # noqa: E712
    ).drop("value")


def unreadable(messages: DataFrame) -> DataFrame:
    """The dead letters: messages that neither the filter nor the table can judge, because
    the site, a readable bot flag, the time or the title is missing, be they broken or incomplete."""
    changes = parse_changes(messages)
    return changes.filter(
        F.col("domain").isNull() | F.col("user_is_bot").isNull() | F.col("page_title").isNull()
        | text.to_instant(F.col("created_at")).isNull()).select("value")


def typed_pages(messages: DataFrame) -> DataFrame:
    """Processed messages as table rows. Rows without a full key are dropped; fields
    the table does not have are ignored."""
    data = messages.select(F.from_json("value", schemas.WIKI_PROCESSED).alias("d"))
    return present(data.select(
        F.col("d.domain").alias("domain"),
        text.to_instant(F.col("d.created_at")).alias("created_at"),
        F.col("d.page_title").alias("page_title"),
        F.col("d.user_id").alias("user_id"),
    ), *PAGE_KEY)


def filter_job(messages: DataFrame, checkpoint: str, fmt: str = "kafka", path: str | None = None,
               **options: str) -> DataStreamWriter:
    return message_writer(to_messages(human_edits(parse_changes(messages))), checkpoint, fmt, path, **options)


def dead_letter_job(messages: DataFrame, checkpoint: str, fmt: str = "kafka", path: str | None = None,
                    **options: str) -> DataStreamWriter:
    return message_writer(unreadable(messages), checkpoint, fmt, path, **options)


def _by_site() -> tuple[list[str], list[Column]]:
    return ["domain"], [F.desc("created_at"), F.asc("page_title")]


def table_job(messages: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Upserts pages by (site, time, title), newest first within a site. Two edits
    with one key in one batch differ in the user only; the larger name is kept."""
    return upsert_stream(typed_pages(messages), path, checkpoint, PAGE_KEY, ["user_id"], *_by_site())


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return read_upserted(spark, path, PAGE_SCHEMA, PAGE_KEY, ["user_id"])


def fold_pages(spark: SparkSession, path: str) -> int | None:
    """Folds the batches since the last fold; the job may go on meanwhile."""
    return compact(spark, path, PAGE_SCHEMA, PAGE_KEY, ["user_id"], *_by_site())
