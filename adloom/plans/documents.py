"""User documents with nested impressions and clicks, and the questions asked of them.

The questions work on impressions, one row each. They come from stored documents
through :func:`impressions_of`, or directly from the events, which is cheaper when
the documents have not been built: building them only to take them apart again
would shuffle the events for nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom import schemas
from adloom.functions import flags, text
from adloom.functions.shape import column_or
from adloom.operators import nesting
from adloom.operators.ranking import top_per_group, top_rows

IMPRESSION = ("event_id", "timestamp", "device_location", "campaign_name", "advertiser_name",
              "ad_category", "clicks")
ORDER = "ingest_ord"


def impressions(raw_events: DataFrame, order: str = ORDER) -> DataFrame:
    """Raw events as impressions; a clicked one carries a one-element click array."""
    click = F.struct(
        F.col("ClickTimestamp").alias("click_timestamp"),
        F.coalesce(F.col("AdRevenue").try_cast("double"), F.lit(0.0)).alias("ad_revenue"),
    ).cast(schemas.CLICK)
    no_clicks = F.array().cast(T.ArrayType(schemas.CLICK))
    return raw_events.select(
        text.to_long(F.col("UserID")).alias("user_id"),
        F.col(order).alias(ORDER),
        F.col("EventID").alias("event_id"),
        F.col("Timestamp").alias("timestamp"),
        column_or(raw_events, "DeviceLocation", F.lit(None).cast("string")).alias("device_location"),
        F.col("CampaignName").alias("campaign_name"),
        F.col("AdvertiserName").alias("advertiser_name"),
        F.col("CampaignTargetingInterest").alias("ad_category"),
        F.when(flags.clicked_word(F.col("WasClicked")), F.array(click)).otherwise(no_clicks).alias("clicks"),
    )


def user_documents(raw_users: DataFrame, user_impressions: DataFrame, **pages: int) -> DataFrame:
    """Every user with demographics, interests and impressions (empty if none)."""
    users = raw_users.select(
        text.to_long(F.col("UserID")).alias("user_id"),
        F.struct(text.to_int(F.col("Age")).alias("age"), F.col("Gender").alias("gender"),
                 F.col("Location").alias("location"), F.col("SignupDate").alias("signup_date"),
                 ).alias("demographics"),
        text.comma_list(F.col("Interests")).alias("interests"),
    )
    return nesting.nest(users, user_impressions, "user_id", IMPRESSION, ORDER, "impressions", **pages).select(
        F.col("user_id").alias("_id"), "page", "demographics", "interests", "impressions")


def impressions_of(documents: DataFrame) -> DataFrame:
    return nesting.unnest(documents.withColumnRenamed("_id", "user_id"), "impressions", ["user_id"])


def user_history(documents: DataFrame, user_id: int) -> DataFrame:
    """The document of one user, page by page if it is a large one."""
    return documents.filter(F.col("_id") == user_id)


def last_sessions(documents: DataFrame, n: int = 5, user_id: int | None = None) -> DataFrame:
    """Each user's last ``n`` impressions in the order they were ingested.

    Only the tail of every stored array is read on, so a very large user brings
    ``n`` elements per row, and ``n`` remain after the tails are merged.
    """
    docs = documents if user_id is None else user_history(documents, user_id)
    size = F.size("impressions")
    tail = F.slice("impressions", F.greatest(size - (n - 1), F.lit(1)), F.lit(n))
    elements = docs.select("_id", "demographics", F.explode_outer(tail).alias("e"))
    kept = top_per_group(elements, ["_id"], [F.col(f"e.{ORDER}").desc_nulls_last()], n)
    return kept.groupBy("_id").agg(
        F.first("demographics").alias("demographics"),
        F.array_sort(F.collect_list("e"), lambda a, b: F.when(
            a[ORDER] < b[ORDER], -1).when(a[ORDER] > b[ORDER], 1).otherwise(0)).alias("last_sessions"))


def hourly_campaign_clicks(user_impressions: DataFrame, start: str, end: str,
                           advertiser: str | None = None) -> DataFrame:
    """Clicks per advertiser, campaign and hour of the click. Both ends of the range
    count, and it tests when the ad was shown; ISO texts compare as times do."""
    shown = user_impressions.filter((F.col("timestamp") >= start) & (F.col("timestamp") <= end))
    if advertiser is not None:
        shown = shown.filter(F.col("advertiser_name") == advertiser)
    clicks = shown.select("advertiser_name", "campaign_name", F.explode("clicks").alias("c"))
    return (
        clicks.groupBy("advertiser_name", F.col("campaign_name").alias("campaign"),
                       F.hour(text.to_wall_clock(F.col("c.click_timestamp"))).cast("bigint").alias("hour"))
        .agg(F.count(F.lit(1)).alias("total_clicks"))
        .orderBy("hour", "advertiser_name", "campaign")
    )


def ad_fatigue(user_impressions: DataFrame, at_least: int = 5) -> DataFrame:
    """Users who saw one campaign often and never clicked."""
    return (
        user_impressions.groupBy("user_id", F.col("campaign_name").alias("campaign"))
        .agg(F.count(F.lit(1)).alias("impression_count"), F.sum(F.size("clicks")).alias("click_count"))
        .filter((F.col("impression_count") >= at_least) & (F.col("click_count") == 0))
        .select("user_id", "campaign", "impression_count")
    )


def top_categories(user_impressions: DataFrame, k: int = 3, user_id: int | None = None) -> DataFrame:
    """Ad categories a user engaged with most, by clicked impressions."""
    rows = user_impressions if user_id is None else user_impressions.filter(F.col("user_id") == user_id)
    counts = (
        rows.filter(F.size("clicks") > 0)
        .groupBy("user_id", F.col("ad_category").alias("category"))
        .agg(F.count(F.lit(1)).alias("total_engagements"))
    )
    order = [F.desc("total_engagements"), F.asc("category")]
    if user_id is not None:
        return top_rows(counts, order, k)
    return top_per_group(counts, ["user_id"], order, k)
