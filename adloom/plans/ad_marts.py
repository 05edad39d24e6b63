"""One table per question, straight from the raw event text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.functions import flags, kpi, text
from adloom.functions.shape import present, rename_present
from adloom.operators.ranking import latest_per_key, top_per_group, top_rows

TIME_WINDOW = "last_30_days"


def _window_label() -> Column:
    return F.lit(TIME_WINDOW).alias("time_window")


def daily_campaign_ctr(raw_events: DataFrame, raw_campaigns: DataFrame) -> DataFrame:
    """Impressions, clicks and click-through rate per day and campaign.

    Events shrink to day and campaign name before names are resolved. A name shared
    by several campaigns counts for each, and for each row of a campaign: rows of one id and name are
    counted first, so the events are not grouped again. Rows without a day or a known campaign
    drop out. Both the id and the name are kept.
    """
    ids = rename_present(raw_campaigns, {"CampaignID": "campaign_id"}).select(
        text.to_long(F.col("campaign_id")).alias("campaign_id"), "CampaignName").filter(F.col("campaign_id").isNotNull())
    times = ids.groupBy("campaign_id", "CampaignName").agg(F.count(F.lit(1)).alias("times"))
    per_name = (
        raw_events.select(
            text.to_wall_clock(F.col("Timestamp")).cast("date").alias("event_date"),
            "CampaignName", "EventID", flags.clicked_truthy(F.col("WasClicked")).alias("clicked"))
        .filter(F.col("event_date").isNotNull())
        .groupBy("event_date", "CampaignName")
        .agg(F.count("EventID").alias("total_impressions"), F.count_if("clicked").alias("total_clicks"))
    )
    per_id = per_name.join(times, "CampaignName").select(
        text.day_label(F.col("event_date")).alias("event_date"), "campaign_id", F.col("CampaignName").alias("campaign_name"),
        (F.col("total_impressions") * F.col("times")).alias("total_impressions"),
        (F.col("total_clicks") * F.col("times")).alias("total_clicks"))
    return per_id.withColumn("ctr", kpi.ctr_fraction("total_clicks", "total_impressions"))


def _spend() -> Column:
    return F.coalesce(F.sum(text.to_money(F.col("AdCost"))), F.lit(0).cast("decimal(12,2)"))


def top_advertisers_by_spend(raw_events: DataFrame, k: int = 5) -> DataFrame:
    spend = (
        raw_events.filter(F.col("AdvertiserName").isNotNull())
        .groupBy(F.col("AdvertiserName").alias("advertiser_name")).agg(_spend().alias("total_spend"))
    )
    return top_rows(spend, [F.desc("total_spend"), F.asc("advertiser_name")], k).select(
        _window_label(), kpi.as_double("total_spend"), "advertiser_name")


def user_ad_history(raw_events: DataFrame, written: list[str]) -> DataFrame:
    """What each user saw and when; one row per user and time, the last write wins.
    ``written`` names the columns that say which of two rows was written later."""
    rows = present(raw_events.select(
        text.to_long(F.col("UserID")).alias("user_id"),
        text.to_wall_clock(F.col("Timestamp")).alias("event_timestamp"),
        F.col("CampaignName").alias("campaign_name"),
        flags.clicked_strict(F.col("WasClicked")).alias("was_clicked"),
        *[F.col(c).alias(f"_w{i}") for i, c in enumerate(written)],
    ), "user_id", "event_timestamp")
    order = [f"_w{i}" for i in range(len(written))]
    return latest_per_key(rows, ["user_id", "event_timestamp"], order).drop(*order)


def user_ad_history_page(history: DataFrame, user_id: int | None = None, limit: int = 10) -> DataFrame:
    """The newest entries of one user, or of every user."""
    rows = history if user_id is None else history.filter(F.col("user_id") == user_id)
    return top_per_group(rows, ["user_id"], [F.desc("event_timestamp")], limit)


def top_users_by_clicks(raw_events: DataFrame, k: int = 10) -> DataFrame:
    clicks = (
        raw_events.filter(flags.clicked_strict(F.col("WasClicked")))
        .select(text.to_long(F.col("UserID")).alias("user_id")).filter(F.col("user_id").isNotNull())
        .groupBy("user_id").agg(F.count(F.lit(1)).alias("total_clicks"))
    )
    return top_rows(clicks, [F.desc("total_clicks"), F.asc("user_id")], k).select(
        _window_label(), "total_clicks", "user_id")


def top_advertisers_by_region(raw_events: DataFrame, raw_users: DataFrame, k: int = 5) -> DataFrame:
    """Biggest spenders per home region of the user who saw the ad. Events shrink to one row
    per user and advertiser before they meet the users."""
    regions = present(rename_present(raw_users, {"Location": "region"}).select("UserID", "region"), "UserID", "region")
    per_user = (
        present(raw_events.select("UserID", "AdvertiserName", "AdCost"), "UserID", "AdvertiserName")
        .groupBy("UserID", F.col("AdvertiserName").alias("advertiser_name"))
        .agg(_spend().alias("spend"))
    )
    spend = (
        per_user.join(regions, "UserID")
        .groupBy("region", "advertiser_name").agg(F.sum("spend").alias("total_spend"))
    )
    best = top_per_group(spend, ["region"], [F.desc("total_spend"), F.asc("advertiser_name")], k)
    return best.select("region", _window_label(), kpi.as_double("total_spend"), "advertiser_name")
