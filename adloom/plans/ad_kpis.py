"""KPI reports over the star schema.

Reports first shrink the event fact to one row per campaign (or location, user,
device), where partial aggregation in the map tasks absorbs hot keys, and only
then join dimensions. Every top-k ends in a unique tie-break.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.functions import kpi
from adloom.functions.shape import within
from adloom.operators.ranking import top_rows


def _in_window(events: DataFrame, start: str | None, end: str | None) -> DataFrame:
    return events.filter(within("event_timestamp", start, end)) if start else events


def campaign_performance(events: DataFrame, campaigns: DataFrame, start: str, end: str, k: int = 5) -> DataFrame:
    """Campaigns with the best click-through rate."""
    best = top_rows(
        _in_window(events, start, end).groupBy("campaign_id")
        .agg(F.sum("ad_cost").alias("total_cost"),
             kpi.ctr_pct(kpi.clicks_by_revenue(), F.count("event_id")).alias("ctr")),
        [F.desc("ctr"), F.asc("campaign_id")], k)
    return (
        best.join(campaigns.select("campaign_id", "campaign_name"), "campaign_id", "left")
        .orderBy(F.desc("ctr"), F.asc("campaign_id"))
        .select("campaign_name", "ctr", kpi.as_double("total_cost"))
    )


def advertiser_spending(events: DataFrame, campaigns: DataFrame, advertisers: DataFrame,
                        start: str, end: str, k: int = 5) -> DataFrame:
    """Advertisers that spent most, with their click-through rate."""
    per_campaign = _in_window(events, start, end).groupBy("campaign_id").agg(
        F.sum("ad_cost").alias("cost"), kpi.clicks_by_revenue().alias("clicks"),
        F.count("event_id").alias("impressions"))
    spenders = top_rows(
        per_campaign.join(campaigns.select("campaign_id", "advertiser_id"), "campaign_id")
        .groupBy("advertiser_id")
        .agg(F.sum("cost").alias("total_cost"), F.sum("clicks").alias("clicks"),
             F.sum("impressions").alias("impressions")),
        [F.desc("total_cost"), F.asc("advertiser_id")], k)
    return (
        spenders.join(advertisers, "advertiser_id")
        .orderBy(F.desc("total_cost"), F.asc("advertiser_id"))
        .select("advertiser_name", kpi.as_double("total_cost"),
                kpi.ctr_pct("clicks", "impressions").alias("ctr"))
    )


def cost_efficiency(events: DataFrame, locations: DataFrame, start: str, end: str, k: int = 30) -> DataFrame:
    """Country and campaign pairs with most revenue: cost per mille and per click."""
    per_pair = _in_window(events, start, end).groupBy("location_id", "campaign_id").agg(
        F.sum("ad_cost").alias("cost"), F.sum("ad_revenue").alias("revenue"),
        kpi.clicks_by_revenue().alias("clicks"), F.count("event_id").alias("impressions"))
    best = top_rows(
        per_pair.join(locations, "location_id").groupBy("country_name", "campaign_id")
        .agg(F.sum("cost").alias("total_cost"), F.sum("revenue").alias("total_revenue"),
             F.sum("clicks").alias("clicks"), F.sum("impressions").alias("impressions")),
        [F.desc("total_revenue"), F.asc("country_name"), F.asc("campaign_id")], k)
    return best.select(
        "country_name", "campaign_id", kpi.as_double("total_revenue"), kpi.as_double("total_cost"),
        kpi.cpm("total_cost", "impressions").alias("cpm"), kpi.cpc("total_cost", "clicks").alias("cpc"))


def campaign_cost_per_click(events: DataFrame, locations: DataFrame, start: str, end: str) -> DataFrame:
    """Cost per click and per mille and return on ad spend of every campaign (no country) and of
    every country and campaign pair."""
    per_pair = _in_window(events, start, end).groupBy("location_id", "campaign_id").agg(
        F.sum("ad_cost").alias("cost"), F.sum("ad_revenue").alias("revenue"),
        kpi.clicks_by_revenue().alias("clicks"), F.count("event_id").alias("impressions"))
    sums = [F.sum(c).alias(c) for c in ("cost", "revenue", "clicks", "impressions")]
    by_country = per_pair.join(locations, "location_id").groupBy("country_name", "campaign_id").agg(*sums)
    in_all = per_pair.groupBy(F.lit(None).cast("string").alias("country_name"), "campaign_id").agg(*sums)
    return by_country.unionByName(in_all).select(
        "country_name", "campaign_id", "clicks", kpi.cpm("cost", "impressions").alias("cpm"),
        kpi.cpc("cost", "clicks").alias("cpc"), kpi.roas("revenue", "cost").alias("roas"))


def regional_analysis(events: DataFrame, locations: DataFrame, start: str, end: str, k: int = 10) -> DataFrame:
    """Countries with most revenue and their return on ad spend."""
    best = top_rows(
        _in_window(events, start, end).groupBy("location_id")
        .agg(F.sum("ad_revenue").alias("total_revenue"), F.sum("ad_cost").alias("total_cost"),
             kpi.clicks_by_revenue().alias("total_clicks"))
        .filter(F.col("total_revenue") > 0),
        [F.desc("total_revenue"), F.asc("location_id")], k)
    return (
        best.join(locations, "location_id")
        .orderBy(F.desc("total_revenue"), F.asc("location_id"))
        .select("country_name", kpi.as_double("total_revenue"), "total_clicks",
                kpi.roas("total_revenue", "total_cost").alias("roas"))
    )


def engaged_users(events: DataFrame, start: str, end: str, k: int = 20) -> DataFrame:
    """Users with most clicks, then the best click-through rate."""
    per_user = _in_window(events, start, end).groupBy("user_id").agg(
        F.count("event_id").alias("total_impressions"), kpi.clicks_by_revenue().alias("total_clicks"))
    rated = per_user.filter(F.col("total_clicks") > 0).withColumn(
        "user_ctr", kpi.ctr_pct("total_clicks", "total_impressions"))
    return top_rows(rated, [F.desc("total_clicks"), F.desc("user_ctr"), F.asc("user_id")], k)


def budget_consumption(events: DataFrame, campaigns: DataFrame, start: str, end: str,
                       over: float = 0.8) -> DataFrame:
    """Campaigns that used more than a share of their budget; zero budgets never do."""
    spent = _in_window(events, start, end).groupBy("campaign_id").agg(F.sum("ad_cost").alias("total_spent"))
    return (
        spent.join(campaigns.select("campaign_id", "campaign_name", "budget", "remaining_budget"), "campaign_id")
        .filter(kpi.over_share("total_spent", "budget", over))
        .select("campaign_name", kpi.as_double("budget"), kpi.as_double("total_spent"),
                kpi.as_double("remaining_budget"),
                kpi.budget_used_pct("total_spent", "budget").alias("budget_used_pct"))
        .orderBy(F.desc("budget_used_pct"), F.asc("campaign_name"))
    )


def campaign_device(events: DataFrame, campaigns: DataFrame, start: str, end: str) -> DataFrame:
    """Click-through rate and return on ad spend per campaign and device."""
    per_id = _in_window(events, start, end).groupBy("campaign_id", "device").agg(
        F.count("event_id").alias("impressions"), kpi.clicks_by_revenue().alias("clicks"),
        F.sum("ad_revenue").alias("revenue"), F.sum("ad_cost").alias("cost"))
    per_name = (
        per_id.join(campaigns.select("campaign_id", "campaign_name"), "campaign_id")
        .groupBy("campaign_name", "device")
        .agg(F.sum("impressions").alias("total_impressions"), F.sum("clicks").alias("total_clicks"),
             F.sum("revenue").alias("total_revenue"), F.sum("cost").alias("total_cost"))
    )
    return per_name.select(
        "campaign_name", "device", "total_impressions", "total_clicks", kpi.as_double("total_revenue"),
        kpi.ctr_pct("total_clicks", "total_impressions").alias("ctr"),
        kpi.roas("total_revenue", "total_cost").alias("roas"),
    ).orderBy("campaign_name", F.desc("ctr"), "device")


def device_performance(events: DataFrame, start: str, end: str) -> DataFrame:
    """Click-through rate per device."""
    per_device = _in_window(events, start, end).groupBy("device").agg(
        F.count("event_id").alias("total_impressions"), kpi.clicks_by_revenue().alias("total_clicks"))
    return per_device.withColumn("ctr", kpi.ctr_pct("total_clicks", "total_impressions")).orderBy(
        F.desc("ctr"), F.asc("device"))


def overall_performance(events: DataFrame) -> DataFrame:
    """The same figures over all events, in one row; zeros and nulls when there are none."""
    totals = events.agg(
        F.count("event_id").alias("total_impressions"), kpi.clicks_by_revenue().alias("total_clicks"),
        F.sum("ad_cost").cast("double").alias("total_spend"))
    return totals.withColumn(
        "ctr", F.coalesce(kpi.ctr_pct("total_clicks", "total_impressions"), F.lit(0.0)))


# Reports by key. Called with an id they answer for that one key, and an unknown id
# gives an empty frame; without, they build the mart that serves every key.

def campaign_summary(events: DataFrame, campaign_id: int | None = None) -> DataFrame:
    rows = events if campaign_id is None else events.filter(F.col("campaign_id") == campaign_id)
    totals = rows.filter(F.col("campaign_id").isNotNull()).groupBy("campaign_id").agg(
        F.count("event_id").alias("total_impressions"), kpi.clicks_by_revenue().alias("total_clicks"),
        F.sum("ad_cost").cast("double").alias("total_spend"))
    return totals.withColumn(
        "ctr", F.coalesce(kpi.ctr_pct("total_clicks", "total_impressions"), F.lit(0.0)))


def advertiser_total(events: DataFrame, campaigns: DataFrame, advertiser_id: int | None = None) -> DataFrame:
    owned = campaigns.select("campaign_id", "advertiser_id").filter(F.col("advertiser_id").isNotNull())
    if advertiser_id is not None:
        owned = owned.filter(F.col("advertiser_id") == advertiser_id)
    per_campaign = events.groupBy("campaign_id").agg(F.sum("ad_cost").alias("cost"))
    totals = per_campaign.join(owned, "campaign_id").groupBy("advertiser_id").agg(F.sum("cost").alias("cost"))
    return totals.filter(F.col("cost").isNotNull()).select(
        "advertiser_id", F.col("cost").cast("double").alias("total_spend"))


def user_engagements(events: DataFrame, campaigns: DataFrame, advertisers: DataFrame,
                     user_id: int | None = None) -> DataFrame:
    clicked = events.filter(F.col("ad_revenue") > 0)
    if user_id is not None:
        clicked = clicked.filter(F.col("user_id") == user_id)
    return (
        clicked.join(campaigns.select("campaign_id", "campaign_name", "advertiser_id"), "campaign_id")
        .join(advertisers, "advertiser_id")
        .select("user_id", "event_id", "campaign_name", "advertiser_name",
                F.col("event_timestamp").alias("timestamp"))
    )
