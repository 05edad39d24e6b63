"""Campaign and advertiser marts kept up to date from a stream of ad events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.functions import kpi
from adloom.streaming.states import Sums


def campaign_sums() -> Sums:
    """Additive state of a campaign. Money is summed as decimal, so the order of the batches changes no cent."""
    return Sums(
        {"campaign_id": "bigint"},
        {"impressions": (F.count("event_id"), "bigint"), "clicks": (kpi.clicks_by_revenue(), "bigint"),
         "cost": (F.sum("ad_cost"), "decimal(38,2)"), "revenue": (F.sum("ad_revenue"), "decimal(38,2)")})


def campaign_summary(states: DataFrame) -> DataFrame:
    """The campaign report out of added-up states; what is no sum is worked out here."""
    return states.filter(F.col("campaign_id").isNotNull()).select(
        "campaign_id", F.col("impressions").alias("total_impressions"), F.col("clicks").alias("total_clicks"),
        kpi.as_double("cost").alias("total_spend"), F.coalesce(kpi.ctr_pct("clicks", "impressions"), F.lit(0.0)).alias("ctr"))


def advertiser_report(states: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Spend, return and click-through rate per advertiser, rolled up from the states of its campaigns."""
    owned = campaigns.select("campaign_id", "advertiser_id").filter(F.col("advertiser_id").isNotNull())
    totals = states.join(owned, "campaign_id").groupBy("advertiser_id").agg(*(F.sum(c).alias(c) for c in ("impressions", "clicks", "cost", "revenue")))
    return totals.select(
        "advertiser_id", "impressions", "clicks", kpi.as_double("cost").alias("total_spend"),
        kpi.ctr_pct("clicks", "impressions").alias("ctr"), kpi.roas("revenue", "cost").alias("roas"))
