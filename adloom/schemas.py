"""Declared schemas: raw text inputs, star schema, nested documents, messages."""

from __future__ import annotations

from pyspark.sql import types as T


def text_schema(*names: str) -> T.StructType:
    """Every column as string, the way a CSV file is read before it is cleaned."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Column names of the raw input files.
RAW_EVENTS = text_schema(
    "EventID", "UserID", "CampaignName", "AdvertiserName", "CampaignTargetingInterest",
    "Device", "Location", "Timestamp", "BidAmount", "AdCost", "AdRevenue", "WasClicked",
    "ClickTimestamp",
)
RAW_USERS = text_schema("UserID", "Age", "Gender", "Location", "Interests", "SignupDate")
RAW_CAMPAIGNS = text_schema(
    "CampaignID", "CampaignName", "AdvertiserName", "CampaignStartDate", "CampaignEndDate",
    "TargetingCriteria", "AdSlotSize", "Budget", "RemainingBudget",
)
RAW_REVIEWS = text_schema(
    "product_id", "review_date", "review_id", "customer_id", "star_rating",
    "review_headline", "review_body", "verified_purchase",
)
RAW_TWEETS = text_schema("author_id", "text")

# Column order of the star-schema tables.
LOCATIONS = ("location_id", "country_name")
ADVERTISERS = ("advertiser_id", "advertiser_name")
USERS = ("user_id", "age", "gender", "location_id", "signup_date")
USER_INTERESTS = ("user_id", "interest_name")
CAMPAIGNS = (
    "campaign_id", "advertiser_id", "campaign_name", "start_date", "end_date",
    "target_age_min", "target_age_max", "target_interest", "target_location_id",
    "ad_slot_size", "budget", "remaining_budget",
)
FACT_EVENTS = (
    "event_id", "campaign_id", "user_id", "device", "location_id", "event_timestamp",
    "bid_amount", "ad_cost", "was_clicked", "click_timestamp", "ad_revenue",
)

# Names of raw columns in the star-schema tables.
CAMPAIGN_NAMES = {
    "CampaignID": "campaign_id", "CampaignName": "campaign_name",
    "CampaignStartDate": "start_date", "CampaignEndDate": "end_date", "Budget": "budget",
    "AdSlotSize": "ad_slot_size", "RemainingBudget": "remaining_budget",
}
USER_NAMES = {
    "UserID": "user_id", "Age": "age", "Gender": "gender", "SignupDate": "signup_date",
    "RegistrationDate": "signup_date", "Location": "location", "Interests": "interests",
}
EVENT_NAMES = {
    "EventID": "event_id", "UserID": "user_id", "Device": "device", "Timestamp": "event_timestamp",
    "BidAmount": "bid_amount", "AdCost": "ad_cost", "WasClicked": "was_clicked",
    "ClickTimestamp": "click_timestamp", "AdRevenue": "ad_revenue",
}

# Columns of the keyed review tables.
REVIEWS_BY_PRODUCT = (
    "product_id", "review_date", "review_id", "customer_id", "star_rating",
    "review_headline", "review_body",
)
REVIEWS_BY_PRODUCT_RATING = (
    "product_id", "star_rating", "review_date", "review_id", "customer_id",
    "review_headline", "review_body",
)
REVIEWS_BY_CUSTOMER = (
    "customer_id", "review_date", "review_id", "product_id", "star_rating", "review_headline",
)

# Enumerations of the star schema.
DEVICES = ("Mobile", "Desktop", "Tablet")
GENDERS = ("Male", "Female")

MONEY = T.DecimalType(12, 2)

CLICK = T.StructType([
    T.StructField("click_timestamp", T.StringType()),
    T.StructField("ad_revenue", T.DoubleType()),
])

# Wiki change messages as they arrive, and as the filter job passes them on.
WIKI_INPUT = T.StructType([
    T.StructField("meta", text_schema("domain", "dt")),
    T.StructField("performer", T.StructType([
        T.StructField("user_text", T.StringType()),
        T.StructField("user_is_bot", T.BooleanType()),
    ])),
    T.StructField("page_title", T.StringType()),
])
WIKI_PROCESSED = text_schema("user_id", "domain", "created_at", "page_title")
TWEET = text_schema("author_id", "text", "created_at")
