"""Raw event, user and campaign files into the star schema."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom import schemas
from adloom.functions import flags, text
from adloom.functions.shape import column_or, drop_present, keep_present, rename_present, strip_headers
from adloom.operators.lookup import resolve_key
from adloom.operators.surrogate import first_appearance_ids

UNKNOWN_ID = 0


def _parse_present(df: DataFrame, parsers: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """Types the text columns that the file has."""
    return df.withColumns({c: parse(F.col(c)) for c, parse in parsers.items() if c in df.columns})


def dim_locations(raw_users: DataFrame, ordinal: str) -> DataFrame:
    """Countries of the users, numbered as they first appear."""
    users = rename_present(raw_users, {"Location": "country_name", "location": "country_name"})
    return first_appearance_ids(users, "country_name", ordinal, "location_id")


def dim_advertisers(raw_campaigns: DataFrame, ordinal: str) -> DataFrame:
    named = raw_campaigns.withColumnRenamed("AdvertiserName", "advertiser_name")
    return first_appearance_ids(named, "advertiser_name", ordinal, "advertiser_id")


def dim_campaigns(raw_campaigns: DataFrame, advertisers: DataFrame, locations: DataFrame) -> DataFrame:
    """Campaigns with the targeting text taken apart and names turned into ids."""
    parsed = raw_campaigns.withColumns(text.targeting_fields(F.col("TargetingCriteria")))
    with_ids = resolve_key(parsed, advertisers, "AdvertiserName", "advertiser_name", "advertiser_id", "advertiser_id")
    with_ids = resolve_key(with_ids, locations, "target_country", "country_name", "location_id", "target_location_id")
    renamed = rename_present(drop_present(with_ids, "AdvertiserName", "TargetingCriteria", "target_country"), schemas.CAMPAIGN_NAMES)
    typed = _parse_present(renamed, {
        "campaign_id": text.to_long, "start_date": text.to_day, "end_date": text.to_day,
        "budget": text.to_money, "remaining_budget": text.to_double})
    return keep_present(typed, schemas.CAMPAIGNS)


def _users(raw_users: DataFrame) -> DataFrame:
    return rename_present(raw_users, schemas.USER_NAMES).withColumn("user_id", text.to_long(F.col("user_id")))


def dim_users(raw_users: DataFrame, locations: DataFrame) -> DataFrame:
    users = resolve_key(_users(raw_users), locations, "location", "country_name", "location_id", "location_id")
    return keep_present(_parse_present(users, {"age": text.to_int, "signup_date": text.to_day}), schemas.USERS)


def user_interests(raw_users: DataFrame) -> DataFrame:
    """One row per user and interest. A file without that column gives no rows."""
    users = _users(raw_users)
    interests = text.comma_list(column_or(users, "interests", F.lit(None).cast("string")))
    return users.select("user_id", F.explode(interests).alias("interest_name"))


def fact_events(raw_events: DataFrame, campaigns: DataFrame, locations: DataFrame) -> DataFrame:
    """Events with integer keys. Unknown campaigns and countries get id 0."""
    events = strip_headers(raw_events)
    events = resolve_key(events, campaigns, "CampaignName", "campaign_name", "campaign_id", "campaign_id", UNKNOWN_ID)
    events = resolve_key(events, locations, "Location", "country_name", "location_id", "location_id", UNKNOWN_ID)
    renamed = rename_present(events, schemas.EVENT_NAMES)
    typed = _parse_present(renamed, {
        "user_id": text.to_long, "event_timestamp": text.to_wall_clock, "bid_amount": text.to_money,
        "ad_cost": text.to_money, "was_clicked": flags.clicked_truthy,
        "click_timestamp": text.to_wall_clock, "ad_revenue": text.to_money})
    return keep_present(typed, schemas.FACT_EVENTS)


def _rule_rows(df: DataFrame, unique: dict[str, str], known: dict[str, str], offered: dict[str, str]) -> DataFrame:
    """(rule, number, text, used, known) of a table in one pass: keys that have to be unique, values that some
    other table has to have, and keys this one offers for that; each named rule -> column."""
    kinds = dict(df.dtypes)

    def entry(rule: str, column: str, used: int, there: int):
        number = kinds[column] in ("tinyint", "smallint", "int", "bigint")
        return F.struct(F.lit(rule).alias("rule"), (F.col(column) if number else F.lit(None)).cast("bigint").alias("number"),
                        (F.lit(None) if number else F.col(column)).cast("string").alias("text"), F.lit(used).alias("used"), F.lit(there).alias("known"))

    entries = [entry(rule, c, 1, 1) for rule, c in unique.items()]
    entries += [F.when(F.col(c).isNotNull(), entry(rule, c, 1, 0)) for rule, c in known.items()]
    entries += [F.when(F.col(c).isNotNull(), entry(rule, c, 0, 1)) for rule, c in offered.items()]
    return df.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*")


def schema_violations(locations: DataFrame, advertisers: DataFrame, users: DataFrame,
                      campaigns: DataFrame, events: DataFrame) -> DataFrame:
    """What key constraints of a database would reject: values that break each rule
    and the rows they are on. Rules that hold are listed with zeros.

    Every table is read once and turned into narrow rows of (rule, value), which map tasks collapse to one row per value;
    a single shuffle brings uses and keys together."""
    unique = {"locations.country_name unique": "country_name", "advertisers.advertiser_name unique": "advertiser_name",
              "users.user_id unique": "user_id", "campaigns.campaign_id unique": "campaign_id", "events.event_id unique": "event_id"}
    known = {"users.location_id known": "location_id", "campaigns.target_location_id known": "target_location_id",
             "events.campaign_id known": "campaign_id", "events.location_id known": "location_id", "events.user_id known": "user_id"}
    # The column of the other table that each value has to be in.
    offers = {"locations": {"users.location_id known": "location_id", "campaigns.target_location_id known": "location_id", "events.location_id known": "location_id"},
              "campaigns": {"events.campaign_id known": "campaign_id"}, "users": {"events.user_id known": "user_id"}}
    tables = {"locations": locations, "advertisers": advertisers, "users": users, "campaigns": campaigns, "events": events}
    own = lambda rules, name: {r: c for r, c in rules.items() if r.startswith(f"{name}.")}
    rows = [_rule_rows(df, own(unique, name), own(known, name), offers.get(name, {})) for name, df in tables.items()]
    per_value = reduce(DataFrame.unionByName, rows).groupBy("rule", "number", "text").agg(F.sum("used").alias("rows"), F.max("known").alias("known"))
    bad = per_value.filter(F.when(F.col("rule").endswith("unique"), F.col("rows") > 1).otherwise(F.col("known") == 0))
    found = bad.groupBy("rule").agg(F.count(F.lit(1)).alias("bad_values"), F.sum("rows").alias("bad_rows"))
    rules = events.sparkSession.createDataFrame(pa.table({"rule": [*unique, *known]}))
    return rules.join(found, "rule", "left").select("rule", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("bad_values", "bad_rows")))


def invalid_enums(events: DataFrame, users: DataFrame) -> DataFrame:
    """Devices and genders outside the allowed values."""
    devices = events.filter(~F.col("device").isin(*schemas.DEVICES)).select(
        F.lit("events.device").alias("column_name"), F.col("device").alias("value"))
    genders = users.filter(~F.col("gender").isin(*schemas.GENDERS)).select(
        F.lit("users.gender").alias("column_name"), F.col("gender").alias("value"))
    return devices.unionByName(genders).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("rows"))
