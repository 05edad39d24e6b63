"""The driver's tables seen as ad events, users, campaigns, reviews and messages.

Everything is derived row by row from the given parquet tables, so it grows with
them. Some rows are made awkward on purpose (bad dates, null keys, unknown names,
several spellings of true), always by rule, never by leaving rows out. Joins that a
caller does not need are not made: ask for the columns you use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.functions import text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


DEVICE = """case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'Mobile'
                 when o_orderpriority = '3-MEDIUM' then 'Tablet'
                 when o_orderpriority is not null then 'Desktop' end"""
# Inputs are cast before they are multiplied: the product of doubles is not exact.
COST = """cast(cast(l_extendedprice as decimal(12,2)) * cast(l_discount as decimal(4,2)) as decimal(12,2))"""
EARNED = """cast(cast(l_extendedprice as decimal(12,2)) * cast(l_tax as decimal(4,2)) as decimal(12,2))"""

# Star-schema fact: column -> (expression, tables it needs besides lineitem).
FACT = {
    "event_id": ("concat(l_orderkey, '-', l_linenumber)", ()),
    "campaign_id": ("l_partkey", ()),
    "user_id": ("o_custkey", ("orders",)),
    "device": (DEVICE, ("orders",)),
    "location_id": ("s_nationkey", ("supplier",)),
    "event_timestamp": ("l_shipdate", ()),
    "ad_cost": (COST, ()),
    "ad_revenue": (f"case when l_returnflag = 'R' then {EARNED} else cast(0 as decimal(12,2)) end", ()),
}
JOINS = {
    "orders": "l_orderkey = o_orderkey",
    "supplier": "l_suppkey = s_suppkey",
}


def _lineitem_with(spark: SparkSession, sf_dir: str, needs: set[str]) -> DataFrame:
    """Line items, left-joined with the tables needed. No line is lost, and Spark may
    split skewed line-item partitions because they are the outer side."""
    rows = table(spark, sf_dir, "lineitem")
    for other, condition in JOINS.items():
        if other in needs:
            rows = rows.join(table(spark, sf_dir, other), F.expr(condition), "left")
    return rows


def ad_events(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    wanted = columns or tuple(FACT)
    needs = {t for c in wanted for t in FACT[c][1]}
    return _lineitem_with(spark, sf_dir, needs).select(*[F.expr(FACT[c][0]).alias(c) for c in wanted])


def ad_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Campaigns with a budget; every 97th has none."""
    budget = "cast(case when p_partkey % 97 = 0 then 0 else p_retailprice * 80 end as decimal(12,2))"
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("campaign_id"),
        F.concat(F.lit("Campaign_"), "p_partkey").alias("campaign_name"),
        F.expr("cast(substring(p_brand, 7) as bigint)").alias("advertiser_id"),
        F.expr(budget).alias("budget"),
        F.expr("cast(cast(p_retailprice as decimal(12,2)) as double)").alias("remaining_budget"))


def ad_advertisers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_brand").distinct().select(
        F.expr("cast(substring(p_brand, 7) as bigint)").alias("advertiser_id"),
        F.col("p_brand").alias("advertiser_name"))


def ad_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("location_id"), F.col("n_name").alias("country_name"))


# Raw event file, all text. ``written`` says which of two writes of one key is later; rows
# equal in it are equal in every column the keyed tables keep.
EVENT_TIME = "l_shipdate + make_dt_interval(0, 0, 0, (l_orderkey * 7919) % 86400)"
CLICKED = "l_returnflag = 'R'"
RAW_EVENT = {
    "EventID": ("concat(l_orderkey, '-', l_linenumber)", ()),
    "UserID": ("case when l_orderkey % 501 <> 0 then cast(o_custkey as string) end", ("orders",)),
    "CampaignName": ("case when l_partkey % 211 = 0 then 'Campaign_unknown' else concat('Campaign_', l_partkey) end", ()),
    "AdvertiserName": ("case when l_quantity = 50 and l_linenumber = 7 then null"
                       " else concat('Advertiser_', l_partkey % 25) end", ()),
    "CampaignTargetingInterest": ("concat(' Topic_', l_partkey % 7)", ()),
    "Device": (f"case when l_orderkey % 499 = 0 then 'Console' else {DEVICE} end", ("orders",)),
    "Location": ("case when s_suppkey % 50 = 7 then 'Nowhere' else concat('NATION_', s_nationkey) end", ("supplier",)),
    "Timestamp": (f"case when l_orderkey % 997 = 0 then '2024-13-99T00:00:00' else replace(cast({EVENT_TIME} as string), ' ', 'T') end", ()),
    "BidAmount": ("cast(cast(l_extendedprice as decimal(12,2)) as string)", ()),
    "AdCost": (f"cast({COST} as string)", ()),
    "AdRevenue": (f"case when {CLICKED} then cast({EARNED} as string) end", ()),
    "WasClicked": (f"case when {CLICKED} then element_at(array('True', 'true', '1', ' TRUE '), l_linenumber % 4 + 1)"
                   " when l_linenumber = 1 then null else 'False' end", ()),
    "ClickTimestamp": (f"case when {CLICKED} then replace(cast({EVENT_TIME} + make_dt_interval(0, 0, 0, 90) as string), ' ', 'T') end", ()),
    "written": ("struct(l_orderkey, l_linenumber, l_partkey, l_returnflag)", ()),
}


def raw_events(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    wanted = columns or tuple(c for c in RAW_EVENT if c != "written")
    needs = {t for c in wanted for t in RAW_EVENT[c][1]}
    return _lineitem_with(spark, sf_dir, needs).select(*[F.expr(RAW_EVENT[c][0]).alias(c) for c in wanted])


def event_columns(spark: SparkSession, sf_dir: str) -> list[list[str]]:
    """Columns of the raw event file by the tables they need besides line items, so that a join moves those of its
    own only. All are in one group where a key of such a table repeats, as lines then come in several copies."""
    groups: dict[tuple, list[str]] = {}
    for name, (_, needs) in RAW_EVENT.items():
        if name != "written":
            groups.setdefault(needs, []).append(name)
    for other, condition in JOINS.items():
        key = condition.split(" = ")[1]
        if not table(spark, sf_dir, other).where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").isEmpty():
            return [[name for group in groups.values() for name in group]]
    return list(groups.values())


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User file with gaps in age, location and interests and some impossible dates."""
    return table(spark, sf_dir, "customer").select(
        F.expr("cast(c_custkey as string)").alias("UserID"),
        F.expr("case when c_custkey % 37 <> 0 then cast(18 + c_custkey % 60 as string) end").alias("Age"),
        F.expr("case when c_custkey % 97 = 0 then 'Unknown' when c_custkey % 2 = 0 then 'Male' else 'Female' end").alias("Gender"),
        F.expr("case when c_custkey % 41 <> 0 then concat('NATION_', c_nationkey) end").alias("Location"),
        F.expr("case when c_custkey % 29 <> 0 then concat(c_mktsegment, ', Topic_', c_custkey % 7, ',Sports ') end").alias("Interests"),
        F.expr("case when c_custkey % 53 = 0 then '2022-02-30'"
               " else cast(date_add(date'2020-01-01', cast(c_custkey % 1000 as int)) as string) end").alias("SignupDate"),
        F.col("c_custkey").alias("ingest_ord"))


def raw_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Campaign file; the targeting text has no, one or two commas or is missing."""
    ages = "concat('Age ', 13 + p_size % 40, '-', 13 + p_size % 40 + p_size % 30)"
    return table(spark, sf_dir, "part").select(
        F.expr("cast(p_partkey as string)").alias("CampaignID"),
        F.expr("concat('Campaign_', p_partkey)").alias("CampaignName"),
        F.expr("concat('Advertiser_', p_partkey % 25)").alias("AdvertiserName"),
        F.expr("cast(date_add(date'2024-01-01', p_size) as string)").alias("CampaignStartDate"),
        F.expr("case when p_size % 10 = 0 then 'open' else cast(date_add(date'2024-06-01', p_size) as string) end").alias("CampaignEndDate"),
        F.expr(f"""case when p_size % 13 = 0 then null when p_size % 11 = 0 then 'Everyone'
                        when p_size % 7 = 0 then concat({ages}, ', ', p_type)
                        else concat({ages}, ', ', p_type, ' , NATION_', p_partkey % 30) end""").alias("TargetingCriteria"),
        F.expr("element_at(array('300x250', '728x90', '160x600'), cast(p_size % 3 as int) + 1)").alias("AdSlotSize"),
        F.expr("cast(cast(p_retailprice as decimal(12,2)) * 80 as string)").alias("Budget"),
        F.expr("cast(cast(p_retailprice as decimal(12,2)) as string)").alias("RemainingBudget"),
        F.col("p_partkey").alias("ingest_ord"))


# The interaction log as the raw event file behind the user documents.
K = "cast(regexp_extract(props, '([0-9]+)', 1) as bigint)"
DOCUMENT_EVENT = {
    "ingest_ord": "event_id",
    "EventID": "concat('e', event_id)",
    "UserID": "cast(user_id as string)",
    "CampaignName": f"concat('Campaign_', {K})",
    "AdvertiserName": f"concat('Advertiser_', {K} % 10)",
    "CampaignTargetingInterest": f"concat(' Topic_', {K} % 7)",
    "Timestamp": "replace(substring(cast(ts as string), 1, 19), ' ', 'T')",
    "WasClicked": "case when event_type = 'click' then 'True' when event_type = 'view' then '1' else 'False' end",
    "AdRevenue": "case when event_id % 5 <> 0 then cast(value as string) end",
    "ClickTimestamp": "replace(cast(cast(substring(cast(ts as string), 1, 19) as timestamp_ntz)"
                      f" + make_dt_interval(0, 0, {K}) as string), ' ', 'T')",
}


def document_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(*[F.expr(e).alias(c) for c, e in DOCUMENT_EVENT.items()])


RAW_REVIEW = {
    "product_id": ("cast(l_partkey as string)", ()),
    "review_date": ("case when l_quantity = 50 then '2024-13-99' when l_quantity = 49 then null"
                    " else cast(cast(l_shipdate as date) as string) end", ()),
    "review_id": ("case when l_quantity <> 48 then concat('R', l_orderkey, '-', l_linenumber) end", ()),
    "customer_id": ("cast(o_custkey as string)", ("orders",)),
    "star_rating": ("case when l_quantity = 47 then 'none' else cast(1 + cast(l_quantity as bigint) % 5 as string) end", ()),
    "review_headline": ("concat(l_returnflag, '/', l_linestatus, ' ', o_orderpriority)", ("orders",)),
    "review_body": ("concat_ws(' ', 'Bought', l_quantity, 'at', cast(l_extendedprice as decimal(12,2)))", ()),
    "verified_purchase": ("case when l_returnflag = 'R' then 'Y' when l_returnflag = 'A' then 'N'"
                          " when l_linestatus = 'O' then '1' else 'y' end", ()),
    # Every key holds the review id, hence order and line.
    "written": ("struct(l_partkey, l_quantity, l_extendedprice, l_returnflag, l_linestatus)", ()),
}


def raw_reviews(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    wanted = columns or tuple(RAW_REVIEW)
    needs = {t for c in wanted for t in RAW_REVIEW[c][1]}
    return _lineitem_with(spark, sf_dir, needs).select(*[F.expr(RAW_REVIEW[c][0]).alias(c) for c in wanted])


def wiki_changes(events: DataFrame, *keep: str) -> DataFrame:
    """Interaction log as wiki change messages, with the columns to ``keep``. Works on batches and on streams.

    Titles repeat within a minute, so keys collide; every 13th message is cut short
    and every 17th lacks its time."""
    title = F.concat(F.lit("Page_"), (F.col("event_id") / 10).cast("bigint") % 7)
    domain: Column = F.element_at(F.array(*[F.lit(d) for d in (
        "en.wikipedia.org", "www.wikidata.org", "commons.wikimedia.org", "de.wikipedia.org", "fr.wikipedia.org",
    )]), (F.col("event_id") % 5).cast("int") + 1)
    minute = F.expr("replace(substring(cast(ts as string), 1, 13), ' ', 'T')")
    message = F.to_json(F.struct(
        F.struct(domain.alias("domain"),
                 F.when(F.col("event_id") % 17 != 0, F.concat(minute, F.lit(":00:00Z"))).alias("dt")).alias("meta"),
        F.struct(F.concat(F.lit("user_"), "user_id").alias("user_text"),
                 (F.col("event_type") == "error").alias("user_is_bot")).alias("performer"),
        title.alias("page_title")))
    cut = F.when(F.col("event_id") % 13 == 0, F.substring(message, 1, 40)).otherwise(message)
    return events.select(*keep, cut.alias("value"))


def tweets(conversations: DataFrame, *keep: str) -> DataFrame:
    """Conversation turns as tweet messages, with the columns to ``keep``; system turns carry no readable time."""
    seconds = F.col("conv_id") * 20 + F.col("turn")
    created = text.iso_text(F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds))
    return conversations.select(*keep, F.to_json(F.struct(
        F.col("role").alias("author_id"), "text",
        F.when(F.col("role") == "system", F.lit("some day")).otherwise(created).alias("created_at"),
        F.lit("en").alias("lang"))).alias("value"))
