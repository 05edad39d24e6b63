"""The same questions in ANSI SQL over the same parquet tables, for comparison."""

from __future__ import annotations

from adloom.registry import BUDGET_END, BUDGET_START, END, REVIEW_TABLES, SHOWN_FROM, SHOWN_TO, START

DEVICE = """CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Mobile'
    WHEN o_orderpriority = '3-MEDIUM' THEN 'Tablet' WHEN o_orderpriority IS NOT NULL THEN 'Desktop' END"""
COST = "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(12,2))"
EARNED = "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(12,2))"
JOINED = """lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
    LEFT JOIN supplier ON l_suppkey = s_suppkey"""
CLICKED = "l_returnflag = 'R'"


def pct(a: str, b: str, times: int = 100) -> str:
    """times * a / b to two decimals from whole numbers: money in cents on both sides, or counts
    on both; half up, signs apart."""
    n, d = f"CAST(({a}) * 100 AS HUGEINT)", f"CAST(({b}) * 100 AS HUGEINT)"
    whole, rest = f"(abs({n}) * {100 * times}) // abs({d})", f"(abs({n}) * {100 * times}) % abs({d})"
    return f"""CASE WHEN {d} <> 0 THEN sign({n}) * sign({d})
      * CAST({whole} + CASE WHEN {rest} * 2 >= abs({d}) THEN 1 ELSE 0 END AS DOUBLE) / 100 END"""


AD_EVENTS = f"""ad_events AS (
  SELECT concat(l_orderkey, '-', l_linenumber) AS event_id, l_partkey AS campaign_id, o_custkey AS user_id,
    {DEVICE} AS device, s_nationkey AS location_id, l_shipdate AS event_timestamp, {COST} AS ad_cost,
    CASE WHEN {CLICKED} THEN {EARNED} ELSE CAST(0 AS DECIMAL(12,2)) END AS ad_revenue
  FROM {JOINED})"""
CAMPAIGNS = """campaigns AS (
  SELECT p_partkey AS campaign_id, concat('Campaign_', p_partkey) AS campaign_name,
    CAST(substring(p_brand, 7) AS BIGINT) AS advertiser_id,
    CAST(CASE WHEN p_partkey % 97 = 0 THEN 0 ELSE p_retailprice * 80 END AS DECIMAL(12,2)) AS budget,
    CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS DOUBLE) AS remaining_budget
  FROM part)"""
ADVERTISERS = """advertisers AS (
  SELECT DISTINCT CAST(substring(p_brand, 7) AS BIGINT) AS advertiser_id, p_brand AS advertiser_name FROM part)"""
LOCATIONS = "locations AS (SELECT n_nationkey AS location_id, n_name AS country_name FROM nation)"

WINDOW = f"event_timestamp >= TIMESTAMP '{START}' AND event_timestamp < TIMESTAMP '{END}'"
BUDGET_WINDOW = f"event_timestamp >= TIMESTAMP '{BUDGET_START}' AND event_timestamp < TIMESTAMP '{BUDGET_END}'"
CLICKS = "sum(CASE WHEN ad_revenue > 0 THEN 1 ELSE 0 END)"
CTR = pct(CLICKS, "count(event_id)")

EVENT_TIME = "(l_shipdate + to_seconds((l_orderkey * 7919) % 86400))"


def iso(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%S')"


RAW_EVENTS = f"""raw_events AS (
  SELECT concat(l_orderkey, '-', l_linenumber) AS EventID,
    CASE WHEN l_orderkey % 501 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS UserID,
    CASE WHEN l_partkey % 211 = 0 THEN 'Campaign_unknown' ELSE concat('Campaign_', l_partkey) END AS CampaignName,
    CASE WHEN l_quantity = 50 AND l_linenumber = 7 THEN NULL ELSE concat('Advertiser_', l_partkey % 25) END AS AdvertiserName,
    concat(' Topic_', l_partkey % 7) AS CampaignTargetingInterest,
    CASE WHEN l_orderkey % 499 = 0 THEN 'Console' ELSE {DEVICE} END AS Device,
    CASE WHEN s_suppkey % 50 = 7 THEN 'Nowhere' ELSE concat('NATION_', s_nationkey) END AS Location,
    CASE WHEN l_orderkey % 997 = 0 THEN '2024-13-99T00:00:00' ELSE {iso(EVENT_TIME)} END AS "Timestamp",
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS BidAmount,
    CAST({COST} AS VARCHAR) AS AdCost, CASE WHEN {CLICKED} THEN CAST({EARNED} AS VARCHAR) END AS AdRevenue,
    CASE WHEN {CLICKED} THEN CASE l_linenumber % 4 WHEN 0 THEN 'True' WHEN 1 THEN 'true' WHEN 2 THEN '1' ELSE ' TRUE ' END
      WHEN l_linenumber = 1 THEN NULL ELSE 'False' END AS WasClicked,
    CASE WHEN {CLICKED} THEN {iso(EVENT_TIME + " + to_seconds(90)")} END AS ClickTimestamp,
    l_orderkey, l_linenumber, l_partkey, l_returnflag
  FROM {JOINED})"""
RAW_USERS = """raw_users AS (
  SELECT CAST(c_custkey AS VARCHAR) AS UserID,
    CASE WHEN c_custkey % 37 <> 0 THEN CAST(18 + c_custkey % 60 AS VARCHAR) END AS Age,
    CASE WHEN c_custkey % 97 = 0 THEN 'Unknown' WHEN c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS Gender,
    CASE WHEN c_custkey % 41 <> 0 THEN concat('NATION_', c_nationkey) END AS Location,
    CASE WHEN c_custkey % 29 <> 0 THEN concat(c_mktsegment, ', Topic_', c_custkey % 7, ',Sports ') END AS Interests,
    CASE WHEN c_custkey % 53 = 0 THEN '2022-02-30'
      ELSE CAST(DATE '2020-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS VARCHAR) END AS SignupDate,
    c_custkey AS ingest_ord
  FROM customer)"""
AGES = "concat('Age ', 13 + p_size % 40, '-', 13 + p_size % 40 + p_size % 30)"
RAW_CAMPAIGNS = f"""raw_campaigns AS (
  SELECT CAST(p_partkey AS VARCHAR) AS CampaignID, concat('Campaign_', p_partkey) AS CampaignName,
    concat('Advertiser_', p_partkey % 25) AS AdvertiserName,
    CAST(DATE '2024-01-01' + p_size AS VARCHAR) AS CampaignStartDate,
    CASE WHEN p_size % 10 = 0 THEN 'open' ELSE CAST(DATE '2024-06-01' + p_size AS VARCHAR) END AS CampaignEndDate,
    CASE WHEN p_size % 13 = 0 THEN NULL WHEN p_size % 11 = 0 THEN 'Everyone'
      WHEN p_size % 7 = 0 THEN concat({AGES}, ', ', p_type)
      ELSE concat({AGES}, ', ', p_type, ' , NATION_', p_partkey % 30) END AS TargetingCriteria,
    CASE p_size % 3 WHEN 0 THEN '300x250' WHEN 1 THEN '728x90' ELSE '160x600' END AS AdSlotSize,
    CAST(CAST(p_retailprice AS DECIMAL(12,2)) * 80 AS VARCHAR) AS Budget,
    CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) AS RemainingBudget,
    p_partkey AS ingest_ord
  FROM part)"""

TRUTHY = "coalesce(WasClicked IN ('1', 'True', 'true'), FALSE)"
STRICT = "coalesce(WasClicked IN ('1', 'True'), FALSE)"
EVENT_TS = 'TRY_CAST("Timestamp" AS TIMESTAMP)'
WRITTEN = "l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_returnflag DESC"
REVIEW_WRITTEN = ("l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_quantity DESC, l_extendedprice DESC,"
                  " l_returnflag DESC, l_linestatus DESC")

HISTORY = f"""history AS (
  SELECT user_id, event_timestamp, campaign_name, was_clicked FROM (
    SELECT CAST(UserID AS BIGINT) AS user_id, {EVENT_TS} AS event_timestamp, CampaignName AS campaign_name,
      {STRICT} AS was_clicked,
      row_number() OVER (PARTITION BY UserID, {EVENT_TS} ORDER BY {WRITTEN}) AS rn
    FROM raw_events WHERE UserID IS NOT NULL AND {EVENT_TS} IS NOT NULL) WHERE rn = 1)"""

K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT)"
IMPRESSIONS = f"""impressions AS (
  SELECT user_id, event_id AS ingest_ord, concat('e', event_id) AS event_id,
    {iso("ts")} AS "timestamp", concat('Campaign_', {K}) AS campaign_name,
    concat('Advertiser_', {K} % 10) AS advertiser_name, concat(' Topic_', {K} % 7) AS ad_category,
    CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS clicks,
    CASE WHEN event_type = 'click' THEN {iso(f"date_trunc('second', ts) + to_minutes({K})")} END AS click_timestamp,
    CASE WHEN event_type = 'click' THEN CASE WHEN event_id % 5 <> 0 THEN value ELSE 0.0 END END AS ad_revenue
  FROM events)"""

RAW_REVIEWS = f"""raw_reviews AS (
  SELECT CAST(l_partkey AS VARCHAR) AS product_id,
    CASE WHEN l_quantity = 50 THEN '2024-13-99' WHEN l_quantity = 49 THEN NULL
      ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS raw_date,
    CASE WHEN l_quantity <> 48 THEN concat('R', l_orderkey, '-', l_linenumber) END AS review_id,
    CAST(o_custkey AS VARCHAR) AS customer_id,
    CASE WHEN l_quantity <> 47 THEN 1 + CAST(l_quantity AS BIGINT) % 5 END AS star_rating,
    concat(l_returnflag, '/', l_linestatus, ' ', o_orderpriority) AS review_headline,
    concat_ws(' ', 'Bought', CAST(l_quantity AS VARCHAR), 'at', CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR)) AS review_body,
    CASE WHEN l_returnflag = 'R' THEN 'Y' WHEN l_returnflag = 'A' THEN 'N'
      WHEN l_linestatus = 'O' THEN '1' ELSE 'y' END AS verified_purchase,
    l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_returnflag, l_linestatus
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey),
reviews AS (SELECT *, TRY_CAST(raw_date AS DATE) AS review_date,
    strftime(TRY_CAST(raw_date AS DATE), '%Y-%m') AS period FROM raw_reviews),
verified AS (SELECT * FROM reviews WHERE review_id IS NOT NULL AND product_id IS NOT NULL
    AND raw_date IS NOT NULL AND star_rating IS NOT NULL AND verified_purchase IN ('1', 'Y', 'y'))"""

DIMS = f"""{RAW_USERS}, {RAW_CAMPAIGNS},
dim_locations AS (SELECT row_number() OVER (ORDER BY min(ingest_ord)) AS location_id, Location AS country_name
  FROM raw_users WHERE Location IS NOT NULL GROUP BY Location),
dim_advertisers AS (SELECT row_number() OVER (ORDER BY min(ingest_ord)) AS advertiser_id, AdvertiserName AS advertiser_name
  FROM raw_campaigns GROUP BY AdvertiserName),
parsed AS (SELECT *,
    TRY_CAST(regexp_extract(TargetingCriteria, 'Age (\\d+)-(\\d+)', 1) AS INTEGER) AS target_age_min,
    TRY_CAST(regexp_extract(TargetingCriteria, 'Age (\\d+)-(\\d+)', 2) AS INTEGER) AS target_age_max,
    trim(string_split(TargetingCriteria, ',')[2]) AS target_interest,
    trim(string_split(TargetingCriteria, ',')[3]) AS target_country
  FROM raw_campaigns),
dim_campaigns AS (
  SELECT CAST(CampaignID AS BIGINT) AS campaign_id, advertiser_id, CampaignName AS campaign_name,
    TRY_CAST(CampaignStartDate AS DATE) AS start_date, TRY_CAST(CampaignEndDate AS DATE) AS end_date,
    target_age_min, target_age_max, target_interest, location_id AS target_location_id,
    AdSlotSize AS ad_slot_size, CAST(Budget AS DOUBLE) AS budget, CAST(RemainingBudget AS DOUBLE) AS remaining_budget
  FROM parsed LEFT JOIN dim_advertisers ON AdvertiserName = advertiser_name
    LEFT JOIN dim_locations ON target_country = country_name),
dim_users AS (
  SELECT CAST(UserID AS BIGINT) AS user_id, CAST(Age AS INTEGER) AS age, Gender AS gender, location_id,
    TRY_CAST(SignupDate AS DATE) AS signup_date
  FROM raw_users LEFT JOIN dim_locations ON Location = country_name)"""
FACTS = f"""{DIMS}, {RAW_EVENTS},
fact_events AS (
  SELECT EventID AS event_id, coalesce(campaign_id, 0) AS campaign_id, CAST(UserID AS BIGINT) AS user_id, Device AS device,
    coalesce(location_id, 0) AS location_id, {EVENT_TS} AS event_timestamp, CAST(BidAmount AS DOUBLE) AS bid_amount,
    CAST(AdCost AS DOUBLE) AS ad_cost, {TRUTHY} AS was_clicked,
    TRY_CAST(ClickTimestamp AS TIMESTAMP) AS click_timestamp, CAST(AdRevenue AS DOUBLE) AS ad_revenue
  FROM raw_events LEFT JOIN dim_campaigns ON CampaignName = campaign_name
    LEFT JOIN dim_locations ON Location = country_name)"""


def _top(mart: str, who: str) -> str:
    return f"""SELECT period, {who}, review_count FROM (SELECT *, row_number() OVER (
        PARTITION BY period ORDER BY review_count DESC, {who}) AS rn FROM ({mart})) WHERE rn <= 10"""


def _count(who: str, condition: str = "TRUE") -> str:
    return f"""SELECT period, {who}, count(*) AS review_count FROM reviews
        WHERE period IS NOT NULL AND {condition} GROUP BY period, {who}"""


def _keyed(key: str, columns: str, present: str) -> str:
    return f"""WITH {RAW_REVIEWS} SELECT {columns} FROM (SELECT *, row_number() OVER (
        PARTITION BY {key} ORDER BY {REVIEW_WRITTEN}) AS rn FROM reviews WHERE {present}) WHERE rn = 1"""


def _profile(source: str, table: str, columns: tuple[str, ...]) -> str:
    parts = " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, 'string' AS data_type, count("{c}") AS filled,
        count(*) - count("{c}") AS "empty", count(DISTINCT "{c}") AS distinct_values FROM {table}""" for c in columns)
    return f"WITH {source} {parts}"


def _unique(rule: str, table: str, key: str) -> str:
    return f"""SELECT '{rule}' AS rule, count(*) AS bad_values, CAST(coalesce(sum(n), 0) AS BIGINT) AS bad_rows FROM (
        SELECT {key}, count(*) AS n FROM {table} GROUP BY {key} HAVING count(*) > 1)"""


def _known(rule: str, table: str, fk: str, dim: str, pk: str) -> str:
    return f"""SELECT '{rule}' AS rule, count(DISTINCT {fk}) AS bad_values, count(*) AS bad_rows FROM {table}
        WHERE {fk} IS NOT NULL AND {fk} NOT IN (SELECT {pk} FROM {dim})"""


VIOLATIONS = " UNION ALL ".join((
    _unique("locations.country_name unique", "dim_locations", "country_name"),
    _unique("advertisers.advertiser_name unique", "dim_advertisers", "advertiser_name"),
    _unique("users.user_id unique", "dim_users", "user_id"),
    _unique("campaigns.campaign_id unique", "dim_campaigns", "campaign_id"),
    _unique("events.event_id unique", "fact_events", "event_id"),
    _known("users.location_id known", "dim_users", "location_id", "dim_locations", "location_id"),
    _known("campaigns.target_location_id known", "dim_campaigns", "target_location_id", "dim_locations", "location_id"),
    _known("events.campaign_id known", "fact_events", "campaign_id", "dim_campaigns", "campaign_id"),
    _known("events.location_id known", "fact_events", "location_id", "dim_locations", "location_id"),
    _known("events.user_id known", "fact_events", "user_id", "dim_users", "user_id"),
))

WIKI = """changes AS (
  SELECT event_id, concat('user_', user_id) AS user_id,
    CASE event_id % 5 WHEN 0 THEN 'en.wikipedia.org' WHEN 1 THEN 'www.wikidata.org'
      WHEN 2 THEN 'commons.wikimedia.org' WHEN 3 THEN 'de.wikipedia.org' ELSE 'fr.wikipedia.org' END AS domain,
    CASE WHEN event_id % 17 <> 0 THEN strftime(ts, '%Y-%m-%dT%H:00:00Z') END AS created_at,
    concat('Page_', (event_id // 10) % 7) AS page_title, event_type = 'error' AS user_is_bot
  FROM events),
kept AS (SELECT * FROM changes WHERE event_id % 13 <> 0 AND event_id % 5 <= 2 AND NOT user_is_bot)"""

ORACLE: dict[str, str] = {
    "campaign_performance": f"""WITH {AD_EVENTS}, {CAMPAIGNS},
      best AS (SELECT campaign_id, CAST(sum(ad_cost) AS DOUBLE) AS total_cost, {CTR} AS ctr
        FROM ad_events WHERE {WINDOW} GROUP BY campaign_id ORDER BY ctr DESC, campaign_id LIMIT 5)
      SELECT campaign_name, ctr, total_cost FROM best LEFT JOIN campaigns USING (campaign_id)""",
    "advertiser_spending": f"""WITH {AD_EVENTS}, {CAMPAIGNS}, {ADVERTISERS}
      SELECT advertiser_name, CAST(sum(ad_cost) AS DOUBLE) AS total_cost, {CTR} AS ctr
      FROM ad_events JOIN campaigns USING (campaign_id) JOIN advertisers USING (advertiser_id)
      WHERE {WINDOW} GROUP BY advertiser_id, advertiser_name
      ORDER BY sum(ad_cost) DESC, advertiser_id LIMIT 5""",
    "campaign_cost_per_click": f"""WITH {AD_EVENTS}, {LOCATIONS}
      SELECT country_name, campaign_id, CAST({CLICKS} AS BIGINT) AS clicks, {pct("sum(ad_cost)", "count(event_id)", 1000)} AS cpm,
        {pct("sum(ad_cost)", CLICKS, 1)} AS cpc, {pct("sum(ad_revenue)", "sum(ad_cost)", 1)} AS roas
      FROM ad_events JOIN locations USING (location_id) WHERE {WINDOW} GROUP BY country_name, campaign_id
      UNION ALL SELECT NULL, campaign_id, CAST({CLICKS} AS BIGINT), {pct("sum(ad_cost)", "count(event_id)", 1000)},
        {pct("sum(ad_cost)", CLICKS, 1)}, {pct("sum(ad_revenue)", "sum(ad_cost)", 1)}
      FROM ad_events WHERE {WINDOW} GROUP BY campaign_id""",
    "cost_efficiency": f"""WITH {AD_EVENTS}, {LOCATIONS}
      SELECT country_name, campaign_id, CAST(sum(ad_revenue) AS DOUBLE) AS total_revenue,
        CAST(sum(ad_cost) AS DOUBLE) AS total_cost,
        {pct("sum(ad_cost)", "count(event_id)", 1000)} AS cpm, {pct("sum(ad_cost)", CLICKS, 1)} AS cpc
      FROM ad_events JOIN locations USING (location_id) WHERE {WINDOW} GROUP BY country_name, campaign_id
      ORDER BY sum(ad_revenue) DESC, country_name, campaign_id LIMIT 30""",
    "regional_analysis": f"""WITH {AD_EVENTS}, {LOCATIONS}
      SELECT country_name, CAST(sum(ad_revenue) AS DOUBLE) AS total_revenue, CAST({CLICKS} AS BIGINT) AS total_clicks,
        {pct("sum(ad_revenue)", "sum(ad_cost)", 1)} AS roas
      FROM ad_events JOIN locations USING (location_id) WHERE {WINDOW} GROUP BY location_id, country_name
      HAVING sum(ad_revenue) > 0 ORDER BY sum(ad_revenue) DESC, location_id LIMIT 10""",
    "engaged_users": f"""WITH {AD_EVENTS}
      SELECT user_id, count(event_id) AS total_impressions, CAST({CLICKS} AS BIGINT) AS total_clicks, {CTR} AS user_ctr
      FROM ad_events WHERE {WINDOW} GROUP BY user_id HAVING {CLICKS} > 0
      ORDER BY total_clicks DESC, user_ctr DESC, user_id LIMIT 20""",
    "budget_consumption": f"""WITH {AD_EVENTS}, {CAMPAIGNS},
      spent AS (SELECT campaign_id, sum(ad_cost) AS total_spent FROM ad_events WHERE {BUDGET_WINDOW} GROUP BY campaign_id)
      SELECT campaign_name, CAST(budget AS DOUBLE) AS budget, CAST(total_spent AS DOUBLE) AS total_spent,
        remaining_budget, {pct("total_spent", "budget")} AS budget_used_pct
      FROM spent JOIN campaigns USING (campaign_id) WHERE budget <> 0 AND total_spent * 10 > budget * 8""",
    "campaign_device": f"""WITH {AD_EVENTS}, {CAMPAIGNS}
      SELECT campaign_name, device, count(event_id) AS total_impressions, CAST({CLICKS} AS BIGINT) AS total_clicks,
        CAST(sum(ad_revenue) AS DOUBLE) AS total_revenue, {CTR} AS ctr,
        {pct("sum(ad_revenue)", "sum(ad_cost)", 1)} AS roas
      FROM ad_events JOIN campaigns USING (campaign_id) WHERE {WINDOW} GROUP BY campaign_name, device""",
    "device_performance": f"""WITH {AD_EVENTS}
      SELECT device, count(event_id) AS total_impressions, CAST({CLICKS} AS BIGINT) AS total_clicks, {CTR} AS ctr
      FROM ad_events WHERE {WINDOW} GROUP BY device""",
    "campaign_summary": f"""WITH {AD_EVENTS}
      SELECT campaign_id, count(event_id) AS total_impressions, CAST({CLICKS} AS BIGINT) AS total_clicks,
        CAST(sum(ad_cost) AS DOUBLE) AS total_spend, coalesce({CTR}, 0) AS ctr
      FROM ad_events WHERE campaign_id IS NOT NULL GROUP BY campaign_id""",
    "advertiser_total": f"""WITH {AD_EVENTS}, {CAMPAIGNS}
      SELECT advertiser_id, CAST(sum(ad_cost) AS DOUBLE) AS total_spend
      FROM ad_events JOIN campaigns USING (campaign_id) GROUP BY advertiser_id""",
    "user_engagements": f"""WITH {AD_EVENTS}, {CAMPAIGNS}, {ADVERTISERS}
      SELECT user_id, event_id, campaign_name, advertiser_name, CAST(event_timestamp AS VARCHAR) AS "timestamp"
      FROM ad_events JOIN campaigns USING (campaign_id) JOIN advertisers USING (advertiser_id)
      WHERE ad_revenue > 0""",
    "daily_campaign_ctr": f"""WITH {RAW_EVENTS}, {RAW_CAMPAIGNS}
      SELECT CAST(CAST({EVENT_TS} AS DATE) AS VARCHAR) AS event_date, CAST(CampaignID AS BIGINT) AS campaign_id,
        CampaignName AS campaign_name, count(EventID) AS total_impressions,
        CAST(sum(CASE WHEN {TRUTHY} THEN 1 ELSE 0 END) AS BIGINT) AS total_clicks,
        CAST(sum(CASE WHEN {TRUTHY} THEN 1 ELSE 0 END) AS DOUBLE) / CAST(count(EventID) AS DOUBLE) AS ctr
      FROM raw_events JOIN raw_campaigns USING (CampaignName)
      WHERE {EVENT_TS} IS NOT NULL GROUP BY ALL""",
    "top_advertisers_spend": f"""WITH {RAW_EVENTS}
      SELECT 'last_30_days' AS time_window, CAST(sum(CAST(AdCost AS DECIMAL(12,2))) AS DOUBLE) AS total_spend,
        AdvertiserName AS advertiser_name
      FROM raw_events WHERE AdvertiserName IS NOT NULL GROUP BY AdvertiserName
      ORDER BY total_spend DESC, advertiser_name LIMIT 5""",
    "user_ad_history": f"""WITH {RAW_EVENTS}, {HISTORY}
      SELECT user_id, CAST(event_timestamp AS VARCHAR) AS event_timestamp, campaign_name, was_clicked FROM history""",
    "user_ad_history_newest": f"""WITH {RAW_EVENTS}, {HISTORY}
      SELECT user_id, CAST(event_timestamp AS VARCHAR) AS event_timestamp, campaign_name, was_clicked FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp DESC) AS rn FROM history)
      WHERE rn <= 10""",
    "top_users_clicks": f"""WITH {RAW_EVENTS}
      SELECT 'last_30_days' AS time_window, count(*) AS total_clicks, CAST(UserID AS BIGINT) AS user_id
      FROM raw_events WHERE {STRICT} AND UserID IS NOT NULL GROUP BY UserID
      ORDER BY total_clicks DESC, user_id LIMIT 10""",
    "top_advertisers_by_region": f"""WITH {RAW_EVENTS}, {RAW_USERS},
      spend AS (SELECT u.Location AS region, AdvertiserName AS advertiser_name,
          CAST(sum(CAST(AdCost AS DECIMAL(12,2))) AS DOUBLE) AS total_spend
        FROM raw_events e JOIN raw_users u ON e.UserID = u.UserID
        WHERE u.Location IS NOT NULL AND AdvertiserName IS NOT NULL GROUP BY 1, 2)
      SELECT region, 'last_30_days' AS time_window, total_spend, advertiser_name FROM (
        SELECT *, row_number() OVER (PARTITION BY region ORDER BY total_spend DESC, advertiser_name) AS rn FROM spend)
      WHERE rn <= 5""",
    "user_documents": f"""WITH {RAW_USERS}, {IMPRESSIONS}
      SELECT CAST(UserID AS BIGINT) AS _id, CAST(Age AS INTEGER) AS age, Gender AS gender, Location AS location,
        SignupDate AS signup_date,
        coalesce(array_to_string([trim(x) FOR x IN string_split(Interests, ',')], '|'), '') AS interests,
        count(event_id) AS impressions, CAST(coalesce(sum(clicks), 0) AS BIGINT) AS clicks
      FROM raw_users LEFT JOIN impressions ON CAST(UserID AS BIGINT) = user_id GROUP BY ALL""",
    "user_history": f"""WITH {RAW_USERS}, {IMPRESSIONS}
      SELECT user_id, i.ingest_ord, event_id, "timestamp", CAST(NULL AS VARCHAR) AS device_location, campaign_name,
        advertiser_name, ad_category, CAST(clicks AS BIGINT) AS clicks, click_timestamp, ad_revenue
      FROM impressions i JOIN raw_users ON CAST(UserID AS BIGINT) = user_id""",
    "last_sessions": f"""WITH {RAW_USERS}, {IMPRESSIONS},
      tail AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ingest_ord DESC) AS back FROM impressions),
      kept AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ingest_ord) - 1 AS place FROM tail WHERE back <= 5)
      SELECT user_id AS _id, CAST(Age AS INTEGER) AS age, place, event_id, "timestamp", campaign_name
      FROM kept JOIN raw_users ON CAST(UserID AS BIGINT) = user_id""",
    "hourly_campaign_clicks": f"""WITH {IMPRESSIONS}
      SELECT advertiser_name, campaign_name AS campaign, hour(CAST(click_timestamp AS TIMESTAMP)) AS hour,
        count(*) AS total_clicks
      FROM impressions WHERE "timestamp" >= '{SHOWN_FROM}' AND "timestamp" <= '{SHOWN_TO}' AND clicks = 1
      GROUP BY ALL""",
    "ad_fatigue": f"""WITH {IMPRESSIONS}
      SELECT user_id, campaign_name AS campaign, count(*) AS impression_count FROM impressions
      GROUP BY user_id, campaign_name HAVING count(*) >= 4 AND sum(clicks) = 0""",
    "top_categories": f"""WITH {IMPRESSIONS},
      counted AS (SELECT user_id, ad_category AS category, count(*) AS total_engagements FROM impressions
        WHERE clicks = 1 GROUP BY user_id, ad_category)
      SELECT user_id, category, total_engagements FROM (SELECT *, row_number() OVER (
        PARTITION BY user_id ORDER BY total_engagements DESC, category) AS rn FROM counted) WHERE rn <= 3""",
    "reviews_by_product": _keyed(
        "product_id, review_date, review_id",
        "product_id, CAST(review_date AS VARCHAR) AS review_date, review_id, customer_id,"
        " CAST(star_rating AS INTEGER) AS star_rating, review_headline, review_body",
        "product_id IS NOT NULL AND review_date IS NOT NULL AND review_id IS NOT NULL"),
    "reviews_by_product_rating": _keyed(
        "product_id, star_rating, review_date, review_id",
        "product_id, CAST(star_rating AS INTEGER) AS star_rating, CAST(review_date AS VARCHAR) AS review_date,"
        " review_id, customer_id, review_headline, review_body",
        "product_id IS NOT NULL AND star_rating IS NOT NULL AND review_date IS NOT NULL AND review_id IS NOT NULL"),
    "reviews_by_customer": _keyed(
        "customer_id, review_date, review_id",
        "customer_id, CAST(review_date AS VARCHAR) AS review_date, review_id, product_id,"
        " CAST(star_rating AS INTEGER) AS star_rating, review_headline",
        "customer_id IS NOT NULL AND product_id IS NOT NULL AND review_date IS NOT NULL AND review_id IS NOT NULL"),
    "newest_product_reviews": f"""WITH {RAW_REVIEWS},
      keyed AS (SELECT * FROM (SELECT *, row_number() OVER (
          PARTITION BY product_id, review_date, review_id ORDER BY {REVIEW_WRITTEN}) AS rn FROM reviews
          WHERE product_id IS NOT NULL AND review_date IS NOT NULL AND review_id IS NOT NULL) WHERE rn = 1),
      paged AS (SELECT *, row_number() OVER (
          PARTITION BY product_id ORDER BY review_date DESC, review_id) AS page FROM keyed)
      SELECT product_id, CAST(review_date AS VARCHAR) AS review_date, review_id, customer_id,
        CAST(star_rating AS INTEGER) AS star_rating, review_headline, review_body FROM paged WHERE page <= 10""",
    "top_products_by_period": f"WITH {RAW_REVIEWS} {_count('product_id')}",
    "top_products": f"WITH {RAW_REVIEWS} {_top(_count('product_id'), 'product_id')}",
    "top_customers_verified": f"""WITH {RAW_REVIEWS} {_count("customer_id", "verified_purchase = 'Y'")}""",
    "top_verified_customers": f"""WITH {RAW_REVIEWS} {_top(_count("customer_id", "verified_purchase = 'Y'"), "customer_id")}""",
    "top_haters": f"""WITH {RAW_REVIEWS} {_top(_count("customer_id", "star_rating IN (1, 2)"), "customer_id")}""",
    "top_backers": f"""WITH {RAW_REVIEWS} {_top(_count("customer_id", "star_rating IN (4, 5)"), "customer_id")}""",
    "customer_marts": f"""WITH {RAW_REVIEWS}
      SELECT *, 'verified' AS mart FROM ({_count("customer_id", "verified_purchase = 'Y'")})
      UNION ALL SELECT *, 'haters' AS mart FROM ({_count("customer_id", "star_rating IN (1, 2)")})
      UNION ALL SELECT *, 'backers' AS mart FROM ({_count("customer_id", "star_rating IN (4, 5)")})""",
    "product_stats": f"""WITH {RAW_REVIEWS} SELECT product_id, count(review_id) AS total_reviews,
        CAST(sum(star_rating) AS DOUBLE) / count(star_rating) AS avg_rating FROM verified GROUP BY product_id""",
    "customer_activity": f"""WITH {RAW_REVIEWS} SELECT customer_id, count(review_id) AS verified_reviews_count
        FROM verified GROUP BY customer_id""",
    "product_trends": f"""WITH {RAW_REVIEWS} SELECT product_id, year(review_date) AS "year", month(review_date) AS "month",
        count(review_id) AS review_count FROM verified GROUP BY ALL""",
    "dim_locations": f"WITH {DIMS} SELECT location_id, country_name FROM dim_locations",
    "dim_advertisers": f"WITH {DIMS} SELECT advertiser_id, advertiser_name FROM dim_advertisers",
    "dim_campaigns": f"""WITH {DIMS} SELECT * REPLACE (CAST(start_date AS VARCHAR) AS start_date,
        CAST(end_date AS VARCHAR) AS end_date) FROM dim_campaigns""",
    "dim_users": f"WITH {DIMS} SELECT * REPLACE (CAST(signup_date AS VARCHAR) AS signup_date) FROM dim_users",
    "user_interests": f"""WITH {RAW_USERS} SELECT CAST(UserID AS BIGINT) AS user_id,
        trim(unnest(string_split(Interests, ','))) AS interest_name FROM raw_users WHERE Interests IS NOT NULL""",
    "fact_events": f"""WITH {FACTS} SELECT * REPLACE (CAST(event_timestamp AS VARCHAR) AS event_timestamp,
        CAST(click_timestamp AS VARCHAR) AS click_timestamp) FROM fact_events""",
    "schema_violations": f"WITH {FACTS} {VIOLATIONS}",
    "invalid_enums": f"""WITH {FACTS}
      SELECT 'events.device' AS column_name, device AS value, count(*) AS rows FROM fact_events
      WHERE device NOT IN ('Mobile', 'Desktop', 'Tablet') GROUP BY device
      UNION ALL SELECT 'users.gender', gender, count(*) FROM dim_users
      WHERE gender NOT IN ('Male', 'Female') GROUP BY gender""",
    "column_profile_events": _profile(RAW_EVENTS, "raw_events", (
        "EventID", "UserID", "CampaignName", "AdvertiserName", "CampaignTargetingInterest", "Device", "Location",
        "Timestamp", "BidAmount", "AdCost", "AdRevenue", "WasClicked", "ClickTimestamp")),
    "column_profile_users": _profile(RAW_USERS, "raw_users", (
        "UserID", "Age", "Gender", "Location", "Interests", "SignupDate")),
    "column_profile_campaigns": _profile(RAW_CAMPAIGNS, "raw_campaigns", (
        "CampaignID", "CampaignName", "AdvertiserName", "CampaignStartDate", "CampaignEndDate",
        "TargetingCriteria", "AdSlotSize", "Budget", "RemainingBudget")),
    "overall_performance": f"""WITH {AD_EVENTS}
      SELECT count(event_id) AS total_impressions, CAST({CLICKS} AS BIGINT) AS total_clicks,
        CAST(sum(ad_cost) AS DOUBLE) AS total_spend, coalesce({CTR}, 0) AS ctr FROM ad_events""",
    "sql_text_report": f"""WITH {AD_EVENTS}
      SELECT device, count(event_id) AS total_impressions, CAST({CLICKS} AS BIGINT) AS total_clicks
      FROM ad_events WHERE {WINDOW} GROUP BY device HAVING {CLICKS} > 0""",
    "first_events": f"""SELECT event_id AS ingest_ord, concat('e', event_id) AS EventID,
        concat('Campaign_', {K}) AS CampaignName, {iso("ts")} AS "Timestamp"
      FROM events ORDER BY event_id LIMIT 750""",
    "append_load": f"""WITH {DIMS} SELECT advertiser_id, advertiser_name FROM dim_advertisers
      UNION ALL SELECT advertiser_id, advertiser_name FROM dim_advertisers""",
    "keyed_review_pages": f"""WITH {RAW_REVIEWS},
      keyed AS (SELECT * FROM (SELECT *, row_number() OVER (
          PARTITION BY product_id, star_rating, review_date, review_id ORDER BY {REVIEW_WRITTEN}) AS rn FROM reviews
          WHERE product_id IS NOT NULL AND star_rating IS NOT NULL AND review_date IS NOT NULL
            AND review_id IS NOT NULL) WHERE rn = 1),
      paged AS (SELECT *, row_number() OVER (
          PARTITION BY product_id, star_rating ORDER BY review_date DESC, review_id) AS page FROM keyed)
      SELECT product_id, CAST(star_rating AS INTEGER) AS star_rating, CAST(review_date AS VARCHAR) AS review_date,
        review_id, customer_id FROM paged WHERE page <= 3""",
    "wiki_filter": f"""WITH {WIKI} SELECT user_id, domain, created_at, page_title,
        CAST(user_is_bot AS VARCHAR) AS user_is_bot FROM kept""",
    "wiki_dead_letters": f"""WITH {WIKI} SELECT substring(concat('{{"meta":{{"domain":"', domain, '"',
          CASE WHEN created_at IS NOT NULL THEN concat(',"dt":"', created_at, '"') ELSE '' END, '}},"performer":{{'), 1, 40) AS value
        FROM changes WHERE event_id % 13 = 0
      UNION ALL SELECT concat('{{"meta":{{"domain":"', domain, '"}},"performer":{{"user_text":"', user_id, '","user_is_bot":',
          CASE WHEN user_is_bot THEN 'true' ELSE 'false' END, '}},"page_title":"', page_title, '"}}')
        FROM changes WHERE event_id % 13 <> 0 AND created_at IS NULL""",
    "tweet_dead_letters": "SELECT translate(coalesce(text, ''), chr(10) || chr(13), '  ') AS value FROM conversations WHERE role = 'system'",
    "wiki_table": f"""WITH {WIKI} SELECT domain, strftime(CAST(created_at[:19] AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS created_at,
        page_title, max({{'arrival': event_id % 3, 'user_id': user_id}}).user_id AS user_id
      FROM kept WHERE created_at IS NOT NULL GROUP BY ALL""",
    "tweet_minutes": """
      WITH sent AS (SELECT role AS author_id, coalesce(text, '') AS text,
        CASE WHEN role <> 'system' THEN TIMESTAMP '2024-01-01 00:00:00' + to_seconds(conv_id * 20 + turn) END AS ts
        FROM conversations)
      SELECT author_id, coalesce(strftime(ts, '%Y-%m-%dT%H:%M:%S'), 'some day') AS created_at, text,
        coalesce(strftime(ts, '%d_%m_%Y_%H_%M'), 'unknown_time') AS time_key FROM sent""",
    "csv_replay": "SELECT role AS author_id, text, 'true' AS has_time FROM conversations",
}

# Stored and read back, these give what their computed twins give.
ORACLE["json_export"] = ORACLE["cost_efficiency"]
ORACLE["csv_bulk_load"] = ORACLE["fact_events"]
ORACLE["csv_review_tables"] = " UNION ALL ".join(
    f"""SELECT '{name}' AS table_name, CAST({who} AS VARCHAR) AS who, concat_ws('/', {", ".join(["''", *(f'"{c}"' for c in what)])}) AS what,
      CAST({number or "NULL"} AS BIGINT) AS number FROM ({ORACLE[{"customers_by_period": "customer_marts"}.get(name, name)]})"""
    for name, (who, what, number) in REVIEW_TABLES.items())
ORACLE["csv_reviews"] = ORACLE["product_stats"]
ORACLE["review_upsert"] = f"""WITH clean AS ({ORACLE["reviews_by_product"]})
  SELECT product_id, review_date, review_id, customer_id,
    CASE WHEN star_rating >= 3 THEN 1 WHEN star_rating = 2 AND stage = 'later' THEN 5 ELSE star_rating END AS star_rating, stage
  FROM clean CROSS JOIN (VALUES ('before'), ('folded'), ('later')) AS stages(stage)
  UNION ALL SELECT product_id, review_date, concat(review_id, '-again'), customer_id, star_rating, 'later' FROM clean"""
ORACLE["campaign_mart"] = ORACLE["campaign_summary"]
ORACLE["stored_documents"] = ORACLE["top_categories"]
ORACLE["campaign_state"] = ORACLE["campaign_summary"]
ORACLE["advertiser_state"] = f"""WITH {AD_EVENTS}, {CAMPAIGNS}
  SELECT advertiser_id, count(event_id) AS impressions, CAST({CLICKS} AS BIGINT) AS clicks, CAST(sum(ad_cost) AS DOUBLE) AS total_spend,
    {CTR} AS ctr, {pct("sum(ad_revenue)", "sum(ad_cost)", 1)} AS roas
  FROM ad_events JOIN campaigns USING (campaign_id) GROUP BY advertiser_id"""


def _inferred(source: str, table: str, columns: dict[str, str]) -> str:
    """The narrowest kind that all filled cells of a column fit; ``columns`` maps names to SQL."""
    fits = {
        "boolean": "regexp_full_match(lower(c), 'true|false')",
        "int": "regexp_full_match(c, '[+-]?[0-9]+') AND TRY_CAST(c AS INTEGER) IS NOT NULL",
        "bigint": "regexp_full_match(c, '[+-]?[0-9]+') AND TRY_CAST(c AS BIGINT) IS NOT NULL",
        "decimal(38,0)": "regexp_full_match(c, '[+-]?[0-9]+') AND TRY_CAST(c AS DECIMAL(38,0)) IS NOT NULL",
        "double": "regexp_full_match(c, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?')",
        "date": "regexp_full_match(c, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AND TRY_CAST(c AS DATE) IS NOT NULL",
        "timestamp_ntz": "regexp_full_match(c, '[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}:[0-9]{2})?') AND TRY_CAST(c AS TIMESTAMP) IS NOT NULL",
    }
    kind = "CASE WHEN count(c) = 0 THEN 'string' " + " ".join(
        f"WHEN count(*) FILTER ({test}) = count(c) THEN '{name}'" for name, test in fits.items()) + " ELSE 'string' END"
    return " UNION ALL ".join(
        f"""SELECT '{table}' AS table_name, '{name}' AS column_name, {kind} AS data_type, count(*) AS cells, count(c) AS filled
        FROM (SELECT nullif(trim({sql}), '') AS c FROM {source})""" for name, sql in columns.items())


_QUOTED = {name: tuple(f'"{c}"' for c in columns) for name, columns in {
    "events": ("EventID", "UserID", "CampaignName", "AdvertiserName", "CampaignTargetingInterest", "Device", "Location", "Timestamp",
               "BidAmount", "AdCost", "AdRevenue", "WasClicked", "ClickTimestamp"),
    "users": ("UserID", "Age", "Gender", "Location", "Interests", "SignupDate"),
    "campaigns": ("CampaignID", "CampaignName", "AdvertiserName", "CampaignStartDate", "CampaignEndDate", "TargetingCriteria",
                  "AdSlotSize", "Budget", "RemainingBudget")}.items()}
_REVIEW_CELLS = {"product_id": "product_id", "review_date": "raw_date", "review_id": "review_id", "customer_id": "customer_id",
                 "star_rating": "coalesce(CAST(star_rating AS VARCHAR), 'none')", "review_headline": "review_headline",
                 "review_body": "review_body", "verified_purchase": "verified_purchase"}
ORACLE["csv_inferred_types"] = f"""WITH {RAW_USERS}, {RAW_CAMPAIGNS}, {RAW_EVENTS}, {RAW_REVIEWS}
  """ + " UNION ALL ".join([
    *(_inferred(f"raw_{table}", table, {c.strip('"'): c for c in columns} | ({"ingest_ord": "CAST(ingest_ord AS VARCHAR)"} if table != "events" else {}))
      for table, columns in _QUOTED.items()),
    _inferred("raw_reviews", "reviews", _REVIEW_CELLS)])
ORACLE["csv_typed_campaigns"] = f"""WITH {RAW_CAMPAIGNS} SELECT CAST(CampaignID AS INTEGER) AS CampaignID, CampaignName, AdvertiserName,
    CampaignStartDate, CampaignEndDate, TargetingCriteria, AdSlotSize, CAST(Budget AS DOUBLE) AS Budget,
    CAST(RemainingBudget AS DOUBLE) AS RemainingBudget FROM raw_campaigns"""
_KINDS = """CASE type WHEN 'VARCHAR' THEN 'string' WHEN 'UBIGINT' THEN 'bigint' ELSE lower(type) END"""
ORACLE["message_fields"] = f"""WITH {WIKI},
  sent AS (SELECT 'wiki' AS topic, CASE WHEN event_id % 13 = 0 THEN substring(value, 1, 40) ELSE value END AS value FROM (
      SELECT event_id, concat('{{"meta":{{"domain":"', domain, '"', CASE WHEN created_at IS NOT NULL THEN concat(',"dt":"', created_at, '"') ELSE '' END,
        '}},"performer":{{"user_text":"', user_id, '","user_is_bot":', CASE WHEN user_is_bot THEN 'true' ELSE 'false' END,
        '}},"page_title":"', page_title, '"}}') AS value FROM changes)
    UNION ALL SELECT 'tweets', CAST(to_json(map_from_entries(list_filter([('author_id', role), ('text', text), ('created_at', 'x'), ('lang', 'en')],
        lambda x: x[2] IS NOT NULL))) AS VARCHAR) FROM conversations)
  SELECT topic, fullkey AS path, {_KINDS} AS kind, count(*) AS rows
  FROM (SELECT topic, value FROM sent WHERE json_valid(value)) s, json_tree(s.value) GROUP BY ALL
  UNION ALL SELECT topic, '$', 'unreadable', count(*) FROM sent WHERE NOT json_valid(value) GROUP BY topic"""
ORACLE["open_tweets"] = """SELECT role AS author, text, concat('{"created_at":"', CASE WHEN role IS DISTINCT FROM 'system' THEN
      strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(conv_id * 20 + turn), '%Y-%m-%dT%H:%M:%S') ELSE 'some day' END, '","lang":"en"}') AS rest
  FROM conversations"""
ORACLE["document_export"] = ORACLE["user_documents"]
ORACLE["profile_of_loads"] = f"""SELECT column_name, filled, "empty", true AS near FROM ({ORACLE["column_profile_events"]})"""
ORACLE["lookup_batch"] = f"""WITH clean AS ({ORACLE["reviews_by_product"]})
  SELECT review_id, customer_id, product_id, review_date, star_rating FROM clean
  WHERE review_id IN (SELECT min(review_id) FROM clean GROUP BY customer_id)"""
ORACLE["bucketed_engagements"] = ORACLE["user_engagements"]
ORACLE["paced_replay"] = """SELECT n AS number, role AS author_id, text,
    strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(n // 12), '%Y-%m-%dT%H:%M:%S') AS created_at
  FROM (SELECT *, row_number() OVER (ORDER BY conv_id * 100000 + turn, role NULLS FIRST, text NULLS FIRST) - 1 AS n FROM conversations)"""
