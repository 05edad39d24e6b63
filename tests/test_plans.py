"""Hand-made edge cases for reports, marts, star schema and reviews."""

import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from adloom import schemas
from adloom.operators.profile import column_profile
from adloom.plans import ad_kpis, ad_marts, reviews, star_schema
from adloom.plans import sample_tables as t
from adloom.registry import QUERIES
from conftest import plan_of, rows

D = Decimal


@pytest.fixture(scope="module")
def star(spark):
    day = dt.datetime(2024, 11, 5)
    late = dt.datetime(2024, 12, 1)
    facts = spark.createDataFrame([
        # event, campaign, user, device, location, time, cost, revenue
        ("e1", 1, 7, "Mobile", 1, day, D("10.00"), D("4.00")),
        ("e2", 1, 7, "Mobile", 1, day, D("5.00"), D("0.00")),
        ("e3", 2, 8, "Tablet", 2, day, D("1.00"), None),
        ("e4", 2, 8, "Tablet", 2, day, D("0.00"), None),
        ("e5", 3, 9, "Desktop", 3, day, D("0.00"), D("2.00")),
        ("e6", 9, 9, "Desktop", 9, day, D("3.00"), D("1.00")),
        ("e7", 1, 7, "Mobile", 1, late, D("99.00"), D("99.00")),
    ], "event_id string, campaign_id long, user_id long, device string, location_id long,"
       " event_timestamp timestamp_ntz, ad_cost decimal(12,2), ad_revenue decimal(12,2)")
    campaigns = spark.createDataFrame([
        (1, "C1", 1, D("15.00"), 1.0), (2, "C2", 1, D("0.00"), 0.0), (3, "C3", 2, None, None)],
        "campaign_id long, campaign_name string, advertiser_id long, budget decimal(12,2), remaining_budget double")
    advertisers = spark.createDataFrame([(1, "A1"), (2, "A2")], "advertiser_id long, advertiser_name string")
    locations = spark.createDataFrame([(1, "L1"), (2, "L2"), (3, "L3")], "location_id long, country_name string")
    return facts, campaigns, advertisers, locations


W = ("2024-11-01", "2024-12-01")


def listed(df):
    return [tuple(r) for r in df.collect()]


def test_campaign_performance_keeps_unknown_campaigns(star):
    facts, campaigns, *_ = star
    # Ties at 100 % are settled by id; campaign 9 has no name but stays.
    assert listed(ad_kpis.campaign_performance(facts, campaigns, *W, k=3)) == [
        ("C3", 100.0, 0.0), (None, 100.0, 3.0), ("C1", 50.0, 15.0)]


def test_advertiser_spending(star):
    facts, campaigns, advertisers, _ = star
    assert listed(ad_kpis.advertiser_spending(facts, campaigns, advertisers, *W)) == [("A1", 16.0, 25.0), ("A2", 0.0, 100.0)]


def test_cost_efficiency_null_cpc_without_clicks(star):
    facts, _, _, locations = star
    assert listed(ad_kpis.cost_efficiency(facts, locations, *W)) == [
        ("L1", 1, 4.0, 15.0, 7500.0, 15.0), ("L3", 3, 2.0, 0.0, 0.0, 0.0), ("L2", 2, None, 1.0, 500.0, None)]


def test_regional_drops_places_without_revenue(star):
    facts, _, _, locations = star
    assert listed(ad_kpis.regional_analysis(facts, locations, *W)) == [("L1", 4.0, 1, 0.27), ("L3", 2.0, 1, None)]


def test_engaged_users(star):
    # User 9 clicked twice; user 8 never did.
    assert listed(ad_kpis.engaged_users(star[0], *W)) == [(9, 2, 2, 100.0), (7, 2, 1, 50.0)]


def test_budget_zero_and_null_never_count(star):
    facts, campaigns, *_ = star
    assert listed(ad_kpis.budget_consumption(facts, campaigns, *W)) == [("C1", 15.0, 15.0, 1.0, 100.0)]
    assert listed(ad_kpis.budget_consumption(facts, campaigns, *W, over=1.0)) == []


def test_campaign_device_and_device(star):
    facts, campaigns, *_ = star
    assert listed(ad_kpis.campaign_device(facts, campaigns, *W)) == [
        ("C1", "Mobile", 2, 1, 4.0, 50.0, 0.27), ("C2", "Tablet", 2, 0, None, 0.0, None),
        ("C3", "Desktop", 1, 1, 2.0, 100.0, None)]
    assert listed(ad_kpis.device_performance(facts, *W)) == [
        ("Desktop", 2, 2, 100.0), ("Mobile", 2, 1, 50.0), ("Tablet", 2, 0, 0.0)]


def test_lookups_by_key_and_unknown_ids(star):
    facts, campaigns, advertisers, _ = star
    assert listed(ad_kpis.campaign_summary(facts, 1)) == [(1, 3, 2, 114.0, 66.67)]
    assert listed(ad_kpis.campaign_summary(facts, 77)) == []
    assert listed(ad_kpis.advertiser_total(facts, campaigns, 1)) == [(1, 115.0)]
    assert listed(ad_kpis.advertiser_total(facts, campaigns, 77)) == []
    assert rows(ad_kpis.user_engagements(facts, campaigns, advertisers, 7).select("event_id", "advertiser_name")) == [
        ("e1", "A1"), ("e7", "A1")]
    assert listed(ad_kpis.user_engagements(facts, campaigns, advertisers, 77)) == []


@pytest.fixture(scope="module")
def ads(spark):
    base = {"CampaignName": "C1", "AdvertiserName": "A", "AdCost": "1.00", "UserID": "1", "Timestamp": "2024-10-08T10:00:00"}
    schema = schemas.text_schema(*schemas.RAW_EVENTS.names)
    events = [
        base | {"EventID": "a", "WasClicked": "true"},
        base | {"EventID": "b", "WasClicked": "False", "Timestamp": "2024-10-08T10:00:00"},
        base | {"EventID": None, "WasClicked": "True", "UserID": "2"},
        base | {"EventID": "d", "WasClicked": "1", "Timestamp": "2024-13-99", "UserID": None},
        base | {"EventID": "e", "CampaignName": "other", "AdvertiserName": None, "AdCost": "x"},
        base | {"EventID": "f", "AdvertiserName": "B", "AdCost": "bad", "UserID": "2", "Timestamp": "2024-10-09T00:00:00"},
    ]
    data = [tuple(e.get(c) for c in schema.names) + (i,) for i, e in enumerate(events)]
    return spark.createDataFrame(data, schema.add("written", "long"))


def test_daily_ctr_fans_out_on_shared_names(spark, ads):
    campaigns = spark.createDataFrame([("1", "C1"), ("2", "C1"), (None, "other")], "CampaignID string, CampaignName string")
    got = rows(ad_marts.daily_campaign_ctr(ads, campaigns))
    # Two of three rows of the day carry an event id; both spellings of true count.
    assert got == sorted([(d, i, "C1", n, c, r) for i in (1, 2) for d, n, c, r in (
        ("2024-10-08", 2, 2, 1.0), ("2024-10-09", 1, 0, 0.0))], key=repr)


def test_daily_ctr_groups_events_once(spark, ads):
    campaigns = spark.createDataFrame([("1", "C1"), ("1", "C1"), ("2", "C1")], "CampaignID string, CampaignName string")
    daily = ad_marts.daily_campaign_ctr(ads, campaigns)
    assert plan_of(daily).count("Aggregate(keys=[event_date") == 2  # in the map tasks and after the shuffle
    assert [tuple(r)[:4] for r in daily.where("event_date = '2024-10-08'").orderBy("campaign_id").select(
        "campaign_id", "campaign_name", "total_impressions", "total_clicks").collect()] == [(1, "C1", 4, 4), (2, "C1", 2, 2)]


def test_spend_marts_drop_null_keys_and_count_bad_costs_as_zero(spark, ads):
    assert listed(ad_marts.top_advertisers_by_spend(ads)) == [("last_30_days", 4.0, "A"), ("last_30_days", 0.0, "B")]
    users = spark.createDataFrame([("1", "East"), ("2", None)], "UserID string, Location string")
    assert listed(ad_marts.top_advertisers_by_region(ads, users)) == [("East", "last_30_days", 2.0, "A")]


def test_history_keeps_the_last_write(ads):
    history = ad_marts.user_ad_history(ads, ["written"])
    at = dt.datetime(2024, 10, 8, 10)
    assert rows(history) == sorted([
        (1, at, "other", False), (2, at, "C1", True), (2, dt.datetime(2024, 10, 9), "C1", False)], key=repr)
    assert [r[1].day for r in ad_marts.user_ad_history_page(history, 2, 1).collect()] == [9]


def test_top_users_use_the_strict_flag(ads):
    # 'true' is no click here, and the '1' row has no user.
    assert listed(ad_marts.top_users_by_clicks(ads)) == [("last_30_days", 1, 2)]


def test_star_schema_variants(spark):
    users = spark.createDataFrame(
        [(0, "5", "Norway", "a,b", "2024-01-02"), (1, "6", "Chile", None, "bad"), (2, "7", "Norway", " c ", None)],
        "ord long, UserID string, location string, interests string, RegistrationDate string")
    locations = star_schema.dim_locations(users, "ord")
    assert rows(locations) == [(1, "Norway"), (2, "Chile")]
    assert rows(star_schema.dim_users(users, locations)) == sorted([
        (5, 1, dt.date(2024, 1, 2)), (6, 2, None), (7, 1, None)], key=repr)
    assert rows(star_schema.user_interests(users)) == [(5, "a"), (5, "b"), (7, "c")]
    assert listed(star_schema.user_interests(users.drop("interests"))) == []


def test_campaigns_and_facts(spark):
    locations = spark.createDataFrame([(1, "Norway")], "location_id long, country_name string")
    advertisers = spark.createDataFrame([(4, "A")], "advertiser_id long, advertiser_name string")
    raw_campaigns = spark.createDataFrame([
        ("1", "C1", "A", "2024-01-01", "never", "Age 18-35, Sports, Norway", "s", "10.50", "3"),
        ("2", "C1", "Z", None, None, "Everyone", None, "x", None)], schemas.RAW_CAMPAIGNS)
    campaigns = star_schema.dim_campaigns(raw_campaigns, advertisers, locations)
    assert tuple(campaigns.columns) == schemas.CAMPAIGNS
    assert rows(campaigns) == [
        (1, 4, "C1", dt.date(2024, 1, 1), None, 18, 35, "Sports", 1, "s", D("10.50"), 3.0),
        (2, None, "C1", None, None, None, None, None, None, None, None, None)]
    events = spark.createDataFrame(
        [("e1", "1", "C1", "Norway", "2024-01-01T00:00:00", "true", "1.5"), ("e2", "x", "C9", "Peru", "?", "0", "")],
        "EventID string, ` UserID` string, CampaignName string, Location string, Timestamp string, WasClicked string, AdCost string")
    facts = star_schema.fact_events(events, campaigns, locations)
    # Header names are trimmed; a shared campaign name fans out; unknown names get 0.
    at = dt.datetime(2024, 1, 1)
    assert facts.columns == [c for c in schemas.FACT_EVENTS if c in facts.columns]
    assert rows(facts) == sorted([
        ("e1", 1, 1, 1, at, D("1.50"), True), ("e1", 2, 1, 1, at, D("1.50"), True),
        ("e2", 0, None, 0, None, None, False)], key=repr)


def test_violations_are_found(spark):
    locations = spark.createDataFrame([(1, "N"), (2, "N")], "location_id long, country_name string")
    advertisers = spark.createDataFrame([(1, "A")], "advertiser_id long, advertiser_name string")
    users = spark.createDataFrame([(1, 1), (1, 9)], "user_id long, location_id long")
    campaigns = spark.createDataFrame([(1, None)], "campaign_id long, target_location_id long")
    events = spark.createDataFrame([("e", 0, 5, 1), ("e", 1, 1, 1)], "event_id string, campaign_id long, user_id long, location_id long")
    found = {r[0]: (r[1], r[2]) for r in star_schema.schema_violations(locations, advertisers, users, campaigns, events).collect()}
    assert {k: v for k, v in found.items() if v != (0, 0)} == {
        "locations.country_name unique": (1, 2), "users.user_id unique": (1, 2), "events.event_id unique": (1, 2),
        "users.location_id known": (1, 1), "events.campaign_id known": (1, 1), "events.user_id known": (1, 1)}
    assert len(found) == 10


REVIEW = "product_id string, customer_id string, review_date string, review_id string, star_rating string," \
         " verified_purchase string, review_headline string, review_body string, written long"


@pytest.fixture(scope="module")
def raw_reviews(spark):
    return spark.createDataFrame([
        ("p", "c1", "2024-01-05", "r1", "5", "Y", "old", "b", 1),
        ("p", "c1", "2024-01-05", "r1", "5", "Y", "new", "b", 2),
        ("p", "c2", "2024-01-09", "r2", "1", "y", "h", "b", 3),
        ("p", "c2", "2024-01-07", "r3", None, "1", "h", "b", 4),
        ("p", "c3", "2024-13-99", "r4", "4", "Y", "h", "b", 5),
        ("q", "c3", "2024-02-01", None, "2", "N", "h", "b", 6),
        (None, "c3", "2024-02-01", "r6", "2", "N", "h", "b", 7),
    ], REVIEW)


def test_keyed_review_copies(raw_reviews):
    clean = reviews.clean_reviews(raw_reviews)
    by_product = reviews.reviews_by_product(clean, ["written"])
    assert rows(by_product.select("review_id", "review_headline")) == [("r1", "new"), ("r2", "h"), ("r3", "h")]
    by_rating = reviews.reviews_by_product_rating(clean, ["written"])
    assert rows(by_rating.select("review_id")) == [("r1",), ("r2",)]
    by_customer = reviews.reviews_by_customer(clean, ["written"])
    assert rows(by_customer.select("customer_id", "review_id")) == [("c1", "r1"), ("c2", "r2"), ("c2", "r3")]
    newest = reviews.newest_reviews(by_product, ["product_id"], 2)
    assert [r["review_id"] for r in newest.orderBy(F.desc("review_date")).collect()] == ["r2", "r3"]


def test_review_marts_and_shared_pass_agree(raw_reviews):
    clean = reviews.clean_reviews(raw_reviews)
    shared = reviews.customer_marts(clean)
    for name, mart in {"verified": reviews.top_customers_verified, "haters": reviews.top_haters,
                       "backers": reviews.top_backers}.items():
        assert rows(shared.filter(F.col("mart") == name).select("period", "customer_id", "review_count")) == rows(mart(clean))
    assert rows(reviews.top_products_by_period(clean)) == sorted(
        [("2024-01", "p", 4), ("2024-02", "q", 1), ("2024-02", None, 1)], key=repr)
    top = reviews.top_of_period(reviews.top_products_by_period(clean), "product_id", 1, period="2024-01")
    assert rows(top) == [("2024-01", "p", 4)]


def test_review_aggregates_keep_unreadable_dates(raw_reviews):
    verified = reviews.verified_reviews(raw_reviews)
    assert rows(reviews.product_stats(verified)) == [("p", 4, 3.75)]
    assert rows(reviews.customer_activity(verified)) == [("c1", 2), ("c2", 1), ("c3", 1)]
    assert rows(reviews.product_trends(verified)) == sorted([("p", 2024, 1, 3), ("p", None, None, 1)], key=repr)


@pytest.mark.parametrize("name", ["campaign_performance", "advertiser_spending", "cost_efficiency", "regional_analysis",
                                  "engaged_users", "top_advertisers_spend", "top_users_clicks"])
def test_top_k_reports_never_sort_everything(spark, tiny, name):
    plan = plan_of(QUERIES[name](spark, tiny))
    assert "TakeOrderedAndProject" in plan


def test_scans_read_only_what_they_need(spark, tiny):
    plan = plan_of(QUERIES["device_performance"](spark, tiny))
    assert "l_discount" not in plan and "supplier" not in plan
    assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThan(l_shipdate" in plan


# Streams and stored tables: building the frame runs the job.
RUNS_WHILE_BUILT = {"wiki_filter", "wiki_dead_letters", "wiki_table", "tweet_minutes", "csv_replay", "csv_bulk_load",
                    "json_export", "append_load", "campaign_mart", "keyed_review_pages", "stored_documents",
                    "campaign_state", "advertiser_state", "message_fields", "document_export", "paced_replay", "review_upsert"}


def test_rewritten_tables_give_the_same_results(spark, tiny, tmp_path):
    """Rows in another order and in many files change no result."""
    for name in ("lineitem", "orders", "events", "customer", "part"):
        t.table(spark, tiny, name).repartition(5, F.rand(1)).write.parquet(str(tmp_path / f"{name}.parquet"))
    for name in ("supplier", "nation"):
        t.table(spark, tiny, name).write.parquet(str(tmp_path / f"{name}.parquet"))
    for name in ("campaign_performance", "user_ad_history", "reviews_by_product", "top_haters", "last_sessions",
                 "user_history", "dim_locations", "dim_campaigns"):
        assert rows(QUERIES[name](spark, str(tmp_path))) == rows(QUERIES[name](spark, tiny)), name


def test_overall_figures_of_nothing(star):
    assert listed(ad_kpis.overall_performance(star[0].filter("false"))) == [(0, 0, None, 0.0)]


def test_no_plan_has_a_cross_join_or_python(spark, tiny):
    for name, query in QUERIES.items():
        if name in RUNS_WHILE_BUILT:
            continue
        plan = plan_of(query(spark, tiny))
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas"):
            assert word not in plan, f"{word} in {name}"


def test_key_checks_read_every_table_once(spark, tiny):
    plan = plan_of(QUERIES["schema_violations"](spark, tiny))
    assert plan.count("FileScan") == 5
    assert plan.count("Exchange hashpartitioning") <= 3  # of values, of rules, and for the join with the rules


def test_profile_sends_numbers_as_numbers(spark):
    df = spark.range(100).selectExpr("id", "cast(id as int) AS i", "id % 2 = 0 AS b", "date_add(date'2024-01-01', cast(id as int)) AS d")
    plan = plan_of(column_profile(df))
    assert "string" not in plan.split("Exchange hashpartitioning")[-1].split("Exchange")[0].lower().replace("tostring", "")
    assert plan.count("Range (") == 1


@pytest.mark.parametrize("name", ["column_profile_events", "profile_of_loads"])
def test_event_profiles_join_keys_alone(spark, tiny, name):
    """Columns that need no order are not moved to the orders."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(QUERIES[name](spark, tiny))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    moved = re.findall(r"Exchange hashpartitioning\(l_orderkey.*?FileScan parquet \[(.*?)\]", plan, re.DOTALL)
    assert moved and {re.sub(r"#\d+L?", "", columns) for columns in moved} == {"l_orderkey"}


def test_event_columns_are_parted_by_their_joins(spark, tiny):
    groups = t.event_columns(spark, tiny)
    assert sorted(c for g in groups for c in g) == sorted(c for c in t.RAW_EVENT if c != "written")
    assert len(groups) == 3 and all(len({t.RAW_EVENT[c][1] for c in g}) == 1 for g in groups)


def test_profiles_of_events_with_a_repeated_order(spark, tiny, tmp_path):
    """Lines of an order that is listed twice come twice, in every column."""
    for name in ("lineitem", "supplier", "orders"):
        df = t.table(spark, tiny, name)
        (df.unionAll(df.where("o_orderkey < 9")) if name == "orders" else df).write.parquet(str(tmp_path / f"{name}.parquet"))
    whole = column_profile(t.raw_events(spark, str(tmp_path)))
    assert rows(QUERIES["column_profile_events"](spark, str(tmp_path))) == rows(whole)
    loads = QUERIES["profile_of_loads"](spark, str(tmp_path))
    assert rows(loads.select("column_name", "filled", "empty")) == rows(whole.select("column_name", "filled", "empty"))
