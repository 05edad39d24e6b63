"""The named queries over the driver's tables.

Lookups by key are registered in the form that answers for every key, so each query
covers its whole tables. Dates, times and nested values are flattened to plain
columns here; the plan functions keep the typed forms.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom import schemas, session
from adloom.functions import text
from adloom.operators import profile
from adloom.plans import ad_kpis, ad_marts, documents, etl, live_marts, reviews, star_schema
from adloom.plans import sample_tables as t
from adloom.sources import files, inference, json_documents, messages, open_messages, tables
from adloom.streaming import keyed_sink, states, tweets, wiki
from adloom.streaming.run import drain

Query = Callable[[SparkSession, str], DataFrame]

# Report window; the data reaches from early 1995 to late 2001.
START, END = "1995-07-01", "2001-07-01"
BUDGET_START, BUDGET_END = "1995-01-01", "2002-01-01"
# Both ends count.
SHOWN_FROM, SHOWN_TO = "2024-01-02T00:00:00", "2024-01-30T00:00:00"
ARRIVALS = 3  # portions in which loads and messages come


def _text(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("string") for n in names})


def _double(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("double") for n in names})


# --- KPI reports ------------------------------------------------------------

def campaign_performance(spark: SparkSession, sf: str) -> DataFrame:
    events = t.ad_events(spark, sf, "event_id", "campaign_id", "event_timestamp", "ad_cost", "ad_revenue")
    return ad_kpis.campaign_performance(events, t.ad_campaigns(spark, sf), START, END)


def advertiser_spending(spark: SparkSession, sf: str) -> DataFrame:
    events = t.ad_events(spark, sf, "event_id", "campaign_id", "event_timestamp", "ad_cost", "ad_revenue")
    return ad_kpis.advertiser_spending(
        events, t.ad_campaigns(spark, sf), t.ad_advertisers(spark, sf), START, END)


def cost_efficiency(spark: SparkSession, sf: str) -> DataFrame:
    events = t.ad_events(spark, sf, "event_id", "campaign_id", "location_id", "event_timestamp", "ad_cost", "ad_revenue")
    return ad_kpis.cost_efficiency(events, t.ad_locations(spark, sf), START, END)


def campaign_cost_per_click(spark: SparkSession, sf: str) -> DataFrame:
    events = t.ad_events(spark, sf, "event_id", "campaign_id", "location_id", "event_timestamp", "ad_cost", "ad_revenue")
    return ad_kpis.campaign_cost_per_click(events, t.ad_locations(spark, sf), START, END)


def regional_analysis(spark: SparkSession, sf: str) -> DataFrame:
    events = t.ad_events(spark, sf, "location_id", "event_timestamp", "ad_cost", "ad_revenue")
    return ad_kpis.regional_analysis(events, t.ad_locations(spark, sf), START, END)


def engaged_users(spark: SparkSession, sf: str) -> DataFrame:
    events = t.ad_events(spark, sf, "event_id", "user_id", "event_timestamp", "ad_revenue")
    return ad_kpis.engaged_users(events, START, END)


def budget_consumption(spark: SparkSession, sf: str) -> DataFrame:
    events = t.ad_events(spark, sf, "campaign_id", "event_timestamp", "ad_cost")
    return ad_kpis.budget_consumption(events, t.ad_campaigns(spark, sf), BUDGET_START, BUDGET_END)


def campaign_device(spark: SparkSession, sf: str) -> DataFrame:
    events = t.ad_events(spark, sf, "event_id", "campaign_id", "device", "event_timestamp", "ad_cost", "ad_revenue")
    return ad_kpis.campaign_device(events, t.ad_campaigns(spark, sf), START, END)


def device_performance(spark: SparkSession, sf: str) -> DataFrame:
    events = t.ad_events(spark, sf, "event_id", "device", "event_timestamp", "ad_revenue")
    return ad_kpis.device_performance(events, START, END)


def campaign_summary(spark: SparkSession, sf: str) -> DataFrame:
    return ad_kpis.campaign_summary(t.ad_events(spark, sf, "event_id", "campaign_id", "ad_cost", "ad_revenue"))


def advertiser_total(spark: SparkSession, sf: str) -> DataFrame:
    return ad_kpis.advertiser_total(t.ad_events(spark, sf, "campaign_id", "ad_cost"), t.ad_campaigns(spark, sf))


def user_engagements(spark: SparkSession, sf: str) -> DataFrame:
    events = t.ad_events(spark, sf, "event_id", "campaign_id", "user_id", "event_timestamp", "ad_revenue")
    return _text(ad_kpis.user_engagements(
        events, t.ad_campaigns(spark, sf), t.ad_advertisers(spark, sf)), "timestamp")


# --- marts ------------------------------------------------------------------

def daily_campaign_ctr(spark: SparkSession, sf: str) -> DataFrame:
    events = t.raw_events(spark, sf, "EventID", "CampaignName", "Timestamp", "WasClicked")
    return ad_marts.daily_campaign_ctr(events, t.raw_campaigns(spark, sf))


def top_advertisers_spend(spark: SparkSession, sf: str) -> DataFrame:
    return ad_marts.top_advertisers_by_spend(t.raw_events(spark, sf, "AdvertiserName", "AdCost"))


def _history(spark: SparkSession, sf: str) -> DataFrame:
    events = t.raw_events(spark, sf, "UserID", "Timestamp", "CampaignName", "WasClicked", "written")
    return ad_marts.user_ad_history(events, ["written"])


def user_ad_history(spark: SparkSession, sf: str) -> DataFrame:
    return _text(_history(spark, sf), "event_timestamp")


def user_ad_history_newest(spark: SparkSession, sf: str) -> DataFrame:
    return _text(ad_marts.user_ad_history_page(_history(spark, sf)), "event_timestamp")


def top_users_clicks(spark: SparkSession, sf: str) -> DataFrame:
    return ad_marts.top_users_by_clicks(t.raw_events(spark, sf, "UserID", "WasClicked"))


def top_advertisers_by_region(spark: SparkSession, sf: str) -> DataFrame:
    events = t.raw_events(spark, sf, "UserID", "AdvertiserName", "AdCost")
    return ad_marts.top_advertisers_by_region(events, t.raw_users(spark, sf))


# --- documents --------------------------------------------------------------

def _impressions(spark: SparkSession, sf: str) -> DataFrame:
    return documents.impressions(t.document_events(spark, sf))


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return documents.user_documents(t.raw_users(spark, sf), _impressions(spark, sf))


def user_documents(spark: SparkSession, sf: str) -> DataFrame:
    return _document_heads(_documents(spark, sf))


def _document_heads(docs: DataFrame) -> DataFrame:
    """Document head per user, with sizes and sums over the nested parts."""
    clicks = F.flatten(F.transform("impressions", lambda i: i["clicks"]))
    return docs.groupBy(
        "_id", "demographics.age", "demographics.gender", "demographics.location", "demographics.signup_date",
        F.array_join("interests", "|").alias("interests"),
    ).agg(F.sum(F.size("impressions")).alias("impressions"), F.sum(F.size(clicks)).alias("clicks"))


def user_history(spark: SparkSession, sf: str) -> DataFrame:
    """Every impression of every document, as stored."""
    return documents.impressions_of(_documents(spark, sf)).select(
        "user_id", "ingest_ord", "event_id", "timestamp", "device_location", "campaign_name",
        "advertiser_name", "ad_category", F.size("clicks").cast("bigint").alias("clicks"),
        F.get("clicks", F.lit(0))["click_timestamp"].alias("click_timestamp"),
        F.get("clicks", F.lit(0))["ad_revenue"].alias("ad_revenue"))


def last_sessions(spark: SparkSession, sf: str) -> DataFrame:
    last = documents.last_sessions(_documents(spark, sf))
    return last.select(
        "_id", "demographics.age", F.posexplode("last_sessions").alias("place", "e"),
    ).select("_id", "age", F.col("place").cast("bigint").alias("place"), "e.event_id", "e.timestamp", "e.campaign_name")


def hourly_campaign_clicks(spark: SparkSession, sf: str) -> DataFrame:
    return documents.hourly_campaign_clicks(_impressions(spark, sf), SHOWN_FROM, SHOWN_TO)


def ad_fatigue(spark: SparkSession, sf: str) -> DataFrame:
    return documents.ad_fatigue(_impressions(spark, sf), at_least=4)


def top_categories(spark: SparkSession, sf: str) -> DataFrame:
    return documents.top_categories(_impressions(spark, sf))


# --- reviews ----------------------------------------------------------------

WRITTEN = ["written"]


def _reviews(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    raw = t.raw_reviews(spark, sf, *dict.fromkeys([*columns, "review_date", "star_rating"]))
    return reviews.clean_reviews(raw)


def reviews_by_product(spark: SparkSession, sf: str) -> DataFrame:
    return _text(reviews.reviews_by_product(reviews.clean_reviews(t.raw_reviews(spark, sf)), WRITTEN), "review_date")


def reviews_by_product_rating(spark: SparkSession, sf: str) -> DataFrame:
    return _text(reviews.reviews_by_product_rating(
        reviews.clean_reviews(t.raw_reviews(spark, sf)), WRITTEN), "review_date")


def reviews_by_customer(spark: SparkSession, sf: str) -> DataFrame:
    return _text(reviews.reviews_by_customer(reviews.clean_reviews(t.raw_reviews(spark, sf)), WRITTEN), "review_date")


def newest_product_reviews(spark: SparkSession, sf: str) -> DataFrame:
    keyed = reviews.reviews_by_product(reviews.clean_reviews(t.raw_reviews(spark, sf)), WRITTEN)
    return _text(reviews.newest_reviews(keyed, ["product_id"]), "review_date")


def top_products_by_period(spark: SparkSession, sf: str) -> DataFrame:
    return reviews.top_products_by_period(_reviews(spark, sf, "product_id"))


def top_products(spark: SparkSession, sf: str) -> DataFrame:
    return reviews.top_of_period(top_products_by_period(spark, sf), "product_id")


def _customer_reviews(spark: SparkSession, sf: str) -> DataFrame:
    return _reviews(spark, sf, "customer_id", "verified_purchase")


def top_customers_verified(spark: SparkSession, sf: str) -> DataFrame:
    return reviews.top_customers_verified(_customer_reviews(spark, sf))


def top_verified_customers(spark: SparkSession, sf: str) -> DataFrame:
    return reviews.top_of_period(top_customers_verified(spark, sf), "customer_id")


def top_haters(spark: SparkSession, sf: str) -> DataFrame:
    return reviews.top_of_period(reviews.top_haters(_customer_reviews(spark, sf)), "customer_id")


def top_backers(spark: SparkSession, sf: str) -> DataFrame:
    return reviews.top_of_period(reviews.top_backers(_customer_reviews(spark, sf)), "customer_id")


def customer_marts(spark: SparkSession, sf: str) -> DataFrame:
    return reviews.customer_marts(_customer_reviews(spark, sf))


def product_stats(spark: SparkSession, sf: str) -> DataFrame:
    raw = t.raw_reviews(spark, sf, "review_id", "product_id", "review_date", "star_rating", "verified_purchase")
    return reviews.product_stats(reviews.verified_reviews(raw))


def customer_activity(spark: SparkSession, sf: str) -> DataFrame:
    raw = t.raw_reviews(spark, sf, "review_id", "product_id", "customer_id", "review_date", "star_rating", "verified_purchase")
    return reviews.customer_activity(reviews.verified_reviews(raw))


def product_trends(spark: SparkSession, sf: str) -> DataFrame:
    raw = t.raw_reviews(spark, sf, "review_id", "product_id", "review_date", "star_rating", "verified_purchase")
    return reviews.product_trends(reviews.verified_reviews(raw))


# --- star schema ------------------------------------------------------------

def dim_locations(spark: SparkSession, sf: str) -> DataFrame:
    return star_schema.dim_locations(t.raw_users(spark, sf), "ingest_ord")


def dim_advertisers(spark: SparkSession, sf: str) -> DataFrame:
    return star_schema.dim_advertisers(t.raw_campaigns(spark, sf), "ingest_ord")


def _campaigns(spark: SparkSession, sf: str, locations: DataFrame | None = None) -> DataFrame:
    return star_schema.dim_campaigns(t.raw_campaigns(spark, sf), dim_advertisers(spark, sf), locations or dim_locations(spark, sf))


def dim_campaigns(spark: SparkSession, sf: str) -> DataFrame:
    return _double(_text(_campaigns(spark, sf), "start_date", "end_date"), "budget")


def _users(spark: SparkSession, sf: str, locations: DataFrame | None = None) -> DataFrame:
    return star_schema.dim_users(t.raw_users(spark, sf), locations or dim_locations(spark, sf))


def dim_users(spark: SparkSession, sf: str) -> DataFrame:
    return _text(_users(spark, sf), "signup_date")


def user_interests(spark: SparkSession, sf: str) -> DataFrame:
    return star_schema.user_interests(t.raw_users(spark, sf))


def _facts(spark: SparkSession, sf: str) -> DataFrame:
    locations = dim_locations(spark, sf)
    return star_schema.fact_events(t.raw_events(spark, sf), _campaigns(spark, sf, locations), locations)


def fact_events(spark: SparkSession, sf: str) -> DataFrame:
    return _double(_text(_facts(spark, sf), "event_timestamp", "click_timestamp"), "bid_amount", "ad_cost", "ad_revenue")


def schema_violations(spark: SparkSession, sf: str) -> DataFrame:
    """The rules of the star schema, checked on the stored tables: each is written once and read once."""
    base = session.scratch_dir(spark, "star")

    def store(df: DataFrame, name: str) -> DataFrame:
        tables.write_table(df, f"{base}/{name}", mode="overwrite")
        return tables.read_table(spark, f"{base}/{name}")

    locations, advertisers = store(dim_locations(spark, sf), "locations"), store(dim_advertisers(spark, sf), "advertisers")
    campaigns = store(star_schema.dim_campaigns(t.raw_campaigns(spark, sf), advertisers, locations), "campaigns")
    users = store(star_schema.dim_users(t.raw_users(spark, sf), locations), "users")
    events = store(star_schema.fact_events(t.raw_events(spark, sf), campaigns, locations), "events")
    return star_schema.schema_violations(locations, advertisers, users, campaigns, events)


def invalid_enums(spark: SparkSession, sf: str) -> DataFrame:
    return star_schema.invalid_enums(_facts(spark, sf), _users(spark, sf))


def _profile_of_events(spark: SparkSession, sf: str, parts: list[list[str]]) -> DataFrame:
    """The exact profile of the raw events in parts of columns. Most values of some columns occur once, so columns
    that need no join are collapsed each by itself, in little memory."""
    frames = []
    for part in parts:
        frames += [part] if any(t.RAW_EVENT[c][1] for c in part) else [[c] for c in part]
    return profile.column_profile(*(t.raw_events(spark, sf, *columns) for columns in frames))


def column_profile_events(spark: SparkSession, sf: str) -> DataFrame:
    return _profile_of_events(spark, sf, t.event_columns(spark, sf))


def column_profile_users(spark: SparkSession, sf: str) -> DataFrame:
    return profile.column_profile(t.raw_users(spark, sf).drop("ingest_ord"))


def column_profile_campaigns(spark: SparkSession, sf: str) -> DataFrame:
    return profile.column_profile(t.raw_campaigns(spark, sf).drop("ingest_ord"))


# --- stored tables: written to the scratch folder and read back ----------------

DEVICE_SQL = f"""
  SELECT device, count(event_id) AS total_impressions, sum(CASE WHEN ad_revenue > 0 THEN 1 ELSE 0 END) AS total_clicks
  FROM {{ad_events}} WHERE event_timestamp >= '{START}' AND event_timestamp < '{END}'
  GROUP BY device HAVING total_clicks > 0 ORDER BY total_clicks DESC, device"""


def overall_performance(spark: SparkSession, sf: str) -> DataFrame:
    return ad_kpis.overall_performance(t.ad_events(spark, sf, "event_id", "ad_cost", "ad_revenue"))


def sql_text_report(spark: SparkSession, sf: str) -> DataFrame:
    events = t.ad_events(spark, sf, "event_id", "device", "event_timestamp", "ad_revenue")
    return tables.run_sql(spark, DEVICE_SQL, {"ad_events": events})


FIRST_EVENTS = 750  # rows of the bounded load, fewer than any of the tables has


def first_events(spark: SparkSession, sf: str) -> DataFrame:
    """The bounded load: the first events in the order they came in."""
    rows = files.first_rows(t.document_events(spark, sf), FIRST_EVENTS)
    return rows.select("ingest_ord", "EventID", "CampaignName", "Timestamp")


def csv_bulk_load(spark: SparkSession, sf: str) -> DataFrame:
    """Mapped facts out to headerless CSV, and in again with an explicit column list."""
    path = session.scratch_dir(spark, "bulk-load")
    files.write_csv(_facts(spark, sf), path, header=False)
    loaded = files.read_csv(spark, path, schemas.text_schema(*schemas.FACT_EVENTS), header=False)
    whole = {c: text.to_long(F.col(c)) for c in ("campaign_id", "user_id", "location_id")}
    moments = {c: text.to_wall_clock(F.col(c)).cast("string") for c in ("event_timestamp", "click_timestamp")}
    typed = loaded.withColumns(whole | moments | {"was_clicked": F.col("was_clicked").try_cast("boolean")})
    return _double(typed, "bid_amount", "ad_cost", "ad_revenue")


def json_export(spark: SparkSession, sf: str) -> DataFrame:
    path = session.scratch_dir(spark, "json-export")
    files.export_results({"cost_efficiency": cost_efficiency(spark, sf)}, path)
    fields = "country_name string, campaign_id bigint, total_revenue double, total_cost double, cpm double, cpc double"
    return spark.read.schema(fields).json(f"{path}/cost_efficiency")


def append_load(spark: SparkSession, sf: str) -> DataFrame:
    """Loaded twice by append, the rows are there twice."""
    path = session.scratch_dir(spark, "append-load")
    for _ in range(2):
        tables.write_table(dim_advertisers(spark, sf), path, mode="append")
    return tables.read_table(spark, path, ["advertiser_id", "advertiser_name"])


def campaign_mart(spark: SparkSession, sf: str) -> DataFrame:
    """Loaded twice by overwrite, the mart holds the last load."""
    path = session.scratch_dir(spark, "campaign-mart")
    for _ in range(2):
        tables.write_keyed(campaign_summary(spark, sf), path, ["campaign_id"], [])
    return tables.read_table(spark, path)


def keyed_review_pages(spark: SparkSession, sf: str) -> DataFrame:
    """The stored copy by product and rating, read as the newest page of every key."""
    path = session.scratch_dir(spark, "review-pages")
    clean = reviews.clean_reviews(t.raw_reviews(spark, sf))
    key = ["product_id", "star_rating"]
    tables.write_keyed(reviews.reviews_by_product_rating(clean, WRITTEN), path, key,
                       [F.desc("review_date"), F.asc("review_id")])
    pages = reviews.newest_reviews(tables.read_table(spark, path), key, 3)
    return _text(pages.select(*key, "review_date", "review_id", "customer_id"), "review_date")


REVIEW_COLUMNS = "product_id string, review_date date, review_id string, customer_id string, star_rating int"


def review_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Loads of reviews by product: the second lowers some ratings and brings rows again. Read before and
    after folding, and with a load after that, which brings new keys and replaces folded ones."""
    path, key = session.scratch_dir(spark, "review-loads"), list(reviews.BY_PRODUCT)
    layout, buckets = (["product_id"], [F.desc("review_date"), F.asc("review_id")]), tables.bucket_count(spark, f"{sf.rstrip('/')}/lineitem.parquet")
    append = keyed_sink.append_batches(path, key, ["star_rating"], *layout, buckets=buckets)
    found = reviews.reviews_by_product(reviews.clean_reviews(t.raw_reviews(spark, sf)), WRITTEN, buckets=buckets).drop("review_headline", "review_body")
    name = tables.entry_name("clean")
    with session.shuffles_released(spark):
        tables.write_bucketed(found, name, f"{path}-clean", key, buckets)
    clean = spark.table(name)

    def load(rows: DataFrame, batch: int) -> None:
        with session.shuffles_released(spark):
            append(rows, batch)

    def now(stage: str) -> DataFrame:
        """The files of the table as of now; they outlive the next fold."""
        return keyed_sink.read_upserted(spark, path, REVIEW_COLUMNS, key, ["star_rating"]).withColumn("stage", F.lit(stage))

    load(clean, 0)
    load(clean.filter(F.col("star_rating") >= 3).withColumn("star_rating", F.lit(1)), 1)
    stages = now("before")
    with session.shuffles_released(spark):
        keyed_sink.compact(spark, path, REVIEW_COLUMNS, key, ["star_rating"], *layout)
    stages = stages.unionByName(now("folded"))
    second = clean.withColumn("review_id", F.concat("review_id", F.lit("-again")))
    load(second.unionByName(clean.filter(F.col("star_rating") == 2).withColumn("star_rating", F.lit(5))), 2)
    spark.sql(f"DROP TABLE {name}")  # the files stay
    return _text(stages.unionByName(now("later")), "review_date")


def _loaded_reviews(spark: SparkSession, sf: str) -> str:
    """The load of a CSV whose header has more columns in another order and some ratings as 5.0; where its tables are."""
    path = session.scratch_dir(spark, "csv-reviews")
    raw = t.raw_reviews(spark, sf)
    other = raw.select(F.lit("X").alias("marketplace"), "customer_id", "review_id",
                       F.when(F.col("star_rating") == "5", F.lit("5.0")).otherwise(F.col("star_rating")).alias("star_rating"),
                       "verified_purchase", "product_id", "review_body", "review_date", "review_headline")
    with session.shuffles_released(spark):
        files.write_csv(other, f"{path}/csv", packed=True)
    etl.load_reviews(spark, f"{path}/csv", f"{path}/out")
    return f"{path}/out"


def csv_reviews(spark: SparkSession, sf: str) -> DataFrame:
    """One table of the load, as it is."""
    return tables.read_table(spark, f"{_loaded_reviews(spark, sf)}/product_stats")


# Of the eight tables of the load: whom a row is about, what it says besides, and its number. Of rows written
# twice, which is kept follows the order of the file, and there rows of one key differ in what is left out here.
REVIEW_TABLES = {
    "reviews_by_product": ("product_id", ("review_date", "review_id"), None),
    "reviews_by_product_rating": ("product_id", ("review_date", "review_id"), "star_rating"),
    "reviews_by_customer": ("customer_id", ("review_date", "review_id"), None),
    "top_products_by_period": ("product_id", ("period",), "review_count"),
    "customers_by_period": ("customer_id", ("mart", "period"), "review_count"),
    "product_stats": ("product_id", (), "total_reviews"),
    "customer_activity": ("customer_id", (), "verified_reviews_count"),
    "product_trends": ("product_id", ("year", "month"), "review_count"),
}


def csv_review_tables(spark: SparkSession, sf: str) -> DataFrame:
    """All eight tables of the load, in one shape."""
    out, found = _loaded_reviews(spark, sf), None
    for name, (who, what, number) in REVIEW_TABLES.items():
        rows = tables.read_table(spark, f"{out}/{name}").select(
            F.lit(name).alias("table_name"), F.col(who).cast("string").alias("who"), F.concat_ws("/", F.lit(""), *(F.col(c).cast("string") for c in what)).alias("what"),
            (F.lit(None) if number is None else F.col(number)).cast("bigint").alias("number"))
        found = rows if found is None else found.unionByName(rows)
    return found


def _typed_inputs(spark: SparkSession, sf: str, base: str) -> dict[str, str]:
    """The raw inputs as CSV files with headers, reviews with semicolons; separator by table."""
    raw = {"events": t.raw_events(spark, sf), "users": t.raw_users(spark, sf), "campaigns": t.raw_campaigns(spark, sf),
           "reviews": t.raw_reviews(spark, sf).drop("written")}
    separators = {name: ";" if name == "reviews" else "," for name in raw}
    for name, df in raw.items():
        files.write_csv(df, f"{base}/{name}", sep=separators[name], packed=True)
    return separators


def csv_inferred_types(spark: SparkSession, sf: str) -> DataFrame:
    """Types of all columns of the raw files, from all their cells."""
    base, found = session.scratch_dir(spark, "inferred"), None
    for name, sep in _typed_inputs(spark, sf, base).items():
        types = inference.column_types(inference.cell_profile(files.read_csv(spark, f"{base}/{name}", sep=sep)))
        types = types.withColumn("table_name", F.lit(name))
        found = types if found is None else found.unionByName(types)
    return found


def csv_typed_campaigns(spark: SparkSession, sf: str) -> DataFrame:
    """Campaigns loaded with the types found; no type is named here."""
    base = session.scratch_dir(spark, "typed")
    files.write_csv(t.raw_campaigns(spark, sf).drop("ingest_ord"), base)
    return _text(inference.read_typed_csv(spark, base), "CampaignStartDate")


def stored_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents stored nested; categories asked from the stored form."""
    path = session.scratch_dir(spark, "documents")
    tables.write_table(_documents(spark, sf), path)
    return documents.top_categories(documents.impressions_of(tables.read_table(spark, path)))


def document_export(spark: SparkSession, sf: str) -> DataFrame:
    """All user documents as one indented JSON list, written in parts and read back."""
    path = session.scratch_dir(spark, "document-export")
    docs = _documents(spark, sf)
    json_documents.write_json_list(docs.orderBy("_id", "page"), path)
    return _document_heads(json_documents.read_json_list(spark, path, docs.schema))


def profile_of_loads(spark: SparkSession, sf: str) -> DataFrame:
    """The profile of events that came in three loads, from stored sketches; distinct values are within 3 %."""
    path, parts = session.scratch_dir(spark, "load-profiles"), t.event_columns(spark, sf)
    came = F.pmod(F.xxhash64("EventID"), F.lit(ARRIVALS))
    for load in range(ARRIVALS):
        profile.store_sketches([t.raw_events(spark, sf, *{"EventID", *columns}).where(came == load).select(*columns) for columns in parts], path, load)
    exact = _profile_of_events(spark, sf, parts).select("column_name", F.col("distinct_values").alias("exact"))
    near = F.abs(F.col("distinct_values") - F.col("exact")) <= F.col("exact") * 0.03
    return profile.profile_of_loads(spark, path).join(exact, "column_name").select("column_name", "filled", "empty", near.alias("near"))


def lookup_batch(spark: SparkSession, sf: str) -> DataFrame:
    """One review of every customer, looked up by review id in the copy laid out by product."""
    path = session.scratch_dir(spark, "lookups")
    clean = reviews.reviews_by_product(reviews.clean_reviews(t.raw_reviews(spark, sf)), WRITTEN)
    tables.write_keyed(clean, path, ["product_id"], [F.desc("review_date"), F.asc("review_id")], lookups=["review_id", "customer_id"])
    stored = tables.read_table(spark, path)
    wanted = stored.groupBy("customer_id").agg(F.min("review_id").alias("review_id"))
    found = tables.lookup_batch(stored, wanted, "review_id")
    return _text(found.select("review_id", "customer_id", "product_id", "review_date", "star_rating"), "review_date")


def bucketed_engagements(spark: SparkSession, sf: str) -> DataFrame:
    """Clicked events with their campaigns, both stored in equal buckets by campaign."""
    base = session.scratch_dir(spark, "buckets")
    name = f"adloom_{base.rsplit('-', 1)[-1]}"
    events = t.ad_events(spark, sf, "event_id", "campaign_id", "user_id", "event_timestamp", "ad_revenue")
    tables.write_bucketed(events, f"{name}_events", f"{base}/events", ["campaign_id"], 8)
    tables.write_bucketed(t.ad_campaigns(spark, sf), f"{name}_campaigns", f"{base}/campaigns", ["campaign_id"], 8)
    found = ad_kpis.user_engagements(spark.table(f"{name}_events"), spark.table(f"{name}_campaigns"), t.ad_advertisers(spark, sf))
    return _text(found, "timestamp")


# --- streams ----------------------------------------------------------------

def _follow(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """One of the driver's parquet tables as a stream. Written as a pattern, the path
    may be one file or a folder of files; a plain path has to be a folder."""
    schema = t.table(spark, sf, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf.rstrip('/')}/{name}.parque[t]")


def _filtered_topic(spark: SparkSession, sf: str, base: str) -> str:
    changes = t.wiki_changes(_follow(spark, sf, "events"))
    drain(wiki.filter_job(changes, f"{base}/filter-progress", "text", f"{base}/processed"))
    return f"{base}/processed"


def wiki_filter(spark: SparkSession, sf: str) -> DataFrame:
    topic = _filtered_topic(spark, sf, session.scratch_dir(spark, "wiki-filter"))
    fields = "user_id string, domain string, created_at string, page_title string, user_is_bot boolean"
    return spark.read.schema("value string").text(topic).select(F.from_json("value", fields).alias("d")).select(
        "d.user_id", "d.domain", "d.created_at", "d.page_title", F.col("d.user_is_bot").cast("string").alias("user_is_bot"))


def wiki_dead_letters(spark: SparkSession, sf: str) -> DataFrame:
    base = session.scratch_dir(spark, "wiki-dead")
    changes = t.wiki_changes(_follow(spark, sf, "events"))
    drain(wiki.dead_letter_job(changes, f"{base}/progress", "text", f"{base}/dead"))
    return spark.read.schema("value string").text(f"{base}/dead")


def _arrivals(rows: DataFrame, number: str, path: str):
    """Message texts that arrive in a folder in several portions, which cover all rows; yields after each."""
    for k in range(ARRIVALS):
        rows.where(F.col(number) % ARRIVALS == k).select("value").write.mode("append").text(path)
        yield k


def wiki_table(spark: SparkSession, sf: str) -> DataFrame:
    """Both jobs run again on every arrival of messages, whose keys collide; the table is folded before the last."""
    base = session.scratch_dir(spark, "wiki-table")
    events = t.table(spark, sf, "events")
    for k in _arrivals(t.wiki_changes(events, "event_id"), "event_id", f"{base}/raw"):
        if k == ARRIVALS - 1:
            wiki.fold_pages(spark, f"{base}/pages")
        raw = messages.read_messages(spark, "text", f"{base}/raw")
        drain(wiki.filter_job(raw, f"{base}/filter-progress", "text", f"{base}/processed"))
        processed = messages.read_messages(spark, "text", f"{base}/processed")
        drain(wiki.table_job(processed, f"{base}/pages", f"{base}/table-progress"))
    utc = F.to_utc_timestamp("created_at", F.current_timezone())
    return wiki.read_pages(spark, f"{base}/pages").withColumn("created_at", F.date_format(utc, "yyyy-MM-dd HH:mm:ss"))


def tweet_minutes(spark: SparkSession, sf: str) -> DataFrame:
    """Minutes read from folded files and later ones together: minutes are folded before the last arrival of tweets."""
    base = session.scratch_dir(spark, "tweet-minutes")
    for k in _arrivals(t.tweets(t.table(spark, sf, "conversations"), "conv_id"), "conv_id", f"{base}/raw"):
        if k == ARRIVALS - 1:
            tweets.fold_minutes(spark, f"{base}/minutes")
        drain(tweets.minute_job(messages.read_messages(spark, "text", f"{base}/raw"), f"{base}/minutes", f"{base}/progress"))
    return tweets.read_minutes(spark, f"{base}/minutes")


def _campaign_states(spark: SparkSession, sf: str) -> DataFrame:
    """States from a stream of ad events in three micro-batches, the second of which is run twice; folded before the last."""
    base, sums = session.scratch_dir(spark, "campaign-state"), live_marts.campaign_sums()
    events = t.ad_events(spark, sf, "event_id", "campaign_id", "ad_cost", "ad_revenue")
    write = states.append_states(f"{base}/states", sums)

    def write_again(batch: DataFrame, batch_id: int) -> None:
        for _ in range(2 if batch_id == 1 else 1):
            write(batch, batch_id)
        if batch_id == 1:
            states.fold_states(spark, f"{base}/states", sums)

    for k in range(ARRIVALS):  # as many files each as the scan has parts, so a task reads what one part brought
        events.where(F.pmod(F.xxhash64("event_id"), F.lit(ARRIVALS)) == k).write.mode("append").parquet(f"{base}/events")
        source = spark.readStream.schema(events.schema).parquet(f"{base}/events")
        drain(source.writeStream.option("checkpointLocation", f"{base}/progress").foreachBatch(write_again))
    return states.read_states(spark, f"{base}/states", sums)


def campaign_state(spark: SparkSession, sf: str) -> DataFrame:
    return live_marts.campaign_summary(_campaign_states(spark, sf))


def advertiser_state(spark: SparkSession, sf: str) -> DataFrame:
    return live_marts.advertiser_report(_campaign_states(spark, sf), t.ad_campaigns(spark, sf))


TWEET_FIELDS = {"author": ("$.author_id", "string"), "text": ("$.text", "string")}


def message_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Every field of the wiki messages and the tweets, found without a schema."""
    wiki_topic = t.wiki_changes(t.table(spark, sf, "events")).select(F.lit("wiki").alias("topic"), "value")
    tweet_topic = t.tweets(t.table(spark, sf, "conversations")).select(F.lit("tweets").alias("topic"), "value")
    return open_messages.message_fields(wiki_topic.unionByName(tweet_topic), by=("topic",))


def open_tweets(spark: SparkSession, sf: str) -> DataFrame:
    """Tweets as two named fields and all others as they came."""
    return open_messages.open_columns(t.tweets(t.table(spark, sf, "conversations")), TWEET_FIELDS)


def tweet_dead_letters(spark: SparkSession, sf: str) -> DataFrame:
    """System turns are sent as plain text, which is no tweet; all others as tweets."""
    base = session.scratch_dir(spark, "tweet-dead")
    turns = _follow(spark, sf, "conversations")
    plain = F.translate(F.coalesce("text", F.lit("")), "\n\r", "  ")
    sent = turns.select(F.when(F.col("role") == "system", plain).otherwise(
        F.to_json(F.struct(F.col("role").alias("author_id"), "text"))).alias("value"))
    drain(tweets.dead_letter_job(sent, f"{base}/progress", "text", f"{base}/dead"))
    return spark.read.schema("value string").text(f"{base}/dead")


def csv_replay(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation turns written as CSV, replayed as messages. The creation time is
    the time of the replay, so only its presence can be compared."""
    base = session.scratch_dir(spark, "csv-replay")
    turns = t.table(spark, sf, "conversations").select(F.col("role").alias("author_id"), "text")
    files.write_csv(turns, f"{base}/csv")
    rows = tweets.follow_csv(spark, f"{base}/csv", max_files=8, multi_line=True)
    drain(tweets.replay_job(rows, f"{base}/progress", "text", f"{base}/topic"))
    fields = "author_id string, text string, created_at string"
    return spark.read.schema("value string").text(f"{base}/topic").select(F.from_json("value", fields).alias("d")).select(
        "d.author_id", "d.text", F.col("d.created_at").isNotNull().cast("string").alias("has_time"))


def paced_replay(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation turns replayed at twelve a second of the clock, in their order, ten minutes a batch."""
    base, rate, seconds = session.scratch_dir(spark, "paced"), 12, 600
    turns = t.table(spark, sf, "conversations").select((F.col("conv_id") * 100_000 + F.col("turn")).alias("ordinal"), F.col("role").alias("author_id"), "text")
    sent = tweets.number_rows(turns, "ordinal", f"{base}/numbered", ties=("author_id", "text"))
    numbered = spark.read.parquet(f"{base}/numbered").drop("ordinal")
    tweets.replay_paced(tweets.paced_job(numbered, f"{base}/topic", f"{base}/progress", "2024-01-01 00:00:00", rate, seconds), sent, rate, seconds)
    fields = "number long, author_id string, text string, created_at string"
    topic = spark.read.schema("value string").text(f"{base}/topic/*")
    return topic.select(F.from_json("value", fields).alias("d")).select("d.*")


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    campaign_performance, advertiser_spending, cost_efficiency, regional_analysis, engaged_users,
    budget_consumption, campaign_device, device_performance, campaign_summary, advertiser_total,
    user_engagements,
    daily_campaign_ctr, top_advertisers_spend, user_ad_history, user_ad_history_newest, top_users_clicks,
    top_advertisers_by_region,
    user_documents, user_history, last_sessions, hourly_campaign_clicks, ad_fatigue, top_categories,
    reviews_by_product, reviews_by_product_rating, reviews_by_customer, newest_product_reviews,
    top_products_by_period, top_products, top_customers_verified, top_verified_customers, top_haters,
    top_backers, customer_marts, product_stats, customer_activity, product_trends,
    dim_locations, dim_advertisers, dim_campaigns, dim_users, user_interests, fact_events,
    schema_violations, invalid_enums, column_profile_events, column_profile_users, column_profile_campaigns,
    campaign_cost_per_click, overall_performance, sql_text_report, first_events, csv_bulk_load, json_export, append_load, campaign_mart,
    keyed_review_pages, stored_documents,
    review_upsert, csv_reviews, csv_review_tables, csv_inferred_types, csv_typed_campaigns, message_fields, open_tweets, campaign_state, advertiser_state,
    document_export, profile_of_loads, lookup_batch, bucketed_engagements, paced_replay,
    wiki_filter, wiki_dead_letters, wiki_table, tweet_minutes, tweet_dead_letters, csv_replay,
)}
