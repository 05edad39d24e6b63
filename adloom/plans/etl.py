"""Whole loads: raw files in, stored tables out. Every table is written by overwrite,
so a load that failed half-way is simply run again. Later tables read the stored
earlier ones: ids stay the same and no plan drags the whole history along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom import schemas
from adloom.plans import ad_kpis, ad_marts, documents, reviews, star_schema
from adloom.session import scans_of, shuffles_released
from adloom.sources.files import INGEST_ORDER, export_results, first_rows, read_csv, with_ingest_order
from adloom.sources.json_documents import write_json_lists
from adloom.sources.tables import read_table, write_keyed, write_table


SORTED_BYTES = 32 << 20  # of staged files, whose rows a task sorts in memory


def _raw(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    rows = with_ingest_order(read_csv(spark, path))
    return rows if limit is None else first_rows(rows, limit)


def load_star_schema(spark: SparkSession, campaigns_csv: str, users_csv: str, events_csv: str, out: str,
                     limit: int | None = None) -> DataFrame:
    """Dimensions first, then the facts that refer to them. ``limit`` bounds the load
    to the first events of the file. Returns the key violations found, empty if none."""
    def store(df: DataFrame, name: str) -> DataFrame:
        write_table(df, f"{out}/{name}", mode="overwrite")
        return read_table(spark, f"{out}/{name}")

    # Files that several tables come from are parsed once.
    raw_campaigns, raw_users = store(_raw(spark, campaigns_csv), "staged_campaigns"), store(_raw(spark, users_csv), "staged_users")
    locations = store(star_schema.dim_locations(raw_users, INGEST_ORDER), "locations")
    advertisers = store(star_schema.dim_advertisers(raw_campaigns, INGEST_ORDER), "advertisers")
    campaigns = store(star_schema.dim_campaigns(raw_campaigns, advertisers, locations), "campaigns")
    users = store(star_schema.dim_users(raw_users, locations), "users")
    store(star_schema.user_interests(raw_users), "user_interests")
    events = store(star_schema.fact_events(_raw(spark, events_csv, limit), campaigns, locations), "events")
    return star_schema.schema_violations(locations, advertisers, users, campaigns, events).filter(F.col("bad_values") > 0)


def kpi_reports(spark: SparkSession, star: str, start: str, end: str) -> dict[str, DataFrame]:
    """The KPI reports over a stored star schema, by title."""
    events, campaigns, advertisers, locations = (
        read_table(spark, f"{star}/{name}") for name in ("events", "campaigns", "advertisers", "locations"))
    return {
        "campaign_performance": ad_kpis.campaign_performance(events, campaigns, start, end),
        "advertiser_spending": ad_kpis.advertiser_spending(events, campaigns, advertisers, start, end),
        "cost_efficiency": ad_kpis.cost_efficiency(events, locations, start, end),
        "regional_analysis": ad_kpis.regional_analysis(events, locations, start, end),
        "engaged_users": ad_kpis.engaged_users(events, start, end),
        "budget_consumption": ad_kpis.budget_consumption(events, campaigns, start, end),
        "campaign_device": ad_kpis.campaign_device(events, campaigns, start, end),
        "device_performance": ad_kpis.device_performance(events, start, end),
    }


def export_kpi_reports(spark: SparkSession, star: str, out: str, start: str, end: str) -> None:
    export_results(kpi_reports(spark, star, start, end), out)


def export_kpi_document(spark: SparkSession, star: str, out: str, start: str, end: str) -> None:
    """All KPI reports as one indented JSON document: a list of records by title, empty for a report without rows."""
    write_json_lists(kpi_reports(spark, star, start, end), out)


def load_lookup_marts(spark: SparkSession, star: str, out: str) -> None:
    """Stored answers to the lookups by campaign, advertiser and user. A request reads
    the few row groups its key falls into and recomputes nothing."""
    events, campaigns, advertisers = (
        read_table(spark, f"{star}/{name}") for name in ("events", "campaigns", "advertisers"))
    write_keyed(ad_kpis.campaign_summary(events), f"{out}/campaign_summary", ["campaign_id"], [])
    write_keyed(ad_kpis.advertiser_total(events, campaigns), f"{out}/advertiser_total", ["advertiser_id"], [])
    write_keyed(ad_kpis.user_engagements(events, campaigns, advertisers), f"{out}/user_engagements",
                ["user_id"], [F.desc("timestamp"), F.asc("event_id")])


def load_ad_marts(spark: SparkSession, campaigns_csv: str, users_csv: str, events_csv: str, out: str) -> None:
    """One table per question over the raw events."""
    staged = {"campaigns": campaigns_csv, "users": users_csv, "events": events_csv}
    for name, path in staged.items():  # each raw file is parsed once
        write_table(_raw(spark, path), f"{out}/staged_{name}", mode="overwrite")
    campaigns, users, events = (read_table(spark, f"{out}/staged_{name}") for name in staged)
    write_keyed(ad_marts.daily_campaign_ctr(events, campaigns), f"{out}/campaign_daily_performance",
                ["event_date"], [F.asc("campaign_name"), F.asc("campaign_id")])
    write_keyed(ad_marts.top_advertisers_by_spend(events), f"{out}/top_advertisers_by_spend",
                ["time_window"], [F.desc("total_spend"), F.asc("advertiser_name")])
    write_keyed(ad_marts.user_ad_history(events, [INGEST_ORDER]), f"{out}/user_ad_history",
                ["user_id"], [F.desc("event_timestamp")])
    write_keyed(ad_marts.top_users_by_clicks(events), f"{out}/top_users_by_clicks",
                ["time_window"], [F.desc("total_clicks"), F.asc("user_id")])
    write_keyed(ad_marts.top_advertisers_by_region(events, users), f"{out}/top_advertisers_by_region",
                ["region", "time_window"], [F.desc("total_spend"), F.asc("advertiser_name")])


def load_documents(spark: SparkSession, users_csv: str, events_csv: str, out: str, limit: int | None = None) -> None:
    """User documents with nested impressions, laid out by user."""
    seen = documents.impressions(_raw(spark, events_csv, limit))
    docs = documents.user_documents(_raw(spark, users_csv), seen)
    write_keyed(docs, out, ["_id"], [F.asc("page")])


def load_reviews(spark: SparkSession, reviews_csv: str, out: str, sep: str = ",") -> None:
    """Keyed copies, monthly rankings and aggregates. The three customer rankings
    share one pass, stored once and read back three times."""
    with shuffles_released(spark):
        _load_reviews(spark, reviews_csv, out, sep)


def _load_reviews(spark: SparkSession, reviews_csv: str, out: str, sep: str) -> None:
    raw = with_ingest_order(read_csv(spark, reviews_csv, sep=sep))
    absent = [c for c in schemas.RAW_REVIEWS.names if c not in raw.columns]
    if absent:
        raise ValueError(f"columns missing in {reviews_csv}: {', '.join(absent)}")
    # All columns are stored once, by ranges of the product; every table below reads them back, pruned, the two by product as they lie.
    staged = reviews.mark_last_writes(raw.select(*schemas.RAW_REVIEWS.names, INGEST_ORDER), INGEST_ORDER)
    write_table(staged, f"{out}/staged_reviews", mode="overwrite", compression="zstd", **{"parquet.block.size": str(SORTED_BYTES)})
    raw = read_table(spark, f"{out}/staged_reviews")
    clean = reviews.clean_reviews(raw)
    newest = [F.desc("review_date"), F.asc("review_id")]
    written = [INGEST_ORDER]
    with scans_of(spark, SORTED_BYTES):  # sorted as they are read
        write_keyed(reviews.reviews_by_product(clean, written, ranged=True), f"{out}/reviews_by_product", ["product_id"], newest, ranged=True)
        write_keyed(reviews.reviews_by_product_rating(clean, written, ranged=True), f"{out}/reviews_by_product_rating",
                    ["product_id", "star_rating"], newest, ranged=True)
    write_keyed(reviews.reviews_by_customer(clean, written, ranged=True), f"{out}/reviews_by_customer", ["customer_id"], newest, ranged=True)

    write_keyed(reviews.top_products_by_period(clean), f"{out}/top_products_by_period", ["period"],
                [F.desc("review_count"), F.asc("product_id")], folders=True)
    write_keyed(reviews.customer_marts(clean), f"{out}/customers_by_period", ["mart", "period"],
                [F.desc("review_count"), F.asc("customer_id")], folders=True)

    verified = reviews.verified_reviews(raw)
    for name, mart in {"product_stats": reviews.product_stats, "customer_activity": reviews.customer_activity,
                       "product_trends": reviews.product_trends}.items():
        write_table(mart(verified), f"{out}/{name}", mode="overwrite")
