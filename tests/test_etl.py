"""Whole loads from CSV files made of the driver's tables."""

import json
import re
import time

import pytest
from pyspark.sql import functions as F

from adloom import session
from adloom.plans import ad_kpis, ad_marts, documents, etl, reviews, star_schema
from adloom.plans import sample_tables as t
from adloom.sources import files, tables
from conftest import plan_of, rows


@pytest.fixture(scope="module")
def raw(spark, tiny, tmp_path_factory):
    """Raw files in ordinal order, one file each, as the inputs arrive."""
    base = str(tmp_path_factory.mktemp("raw"))
    files.write_csv(t.raw_campaigns(spark, tiny).orderBy("ingest_ord").drop("ingest_ord").coalesce(1), f"{base}/campaigns")
    files.write_csv(t.raw_users(spark, tiny).orderBy("ingest_ord").drop("ingest_ord").coalesce(1), f"{base}/users")
    files.write_csv(t.raw_events(spark, tiny).coalesce(1), f"{base}/events")
    files.write_csv(t.raw_reviews(spark, tiny).drop("written").select(
        "product_id", "review_date", "review_id", "customer_id", "star_rating", "review_headline", "review_body",
        "verified_purchase").coalesce(1), f"{base}/reviews")
    return base


@pytest.fixture(scope="module")
def star(spark, raw, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("star"))
    bad = etl.load_star_schema(spark, f"{raw}/campaigns", f"{raw}/users", f"{raw}/events", out)
    return out, {r["rule"]: r["bad_rows"] for r in bad.collect()}


def test_star_schema_equals_the_frames(spark, tiny, star):
    out, bad = star
    locations = star_schema.dim_locations(t.raw_users(spark, tiny), "ingest_ord")
    assert rows(tables.read_table(spark, f"{out}/locations")) == rows(locations)
    advertisers = star_schema.dim_advertisers(t.raw_campaigns(spark, tiny), "ingest_ord")
    campaigns = star_schema.dim_campaigns(t.raw_campaigns(spark, tiny), advertisers, locations)
    assert rows(tables.read_table(spark, f"{out}/campaigns")) == rows(campaigns)
    facts = star_schema.fact_events(t.raw_events(spark, tiny), campaigns, locations)
    assert rows(tables.read_table(spark, f"{out}/events")) == rows(facts)
    # Unknown campaigns get id 0, which happens to be a campaign in these tables.
    assert set(bad) == {"events.event_id unique", "events.location_id known"}


def test_a_repeated_load_gives_the_same_tables(spark, raw, star):
    out, bad = star
    before = rows(tables.read_table(spark, f"{out}/events"))
    again = etl.load_star_schema(spark, f"{raw}/campaigns", f"{raw}/users", f"{raw}/events", out)
    assert {r["rule"]: r["bad_rows"] for r in again.collect()} == bad
    assert rows(tables.read_table(spark, f"{out}/events")) == before


def test_bounded_load_takes_the_first_events(spark, raw, tmp_path):
    out = str(tmp_path)
    etl.load_star_schema(spark, f"{raw}/campaigns", f"{raw}/users", f"{raw}/events", out, limit=25)
    first = [r["EventID"] for r in files.read_csv(spark, f"{raw}/events").limit(25).collect()]
    assert sorted(r["event_id"] for r in tables.read_table(spark, f"{out}/events").collect()) == sorted(first)


def test_reports_and_lookup_marts(spark, star, tmp_path):
    out, _ = star
    etl.export_kpi_reports(spark, out, str(tmp_path / "json"), "1995-01-01", "2002-01-01")
    reports = etl.kpi_reports(spark, out, "1995-01-01", "2002-01-01")
    for title, df in reports.items():
        lines = [json.loads(x) for p in (tmp_path / "json" / title).glob("*.json") for x in p.read_text().splitlines()]
        assert len(lines) == df.count() and len(lines) > 0
    etl.export_kpi_document(spark, out, str(tmp_path / "document"), "1995-01-01", "2002-01-01")
    parts = sorted((tmp_path / "document").glob("part-*"))
    document = json.loads("".join(p.read_text() for p in parts))
    assert {title: len(found) for title, found in document.items()} == {title: df.count() for title, df in reports.items()}
    assert document["device_performance"] == [json.loads(x) for x in reports["device_performance"].toJSON().collect()]
    etl.load_lookup_marts(spark, out, str(tmp_path / "marts"))
    events = tables.read_table(spark, f"{out}/events")
    some = events.filter("ad_revenue > 0 and campaign_id > 0").first()
    mart = spark.read.parquet(str(tmp_path / "marts" / "campaign_summary"))
    assert rows(tables.read_by_key(mart, {"campaign_id": some["campaign_id"]})) == rows(
        ad_kpis.campaign_summary(events, some["campaign_id"]))


def test_ad_marts(spark, raw, tmp_path):
    out = str(tmp_path)
    etl.load_ad_marts(spark, f"{raw}/campaigns", f"{raw}/users", f"{raw}/events", out)
    events = files.with_ingest_order(files.read_csv(spark, f"{raw}/events"))
    history = spark.read.parquet(f"{out}/user_ad_history")
    assert rows(history) == rows(ad_marts.user_ad_history(events, ["ingest_ord"]))
    assert history.select("user_id", "event_timestamp").distinct().count() == history.count()
    assert spark.read.parquet(f"{out}/top_users_by_clicks").count() == 10
    assert spark.read.parquet(f"{out}/top_advertisers_by_spend").count() == 5
    by_region = spark.read.parquet(f"{out}/top_advertisers_by_region")
    assert by_region.groupBy("region").count().agg(F.max("count")).first()[0] == 5
    assert rows(spark.read.parquet(f"{out}/campaign_daily_performance")) == rows(
        ad_marts.daily_campaign_ctr(events, files.read_csv(spark, f"{raw}/campaigns")))


def test_documents(spark, raw, tmp_path):
    out = str(tmp_path / "docs")
    etl.load_documents(spark, f"{raw}/users", f"{raw}/events", out)
    docs = spark.read.parquet(out)
    known = files.read_csv(spark, f"{raw}/events").filter("UserID is not null").count()
    assert documents.impressions_of(docs).count() == known
    assert docs.count() == files.read_csv(spark, f"{raw}/users").count()


def test_reviews(spark, raw, tmp_path):
    out = str(tmp_path)
    etl.load_reviews(spark, f"{raw}/reviews", out)
    source = files.with_ingest_order(files.read_csv(spark, f"{raw}/reviews"))
    clean = reviews.clean_reviews(source)
    assert rows(spark.read.parquet(f"{out}/reviews_by_customer")) == rows(reviews.reviews_by_customer(clean, ["ingest_ord"]))
    haters = spark.read.parquet(f"{out}/customers_by_period").filter("mart = 'haters'")
    assert rows(haters.select("period", F.col("customer_id"), "review_count")) == rows(reviews.top_haters(clean))
    page = tables.read_by_key(haters, {"period": "1998-03"}, [F.desc("review_count"), F.asc("customer_id")], 3)
    assert rows(page.select("customer_id")) == rows(
        reviews.top_of_period(reviews.top_haters(clean), "customer_id", 3, "1998-03").select("customer_id"))
    assert rows(spark.read.parquet(f"{out}/product_trends")) == rows(reviews.product_trends(reviews.verified_reviews(source)))


def test_copies_by_product_share_one_shuffle(spark, tmp_path):
    """Writes of one key with and without ratings, some without a whole key; the copies are taken as the marked rows lie."""
    raw = spark.range(3000).select(
        F.expr("case when id % 3 > 0 then concat('p', id % 7) end").alias("product_id"),
        F.expr("case when id % 11 = 0 then '2024-13-99' when id % 13 > 0 then concat('2024-01-1', id % 4) end").alias("review_date"),
        F.expr("case when id % 17 > 0 then concat('r', id % 5) end").alias("review_id"), F.expr("concat('c', id % 23)").alias("customer_id"),
        F.expr("case when id % 6 = 0 then 'none' when id % 6 = 1 then '5.0' else cast(id % 6 as string) end").alias("star_rating"),
        F.expr("concat('head ', id)").alias("review_headline"), F.expr("concat('body ', id)").alias("review_body"),
        F.lit("Y").alias("verified_purchase"), F.expr("id * 7919 % 3001").alias("ingest_ord"))
    marked = reviews.mark_last_writes(raw, "ingest_ord")
    assert plan_of(marked).count("Exchange") == 1 and plan_of(marked).count("Sort ") == 1
    tables.write_table(marked, str(tmp_path / "staged"))
    staged = tables.read_table(spark, str(tmp_path / "staged"))
    assert rows(staged.select(*raw.columns)) == rows(raw)
    clean, plain = reviews.clean_reviews(staged), reviews.clean_reviews(raw)
    for copy in (reviews.reviews_by_product, reviews.reviews_by_product_rating, reviews.reviews_by_customer):
        assert rows(copy(clean, ["ingest_ord"], ranged=True)) == rows(copy(plain, ["ingest_ord"])) != []
    for copy, by in ((reviews.reviews_by_product, ["product_id"]), (reviews.reviews_by_product_rating, ["product_id", "star_rating"])):
        stored = tables.cluster_for_reads(copy(clean, ["ingest_ord"], ranged=True), by, [F.desc("review_date"), F.asc("review_id")], ranged=True)
        assert "Exchange" not in plan_of(stored)
    alone = raw.withColumn("product_id", F.lit(None).cast("string")).withColumn("review_date", F.lit(None).cast("string")).withColumn("review_id", F.lit(None).cast("string"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [len(part) for part in reviews.mark_last_writes(alone, "ingest_ord").rdd.glom().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 3000 and max(sizes) < 1500  # not all in one task


def test_load_gives_up_the_shuffle_files_of_each_write(spark, tmp_path):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    kept = lambda: set(re.findall(r"shuffle_\d+", spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
                                  .getAllFiles().mkString(" ")))
    before, old = kept(), spark.conf.get(name, None)
    with session.shuffles_released(spark):
        tables.write_keyed(spark.range(100).selectExpr("id % 3 as k", "id"), str(tmp_path / "t"), ["k"], [F.asc("id")])
    assert spark.conf.get(name, None) == old
    for _ in range(50):  # they are removed in the background
        if not kept() - before:
            break
        time.sleep(0.1)
    assert not kept() - before
    assert tables.read_table(spark, str(tmp_path / "t")).count() == 100


def test_rows_sorted_as_they_are_read_come_in_small_parts(spark, tmp_path):
    name = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(name)
    tables.write_table(spark.range(400_000).selectExpr("id", "uuid() as text").coalesce(1), str(tmp_path / "staged"),
                       **{"parquet.block.size": str(1 << 20)})
    parts = lambda: tables.read_table(spark, str(tmp_path / "staged")).rdd.glom().map(len).collect()
    with session.scans_of(spark, 2 << 20):
        assert max(parts()) < 150_000 and sum(parts()) == 400_000
        with session.scans_of(spark, 1 << 40):
            assert spark.conf.get(name) == str(2 << 20)  # none is made larger
    assert spark.conf.get(name) == old


def test_load_of_reviews_sorts_small_parts(spark, raw, tmp_path, monkeypatch):
    seen, name = {}, "spark.sql.files.maxPartitionBytes"
    write = etl.write_keyed
    monkeypatch.setattr(etl, "write_keyed", lambda df, path, *a, **b: (seen.update({path.rsplit("/", 1)[1]: session.in_bytes(spark.conf.get(name))}), write(df, path, *a, **b)))
    etl.load_reviews(spark, f"{raw}/reviews", str(tmp_path))
    assert max(seen["reviews_by_product"], seen["reviews_by_product_rating"]) <= 32 << 20
