import datetime as dt

import pytest
from pyspark.sql import functions as F

from adloom import schemas
from adloom.plans import documents
from adloom.plans import sample_tables as t
from conftest import rows

USERS = schemas.text_schema("UserID", "Age", "Gender", "Location", "Interests", "SignupDate")


def events(spark, data):
    """(ordinal, user, time, campaign, category, flag, click time, revenue)"""
    return spark.createDataFrame(
        [(o, f"e{o}", u, ts, c, "Advertiser_5", cat, f, ct, r) for o, u, ts, c, cat, f, ct, r in data],
        "ingest_ord long, EventID string, UserID string, Timestamp string, CampaignName string, AdvertiserName string,"
        " CampaignTargetingInterest string, WasClicked string, ClickTimestamp string, AdRevenue string")


# The four impressions of the published example document.
SHOWN = [("2024-10-08T12:24:18", "Campaign_565", " Finance"), ("2024-11-03T17:28:31", "Campaign_582", " Education"),
         ("2024-12-01T08:26:59", "Campaign_783", " Technology"), ("2024-10-30T21:31:25", "Campaign_370", " Finance")]


@pytest.fixture(scope="module")
def user_23(spark):
    users = spark.createDataFrame([("23", "49", "Male", "Australia", "Fashion,Travel", "2022-08-31"),
                                   ("24", None, None, None, None, None)], USERS)
    seen = events(spark, [(i, "23", ts, c, cat, "False", None, None) for i, (ts, c, cat) in enumerate(SHOWN)])
    return documents.user_documents(users, documents.impressions(seen))


def test_document_shape(user_23):
    doc = documents.user_history(user_23, 23).first().asDict(recursive=True)
    assert doc["demographics"] == {"age": 49, "gender": "Male", "location": "Australia", "signup_date": "2022-08-31"}
    assert doc["interests"] == ["Fashion", "Travel"]
    assert [(i["timestamp"], i["campaign_name"], i["ad_category"]) for i in doc["impressions"]] == SHOWN
    assert all(i["clicks"] == [] and i["device_location"] is None for i in doc["impressions"])
    other = documents.user_history(user_23, 24).first()
    assert other["interests"] == [] and other["impressions"] == []
    assert documents.user_history(user_23, 99).count() == 0


def test_last_sessions_keep_ingest_order(user_23):
    # December comes before October: the order is that of arrival.
    last = documents.last_sessions(user_23, 5, user_id=23).first()
    assert [(i["timestamp"], i["campaign_name"], i["ad_category"]) for i in last["last_sessions"]] == SHOWN
    two = documents.last_sessions(user_23, 2, user_id=23).first()
    assert [i["campaign_name"] for i in two["last_sessions"]] == ["Campaign_783", "Campaign_370"]
    assert documents.last_sessions(user_23, 5, user_id=24).first()["last_sessions"] == []


def test_clicks_follow_the_word_dialect(spark):
    data = [(i, "1", "2024-01-01T00:00:00", "C", "x", f, "2024-01-01T00:01:00", r) for i, (f, r) in enumerate(
        [("True", "1.5"), (" TRUE ", None), ("true", "bad"), ("1", "2"), ("False", "2"), (None, None)])]
    got = documents.impressions(events(spark, data)).orderBy("ingest_ord").select("clicks").collect()
    assert [[c["ad_revenue"] for c in r["clicks"]] for r in got] == [[1.5], [0.0], [0.0], [], [], []]


def test_hourly_clicks_use_closed_range_and_click_hour(spark):
    start, end = "2024-10-31T00:00:00", "2024-11-01T00:00:00"
    data = [
        (0, "1", start, "C1", "x", "True", "2024-10-31T00:10:00", "1"),
        (1, "1", end, "C1", "x", "True", "2024-11-01T00:05:00", "1"),          # upper end counts
        (2, "1", "2024-10-31T23:59:00", "C2", "x", "True", "2024-11-01T00:01:00", "1"),  # clicked after midnight
        (3, "1", "2024-11-01T00:00:01", "C1", "x", "True", "2024-11-01T05:00:00", "1"),  # shown too late
        (4, "1", "2024-10-31T07:00:00", "C1", "x", "False", None, None),
    ]
    got = documents.hourly_campaign_clicks(documents.impressions(events(spark, data)), start, end, "Advertiser_5")
    assert rows(got.select("campaign", "hour", "total_clicks")) == [("C1", 0, 2), ("C2", 0, 1)]
    assert documents.hourly_campaign_clicks(documents.impressions(events(spark, data)), start, end, "nobody").count() == 0


def test_fatigue_threshold_is_a_parameter(spark):
    data, n = [], 0
    for user, shown, clicked in (("1", 4, False), ("2", 5, False), ("3", 6, True)):
        for i in range(shown):
            data.append((n, user, "2024-01-01T00:00:00", "C", "x", str(clicked and i == 0), None, None))
            n += 1
    seen = documents.impressions(events(spark, data))
    assert rows(documents.ad_fatigue(seen)) == [(2, "C", 5)]
    assert rows(documents.ad_fatigue(seen, at_least=4)) == [(1, "C", 4), (2, "C", 5)]


def test_top_categories_count_clicked_impressions(spark):
    cats = [" a", " b", " b", " c", " d", " d", " d"]
    data = [(i, "1", "2024-01-01T00:00:00", "C", c, "True", None, "1") for i, c in enumerate(cats)]
    data += [(20 + i, "1", "2024-01-01T00:00:00", "C", " a", "False", None, None) for i in range(9)]
    seen = documents.impressions(events(spark, data))
    assert [tuple(r) for r in documents.top_categories(seen, user_id=1).collect()] == [(1, " d", 3), (1, " b", 2), (1, " a", 1)]
    assert rows(documents.top_categories(seen)) == sorted([(1, " d", 3), (1, " b", 2), (1, " a", 1)], key=repr)


def test_split_documents_answer_like_whole_ones(spark, tiny, tmp_path):
    """Stored documents, cut into small pieces, against the impressions they hold."""
    seen = documents.impressions(t.document_events(spark, tiny))
    users = t.raw_users(spark, tiny)
    path = str(tmp_path / "docs")
    documents.user_documents(users, seen, page_size=4).write.parquet(path)
    docs = spark.read.parquet(path)
    assert docs.groupBy("_id").count().filter("count > 1").count() > 0
    assert docs.filter(F.size("impressions") > 4).count() == 0
    flat = documents.impressions_of(docs)
    assert rows(documents.ad_fatigue(flat, 2)) == rows(documents.ad_fatigue(seen, 2))
    assert rows(documents.top_categories(flat)) == rows(documents.top_categories(seen))
    window = ("2024-01-02T00:00:00", "2024-01-20T00:00:00")
    assert rows(documents.hourly_campaign_clicks(flat, *window)) == rows(documents.hourly_campaign_clicks(seen, *window))
    whole = documents.user_documents(users, seen)
    order = F.transform("last_sessions", lambda e: e["event_id"])
    assert rows(documents.last_sessions(docs).select("_id", order)) == rows(documents.last_sessions(whole).select("_id", order))
    assert documents.last_sessions(docs).count() == users.count()


def test_proxy_click_times(spark, tiny):
    row = t.document_events(spark, tiny).filter("WasClicked = 'True'").first()
    shown, clicked = dt.datetime.fromisoformat(row["Timestamp"]), dt.datetime.fromisoformat(row["ClickTimestamp"])
    assert 0 <= (clicked - shown).total_seconds() < 6000
