import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from adloom import session
from adloom.plans import sample_tables as t
from adloom.registry import QUERIES
from adloom.sources.messages import read_messages, to_messages
from adloom.plans import live_marts
from adloom.sources import folders, tables
from adloom.streaming import keyed_sink, states, tiers, tweets, wiki
from adloom.streaming.run import drain, start
from adloom.operators.ranking import latest_per_key
from conftest import plan_of, rows


def post(folder, name, *messages):
    """One file of JSON lines; a text is written as it is."""
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.writelines((m if isinstance(m, str) else json.dumps(m)) + "\n" for m in messages)


def change(domain="en.wikipedia.org", bot=False, user="ann", at="2024-05-01T10:00:00Z", title="Page"):
    return {"meta": {"domain": domain, "dt": at}, "performer": {"user_text": user, "user_is_bot": bot},
            "page_title": title, "extra": 1}


@pytest.fixture
def box(tmp_path):
    return lambda name: str(tmp_path / name)


def text_stream(spark, path):
    return read_messages(spark, "text", path)


def test_filter_keeps_known_human_edits(spark, box):
    post(box("in"), "a.json", change(), change(bot=True), change(domain="de.wikipedia.org"),
         change(bot=None), change(bot="false"), {"page_title": "x"}, '{"meta": {"domain": "en.wiki', "not json")
    drain(wiki.filter_job(text_stream(spark, box("in")), box("c"), "text", box("out")))
    drain(wiki.dead_letter_job(text_stream(spark, box("in")), box("c2"), "text", box("dead")))
    kept = [json.loads(r[0]) for r in spark.read.text(box("out")).collect()]
    # A bot flag that is missing or text is unknown, and unknown is not human.
    assert kept == [{"user_id": "ann", "domain": "en.wikipedia.org", "created_at": "2024-05-01T10:00:00Z",
                     "page_title": "Page", "user_is_bot": False}]
    # Neither filter nor table can judge these two, nor the three that are broken or lack the site.
    assert spark.read.text(box("dead")).count() == 5


def test_stream_equals_batch(spark, tiny, box):
    source = t.wiki_changes(t.table(spark, tiny, "events"))
    source.write.text(box("in"))
    drain(wiki.filter_job(text_stream(spark, box("in")), box("c"), "text", box("out")))
    batch = to_messages(wiki.human_edits(wiki.parse_changes(source)))
    assert rows(spark.read.text(box("out"))) == rows(batch)


def pages(*entries):
    return [{"domain": d, "created_at": at, "page_title": p, "user_id": u, "user_is_bot": False} for d, at, p, u in entries]


def test_table_upserts_over_batches_and_restarts(spark, box):
    at = "2024-05-01T10:00:00.250Z"
    post(box("in"), "a.json", *pages(("en", at, "P", "ann"), ("en", at, "P", "bob"), ("en", at, "Q", "ann"),
                                     (None, at, "R", "x"), ("en", "soon", "R", "x"), ("en", at, None, "x")), "broken")
    job = lambda: wiki.table_job(text_stream(spark, box("in")), box("table"), box("c"))
    drain(job())
    table = lambda: rows(wiki.read_pages(spark, box("table")).select("domain", "page_title", "user_id"))
    assert table() == [("en", "P", "bob"), ("en", "Q", "ann")]
    # A later batch wins even when its value sorts first; the job resumes at its checkpoint.
    post(box("in"), "b.json", *pages(("en", at, "P", "aaa"), ("www", at, "P", "zoe")))
    drain(job())
    assert table() == [("en", "P", "aaa"), ("en", "Q", "ann"), ("www", "P", "zoe")]
    assert sorted(p for p in os.listdir(box("table")) if p.startswith("batch_id")) == ["batch_id=0", "batch_id=1"]
    drain(job())
    assert len(table()) == 3


def test_replayed_batch_changes_nothing(spark, box):
    batch = spark.createDataFrame([("en", "2024-05-01 10:00:00", "P", "ann")], "domain string, created_at string, page_title string, user_id string")
    batch = batch.withColumn("created_at", F.col("created_at").cast("timestamp"))
    write = keyed_sink.append_batches(box("t"), wiki.PAGE_KEY, ["user_id"], ["domain"], [F.desc("created_at")])
    write(batch, 0)
    write(batch, 0)
    assert spark.read.parquet(box("t")).count() == 1


def test_compaction_keeps_the_last_write(spark, box):
    at = "2024-05-01T10:00:00Z"
    for i, user in enumerate(("ann", "bob", "abe")):
        post(box("in"), f"{i}.json", *pages(("en", at, "P", user)))
        drain(wiki.table_job(text_stream(spark, box("in")), box("table"), box("c")))
    fold = lambda: keyed_sink.compact(spark, box("table"), wiki.PAGE_SCHEMA, wiki.PAGE_KEY, ["user_id"],
                                      ["domain"], [F.desc("created_at"), F.asc("page_title")])
    assert fold() == 2 and fold() == 2
    assert [r["user_id"] for r in spark.read.parquet(f"{box('table')}-base-2").collect()] == ["abe"]
    assert [r["user_id"] for r in wiki.read_pages(spark, box("table")).collect()] == ["abe"]
    # Later batches are read on top of the base, and folded into the next one.
    post(box("in"), "9.json", *pages(("en", at, "P", "aaa"), ("en", at, "Q", "bob")))
    drain(wiki.table_job(text_stream(spark, box("in")), box("table"), box("c")))
    now = [("P", "aaa"), ("Q", "bob")]
    assert sorted((r["page_title"], r["user_id"]) for r in wiki.read_pages(spark, box("table")).collect()) == now
    assert fold() == 3
    assert sorted((r["page_title"], r["user_id"]) for r in wiki.read_pages(spark, box("table")).collect()) == now


def tweet(at, text="hi", author="1", **more):
    return {"author_id": author, "text": text, "created_at": at} | more


def minutes_of(spark, path):
    return rows(tweets.read_minutes(spark, path).select("time_key", "created_at", "text", "author_id"))


def test_minutes_by_event_time_with_late_and_unknown(spark, box):
    post(box("in"), "a.json", tweet("2022-05-03T17:08:45.123456", lang="en"), tweet("2022-05-03 17:08:01", 'a "b",\nc'),
         tweet("2022-05-03T17:09:00+02:00"), tweet("yesterday"), tweet("2022"), {"text": "no author"}, "broken {")
    job = lambda: tweets.minute_job(text_stream(spark, box("in")), box("out"), box("c"))
    drain(job())
    first = minutes_of(spark, box("out"))
    assert first == sorted([
        ("03_05_2022_17_08", "2022-05-03T17:08:45.123456", "hi", "1"),
        ("03_05_2022_17_08", "2022-05-03 17:08:01", 'a "b",\nc', "1"),
        ("03_05_2022_17_09", "2022-05-03T17:09:00+02:00", "hi", "1"),
        ("unknown_time", "yesterday", "hi", "1"), ("unknown_time", "2022", "hi", "1"),
        ("unknown_time", "", "no author", "")], key=repr)
    before = {p: os.path.getmtime(os.path.join(d, p)) for d, _, fs in os.walk(box("out")) for p in fs}
    # A late row lands in its old minute; files written before are left alone.
    post(box("in"), "b.json", tweet("2022-05-03T17:08:59", "late"))
    drain(job())
    assert len(minutes_of(spark, box("out"))) == 7
    late = [r for r in minutes_of(spark, box("out")) if r[2] == "late"]
    assert late[0][0] == "03_05_2022_17_08"
    after = {p: os.path.getmtime(os.path.join(d, p)) for d, _, fs in os.walk(box("out")) for p in fs}
    assert before.items() <= after.items()
    tweets.compact_minutes(spark, box("out"), box("compact"))
    assert "time_key=unknown_time" in os.listdir(box("compact"))
    assert spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(box("compact")).count() == 7


def test_dead_tweets(spark):
    df = spark.createDataFrame([('{"text": "x"}',), ("broken {",), ("",)], "value string")
    assert {r[0] for r in tweets.unreadable(df).collect()} >= {"broken {"}
    assert tweets.minute_rows(df).filter("text = 'x'").count() == 1


def test_minute_replay_of_one_batch(spark, box):
    batch = tweets.minute_rows(spark.createDataFrame([(json.dumps(tweet("2022-05-03T17:08:45")),)], "value string"))
    write = tweets.append_minutes(box("o"))
    write(batch, 4)
    write(batch, 4)
    assert len(minutes_of(spark, box("o"))) == 1


def test_replay_defaults_and_rate(spark, box):
    for i in range(3):
        os.makedirs(box("csv"), exist_ok=True)
        with open(os.path.join(box("csv"), f"{i}.csv"), "w") as f:
            f.write("text\nhello\n")
    rows_in = tweets.follow_csv(spark, box("csv"), max_files=1, columns=("text",))
    query = drain(tweets.replay_job(rows_in, box("c"), "text", box("topic")))
    # One file per trigger: the cap on admission.
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [1, 1, 1]
    sent = [json.loads(r[0]) for r in spark.read.text(box("topic")).collect()]
    assert {(s["author_id"], s["text"]) for s in sent} == {("unknown", "hello")}
    assert all(s["created_at"][10] == "T" for s in sent)
    named = tweets.replay_payload(spark.createDataFrame([("7", None)], "author_id string, text string")).first()
    assert (named["author_id"], named["text"]) == ("7", None)


def test_interval_trigger_flushes_and_stops(spark, box):
    post(box("in"), "a.json", tweet("2022-05-03T17:08:45"))
    query = start(tweets.minute_job(text_stream(spark, box("in")), box("out"), box("c")), every="1 second")
    query.processAllAvailable()
    query.stop()
    assert len(minutes_of(spark, box("out"))) == 1


def test_registered_streams_read_a_table_in_many_files(spark, tiny, box):
    for name in ("events", "conversations"):
        t.table(spark, tiny, name).repartition(3).write.parquet(box(f"{name}.parquet"))
    root = os.path.dirname(box("x"))
    for query in ("wiki_filter", "wiki_dead_letters", "tweet_minutes", "csv_replay"):
        assert rows(QUERIES[query](spark, root)) == rows(QUERIES[query](spark, tiny))


def test_kafka_is_a_format_parameter(spark):
    with pytest.raises(Exception, match="kafka"):
        read_messages(spark, "kafka", subscribe="input", **{"kafka.bootstrap.servers": "nowhere:9092"})


SCHEMA = "k long, v long"


def _load(spark, path, batch_id, pairs):
    write = keyed_sink.append_batches(path, ["k"], ["v"], ["k"], [])
    write(spark.createDataFrame(pairs, SCHEMA), batch_id)


def _now(spark, path):
    return dict(tuple(r) for r in keyed_sink.read_upserted(spark, path, SCHEMA, ["k"], ["v"]).collect())


def _fold(spark, path, fanout=3):
    return keyed_sink.compact(spark, path, SCHEMA, ["k"], ["v"], ["k"], [], fanout)


def test_folds_rewrite_what_arrived_and_retire_what_they_replaced(spark, box):
    """A large first load, then many small ones with colliding keys; a fold after each."""
    path, expected, written = box("table"), {}, []
    for batch in range(12):
        pairs = [(k, batch) for k in (range(5000) if batch == 0 else range(batch * 7, batch * 7 + 20))]
        _load(spark, path, batch, pairs)
        expected |= dict(pairs)
        assert _now(spark, path) == expected  # runs and a batch after them
        assert _fold(spark, path) == batch
        assert _now(spark, path) == expected  # runs alone
        written.append(spark.read.parquet(f"{path}-base-{batch}").count())
    # Levels of up to two runs: 1, 1, then three become one of the next level. The large load is rewritten
    # with the third and the ninth fold only.
    assert [k for k, n in enumerate(written) if n >= 5000] == [0, 2, 8]
    assert sum(n for n in written if n < 5000) < 12 * 20 * 3
    runs = tiers.manifest(spark, path).runs
    assert [(r.first, r.last) for r in sorted(runs, key=lambda r: r.first)] == [(0, 8), (9, 11)]
    # What the last two manifests do not name is gone: runs, batches and older manifests.
    kept = [n for n in os.listdir(os.path.dirname(path)) if "-base-" in n]
    assert sorted(kept) == ["table-base-10", "table-base-11", "table-base-8", "table-base-9"]
    assert [n for n in os.listdir(path) if n.startswith("batch_id")] == ["batch_id=11"]
    assert sorted(os.listdir(f"{path}-folds")) == ["11", "12"]
    assert _fold(spark, path) == 11 and _now(spark, path) == expected


def test_a_fold_that_failed_is_repeated(spark, box):
    path = box("table")
    _load(spark, path, 0, [(1, 1), (2, 2)])
    _fold(spark, path)
    _load(spark, path, 1, [(2, 5)])
    folders.remove(spark, f"{path}/batch_id=7")  # nothing there, nothing happens
    # A run written without its manifest, and a batch folder without its end mark, count for nothing.
    spark.createDataFrame([(9, 9)], SCHEMA).write.parquet(f"{path}-base-1")
    assert _now(spark, path) == {1: 1, 2: 5}
    assert _fold(spark, path) == 1
    assert _now(spark, path) == {1: 1, 2: 5}
    # Batch 1 comes once more after its fold, as a stream that was stopped may send it.
    _load(spark, path, 1, [(2, 5)])
    assert _now(spark, path) == {1: 1, 2: 5} and _fold(spark, path) == 1


def test_states_add_up_and_replays_count_once(spark, tiny, box):
    sums = live_marts.campaign_sums()
    events = t.ad_events(spark, tiny, "event_id", "campaign_id", "ad_cost", "ad_revenue").withColumn("third", F.abs(F.hash("event_id")) % 3)
    write = states.append_states(box("states"), sums)
    whole = rows(live_marts.campaign_summary(sums.of(events)))
    for batch in range(3):
        for _ in range(2):  # each is run twice
            write(events.where(F.col("third") == batch), batch)
        if batch:
            assert states.fold_states(spark, box("states"), sums) == batch
    assert rows(live_marts.campaign_summary(states.read_states(spark, box("states"), sums))) == whole
    write(events.where("third = 1"), 1)  # and once more after it was folded
    assert rows(live_marts.campaign_summary(states.read_states(spark, box("states"), sums))) == whole
    total = states.read_states(spark, box("states"), sums, keys=[]).first()
    assert total.impressions == events.count()
    # A state of a batch is one row per key, whatever the batch holds.
    assert spark.read.parquet(f"{box('states')}/batch_id=1").groupBy("campaign_id").count().where("count > 1").count() == 0


def test_minutes_are_read_over_folds_and_later_batches(spark, box):
    job = lambda: tweets.minute_job(text_stream(spark, box("in")), box("out"), box("c"))
    expected = []
    for k in range(5):
        post(box("in"), f"{k}.json", tweet("2022-05-03T17:08:45", f"t{k}"), tweet("2022-05-03T17:09:45", f'late "{k}",\n'), tweet("some day", "", ""))
        expected += [("03_05_2022_17_08", "2022-05-03T17:08:45", f"t{k}", "1"), ("03_05_2022_17_09", "2022-05-03T17:09:45", f'late "{k}",\n', "1"),
                     ("unknown_time", "some day", "", "")]
        drain(job())
        assert minutes_of(spark, box("out")) == sorted(expected, key=repr)
        if k % 2:
            assert tweets.fold_minutes(spark, box("out"), fanout=2) == k
            assert minutes_of(spark, box("out")) == sorted(expected, key=repr)
    assert [r.last for r in tiers.manifest(spark, box("out")).runs] == [3]
    found = [f for _, _, fs in os.walk(f"{box('out')}-base-3") for f in fs if f.endswith(".csv")]
    assert len(found) <= 6  # three minutes, few files each


def test_ad_event_stream_is_read_in_as_many_parts_as_the_scan(spark, tiny, tmp_path, monkeypatch):
    lines = t.table(spark, tiny, "lineitem")
    lines.repartition(6).write.parquet(str(tmp_path / "in" / "lineitem.parquet"))
    monkeypatch.setattr(session, "scratch_dir", lambda spark, label: str(tmp_path / label))
    assert rows(QUERIES["campaign_state"](spark, str(tmp_path / "in"))) == rows(live_marts.campaign_summary(
        live_marts.campaign_sums().of(t.ad_events(spark, tiny))))
    base = tmp_path / "campaign-state"
    assert len(list((base / "events").glob("part-*"))) > 6
    assert (base / "states-base-1").exists() and {p.name for p in (base / "states").glob("batch_id=*")} == {"batch_id=0", "batch_id=1", "batch_id=2"}


def test_keyed_batches_by_ranges_are_shuffled_once(spark, tmp_path):
    path, schema, key = str(tmp_path / "t"), "k string, d int, v int", ["k", "d"]
    batches = [[(f"p{n % 3}", n % 40, n) for n in range(200)], [(f"p{n % 3}", n % 30, -n) for n in range(90)], [("p9", 1, 1)]]
    layout, found = (["k"], [F.desc("d")]), {}
    write = keyed_sink.append_batches(path, key, ["v"], *layout, ranged=True)
    for b, batch in enumerate(batches):
        df = spark.createDataFrame(batch, schema)
        assert plan_of(tables.cluster_for_reads(latest_per_key(df, key, ["v"], ranged=True), *layout, ranged=True)).count("Exchange") == 1
        write(df, b)
        for row in {(k, d): max(v for x, y, v in batch if (x, y) == (k, d)) for k, d, _ in batch}.items():
            found[row[0]] = row[1]
        now = keyed_sink.read_upserted(spark, path, schema, key, ["v"], ranged=True)
        if b == 0:
            before, then = now, dict(found)
        if b == 1:
            keyed_sink.compact(spark, path, schema, key, ["v"], *layout, ranged=True)
            now = keyed_sink.read_upserted(spark, path, schema, key, ["v"])
            assert "Exchange" not in plan_of(now)  # all in one run
            assert rows(before) == rows(spark.createDataFrame([(*k, v) for k, v in then.items()], schema))
        assert rows(now) == rows(spark.createDataFrame([(*k, v) for k, v in found.items()], schema))


def test_keyed_batches_in_buckets_are_read_and_folded_without_a_shuffle(spark, tmp_path):
    """One product holds half of the rows. A batch comes twice, the second time with other rows; three folds."""
    path, schema, key = str(tmp_path / "o'clock"), "k string, d int, v int", ["k", "d"]
    batches = [[("hot" if n % 2 else f"p{n % 7}", n % 60, n) for n in range(400)], [("hot", n % 45, -n) for n in range(90)],
               [(None, 1, 1), ("hot", None, 2), ("hot", 3, 7)], [("p9", n, n) for n in range(50)], [("hot", n, 5) for n in range(9)]]
    layout, found = (["k"], [F.desc("d")]), {}
    write = keyed_sink.append_batches(path, key, ["v"], *layout, buckets=5)
    read = lambda: keyed_sink.read_upserted(spark, path, schema, key, ["v"])
    fold = lambda: keyed_sink.compact(spark, path, schema, key, ["v"], *layout, fanout=2)
    entries = lambda: [r.tableName for r in spark.sql("SHOW TABLES LIKE 'adloom_keyed_*'").collect()]
    old = set(entries())
    write(spark.createDataFrame([("gone", 1, 1)], schema), 0)
    for b, batch in enumerate(batches):
        df = spark.createDataFrame(batch, schema)
        write(df, b)
        for k, d in {(k, d) for k, d, _ in batch}:
            found[k, d] = max(v for x, y, v in batch if (x, y) == (k, d))
        now, then = read(), spark.createDataFrame([(*k, v) for k, v in found.items()], schema)
        assert "Exchange" not in plan_of(now) and rows(now) == rows(then)
        if b in (1, 3, 4):
            assert fold() == b
            assert rows(now) == rows(then) == rows(read())  # a frame outlives one fold
        if b == 3:  # all runs have come together
            held = [rows(spark.read.parquet(str(f))) for f in (tmp_path / "o'clock-base-3").glob("part-*")]
            assert sum(len(h) for h in held) == len(found) and len(held) == 5
            assert all(sum(k == "hot" for k, *_ in h) < len([k for k, _ in found if k == "hot"]) / 2 for h in held)  # not all in one bucket
    assert {e.split("_")[2] for e in set(entries()) - old} <= {hashlib.md5(path.encode()).hexdigest()}
    assert {int(e.split("_")[3]) for e in set(entries()) - old} == {2, 3}  # entries go with the files they lead to
    with pytest.raises(ValueError, match="has 5 buckets"):
        keyed_sink.append_batches(path, key, ["v"], *layout, buckets=6)(spark.createDataFrame(batches[0], schema), 9)
    later = spark.createDataFrame([("p9", 1, 70)], schema)
    keyed_sink.append_batches(path, key, ["v"], *layout)(later, 5)  # the table knows its buckets
    assert "Exchange" not in plan_of(read()) and ("p9", 1, 70) in rows(read())
    keyed_sink.append_batches(str(tmp_path / "plain"), key, ["v"], *layout)(later, 0)
    with pytest.raises(ValueError, match="without buckets"):
        keyed_sink.append_batches(str(tmp_path / "plain"), key, ["v"], *layout, buckets=5)(later, 1)


def test_review_upsert_reads_its_stages_as_they_lie(spark, tiny):
    found = QUERIES["review_upsert"](spark, tiny)
    assert "Exchange" not in plan_of(found) and found.groupBy("stage").count().count() == 3
