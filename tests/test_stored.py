"""Stored forms: JSON documents, lookups off the sort order, buckets, growing profiles, paced replay."""

import json
import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from adloom.operators import profile
from adloom.sources import json_documents, tables
from adloom.streaming import tweets
from conftest import plan_of, rows

RECORDS = "id long, name string, nested array<struct<a: int, b: string>>, d double"


def text_of(path):
    parts = sorted(p for p in os.listdir(path) if p.startswith("part-"))
    return "".join((path / p).read_text(encoding="utf-8") for p in parts)


def records(spark, n):
    data = [(k, f'né "{k}",\n}}', [(k, "x"), (None, None)] if k % 3 else [], k / 4 if k % 5 else None) for k in range(n)]
    as_json = [{"id": i, "name": s, "nested": [{"a": a, "b": b} for a, b in v], "d": d} for i, s, v, d in data]
    return spark.createDataFrame(data, RECORDS).repartition(5).orderBy(F.desc("id")), as_json[::-1]


def test_json_lines_are_made_in_chunks():
    record = json.dumps({"a": ["x" * 100] * 10})
    batch = pa.RecordBatch.from_pydict({"part": [0] * 50, "at": list(range(50)), "record": [record] * 50, "comma": [k < 49 for k in range(50)]})
    found = list(json_documents._indented(iter([batch, batch.slice(0, 0)]), 4, 1, 3000))
    assert max(b.num_rows for b in found) == 3 and sum(b.num_rows for b in found) == 50
    assert [x for b in found for x in b.column(1).to_pylist()] == list(range(50))
    text = "\n".join(x for b in found for x in b.column(2).to_pylist())
    assert f"[\n{text}\n]" == json.dumps([json.loads(record)] * 50, indent=4)


@pytest.mark.parametrize("n", [0, 1, 60])
def test_json_list_is_what_dumps_gives(spark, tmp_path, n):
    df, expected = records(spark, n)
    json_documents.write_json_list(df, str(tmp_path / "doc"))
    assert text_of(tmp_path / "doc") == json.dumps(expected, indent=4, ensure_ascii=False) + "\n"
    back = json_documents.read_json_list(spark, str(tmp_path / "doc"), df.schema)
    assert rows(back) == rows(df)


def test_json_lists_by_title(spark, tmp_path):
    df, expected = records(spark, 7)
    json_documents.write_json_lists({"Top \"7\"": df, "none": df.limit(0), "one": df.limit(1)}, str(tmp_path / "doc"), indent=2)
    whole = {"Top \"7\"": expected, "none": [], "one": expected[:1]}
    assert text_of(tmp_path / "doc") == json.dumps(whole, indent=2, ensure_ascii=False) + "\n"
    json_documents.write_json_lists({"none": df.limit(0)}, str(tmp_path / "empty"))
    assert json.loads(text_of(tmp_path / "empty")) == {"none": []}


def scanned(df):
    """Rows that leave the file scan."""
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(k).metrics().apply("numOutputRows").value() for k in range(leaves.size()))


def test_lookup_passes_over_files_without_the_value(spark, tmp_path):
    """Ids are spread over all files, so that least and greatest values tell nothing."""
    n, files = 20_000, 8
    df = spark.range(n).select(F.md5(F.col("id").cast("string")).alias("review_id"), (F.col("id") % files).alias("product"), "id")
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.write_keyed(df, path, ["product"], [F.asc("id")], lookups=["review_id"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    stored = spark.read.parquet(path)
    parts = stored.select(F.input_file_name()).distinct().count()
    assert parts > 2
    wanted = df.where("id = 77").first().review_id
    one = tables.lookup(stored, "review_id", [wanted, wanted, None])
    assert [r.id for r in one.collect()] == [77]
    assert 0 < scanned(one) <= n // parts * 2 < n
    assert tables.lookup(stored, "review_id", []).collect() == []
    keys = df.where("id % 5000 = 77").select("review_id").unionAll(df.where("id = 77").select("review_id"))
    assert sorted(r.id for r in tables.lookup_batch(stored, keys, "review_id").collect()) == [77, 5077, 10077, 15077]
    many = df.where("id % 10 = 0").select("review_id")
    assert tables.lookup_batch(stored, many, "review_id").count() == n // 10
    with pytest.raises(ValueError, match="lookup_batch"):
        tables.lookup(stored, "review_id", [str(k) for k in range(100)])


def test_bucketed_tables_join_and_group_without_a_shuffle(spark, tmp_path):
    left = spark.range(1000).select((F.col("id") % 50).alias("k"), "id")
    right = spark.range(50).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables.write_bucketed(left, "bucketed_left", str(tmp_path / "l"), ["k"], 4)
        tables.write_bucketed(right, "bucketed_right", str(tmp_path / "r"), ["k"], 4)
        joined = spark.table("bucketed_left").join(spark.table("bucketed_right"), "k")
        assert rows(joined.select("id", "name")) == sorted(((i, f"n{i % 50}") for i in range(1000)), key=repr)
        plan = plan_of(joined)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert "Exchange" not in plan_of(joined.groupBy("k").count())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP TABLE IF EXISTS bucketed_left")
        spark.sql("DROP TABLE IF EXISTS bucketed_right")


def test_profile_of_loads_reads_sketches_alone(spark, tmp_path):
    df = spark.range(30_000).select("id", (F.col("id") % 700).cast("string").alias("few"), F.lit(None).cast("date").alias("none"),
                                    F.when(F.col("id") % 3 > 0, F.col("id") / 7).alias("real"))
    path = str(tmp_path / "p")
    for load in range(3):
        for _ in range(2 if load == 1 else 1):  # one load comes twice
            profile.store_sketches(df.where(F.col("id") % 3 == load), path, load)
    found = {r.column_name: r for r in profile.profile_of_loads(spark, path).collect()}
    exact = {r.column_name: r for r in profile.column_profile(df).collect()}
    assert {n: (r.data_type, r.filled, r.empty) for n, r in found.items()} == {n: (r.data_type, r.filled, r.empty) for n, r in exact.items()}
    assert (exact["none"].filled, exact["none"].empty, exact["few"].distinct_values) == (0, 30_000, 700)
    assert all(abs(found[n].distinct_values - exact[n].distinct_values) <= 0.03 * exact[n].distinct_values for n in exact)
    assert spark.read.parquet(path).count() == 3 * 4  # all that a later profile reads
    none = profile.column_profile(df.limit(0))
    assert {(r.filled, r.empty, r.distinct_values) for r in none.collect()} == {(0, 0, 0)}


def test_paced_replay_keeps_order_and_rate(spark, tmp_path):
    n, rate, seconds = 101, 12, 3
    df = spark.range(n).select((F.col("id") * 1000).alias("o"), F.concat(F.lit("t"), "id").alias("text")).repartition(4)
    base = str(tmp_path)
    assert tweets.number_rows(df, "o", f"{base}/numbered") == n
    numbered = spark.read.parquet(f"{base}/numbered").drop("o")
    job = lambda: tweets.paced_job(numbered, f"{base}/topic", f"{base}/progress", "2024-01-01 00:00:00", rate, seconds)
    tweets.replay_paced(job(), 40, rate, seconds)  # stopped early
    tweets.replay_paced(job(), n, rate, seconds)  # and taken up again
    sent = [json.loads(r[0]) for r in spark.read.text(f"{base}/topic/*").collect()]
    sent.sort(key=lambda r: r["number"])
    assert [r["text"] for r in sent] == [f"t{k}" for k in range(n)]
    assert [r["created_at"] for r in sent] == [f"2024-01-01T00:00:{k // rate:02d}" for k in range(n)]
    first = [json.loads(x) for p in (tmp_path / "topic" / "batch_id=0").glob("part-*") for x in p.read_text().splitlines()]
    assert len(first) == rate * seconds
    tweets.replay_paced(job(), 0, rate, seconds)  # nothing to send
