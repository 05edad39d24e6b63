import json
import os

import pytest
from pyspark.sql import functions as F

from adloom import schemas, session
from adloom.sources import files, tables
from conftest import plan_of, rows


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_is_read_as_text_with_clean_headers(spark, tmp_path):
    path = write(tmp_path / "a.csv", ' id ,note\n1,"a, ""quoted"""\nx,\n')
    df = files.read_csv(spark, path)
    assert df.columns == ["id", "note"]
    assert rows(df) == sorted([("1", 'a, "quoted"'), ("x", None)], key=repr)


def test_csv_with_separator_and_schema(spark, tmp_path):
    path = write(tmp_path / "a.csv", "author_id;text\n7;hi\n")
    assert rows(files.read_csv(spark, path, schemas.RAW_TWEETS, sep=";")) == [("7", "hi")]


def test_csv_round_trip_keeps_awkward_text(spark, tmp_path):
    texts = ['line one\nline two', 'say "hi", twice', "back\\slash", "plain", "ünïcode"]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "author_id string, text string")
    files.write_csv(df, str(tmp_path / "out"))
    back = files.read_csv(spark, str(tmp_path / "out"), schemas.RAW_TWEETS, multi_line=True)
    assert rows(back) == rows(df)


def test_headerless_export_and_bulk_load(spark, tmp_path):
    df = spark.createDataFrame([("e1", "1"), ("e2", None)], "event_id string, campaign_id string")
    files.write_csv(df, str(tmp_path / "out"), header=False)
    parts = [p for p in os.listdir(tmp_path / "out") if p.endswith(".csv")]
    assert all("event_id" not in (tmp_path / "out" / p).read_text() for p in parts)
    schema = schemas.text_schema("event_id", "campaign_id")
    assert rows(files.read_csv(spark, str(tmp_path / "out"), schema, header=False)) == rows(df)


def test_ingest_order_follows_the_file_over_many_splits(spark, tmp_path):
    path = write(tmp_path / "big.csv", "n,pad\n" + "".join(f"{i},{'x' * 400}\n" for i in range(30_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(2 << 20))
    try:
        df = files.with_ingest_order(files.read_csv(spark, path))
        assert df.rdd.getNumPartitions() > 3
        got = [int(r[0]) for r in df.orderBy("ingest_ord").select("n").collect()]
        assert got == list(range(30_000))
        assert df.select("ingest_ord").distinct().count() == 30_000
        first = files.first_rows(df, 10)
        assert sorted(int(r[0]) for r in first.select("n").collect()) == list(range(10))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_json_export_one_folder_per_result(spark, tmp_path):
    top = spark.createDataFrame([("a", None)], "name string, cpc double")
    none = spark.createDataFrame([], "name string")
    files.export_results({"top": top, "none": none}, str(tmp_path / "r"))
    lines = [json.loads(x) for p in (tmp_path / "r" / "top").glob("*.json") for x in p.read_text().splitlines()]
    assert lines == [{"name": "a", "cpc": None}]
    assert spark.read.schema("name string").json(str(tmp_path / "r" / "none")).count() == 0


def test_ingest_order_is_unique_over_files(spark, tmp_path):
    os.makedirs(tmp_path / "in")
    for k, name in enumerate(("a.csv", "b c.csv", "d.csv")):
        write(tmp_path / "in" / name, "n\n" + "".join(f"{100 * k + i}\n" for i in range(100)))
    df = files.with_ingest_order(files.read_csv(spark, str(tmp_path / "in")))
    assert [int(r[0]) for r in df.orderBy("ingest_ord").select("n").collect()] == list(range(300))
    assert df.select("ingest_ord").distinct().count() == 300
    for n in (0, 1, 150, 250, 300, 500):
        first = files.first_rows(df, n)
        assert sorted(int(r[0]) for r in first.select("n").collect()) == list(range(min(n, 300)))
        assert "TakeOrdered" not in plan_of(first)
    tied = spark.createDataFrame([(1,), (2,), (2,), (2,), (3,)], "ingest_ord long")
    assert sorted(r[0] for r in files.first_rows(tied, 3).collect()) == [1, 2, 2]


def test_ingest_order_of_gzipped_files(spark, tmp_path):
    """Many more rows than bytes: they count on from file to file all the same."""
    n = 30_000
    for k in range(3):
        files.write_csv(spark.range(n).select(F.lit(k).alias("k")).coalesce(1), str(tmp_path / "in" / f"k{k}"), packed=True)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = files.with_ingest_order(files.read_csv(spark, str(tmp_path / "in" / "*")))
        assert df.count() == 3 * n == df.select("ingest_ord").distinct().count()
        spans = df.groupBy("k").agg(F.min("ingest_ord").alias("low"), F.max("ingest_ord").alias("high")).orderBy("k").collect()
        assert all(a.high < b.low for a, b in zip(spans, spans[1:], strict=False))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_append_overwrite_and_column_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    tables.write_table(df, path)
    tables.write_table(df, path)
    assert tables.read_table(spark, path).count() == 4
    tables.write_table(df, path, mode="overwrite")
    assert rows(tables.read_table(spark, path, ["v"])) == [("a",), ("b",)]


def test_sql_text_over_frames(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 4.0)], "k long, budget double")
    got = tables.run_sql(spark, "select k, count(*) as n from {ledger} group by k having n > 0 order by k", {"ledger": df})
    assert [tuple(r) for r in got.collect()] == [(1, 1), (2, 1)]


def test_keyed_table_upserts_clusters_and_prunes(spark, tmp_path):
    # Key 0 holds most rows; each (k, c) is written twice.
    data = [(0 if i % 10 else i % 97, i // 2, i, f"v{i}") for i in range(4000)]
    df = spark.createDataFrame(data, "k long, c long, w long, v string")
    path = str(tmp_path / "keyed")
    # So little data would be merged into one file.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.write_keyed(df, path, ["k"], [F.desc("c")], primary_key=["k", "c"], written=["w"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    stored = spark.read.parquet(path)
    last = {(k, c): v for k, c, _, v in data}
    assert rows(stored.select("k", "c", "v")) == sorted(((k, c, v) for (k, c), v in last.items()), key=repr)
    # The hot key does not end up in one file.
    hot_files = stored.filter("k = 0").select(F.input_file_name()).distinct().count()
    assert hot_files > 1
    page = tables.read_by_key(stored, {"k": 0}, [F.desc("c")], limit=3)
    assert [r["c"] for r in page.collect()] == sorted((c for k, c in last if k == 0), reverse=True)[:3]
    assert "EqualTo(k,0)" in plan_of(page)


def test_keyed_table_with_folders(spark, tmp_path):
    df = spark.createDataFrame([("2024-01", 3, "a"), ("2024-02", 1, "b")], "period string, n long, id string")
    path = str(tmp_path / "marts")
    tables.write_keyed(df, path, ["period"], [F.desc("n"), F.asc("id")], folders=True)
    assert sorted(p for p in os.listdir(path) if p.startswith("period")) == ["period=2024-01", "period=2024-02"]
    again = df.filter("period = '2024-02'").withColumn("n", F.lit(9))
    tables.write_keyed(again, path, ["period"], [F.desc("n")], folders=True, only_touched=True)
    # A rerun replaces the period it computed, adds no stale rows and leaves other periods.
    assert rows(spark.read.parquet(path).select("period", "n")) == [("2024-01", 3), ("2024-02", 9)]
    tables.write_keyed(again, path, ["period"], [F.desc("n")], folders=True)
    assert rows(spark.read.parquet(path).select("period", "n")) == [("2024-02", 9)]


def test_scratch_is_below_the_configured_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    a, b = session.scratch_dir(spark, "x"), session.scratch_dir(spark, "x")
    assert a.startswith(root) and a != b


def test_shuffle_partitions_follow_the_data():
    small, large = session.shuffle_conf(1 << 20, cores=8), session.shuffle_conf(20 << 40, cores=4000)
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert int(large["spark.sql.shuffle.partitions"]) == (20 << 40) // (256 << 20)


def test_packed_csv_is_bounded_and_read_back(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "PACKED_ROWS", 40)
    df = spark.range(100).selectExpr("cast(id as string) AS id", "concat('a, \"', id, '\" ') AS note")
    files.write_csv(df.coalesce(1), str(tmp_path / "csv"), packed=True)
    assert len(list((tmp_path / "csv").glob("part-*.csv.gz"))) == 3
    assert rows(files.read_csv(spark, str(tmp_path / "csv"))) == rows(df)
