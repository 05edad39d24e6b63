import random

import pytest
from pyspark.sql import functions as F

from adloom.operators import nesting
from adloom.operators.lookup import duplicate_keys, orphan_keys, resolve_key
from adloom.operators.profile import column_profile, profile_of_loads, store_sketches
from adloom.operators.ranking import latest_per_key, top_per_group, top_rows
from adloom.operators.ranks import RANGE, with_rank, with_ranges
from adloom.operators.surrogate import first_appearance_ids
from conftest import plan_of, rows


def test_top_rows_settles_ties_and_plans_no_full_sort(spark):
    data = [(k, v) for k in range(50) for v in (1, 2)]
    for seed in (1, 2):
        random.Random(seed).shuffle(data)
        top = top_rows(spark.createDataFrame(data, "k long, v long"), [F.desc("v"), F.asc("k")], 3)
        assert [tuple(r) for r in top.collect()] == [(0, 2), (1, 2), (2, 2)]
    assert "TakeOrderedAndProject" in plan_of(top)


def test_top_per_group_prunes_in_map_tasks(spark):
    rng = random.Random(3)
    # One group holds most rows.
    data = [("hot" if rng.random() < 0.7 else f"g{rng.randrange(5)}", rng.randrange(40), i) for i in range(2000)]
    df = spark.createDataFrame(data, "g string, v long, id long").repartition(7)
    top = top_per_group(df, ["g"], [F.desc("v"), F.asc("id")], 4)
    expected = []
    for g in {d[0] for d in data}:
        expected += sorted((d for d in data if d[0] == g), key=lambda d: (-d[1], d[2]))[:4]
    assert rows(top) == sorted(expected, key=repr)
    plan = plan_of(top)
    assert plan.index("WindowGroupLimit") < plan.index("Exchange hashpartitioning") < plan.rindex("WindowGroupLimit")


def test_latest_per_key_does_not_depend_on_row_order(spark):
    data = [(i % 20, i, f"v{i}") for i in range(200)]
    results = []
    for seed in (1, 2):
        random.Random(seed).shuffle(data)
        results.append(rows(latest_per_key(spark.createDataFrame(data, "k long, w long, v string"), ["k"], ["w"])))
    assert results[0] == results[1] == sorted(((k, 180 + k, f"v{180 + k}") for k in range(20)), key=repr)


@pytest.mark.parametrize("spread", [1, 1000, 2**33])
def test_ids_follow_first_appearance(spark, spread):
    rng = random.Random(spread)
    data = [(rng.choice("abcdefghijklmnop") * rng.randrange(1, 4), i * spread) for i in range(500)]
    data += [(None, 0)]
    seen = list(dict.fromkeys(v for v, _ in sorted(data[:-1], key=lambda d: d[1])))
    rng.shuffle(data)
    got = first_appearance_ids(spark.createDataFrame(data, "v string, o long"), "v", "o", "id")
    assert rows(got) == sorted(((i + 1, v) for i, v in enumerate(seen)), key=repr)


def test_ids_can_keep_a_null_value(spark):
    df = spark.createDataFrame([("b", 0), (None, 1), ("a", 2)], "v string, o long")
    assert rows(first_appearance_ids(df, "v", "o", "id", keep_null=True)) == sorted([(1, "b"), (2, None), (3, "a")], key=repr)


def _children(n=600):
    rng = random.Random(5)
    # User 1 holds a third of all rows, user 2 is over one page, some have no user.
    def owner(i):
        x = rng.random()
        return 1 if x < 0.34 else 2 if x < 0.38 else None if x < 0.41 else rng.randrange(3, 60)
    return [(owner(i), i, f"e{i}") for i in range(n)]


def test_nesting_loses_nothing_and_bounds_every_array(spark):
    data = _children()
    children = spark.createDataFrame(data, "u long, ord long, e string").repartition(5)
    parents = spark.createDataFrame([(u, f"name{u}") for u in range(0, 70)], "u long, name string")
    nested = nesting.nest(parents, children, "u", ["e"], "ord", "items", page_size=7).cache()
    got = nested.collect()
    assert max(len(r["items"]) for r in got) <= 7
    assert all([i["ord"] for i in r["items"]] == sorted(i["ord"] for i in r["items"]) for r in got)
    for u in range(70):
        pages = sorted((r["page"], r["items"]) for r in got if r["u"] == u)
        assert [p for p, _ in pages] == list(range(len(pages)))
        assert all(len(items) == 7 for _, items in pages[:-1])
        assert [i["ord"] for _, items in pages for i in items] == [d[1] for d in data if d[0] == u]
    assert {r["u"] for r in got} == set(range(70))
    flat = nesting.unnest(nested, "items", ["u"])
    assert rows(flat) == sorted((d for d in data if d[0] is not None), key=repr)
    empty = [r for r in got if not r["items"]]
    assert {r["u"] for r in empty} == set(range(70)) - {d[0] for d in data}
    assert all(r["page"] == 0 for r in empty)


def test_pages_depend_on_the_own_children_only(spark):
    parents = spark.range(0, 3).withColumnRenamed("id", "u")
    own = [(1, i, f"e{i}") for i in range(0, 90, 3)]
    others = [(2, i, "x") for i in range(1, 4000, 3)] + [(None, i, "y") for i in range(2, 900, 3)]
    pages = lambda data: rows(nesting.nest(parents, spark.createDataFrame(data, "u long, ord long, e string"),
                                           "u", ["e"], "ord", "items", page_size=8).filter("u = 1"))
    assert pages(own) == pages(own + others) and len(pages(own)) == 4


def test_small_parents_stay_one_row(spark):
    data = [(u, i, "x") for i, u in enumerate([1, 2, 2, 3, 3, 3])]
    children = spark.createDataFrame(data, "u long, ord long, e string")
    parents = spark.createDataFrame([(u,) for u in range(1, 5)], "u long")
    got = nesting.nest(parents, children, "u", ["e"], "ord", "items")
    assert rows(got.select("u", "page", F.size("items"))) == [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 0, 0)]


def test_resolve_key(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "x"), (3, None)], "n long, name string")
    dim = spark.createDataFrame([(10, "a"), (11, "a"), (12, None)], "id long, label string")
    found = resolve_key(facts, dim, "name", "label", "id", "key", missing=0)
    # A repeated name repeats the row; unknown and null names get the sentinel.
    assert rows(found.select("n", "key")) == [(1, 10), (1, 11), (2, 0), (3, 0)]
    by_null = resolve_key(facts, dim, "name", "label", "id", "key", match_null=True)
    assert rows(by_null.select("n", "key")) == [(1, 10), (1, 11), (2, None), (3, 12)]


def test_key_checks(spark):
    df = spark.createDataFrame([(1, 5), (1, 6), (2, 7), (3, None)], "k long, fk long")
    assert rows(duplicate_keys(df, ["k"])) == [(1, 2)]
    dim = spark.createDataFrame([(5,)], "id long")
    assert rows(orphan_keys(df, "fk", dim, "id")) == [(6, 1), (7, 1)]


def test_profile_counts_exactly(spark):
    df = spark.createDataFrame(
        [(1, "a", 0.0), (1, None, -0.0), (2, "b", 1.5), (None, "a", None)], "i int, s string, d double")
    expected = [("d", "double", 3, 1, 2), ("i", "int", 3, 1, 2), ("s", "string", 3, 1, 2)]
    assert rows(column_profile(df)) == expected
    assert rows(column_profile(df, approx=True)) == expected


def test_profile_of_an_all_null_column(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "i int, n string")
    assert rows(column_profile(df)) == [("i", "int", 2, 0, 2), ("n", "string", 0, 2, 0)]


def test_profile_of_a_table_in_frames(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, "a", 0.0, None), (1, None, -0.0, None), (2, "b", 1.5, None), (None, "a", None, None)], "i int, s string, d double, n date")
    frames = [df.select("s", "n"), df.select("d"), df.select("i")]
    assert rows(column_profile(*frames)) == rows(column_profile(df))
    assert rows(column_profile(*frames, approx=True)) == rows(column_profile(df, approx=True))
    store_sketches(frames, str(tmp_path / "p"), 0)
    assert rows(profile_of_loads(spark, str(tmp_path / "p"))) == rows(column_profile(df))


def _ranked_rows(n=3000):
    """One group holds a third of the rows; ordinals bunch up at both ends and spread over 60 bits."""
    rng = random.Random(11)
    spots = [lambda: rng.randrange(400), lambda: 2**40 + rng.randrange(50), lambda: rng.randrange(2**60), lambda: 2**62 + rng.randrange(400)]
    seen, data = set(), []
    while len(data) < n:
        group, order = (0 if rng.random() < 0.34 else rng.randrange(1, 40)), rng.choice(spots)()
        if (group, order) not in seen:
            seen.add((group, order))
            data.append((group, order, f"v{len(data)}"))
    return data


@pytest.mark.parametrize("limit, fanout", [(20, 4), (64, 1024), (10_000, 1024)])
def test_ranks_of_a_hot_group_in_small_windows(spark, limit, fanout):
    data = _ranked_rows()
    df = spark.createDataFrame(data, "g long, o long, v string").repartition(6)
    expected = []
    for g in {d[0] for d in data}:
        expected += [(*d, k) for k, d in enumerate(sorted((d for d in data if d[0] == g), key=lambda d: d[1]))]
    assert rows(with_rank(df, ["g"], "o", "rank", limit=limit, fanout=fanout)) == sorted(expected, key=repr)
    placed, counts = with_ranges(df, ["g"], "o", limit, fanout)
    assert placed.groupBy("g", RANGE).count().agg(F.max("count")).first()[0] <= limit
    assert (counts is None) == (limit == 10_000)
    assert counts is None or counts.agg(F.sum("_n")).first()[0] == len(data)


def test_ranks_without_a_group_and_with_ties(spark):
    data = [(k // 3, f"{k % 3}") for k in range(300)]
    df = spark.createDataFrame(data, "o long, v string").repartition(5)
    assert rows(with_rank(df, [], "o", "rank", limit=10, ties=["v"])) == sorted(((o, v, k) for k, (o, v) in enumerate(data)), key=repr)
    assert with_rank(df.limit(0), [], "o", "rank").collect() == []


def test_hot_user_is_nested_in_small_windows(spark):
    data = _children()
    children = spark.createDataFrame(data, "u long, ord long, e string").repartition(5)
    parents = spark.createDataFrame([(u, f"name{u}") for u in range(70)], "u long, name string")
    whole = rows(nesting.nest(parents, children, "u", ["e"], "ord", "items", page_size=7))
    assert rows(nesting.nest(parents, children, "u", ["e"], "ord", "items", page_size=7, limit=10)) == whole
