import json

import pytest
from pyspark.sql import functions as F

from adloom.sources import files, inference, open_messages
from conftest import plan_of, rows

CELLS = {
    "flag": (["true", "False", None], "boolean"),
    "small": (["1", "-7", "+3"], "int"),
    "large": (["1", "3000000000", ""], "bigint"),
    "huge": (["1", "9" * 30, " 2 "], "decimal(38,0)"),
    "half": (["1", "2.5", "1e3"], "double"),
    "beyond": (["1", "9" * 60, "2"], "double"),
    "day": (["2024-02-29", None, "2023-01-01"], "date"),
    "moment": (["2024-02-29", "2024-02-29T10:00:00", "2024-02-29 10:00:00.5"], "timestamp_ntz"),
    "instant": (["2024-02-29T10:00:00Z", "2024-02-29T10:00:00+02:00", "2024-02-29"], "timestamp"),
    "bad_day": (["2024-02-29", "2024-13-99", "2023-01-01"], "string"),
    "mixed": (["2024-02-29", "7", None], "string"),
    "none": ([None, "", "  "], "string"),
    "with.dot": (["1", "true", "1"], "string"),
}


@pytest.fixture(scope="module")
def cells(spark):
    names = list(CELLS)
    return spark.createDataFrame(list(zip(*(CELLS[n][0] for n in names), strict=True)), ", ".join(f"`{n}` string" for n in names))


def test_narrowest_type_of_every_column(spark, cells):
    assert inference.types_of(inference.cell_profile(cells)) == {n: kind for n, (_, kind) in CELLS.items()}
    typed = inference.with_types(cells, {n: kind for n, (_, kind) in CELLS.items()})
    # A value lost by the cast would be a type too narrow.
    lost = typed.select(*(F.count(f"`{n}`").alias(f"c{k}") for k, n in enumerate(CELLS))).first()
    assert list(lost) == [sum(bool(v and v.strip()) for v in values) if kind != "string" else sum(v is not None for v in values)
                          for values, kind in CELLS.values()]
    assert [f.dataType.simpleString() for f in typed.schema.fields] == [kind for _, kind in CELLS.values()]
    empty = spark.createDataFrame([], cells.schema)
    assert inference.types_of(inference.cell_profile(empty)) == {}


def test_profiles_of_loads_add_up(spark, cells, tmp_path):
    whole = inference.cell_profile(cells)
    parts = [cells.limit(0), cells.where("small = '1'"), cells.where("small <> '1'")]
    for load, part in enumerate(parts):
        inference.store_profile(inference.cell_profile(part), str(tmp_path), load)
    inference.store_profile(inference.cell_profile(parts[1]), str(tmp_path), 1)  # the same load again
    assert rows(inference.stored_profile(spark, str(tmp_path)).select(whole.columns)) == rows(whole)


def test_one_scan_finds_all_types_of_many_files(spark, tmp_path):
    for k, cell in enumerate(["1", "2.5", "x"]):
        (tmp_path / f"{k}.csv").write_text(f" a ;b;c\n{cell};{k};2024-01-0{k + 1}\n")
    text = files.read_csv(spark, str(tmp_path), sep=";")
    profile = inference.cell_profile(text)
    plan = plan_of(profile)
    assert plan.count("FileScan csv") == 1 and plan.count("Exchange") == 1
    assert inference.types_of(profile) == {"a": "string", "b": "int", "c": "date"}
    typed = inference.read_typed_csv(spark, str(tmp_path), sep=";")
    assert [f.dataType.simpleString() for f in typed.schema.fields] == ["string", "int", "date"]
    assert sorted(str(r.c) for r in typed.collect()) == ["2024-01-01", "2024-01-02", "2024-01-03"]


def _fields(value, path="$"):
    kind = {dict: "object", list: "array", str: "string", bool: "boolean", int: "bigint", float: "decimal", type(None): "null"}[type(value)]
    yield path, kind
    if kind in ("object", "array"):
        for key, member in value.items() if kind == "object" else ((None, m) for m in value):
            yield from _fields(member, path + ("[*]" if key is None else f".{key}" if key.isidentifier() else f'."{key}"'))


MESSAGES = ['{"a":1,"b":{"c":[1,"x",null,{"d":[]}]},"d e":2.5,"f":true}', '{"a":"one","new":{"x":{"y":{"z":null}}}}', "[1, [2]]", '"text"', "7", "{}"]
BROKEN = ['{"a":', "", None, '{"a":1,"a":2}']


def test_fields_of_messages_without_a_schema(spark):
    df = spark.createDataFrame([(m, k % 2) for k, m in enumerate(MESSAGES + BROKEN)], "value string, half int")
    expected = {}
    for m in MESSAGES:
        for field in _fields(json.loads(m)):
            expected[field] = expected.get(field, 0) + 1
    expected["$", "unreadable"] = len(BROKEN)
    assert {(r.path, r.kind): r.rows for r in open_messages.message_fields(df).collect()} == expected
    by_half = open_messages.message_fields(df, by=("half",)).groupBy("path", "kind").agg(F.sum("rows").alias("rows"))
    assert {(r.path, r.kind): r.rows for r in by_half.collect()} == expected
    assert open_messages.message_fields(df.limit(0)).collect() == []


def test_unknown_fields_are_kept(spark):
    df = spark.createDataFrame([(m,) for m in MESSAGES + BROKEN], "value string")
    found = open_messages.open_columns(df, {"a": ("$.a", "bigint"), "deep": ("$.b.c[1]", "string")})
    got = [(r.a, r.deep, None if r.rest is None else json.loads(r.rest)) for r in found.collect()]
    assert got == [(1, "x", {"d e": 2.5, "f": True}), (None, None, {"new": {"x": {"y": {"z": None}}}}), (None, None, None)]
    assert rows(open_messages.unreadable(df)) == sorted([(m,) for m in ["[1, [2]]", '"text"', "7", *BROKEN]], key=repr)
