"""Tool calls linked with their results, ordered, validated and written as canonical JSON.

Calls and results are hash-joined by (conversation, call id); several results of a call
are reduced to the first before the join. Calls of a conversation are put in topological order of
what they depend on: a call's level is one more than the highest level among its
dependencies. A conversation of up to ``CONVERSATION_EDGES`` dependencies is ordered in one task; a longer one
level by level with joins, so it is never gathered, in as many rounds as its longest chain. Within a level calls keep their
position. Ranks come from counts of position ranges, again without gathering. Calls on a
cycle, and those that build on one, have no level and come last.

Arguments must be a JSON object that fits the tool's schema (type, required, properties, items,
enum, minimum, maximum, minLength, maxLength, additionalProperties). Canonical JSON has sorted
keys, no blanks, plain non-ASCII characters, and whole numbers without a fraction.

Null ids link to nothing; null or broken arguments are invalid, as are those with NaN, with numbers beyond a double, with half
a surrogate pair or nested too deeply to read, and are written as the text they came as; dependencies on unknown calls
are reported and otherwise ignored; repeated calls are linked each; results without a call are
kept as orphans. Very long arguments are read whole. Extra columns are left out, whatever their names. Empty tables are fine.
"""

from __future__ import annotations

import json
from collections import defaultdict, deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adloom.session import scratch_dir

POSITIONS_PER_RANGE = 1024
CONVERSATION_EDGES = 200_000  # of a conversation, ordered in one task

_KINDS = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "object": dict, "array": list, "null": type(None)}


def _is(value: object, kind: str) -> bool:
    """JSON tells true from 1, and does not tell 1.0 from 1."""
    if kind == "integer" and isinstance(value, float):
        return value.is_integer()
    return isinstance(value, _KINDS[kind]) and not (kind in ("integer", "number") and isinstance(value, bool))


def schema_errors(value: object, schema: dict, at: str = "$") -> list[str]:
    """What in ``value`` breaks ``schema``, in a fixed order."""
    kinds = schema.get("type")
    if kinds is not None:
        kinds = [kinds] if isinstance(kinds, str) else kinds
        if not any(_is(value, k) for k in kinds):
            return [f"{at}: not {' or '.join(kinds)}"]
    found = []
    if "enum" in schema and canonical(value) not in map(canonical, schema["enum"]):
        found.append(f"{at}: not allowed")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        found += [f"{at}: {word}" for word, out in (("below minimum", value < schema.get("minimum", value)), ("above maximum", value > schema.get("maximum", value))) if out]
    if isinstance(value, str):
        found += [f"{at}: {word}" for word, out in (("too short", len(value) < schema.get("minLength", 0)), ("too long", len(value) > schema.get("maxLength", len(value)))) if out]
    if isinstance(value, dict):
        known = schema.get("properties", {})
        found += [f"{at}.{k}: missing" for k in sorted(schema.get("required", [])) if k not in value]
        for k in sorted(value):
            if k in known:
                found += schema_errors(value[k], known[k], f"{at}.{k}")
            elif schema.get("additionalProperties") is False:
                found.append(f"{at}.{k}: unknown")
    if isinstance(value, list) and "items" in schema:
        for i, x in enumerate(value):
            found += schema_errors(x, schema["items"], f"{at}[{i}]")
    return found


def _plain(value: object) -> object:
    """Whole numbers without a fraction, at any depth."""
    if isinstance(value, float) and value.is_integer() and abs(value) < 1 << 53:
        return int(value)
    if isinstance(value, dict):
        return {k: _plain(v) for k, v in value.items()}
    return [_plain(v) for v in value] if isinstance(value, list) else value


def canonical(value: object) -> str:
    return json.dumps(_plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def _no_constant(name: str) -> None:
    raise ValueError(f"{name} is no JSON")


def parsed(text: str | None) -> tuple[object, str | None]:
    """The value of a JSON text, and why it has none."""
    try:
        value = json.loads(text, parse_constant=_no_constant)
        canonical(value).encode()
        return value, None
    except RecursionError:
        return None, "$: nested too deeply"
    except UnicodeEncodeError:
        return None, "$: half a surrogate pair"
    except (TypeError, ValueError):  # numbers beyond a double among them
        return None, "$: not JSON"


def _order(edges: list[tuple[str, str]]) -> dict[str, int]:
    """Levels of the calls in (call, dependency) pairs that do not build on a cycle."""
    users, waiting = defaultdict(list), defaultdict(int)
    for call, dep in edges:
        users[dep].append(call)
        waiting[call] += 1
    ready, level = deque(d for d in users if not waiting.get(d)), {}
    for d in ready:
        level[d] = 0
    while ready:
        done = ready.popleft()
        for call in users.get(done, ()):
            level[call] = max(level.get(call, 0), level[done] + 1)
            waiting[call] -= 1
            if not waiting[call]:
                ready.append(call)
    return {call: k for call, k in level.items() if not waiting.get(call)}


def _ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Levels above 0 by conversation; edges are sorted by conversation, which may go over several batches."""
    key, held, kind = None, [], None

    def flush() -> pa.RecordBatch:
        found = [(call, k) for call, k in _order(held).items() if k]
        return pa.RecordBatch.from_arrays([pa.array([key] * len(found), kind), pa.array([c for c, _ in found], pa.string()), pa.array([k for _, k in found], pa.int32())],
                                          ["conv", "call", "level"])

    for batch in batches:
        kind = batch.schema.field("conv").type
        for conv, call, dep in zip(*(batch.column(c).to_pylist() for c in ("conv", "call", "dep")), strict=True):
            if held and conv != key:
                yield flush()
                held = []
            key = conv
            held.append((call, dep))
    if held:
        yield flush()


def levels(calls: DataFrame, path: str, most: int = CONVERSATION_EDGES) -> DataFrame:
    """(conv, call, level) of distinct calls that have a level."""
    spark = calls.sparkSession
    known = calls.where(F.col("conv").isNotNull() & F.col("call").isNotNull()).select("conv", "call", "deps")
    nodes = known.select("conv", "call").distinct()
    (known.select("conv", "call", F.explode("deps").alias("dep")).distinct()
     .join(nodes.withColumnRenamed("call", "dep"), ["conv", "dep"]).write.parquet(f"{path}/edges"))
    edges = spark.read.parquet(f"{path}/edges")
    large = edges.groupBy("conv").agg(F.count("*").alias("n")).where(F.col("n") > most).select("conv")
    large.write.parquet(f"{path}/large")
    large = spark.read.parquet(f"{path}/large")
    conv_type = calls.schema["conv"].dataType.simpleString()
    short = edges.join(large, "conv", "left_anti").repartition("conv").sortWithinPartitions("conv").mapInArrow(_ordered, f"conv {conv_type}, call string, level int")
    roots = nodes.join(edges.select("conv", "call").distinct().repartition("call"), ["conv", "call"], "left_anti").withColumn("level", F.lit(0))
    found = roots.unionAll(short)
    if not large.isEmpty():
        found = found.unionAll(_levels_by_rounds(edges.join(large, "conv", "left_semi"), nodes.join(large, "conv", "left_semi"), path))
    found.write.parquet(f"{path}/levels")
    return spark.read.parquet(f"{path}/levels")


def _levels_by_rounds(edges: DataFrame, nodes: DataFrame, path: str) -> DataFrame:
    """Levels above 0 in conversations of any length; a round per level."""
    spark = edges.sparkSession
    open_edges, level = edges, 0
    nodes.join(edges.select("conv", "call").distinct().repartition("call"), ["conv", "call"], "left_anti").write.parquet(f"{path}/level-0")
    done = [f"{path}/level-0"]
    while True:
        ready = spark.read.parquet(done[-1])
        # Edges whose dependency has just got its level are settled; calls without open edges come next.
        left = open_edges.join(ready.select("conv", F.col("call").alias("dep")), ["conv", "dep"], "left_anti")
        left.write.parquet(f"{path}/open-{level}")
        touched = open_edges.select("conv", "call").distinct()
        open_edges = spark.read.parquet(f"{path}/open-{level}")
        level += 1
        touched.join(open_edges.select("conv", "call").distinct(), ["conv", "call"], "left_anti").write.parquet(f"{path}/level-{level}")
        if spark.read.parquet(f"{path}/level-{level}").isEmpty():
            break
        done.append(f"{path}/level-{level}")
    found = spark.read.parquet(done[0]).withColumn("level", F.lit(0))
    for k, each in enumerate(done[1:], 1):
        found = found.unionAll(spark.read.parquet(each).withColumn("level", F.lit(k)))
    return found.where("level > 0")


def _written(batches: Iterator[pa.RecordBatch], schemas: dict[str, dict]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        errors, messages = [], []
        for row in batch.to_pylist():
            arguments, why = parsed(row["arguments"])
            if why:
                found = [why]
            else:
                schema = schemas.get(row["name"])
                found = ["unknown tool"] if schema is None else schema_errors(arguments, {"type": "object"} | schema)
            found += [f"unknown dependency {d}" for d in row["unknown"] or []]
            errors.append(found)
            messages.append(canonical({"arguments": arguments if arguments is not None else row["arguments"], "id": row["call"],
                                       "name": row["name"], "result": row["result"]}))
        keep = [n for n in batch.schema.names if n not in ("arguments", "result", "unknown")]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in keep), pa.array(errors, pa.list_(pa.string())), pa.array(messages, pa.string())], [*keep, "errors", "message"])


def link(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """``calls`` (conv, call, pos, name, arguments, deps) with ``results`` (conv, call, pos, content):
    conv, call, pos, name, level, order, n_results, orphan, errors, message; a row per call, and one
    per (conversation, call id) of results without a call (orphan, no level or order)."""
    spark = calls.sparkSession
    path = scratch_dir(spark, "tool-calls")
    calls = calls.select("conv", "call", "pos", "name", "arguments", "deps")
    results = results.select("conv", "call", "pos", "content")
    conv_type = calls.schema["conv"].dataType.simpleString()
    level = levels(calls, path)
    nodes = level.select("conv", "call")
    unknown = (calls.select("conv", "call", F.explode("deps").alias("dep")).distinct()
               .join(nodes.withColumnRenamed("call", "dep"), ["conv", "dep"], "left_anti")
               .join(calls.select("conv", F.col("call").alias("dep")).distinct(), ["conv", "dep"], "left_anti")
               .groupBy("conv", "call").agg(F.array_sort(F.collect_list("dep")).alias("unknown")))
    first = (results.groupBy("conv", "call").agg(F.min(F.struct("pos", "content")).alias("first"), F.count("*").alias("n_results")))
    first.write.parquet(f"{path}/results")
    first = spark.read.parquet(f"{path}/results")
    (calls.drop("deps").join(level, ["conv", "call"], "left").join(unknown, ["conv", "call"], "left").join(first, ["conv", "call"], "left")
     .select("conv", "call", "pos", "name", "level", "n_results", "arguments", F.col("first.content").alias("result"), "unknown")
     .mapInArrow(lambda b: _written(b, schemas),
                 f"conv {conv_type}, call string, pos long, name string, level int, n_results long, errors array<string>, message string")
     .write.parquet(f"{path}/linked"))
    linked = spark.read.parquet(f"{path}/linked")

    # Order in a conversation: level (cycles last), position, id; ranges of positions are counted first.
    place = linked.withColumn("_level", F.coalesce("level", F.lit(2**31 - 1))).withColumn("_range", F.floor(F.col("pos") / POSITIONS_PER_RANGE))
    counts = place.groupBy("conv", "_level", "_range").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv").orderBy("_level", "_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col("conv").alias("c"), F.col("_level").alias("l"), F.col("_range").alias("r"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("conv", "_level", "_range").orderBy("pos", "call", "message")
    ordered = (place.withColumn("_in", F.row_number().over(inside) - 1).alias("p")
               .join(starts.alias("s"), F.col("conv").eqNullSafe(F.col("c")) & (F.col("_level") == F.col("l")) & F.col("_range").eqNullSafe(F.col("r")), "left")
               .select("conv", "call", "pos", "name", "level", (F.col("start") + F.col("_in")).alias("order"),
                       F.coalesce("n_results", F.lit(0)).alias("n_results"), F.lit(False).alias("orphan"), "errors", "message"))
    known = calls.select("conv", "call").distinct()
    lost = first.join(known, ["conv", "call"], "left_anti")
    orphans = lost.select("conv", "call", F.col("first.pos").alias("pos"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("int").alias("level"),
                          F.lit(None).cast("long").alias("order"), "n_results", F.lit(True).alias("orphan"),
                          F.array(F.lit("no call")).alias("errors"), F.lit(None).cast("string").alias("message"))
    return ordered.unionAll(orphans)


# Tools that the conversations are read as using: a user turn asks, a system turn configures.
TOOLS = {
    "ask": {"type": "object", "required": ["question", "turn"], "additionalProperties": False,
            "properties": {"question": {"type": "string", "minLength": 40}, "turn": {"type": "integer", "minimum": 0}}},
    "configure": {"type": "object", "required": ["instructions"], "additionalProperties": False,
                  "properties": {"instructions": {"type": "string", "minLength": 1}}},
}


def turns_as_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results in a table of turns. The turn after a call answers it; a call builds on
    the one before it, two turns back, so the calls of a conversation are one chain."""
    ident = lambda turn: F.concat_ws("-", F.lit("call"), F.col("conv_id").cast("string"), turn.cast("string"))
    turn = F.col("turn")
    back = turn - 2
    asks = turns.where(F.col("role").isin("user", "system"))
    question = F.to_json(F.struct(F.col("text").alias("question"), turn.alias("turn")))
    calls = asks.select(
        F.col("conv_id").alias("conv"), ident(turn).alias("call"), turn.cast("long").alias("pos"),
        F.when(F.col("role") == "user", "ask").otherwise("configure").alias("name"),
        F.when(F.col("role") == "user", question).otherwise(F.to_json(F.struct(F.col("text").alias("instructions")))).alias("arguments"),
        F.when(back >= 0, F.array(ident(back))).otherwise(F.array().cast("array<string>")).alias("deps"))
    answers = turns.where(~F.coalesce(F.col("role").isin("user", "system"), F.lit(False)))
    results = answers.select(F.col("conv_id").alias("conv"), ident(turn - 1).alias("call"), turn.cast("long").alias("pos"), F.col("text").alias("content"))
    return calls, results


def op9_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = turns_as_calls(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return link(calls, results, TOOLS).select(
        F.col("conv").alias("conv_id"), F.col("call").alias("call_id"), F.col("pos").alias("turn"), "name", "level", F.col("order").alias("call_order"),
        "n_results", "orphan", (F.size("errors") == 0).alias("valid"), F.concat_ws("; ", "errors").alias("errors"), "message")
