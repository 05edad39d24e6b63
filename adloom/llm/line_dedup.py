"""Lines that many documents share, found by sharded cuckoo filters over exact counts.

A line's key is the line without blanks at both ends, A-Z in lower case, known by 128 bits of hash. ``LineIndex`` keeps for
every key the number of documents that hold it, and for every shard of keys a cuckoo filter of those
held by ``limit`` documents or more. Documents are added and removed in batches: a batch
changes the counts by one signed run of (key, change); runs of like size are merged, so reading
them all costs a logarithmic number of runs. Keys that cross the limit enter or leave the
filter of their shard, so taking documents away brings lines of others back. A filter that is
full is built anew, larger, from the counts.

``cut`` asks the filters which lines of the documents may be common, confirms these few
by the exact counts, and drops them. Filters are broadcast while they hold at most ``FILTER_BYTES`` in all; beyond
that every line is joined with the counts directly, which gives the same rows.

Every state is written below the index folder, ending with a row of ``log``; an index opened again goes on from
the last complete state. Documents to remove must have been added with the same text.

A null or empty text is one empty line; empty keys are never common. Each row is a document of its own, repeated rows
and ids included; a key counts once per document. Texts are handled whole, a very long one as a batch of its
own. Columns of the input named like a result are replaced by it. An empty table gives none and changes nothing.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.llm.textops import by_bytes
from adloom.session import scratch_dir

BLANKS = b" \t\n\x0b\x0c\r"
SLOTS = 4  # of a bucket
FILTER_BYTES = 64 << 20
KEYS_PER_SHARD = 1 << 18
_KICKS = 500
_FILTER = "shard int, buckets int, held binary"
RESULTS = ("n_lines", "n_dropped", "kept_text")


class CuckooFilter:
    """Approximate set of 128-bit keys with deletion: 16-bit fingerprints in one of two buckets.

    Never misses a key it was given; takes another for one with a chance of 1 in 8,000."""

    def __init__(self, buckets: int, held: np.ndarray | None = None) -> None:
        self.buckets = buckets  # a power of two
        self.held = np.zeros((buckets, SLOTS), np.uint16) if held is None else held

    @classmethod
    def holding(cls, keys: np.ndarray) -> CuckooFilter:
        buckets = 4
        while buckets * SLOTS * 0.85 < len(keys):
            buckets *= 2
        while True:
            made = cls(buckets)
            if made.insert(keys):
                return made
            buckets *= 2

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint and both buckets of keys (rows of two 64-bit halves)."""
        mark = (keys[:, 1].view(np.uint64) >> np.uint64(48)).astype(np.uint16)
        mark[mark == 0] = 1
        first = (keys[:, 1].view(np.uint64) & np.uint64(self.buckets - 1)).astype(np.int64)
        return mark, first, self._other(first, mark)

    def _other(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        return bucket ^ (mark.astype(np.uint64) * np.uint64(0x5BD1E995) >> np.uint64(7) & np.uint64(self.buckets - 1)).astype(np.int64)

    def _settle(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        """Puts fingerprints into free slots of their buckets; tells which found one."""
        done = np.zeros(len(bucket), bool)
        for slot in range(SLOTS):
            left = np.flatnonzero(~done)
            free = left[self.held[bucket[left], slot] == 0]
            _, one = np.unique(bucket[free], return_index=True)  # a slot takes one at a time
            self.held[bucket[free[one]], slot] = mark[free[one]]
            done[free[one]] = True
        return done

    def insert(self, keys: np.ndarray) -> bool:
        """Adds distinct keys; False if there is no room, after which the filter must be built anew."""
        mark, bucket, other = self._places(keys)
        for kick in range(_KICKS):
            for second in (False, True):
                left = ~self._settle(other if second else bucket, mark)
                mark, bucket, other = mark[left], bucket[left], other[left]
            if not len(mark):
                return True
            # The rest each push one fingerprint of their second bucket to its other place.
            _, one = np.unique(other, return_index=True)
            slot = (kick + mark[one]) % SLOTS
            pushed, at = self.held[other[one], slot].copy(), other[one].copy()
            self.held[at, slot] = mark[one]
            mark[one], bucket[one] = pushed, at
            other[one] = self._other(at, pushed)
        return False

    def remove(self, keys: np.ndarray) -> None:
        """Takes out keys that were inserted."""
        for mark, *places in zip(*self._places(keys), strict=True):
            for bucket in places:
                found = np.flatnonzero(self.held[bucket] == mark)
                if len(found):
                    self.held[bucket, found[0]] = 0
                    break

    def __contains__(self, key: tuple[int, int]) -> bool:
        return bool(self.holds(np.array([key], np.int64))[0])

    def holds(self, keys: np.ndarray) -> np.ndarray:
        mark, first, other = self._places(keys)
        return ((self.held[first] == mark[:, None]) | (self.held[other] == mark[:, None])).any(axis=1)


def _line_keys(text: str | None) -> tuple[list[bytes], list[bytes]]:
    """Lines of a text as bytes, and their keys."""
    lines = (text or "").encode().split(b"\n")
    return lines, [x.strip(BLANKS).lower() for x in lines]  # bytes.lower changes A-Z alone


def _digest(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def _halves(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), ">i8").reshape(-1, 2).astype(np.int64)


def _long_enough(key: bytes, least_chars: int) -> bool:
    return len(key) >= least_chars and (least_chars < 2 or len(key.decode()) >= least_chars)


def _counted(batches: Iterator[pa.RecordBatch], least_chars: int, change: int) -> Iterator[pa.RecordBatch]:
    """Keys of documents with the number of documents of the batch that hold them."""
    for batch in by_bytes(batches):
        seen: Counter[bytes] = Counter()
        for text in batch.column(0).to_pylist():
            seen.update({_digest(k) for k in set(_line_keys(text)[1]) if _long_enough(k, least_chars)})
        halves = _halves(list(seen))
        counts = np.fromiter(seen.values(), np.int64, len(seen)) * change
        yield pa.RecordBatch.from_arrays([pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(counts)], ["k1", "k2", "n"])


def _suspected(batches: Iterator[pa.RecordBatch], filters: dict[int, CuckooFilter] | None, shards: int, least_chars: int) -> Iterator[pa.RecordBatch]:
    """(text hash, key) of lines that the filters know; of all lines without filters."""
    for batch in by_bytes(batches, column=1):
        marks, digests = [], []
        for mark, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            own = {_digest(k) for k in set(_line_keys(text)[1]) if _long_enough(k, least_chars)}
            marks += [mark] * len(own)
            digests += own
        halves = _halves(digests)
        keep = np.ones(len(halves), bool)
        if filters is not None:
            shard, keep = halves[:, 0] % shards, np.zeros(len(halves), bool)
            order = np.argsort(shard, kind="stable")
            cuts = np.searchsorted(shard[order], np.arange(shards + 1))
            for k, one in filters.items():
                own = order[cuts[k] : cuts[k + 1]]
                keep[own] = one.holds(halves[own])
        at = np.flatnonzero(keep)
        yield pa.RecordBatch.from_arrays([pa.array([marks[k] for k in at], pa.binary()), pa.array(halves[at, 0]), pa.array(halves[at, 1])], ["mark", "k1", "k2"])


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the lines of their dropped keys taken out."""
    for batch in by_bytes(batches, column=1):
        lines_of, dropped_of, kept_text = [], [], []
        for text, gone in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            lines, keys = _line_keys(text)
            if gone:
                gone = {(x["k1"], x["k2"]) for x in gone}
                halves = _halves([_digest(k) for k in keys]).tolist()
                kept = [x for x, key, k in zip(lines, keys, halves, strict=True) if not key or tuple(k) not in gone]
            else:
                kept = lines
            lines_of.append(len(lines))
            dropped_of.append(len(lines) - len(kept))
            kept_text.append(b"\n".join(kept).decode())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lines_of, pa.int64()), pa.array(dropped_of, pa.int64()), pa.array(kept_text, pa.string())],
                                         ["row", *RESULTS])


def _keys_of(table: pa.Table) -> np.ndarray:
    return np.stack([np.array(table["k1"], np.int64), np.array(table["k2"], np.int64)], axis=1)


def _stored(shard: int, made: CuckooFilter | None) -> pa.Table:
    kinds = [("shard", pa.int32()), ("buckets", pa.int32()), ("held", pa.binary())]
    row = (shard, 0 if made is None else made.buckets, None if made is None else made.held.tobytes())
    return pa.table({n: pa.array([v], t) for (n, t), v in zip(kinds, row, strict=True)})


def _restored(buckets: int, held: bytes) -> CuckooFilter:
    return CuckooFilter(buckets, np.frombuffer(held, np.uint16).reshape(buckets, SLOTS).copy())


def _built(table: pa.Table) -> pa.Table:
    return _stored(table["shard"][0].as_py(), CuckooFilter.holding(_keys_of(table)))


def _changed(key: tuple, changes: pa.Table, old: pa.Table) -> pa.Table:
    """The filter of a shard after keys came or left; without content if it ran full."""
    shard = key[0].as_py()
    made = _restored(old["buckets"][0].as_py(), old["held"][0].as_py()) if old.num_rows else CuckooFilter(4)
    made.remove(_keys_of(changes.filter(pc.invert(changes["common"]))))
    return _stored(shard, made if made.insert(_keys_of(changes.filter(changes["common"]))) else None)


class LineIndex:
    """Counts and filters of the lines of a growing and shrinking set of documents, stored below ``path``."""

    def __init__(self, spark: SparkSession, path: str, limit: int = 10, least_chars: int = 1, shards: int | None = None) -> None:
        self.spark, self.path, self.limit, self.least_chars = spark, path, limit, max(1, least_chars)
        self.state, self.runs, self.shards = 0, [], shards

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> LineIndex:
        """The index as of its last complete state."""
        last = spark.read.json(f"{path}/log/*").orderBy(F.desc("state")).first()
        index = cls(spark, path, last["limit"], last["least_chars"], last["shards"])
        index.state, index.runs = last["state"], [(name, int(n)) for name, n in last["runs"]]
        return index

    def add(self, docs: DataFrame, text_col: str = "text") -> None:
        self._apply(docs, text_col, 1)

    def remove(self, docs: DataFrame, text_col: str = "text") -> None:
        self._apply(docs, text_col, -1)

    def counts(self) -> DataFrame:
        """(k1, k2, n): documents that hold a key, over all runs."""
        runs = [self.spark.read.parquet(f"{self.path}/runs/{name}") for name, _ in self.runs]
        every = self.spark.createDataFrame([], "k1 long, k2 long, n long")
        for run in runs:
            every = every.unionByName(run)
        return (every.groupBy("k1", "k2").agg(F.sum("n").alias("n")) if len(runs) > 1 else every).where("n <> 0")

    def common(self) -> DataFrame:
        """Keys held by ``limit`` documents or more."""
        return self.counts().where(F.col("n") >= self.limit).select("k1", "k2")

    def filters(self) -> DataFrame:
        return self.spark.read.schema(_FILTER).parquet(f"{self.path}/filters/{self.state}")

    def _write_run(self, rows: DataFrame, name: str) -> tuple[str, int]:
        rows.write.mode("overwrite").parquet(f"{self.path}/runs/{name}")
        return name, self.spark.read.parquet(f"{self.path}/runs/{name}").count()

    def _apply(self, docs: DataFrame, text_col: str, change: int) -> None:
        before, least = list(self.runs), self.least_chars
        found = docs.select(F.col(text_col).cast("string").alias("t")).mapInArrow(lambda b: _counted(b, least, change), "k1 long, k2 long, n long")
        step = self.state + 1
        run = self._write_run(found.groupBy("k1", "k2").agg(F.sum("n").alias("n")), f"{step}-batch")
        if self.shards is None:
            self.shards = max(16, 1 << (run[1] // KEYS_PER_SHARD).bit_length())
        self.runs.append(run)
        full = None
        if before:
            full = self._update_filters(before, run, step)
        else:
            self._build_filters(self.common(), f"{self.path}/filters/{step}")
        self.state = step
        if full:
            again = self._with_shard(self.common()).where(F.col("shard").isin(full))
            kept = self.spark.read.schema(_FILTER).parquet(f"{self.path}/filters/{step}-part").where(F.col("held").isNotNull())
            kept.unionByName(again.groupBy("shard").applyInArrow(_built, _FILTER)).write.mode("overwrite").parquet(f"{self.path}/filters/{step}")
        while len(self.runs) > 1 and self.runs[-2][1] <= 2 * self.runs[-1][1]:
            last, earlier = self.runs.pop(), self.runs.pop()
            both = self.spark.read.parquet(*(f"{self.path}/runs/{n}" for n, _ in (earlier, last)))
            self.runs.append(self._write_run(both.groupBy("k1", "k2").agg(F.sum("n").alias("n")).where("n <> 0"), f"{step}-from-{earlier[0].split('-')[0]}-{len(self.runs)}"))
        log = self.spark.createDataFrame([(step, self.limit, self.least_chars, self.shards, [list(map(str, r)) for r in self.runs])],
                                         "state long, limit long, least_chars long, shards long, runs array<array<string>>")
        log.coalesce(1).write.mode("overwrite").json(f"{self.path}/log/{step}")

    def _with_shard(self, keys: DataFrame) -> DataFrame:
        return keys.withColumn("shard", F.pmod("k1", F.lit(self.shards)).cast("int"))

    def _build_filters(self, keys: DataFrame, path: str) -> None:
        self._with_shard(keys).groupBy("shard").applyInArrow(_built, _FILTER).write.mode("overwrite").parquet(path)

    def _update_filters(self, before: list[tuple[str, int]], run: tuple[str, int], step: int) -> list[int]:
        """Writes the filters after a batch; returns shards that ran full, which have no content yet."""
        delta = self.spark.read.parquet(f"{self.path}/runs/{run[0]}").withColumnRenamed("n", "change")
        earlier = self.spark.read.parquet(*(f"{self.path}/runs/{name}" for name, _ in before))
        old = earlier.join(delta.select("k1", "k2"), ["k1", "k2"], "left_semi").groupBy("k1", "k2").agg(F.sum("n").alias("n"))
        now = delta.join(old, ["k1", "k2"], "left").select("k1", "k2", F.coalesce("n", F.lit(0)).alias("was"), (F.coalesce("n", F.lit(0)) + F.col("change")).alias("now"))
        crossed = now.where((F.col("was") >= self.limit) != (F.col("now") >= self.limit)).select("k1", "k2", (F.col("now") >= self.limit).alias("common"))
        changed = self._with_shard(crossed).groupBy("shard").cogroup(self.filters().groupBy("shard")).applyInArrow(_changed, _FILTER)
        changed.write.mode("overwrite").parquet(f"{self.path}/filters/{step}-part")
        part = self.spark.read.schema(_FILTER).parquet(f"{self.path}/filters/{step}-part")
        full = [r[0] for r in part.where("held IS NULL").select("shard").collect()]  # one number per shard at most
        if not full:
            part.write.mode("overwrite").parquet(f"{self.path}/filters/{step}")
        return full

    def cut(self, docs: DataFrame, text_col: str = "text", filter_bytes: int = FILTER_BYTES) -> DataFrame:
        """Documents (all of which are in the index) with n_lines, n_dropped and kept_text."""
        text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
        marked = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns if c.lower() not in RESULTS)).alias("row"), text.alias("t"), F.unhex(F.md5(text)).alias("mark"))
        sent, shards, least = None, self.shards, self.least_chars
        if self.filters().agg(F.coalesce(F.sum(F.octet_length("held")), F.lit(0))).first()[0] <= filter_bytes:
            sent = self.spark.sparkContext.broadcast({r.shard: _restored(r.buckets, bytes(r.held)) for r in self.filters().collect()})
        suspects = marked.select("mark", "t").mapInArrow(lambda b: _suspected(b, sent and sent.value, shards, least), "mark binary, k1 long, k2 long")
        confirmed = suspects.distinct().join(self.common(), ["k1", "k2"])  # distinct: copies of a text ask once
        gone = confirmed.groupBy("mark").agg(F.collect_list(F.struct("k1", "k2")).alias("gone"))  # lines of one text
        schema = marked.select("row").schema.add("n_lines", "long").add("n_dropped", "long").add("kept_text", "string")
        out = marked.join(gone, "mark", "left").select("row", "t", "gone").mapInArrow(_without, schema)
        return out.select("row.*", *RESULTS)


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    index = LineIndex(spark, scratch_dir(spark, "lines"))
    index.add(docs)
    return index.cut(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))
