"""Hard negatives from blocks of vectors in Hilbert order, chosen by zone maps.

Vectors are written once as Parquet blocks of ``BLOCK`` rows of one label and length, in the order of a
Hilbert curve through their ``AXES`` most varied components. Every block carries the least and
greatest value of each component. From these and an anchor, interval arithmetic gives the
least and greatest score any row of the block can have: a block is read for an anchor only if that
range meets one of the windows the anchor still looks for. Scores themselves are exact whole numbers.

Anchors are searched in chunks of at most ``ANCHOR_BYTES``, near ones together, since they are stored in the same order. A
chunk is broadcast; parts (files of blocks) that no block range leads to are not opened, blocks that none leads to
are not scored, and every task keeps the best few rows of each window, which narrows the window for
its later blocks and is all it sends on. No list of candidates is gathered anywhere.

Rows with a null label or vector, or with a null or non-finite component, take no part; neither
do those with a component of 65,536 or more, whose scores would not be exact. Vectors of different length are not
compared; empty ones score 0. Another row is a row of another id, so rows that repeat an
id are not each other's positives, and each of them is an anchor of its own. A null id is never an anchor and
comes last in ties (the greatest 64-bit id stands for it). An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adloom.session import scratch_dir

BLOCK = 256
AXES, BITS = 8, 4  # of the Hilbert curve
SAMPLE = 4096  # rows that settle its axes and their levels
PART_ROWS = 1 << 18
ANCHOR_BYTES = 4 << 20
STEP = 1024  # anchors scored at once
NO_ID = np.iinfo(np.int64).max
_NONE = np.iinfo(np.int64).min + 1  # its negative is a number too
_LARGEST = 1 << 24

_ROW = "length int, label int, curve long, id long, q binary"
_BLOCK = "part int, length int, label int, n int, low binary, high binary, ids binary, q binary"
_FOUND = "anchor int, slot int, id long, score long"


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places of grid cells (rows of whole numbers below ``2 ** bits``) along the Hilbert curve."""
    x = cells.astype(np.int64).T.copy()
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for axis in x:
            swapped = np.where(axis >> bit & 1 == 1, 0, (x[0] ^ axis) & low)
            x[0] ^= np.where(axis >> bit & 1 == 1, low, swapped)
            axis ^= swapped
    for k in range(1, len(x)):
        x[k] ^= x[k - 1]
    turned = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, 0, -1):
        turned ^= np.where(x[-1] >> bit & 1 == 1, (1 << bit) - 1, 0)
    x ^= turned
    place = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, -1, -1):
        for axis in x:
            place = place << 1 | (axis >> bit & 1)
    return place


class Curve(NamedTuple):
    """Axes of the curve and the values at which their levels change."""

    axes: np.ndarray
    cuts: np.ndarray

    @classmethod
    def fit(cls, q: np.ndarray) -> Curve:
        if q.size == 0:
            return cls(np.zeros(0, np.int64), np.zeros((0, 0)))
        axes = np.argsort(-q.var(axis=0), kind="stable")[:AXES]
        return cls(axes, np.quantile(q[:, axes], np.arange(1, 1 << BITS) / (1 << BITS), axis=0).T)

    def places(self, q: np.ndarray) -> np.ndarray:
        cells = np.zeros((len(q), AXES), np.int64)
        for k, (axis, cuts) in enumerate(zip(self.axes, self.cuts, strict=True)):
            if axis < q.shape[1]:
                cells[:, k] = np.searchsorted(cuts, q[:, axis])
        return hilbert(cells, BITS)


def _vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, whole components) of the usable vectors of a batch, by length."""
    column = column.cast(pa.large_list(pa.float64()))
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    values = pc.fill_null(pc.list_flatten(column), np.nan).to_numpy(zero_copy_only=False)
    starts = np.cumsum(np.maximum(lengths, 0)) - np.maximum(lengths, 0)
    for length in np.unique(lengths[lengths >= 0]):
        rows = np.flatnonzero(lengths == length)
        found = np.floor(256 * values[starts[rows][:, None] + np.arange(length)])
        good = (np.abs(found) < _LARGEST).all(axis=1)  # not so for what is not finite
        yield rows[good], found[good].astype(np.int32)


def _keyed(batches: Iterator[pa.RecordBatch], curve: Curve) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, labels = batch.column(0), batch.column(2)
        for rows, q in _vectors(batch.column(1)):
            packed = [x.tobytes() for x in q]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(rows), q.shape[1], np.int32)), labels.take(pa.array(rows)), pa.array(curve.places(q)),
                pc.fill_null(ids.take(pa.array(rows)), NO_ID), pa.array(packed, pa.binary())], ["length", "label", "curve", "id", "q"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of a task as blocks; rows inside one are ordered by id, which settles ties."""
    names = [x.split(" ")[0] for x in _BLOCK.split(", ")]

    def blocks(held: list[tuple], key: tuple) -> pa.RecordBatch:
        ids = np.array([x[0] for x in held], np.int64)
        order = np.argsort(ids, kind="stable")
        q = np.frombuffer(b"".join(x[1] for x in held), np.int32).reshape(len(held), key[1])[order]
        low, high = (q.min(axis=0), q.max(axis=0)) if len(q) else (q, q)
        row = (*key, len(held), low.tobytes(), high.tobytes(), ids[order].tobytes(), q.tobytes())
        kinds = [pa.int32()] * 4 + [pa.binary()] * 4
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names)

    held, key = [], None
    for batch in batches:
        for part, length, label, row_id, q in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
            if held and (key != (part, length, label) or len(held) == BLOCK):
                yield blocks(held, key)
                held = []
            key = (part, length, label)
            held.append((row_id, q))
    if held:
        yield blocks(held, key)


def write_blocks(rows: DataFrame, path: str, *, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | str = "label") -> None:
    """Writes the block table of ``rows`` below ``path``: folders of blocks by part, and their zone maps alone."""
    label = F.col(label) if isinstance(label, str) else label
    usable = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"), label.cast("int").alias("label")).where("v IS NOT NULL AND label IS NOT NULL")
    sample = usable.orderBy(F.xxhash64("id", "v")).limit(SAMPLE).select("v").toArrow().column(0).combine_chunks()
    curve = Curve.fit(max((q for _, q in _vectors(sample)), key=len, default=np.zeros((0, 0), np.int32)))
    spark = rows.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-usable.count() // PART_ROWS))
    # The running number deals equal rows over several parts.
    dealt = (usable.mapInArrow(lambda b: _keyed(b, curve), _ROW).withColumn("running", F.monotonically_increasing_id())
             .repartitionByRange(parts, "length", "label", "curve", "id", "running").sortWithinPartitions("length", "label", "curve", "id"))
    blocks = dealt.select(F.spark_partition_id().alias("part"), "length", "label", "id", "q").mapInArrow(_packed, _BLOCK)
    blocks.write.partitionBy("part").parquet(f"{path}/blocks")
    spark.read.schema(_BLOCK).parquet(f"{path}/blocks").drop("ids", "q").write.parquet(f"{path}/zones")


def _anchor_rows(batches: Iterator[pa.RecordBatch], every: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, length, label, ids, q in zip(*(batch.column(c).to_pylist() for c in ("part", "length", "label", "ids", "q")), strict=True):
            found = np.frombuffer(ids, np.int64)
            at = np.flatnonzero((found % every == 0) & (found != NO_ID))
            vectors = np.frombuffer(q, np.int32).reshape(len(found), length)[at]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(at), part, np.int32)), pa.array(np.full(len(at), length, np.int32)), pa.array(np.full(len(at), label, np.int32)),
                pa.array(found[at]), pa.array([x.tobytes() for x in vectors], pa.binary())], ["part", "length", "label", "id", "q"])


def _write_anchors(blocks: DataFrame, every: int, path: str) -> int:
    """Numbers the anchors in block order and writes them by chunk; returns the number of chunks."""
    spark = blocks.sparkSession
    blocks.mapInArrow(lambda b: _anchor_rows(b, every), "part int, length int, label int, id long, q binary").write.parquet(f"{path}/found")
    found = spark.read.parquet(f"{path}/found")
    longest = found.agg(F.max("length")).first()[0]
    if longest is None:
        return 0
    size = max(1, ANCHOR_BYTES // (4 * max(longest, 1)))
    # One row per part passes through the first window; a part holds a bounded number of rows.
    starts = found.groupBy("part").agg(F.count("*").alias("n")).select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("start"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy("length", "label", "id", "q")) - 1
    numbered = found.withColumn("inside", inside).join(starts, "part").withColumn("number", F.col("start") + F.col("inside"))
    numbered.select(F.expr(f"number div {size}").alias("chunk"), "number", "length", "label", "id", "q").write.partitionBy("chunk").parquet(f"{path}/chunks")
    return spark.read.parquet(f"{path}/chunks").agg(F.max("chunk")).first()[0] + 1


class Anchors(NamedTuple):
    """Anchors of one length in a chunk. ``low`` and ``high`` are windows of scores (none: low above
    high); ``same`` tells whether rows of the anchor's label are wanted, or those of others."""

    numbers: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    q: np.ndarray
    low: np.ndarray
    high: np.ndarray
    same: bool
    keep: int

    def ranges(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score of each anchor with any vector between ``low`` and ``high``."""
        up, down = np.maximum(self.q, 0), np.minimum(self.q, 0)
        low, high = low.astype(np.int64), high.astype(np.int64)
        return up @ low + down @ high, up @ high + down @ low

    def wanting(self, label: int, low: np.ndarray, high: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Which windows (anchors x slots) a block of this zone may hold rows for."""
        lowest, highest = self.ranges(low, high)
        fits = (self.labels == label) == self.same
        return fits[:, None] & (highest[:, None] >= least) & (lowest[:, None] <= self.high) & (least <= self.high)


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products, in the fastest arithmetic that holds them."""
    bound = max(a.shape[1], 1) * int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0))
    kind = np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64
    return (a.astype(kind) @ b.T.astype(kind)).astype(np.int64, copy=False)


class _Best:
    """The best rows so far of every window: score descending, then id."""

    def __init__(self, anchors: Anchors) -> None:
        self.anchors, self.keep = anchors, anchors.keep
        self.slots = anchors.low.shape[1]
        self.scores = np.full((anchors.low.size, self.keep), _NONE)
        self.ids = np.full((anchors.low.size, self.keep), NO_ID)
        self.least = anchors.low.copy()

    def add(self, windows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        touched, place = np.unique(windows, return_inverse=True)
        all_w = np.concatenate([np.repeat(np.arange(len(touched)), self.keep), place])
        all_s = np.concatenate([self.scores[touched].ravel(), scores])
        all_i = np.concatenate([self.ids[touched].ravel(), ids])
        order = np.lexsort((all_i, -all_s, all_w))
        rank = np.arange(len(order)) - np.searchsorted(all_w[order], all_w[order])
        first = order[rank < self.keep]
        self.scores[touched] = all_s[first].reshape(len(touched), self.keep)
        self.ids[touched] = all_i[first].reshape(len(touched), self.keep)
        flat = self.least.reshape(-1)
        flat[touched] = np.maximum(flat[touched], self.scores[touched, -1])

    def scan(self, label: int, low: np.ndarray, high: np.ndarray, ids: np.ndarray, q: np.ndarray) -> None:
        a = self.anchors
        wanted = a.wanting(label, low, high, self.least)
        rows = np.flatnonzero(wanted.any(axis=1))
        for at in range(0, len(rows), STEP):
            some = rows[at : at + STEP]
            scores = _scores(a.q[some], q)
            if a.same:  # an anchor is not its own positive
                own = np.flatnonzero(np.isin(a.ids[some], ids))
                scores[own] = np.where(a.ids[some][own][:, None] == ids, _NONE, scores[own])
            for slot in range(self.slots):
                here = np.flatnonzero(wanted[some, slot])
                if not len(here):
                    continue
                held = np.where(scores[here] <= a.high[some[here], slot][:, None], scores[here], _NONE)
                least = self.least[some[here], slot]
                if held.shape[1] >= self.keep:  # that many rows reach the least of as many maxima
                    maxima = np.stack([held[:, k :: self.keep].max(axis=1) for k in range(self.keep)])
                    least = np.maximum(least, maxima.min(axis=0))
                row, column = np.nonzero(held >= np.maximum(least, _NONE + 1)[:, None])
                if len(row):
                    self.add(some[here][row] * self.slots + slot, held[row, column], ids[column])

    def rows(self) -> pa.RecordBatch:
        window, place = np.nonzero(self.scores != _NONE)
        return pa.RecordBatch.from_arrays([
            pa.array(self.anchors.numbers[window // self.slots].astype(np.int32)), pa.array((window % self.slots).astype(np.int32)),
            pa.array(self.ids[window, place]), pa.array(self.scores[window, place])], ["anchor", "slot", "id", "score"])


def _zone(row: dict) -> tuple[int, np.ndarray, np.ndarray]:
    return row["label"], np.frombuffer(row["low"], np.int32), np.frombuffer(row["high"], np.int32)


def _parts(batches: Iterator[pa.RecordBatch], chunk: dict[int, Anchors]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seen = {r["part"] for r in batch.to_pylist() if r["length"] in chunk and chunk[r["length"]].wanting(*_zone(r), chunk[r["length"]].low).any()}
        yield pa.RecordBatch.from_arrays([pa.array(sorted(seen), pa.int32())], ["part"])


def _search(batches: Iterator[pa.RecordBatch], chunk: dict[int, Anchors]) -> Iterator[pa.RecordBatch]:
    best = {length: _Best(anchors) for length, anchors in chunk.items()}
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            if row["length"] in best:
                q = np.frombuffer(row["q"], np.int32).reshape(row["n"], row["length"])
                best[row["length"]].scan(*_zone(row), np.frombuffer(row["ids"], np.int64), q)
    yield from (b.rows() for b in best.values())


def _best_rows(spark: SparkSession, path: str, chunk: dict[int, Anchors], keep: int) -> DataFrame:
    """(anchor, slot, id, score, rank) of the best rows of each window of a chunk."""
    sent = spark.sparkContext.broadcast(chunk)
    zones = spark.read.parquet(f"{path}/zones")
    parts = [r[0] for r in zones.mapInArrow(lambda b: _parts(b, sent.value), "part int").distinct().collect()]  # one number per PART_ROWS rows
    blocks = spark.read.schema(_BLOCK).parquet(f"{path}/blocks").where(F.col("part").isin(parts))
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")
    found = blocks.mapInArrow(lambda b: _search(b, sent.value), _FOUND)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def _chunk(rows: pa.Table, positives: int) -> dict[int, Anchors]:
    lengths, out = np.array(rows["length"]), {}
    for length in np.unique(lengths):
        own = rows.filter(pa.array(lengths == length))
        q = np.frombuffer(b"".join(own["q"].to_pylist()), np.int32).reshape(own.num_rows, length).astype(np.int64)
        low, high = np.full((own.num_rows, 1), _NONE), np.full((own.num_rows, 1), NO_ID)
        out[int(length)] = Anchors(np.arange(len(lengths))[lengths == length], np.array(own["id"]), np.array(own["label"]), q, low, high, True, positives)
    return out


def mine(rows: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | str = "label", every: int = 50,
         positives: int = 5, negatives: int = 3, percent: tuple[int, int] = (50, 95)) -> DataFrame:
    """Per anchor (ids divisible by ``every``) and each of its first ``positives``, the first ``negatives``
    rows of other labels whose scores lie between these percentages of the positive's score.

    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = rows.sparkSession
    path = scratch_dir(spark, "hard-negatives")
    write_blocks(rows, path, id_col=id_col, vector_col=vector_col, label=label)
    chunks = _write_anchors(spark.read.schema(_BLOCK).parquet(f"{path}/blocks"), every, f"{path}/anchors")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    for k in range(chunks):
        held = spark.read.parquet(f"{path}/anchors/chunks").where(F.col("chunk") == k).toArrow()
        chunk = _chunk(held, positives)
        found = _best_rows(spark, path, chunk, positives).toArrow()  # at most ``positives`` rows per anchor of the chunk
        scores = np.full((held.num_rows, positives), _NONE)
        ids = np.full((held.num_rows, positives), NO_ID)
        at = np.array(found["anchor"], np.int64), np.array(found["rank"], np.int64) - 1
        scores[at], ids[at] = np.array(found["score"], np.int64), np.array(found["id"], np.int64)
        known = np.maximum(scores, -1)  # negative scores open no window
        low, high = -(-known * percent[0] // 100), known * percent[1] // 100
        low, high = np.where(known < 0, 1, low), np.where(known < 0, 0, high)
        chunk = {n: a._replace(low=low[a.numbers], high=high[a.numbers], same=False, keep=negatives) for n, a in chunk.items()}
        slots = spark.createDataFrame(pa.table({
            "anchor": pa.array(np.repeat(np.arange(held.num_rows, dtype=np.int32), positives)), "slot": pa.array(np.tile(np.arange(positives, dtype=np.int32), held.num_rows)),
            "anchor_id": pa.array(np.repeat(np.array(held["id"], np.int64), positives)), "positive_id": pa.array(ids.ravel()), "positive_score": pa.array(scores.ravel())}))
        result = _best_rows(spark, path, chunk, negatives).join(slots, ["anchor", "slot"])
        real = lambda c: F.when(F.col(c) != int(NO_ID), F.col(c))
        (result.select("anchor_id", real("positive_id").alias("positive_id"), "rank", real("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
         .write.mode("append").parquet(f"{path}/found"))
    return spark.read.schema(schema).parquet(f"{path}/found") if chunks else spark.createDataFrame([], schema)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), label=moved)
