"""Removal of long repeated byte strings by winnowing, with a logarithmic family of prefix fingerprints.

Every byte covered by a string of ``min_bytes`` that also starts anywhere else (same text
included) is removed; strings are judged on the input. Matches never cross texts.

*Sparse suffixes.* Of the suffixes of a text only those starting at a minimiser are
indexed: in any ``min_bytes`` window the leftmost smallest ``SEED``-byte hash names one
position, so equal windows name the same suffix. A suffix entry holds the fingerprint of
its first ``SEED`` bytes (its place in the array), and the fingerprint of the whole stretch
that its windows cover.

*Index family.* A batch of texts becomes a run: its sorted array of distinct prefix fingerprints, each with its number of entries
and its lowest and highest stretch. In each task every chunk of texts gets its own sorted array, and levels of about equal size
merge; the shuffle merges the arrays of all tasks, so a prefix held by a third of all texts is one row per task. Runs are stored
(:class:`SuffixIndex`), and runs of about equal size merge in the same way, so n batches leave O(log n) of them, and a
prefix is looked for in all by one merge. Adding a batch reads no text that came before; which texts hold a repeated string is
then found over all texts of the index. Whoever has one batch alone has one run.

*Long matches.* Stretches under a repeated prefix that are all alike repeat as a whole. Only
stretches that differ under one prefix (the ends of passages, edited copies) are compared
window by window; one representative of each stretch is enough. A prefix with few different
stretches is compared in one task. Under one with very many, no task gathers them: stretches whose
surroundings of the prefix are met once on both sides are left out, and every window of the others is a
row of its own that is counted, and joined, by its 128-bit fingerprint.

Null and short texts have nothing to remove; repeated rows count as repeats; an empty table
gives an empty result. Rows are told apart by id and 128 bits of the text, so repeated or null ids do no harm, and
extra columns of any name are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.llm.textops import _BYTE_VALUES, SpanHashes, by_bytes, mix, sliding_min, some_rows, text_chunks, text_mark
from adloom.session import scratch_dir

SEED = 32
STRETCHES_PER_GROUP = 4096  # of one prefix, compared in one task


def _as_long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


def _sparse_suffixes(column: pa.Array, min_bytes: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Per chunk: row, prefix key, stretch fingerprint, packed place of each suffix entry.

    The place holds the first window's start, the suffix's distance from it and the last
    window's distance from it (16 bits each for the distances)."""
    width = min_bytes - SEED + 1
    for first, data, offsets in text_chunks(column):
        if len(data) < min_bytes:
            continue
        hashes = SpanHashes(data)
        seeds = hashes.of_length(SEED)
        order = (seeds & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(seeds), dtype=np.uint64)
        chosen = (sliding_min(order, width) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        lengths = np.diff(offsets)
        counts = np.maximum(lengths - min_bytes + 1, 0)
        begins = np.cumsum(counts) - counts
        text = np.repeat(np.arange(len(lengths)), counts)
        if not len(text):
            continue
        window = np.arange(len(text)) - begins[text] + offsets[:-1][text]
        anchor = chosen[window]
        new = np.ones(len(window), dtype=bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
        at = np.flatnonzero(new)
        start, end = window[at], window[np.append(at[1:], len(window)) - 1]
        anchor, text = anchor[at], text[at]
        shape = ((anchor - start) << 16) | (end - start)
        stretch = mix(hashes.of(start, end + min_bytes) ^ mix(shape.astype(np.uint64)))
        place = ((start - offsets[text]) << 32) | shape
        yield first + text, seeds[anchor], stretch, place


class SuffixLevels:
    """Sorted arrays of (prefix key, entries, lowest and highest stretch fingerprint)."""

    def __init__(self) -> None:
        self.levels: list[tuple[np.ndarray, ...]] = []

    @staticmethod
    def _merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        key, count, low, high = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(key, kind="stable")  # runs that are sorted already merge in linear time
        key, count, low, high = key[order], count[order], low[order], high[order]
        at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        return key[at], np.add.reduceat(count, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)

    def add(self, key: np.ndarray, stretch: np.ndarray) -> None:
        """The suffix array of a new batch; levels of about equal size merge."""
        if not len(key):
            return
        self.levels.append(self._merged([(key, np.ones(len(key), np.int64), stretch, stretch)]))
        while len(self.levels) > 1 and len(self.levels[-2][0]) < 2 * len(self.levels[-1][0]):
            self.levels[-2:] = [self._merged(self.levels[-2:])]

    def merged(self) -> tuple[np.ndarray, ...] | None:
        return self._merged(self.levels) if self.levels else None


def _prefix_arrays(batches: Iterator[pa.RecordBatch], min_bytes: int) -> Iterator[pa.RecordBatch]:
    index = SuffixLevels()
    for batch in by_bytes(batches, 0, 4 << 20):
        for _, key, stretch, _ in _sparse_suffixes(batch.column(0), min_bytes):
            index.add(key.view(np.int64), stretch.view(np.int64))
    found = index.merged()
    if found is not None:
        for at in range(0, len(found[0]), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(x[at : at + 100_000]) for x in found], ["key", "n", "low", "high"])


_RUN = "key long, n long, low long, high long"


class SuffixIndex:
    """Runs of prefix fingerprints of all texts added so far, stored below ``path``.

    Every state ends with a row of ``log``; an index opened again goes on from the last complete one."""

    def __init__(self, spark: SparkSession, path: str, min_bytes: int = 200) -> None:
        if not SEED <= min_bytes <= 30_000:
            raise ValueError("min_bytes out of range")
        self.spark, self.path, self.min_bytes = spark, path, min_bytes
        self.state, self.runs = 0, []

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> SuffixIndex:
        last = spark.read.json(f"{path}/log/*").orderBy(F.desc("state")).first()
        index = cls(spark, path, last["min_bytes"])
        index.state, index.runs = last["state"], [(name, int(n)) for name, n in last["runs"]]
        return index

    @staticmethod
    def _merged(rows: DataFrame) -> DataFrame:
        return rows.groupBy("key").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))

    def _stored(self, runs: list[tuple[str, int]]) -> DataFrame:
        return self.spark.read.schema(_RUN).parquet(*(f"{self.path}/runs/{name}" for name, _ in runs))

    def _write(self, rows: DataFrame, name: str) -> tuple[str, int]:
        rows.sortWithinPartitions("key").write.mode("overwrite").parquet(f"{self.path}/runs/{name}")
        return name, self._stored([(name, 0)]).count()

    def add(self, docs: DataFrame, text_col: str = "text") -> None:
        """The run of a new batch; runs of about equal size merge."""
        step, least = self.state + 1, self.min_bytes
        arrays = docs.select(F.col(text_col).alias("_text")).mapInArrow(lambda b: _prefix_arrays(b, least), _RUN)
        self.runs.append(self._write(self._merged(arrays), f"{step}-batch"))
        while len(self.runs) > 1 and self.runs[-2][1] < 2 * self.runs[-1][1]:
            last, earlier = self.runs.pop(), self.runs.pop()
            self.runs.append(self._write(self._merged(self._stored([earlier, last])), f"{step}-merged-{len(self.runs)}"))
        self.state = step
        log = self.spark.createDataFrame([(step, least, [list(map(str, r)) for r in self.runs])], "state long, min_bytes long, runs array<array<string>>")
        log.coalesce(1).write.mode("overwrite").json(f"{self.path}/log/{step}")

    def repeated(self) -> DataFrame:
        """(key, mixed) of prefixes met twice or more; mixed if their stretches differ."""
        rows = self._stored(self.runs)
        return (rows if len(self.runs) == 1 else self._merged(rows)).where("n >= 2").select("key", (F.col("low") < F.col("high")).alias("mixed"))

    def cut(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """:func:`cut_repeats` of all texts of the index."""
        return cut_repeats(docs, id_col, text_col, self.min_bytes, self)


def _entries(batches: Iterator[pa.RecordBatch], min_bytes: int) -> Iterator[pa.RecordBatch]:
    for batch in by_bytes(batches, 2, 4 << 20):
        for row, key, stretch, place in _sparse_suffixes(batch.column(2), min_bytes):
            rows = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), _as_long(key), _as_long(stretch), _as_long(place)],
                ["_id", "_h", "key", "stretch", "place"])


def _unpacked(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return place >> 32, (place >> 16) & 0xFFFF, place & 0xFFFF


def _squeeze(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    """Texts as compressed bytes, for the shuffle."""
    squeeze = zstandard.ZstdCompressor(level=3).compress
    for batch in some_rows(batches):
        i = batch.schema.get_field_index(name)
        blobs = pa.array([None if x is None else squeeze(x.encode()) for x in batch.column(i).to_pylist()], pa.binary())
        yield batch.set_column(i, name, blobs)


def _contexts(batches: Iterator[pa.RecordBatch], min_bytes: int) -> Iterator[pa.RecordBatch]:
    """The stretches asked for, cut from their texts: one row per stretch."""
    names = ["key", "alone", "large", "_id", "_h", "place", "bytes"]
    expand = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        ids, hashes = batch.column(0), batch.column(1)
        out: list[list] = [[] for _ in names]
        size = 0
        for row, (blob, wanted) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
            text = expand(blob.as_py()) if blob.is_valid else b""
            for w in wanted.as_py():
                start, _, last = (int(x) for x in _unpacked(np.int64(w["place"])))
                cut = text[start : start + last + min_bytes]
                for column, value in zip(out, (w["key"], w["n"] == 1, w["large"], row, row, w["place"], cut), strict=True):
                    column.append(value)
                size += len(cut)
            if size > 4 << 20 or row == batch.num_rows - 1:
                rows = pa.array(out[3], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int64()), pa.array(out[1], pa.bool_()), pa.array(out[2], pa.bool_()), ids.take(rows), hashes.take(rows),
                     pa.array(out[5], pa.int64()), pa.array(out[6], pa.binary())], names)
                out, size = [[] for _ in names], 0


def _laid_out(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a binary column end to end, and the bounds of its values."""
    ends = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(column.buffers()[2], dtype=np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def _sides(batches: Iterator[pa.RecordBatch], min_bytes: int) -> Iterator[pa.RecordBatch]:
    """Fingerprints of the prefix with what stands before it, and with what stands after it.

    A window holds ``min_bytes - SEED`` bytes besides the prefix, so at least half of them on one
    side: a window that is met again has a side that is met again."""
    half = -(-(min_bytes - SEED) // 2)
    for batch in some_rows(batches, 4_096):
        if not batch.num_rows:
            continue
        start, shift, last = _unpacked(batch.column("place").to_numpy())
        data, ends = _laid_out(batch.column("bytes"))
        hashes, key = SpanHashes(data), mix(batch.column("key").to_numpy().view(np.uint64))
        found = []
        for salt, has, a, b in ((1, shift >= half, shift - half, shift + SEED), (2, shift - last <= min_bytes - SEED - half, shift, shift + SEED + half)):
            side, at = np.zeros(len(key), dtype=np.uint64), np.flatnonzero(has)
            side[at] = mix(hashes.of(ends[at] + a[at], ends[at] + b[at]) ^ key[at]) + np.uint64(salt)
            found.append(pa.array(side.view(np.int64), mask=~has))
        yield pa.RecordBatch.from_arrays([*batch.columns, *found], [*batch.schema.names, "before", "after"])


def _windows(batches: Iterator[pa.RecordBatch], min_bytes: int) -> Iterator[pa.RecordBatch]:
    """Row per window of each stretch: its 128-bit fingerprint under its prefix, and its place in the text."""
    for batch in some_rows(batches, max(1, (1 << 17) // (min_bytes - SEED + 1))):
        if not batch.num_rows:
            continue
        start, _, last = _unpacked(batch.column("place").to_numpy())
        data, ends = _laid_out(batch.column("bytes"))
        key = mix(batch.column("key").to_numpy().view(np.uint64))
        row = np.repeat(np.arange(len(last)), last + 1)
        step = np.arange(len(row)) - np.repeat(np.cumsum(last + 1) - (last + 1), last + 1)
        at, rows = ends[row] + step, pa.array(row)
        value = mix(SpanHashes(data).of(at, at + min_bytes) ^ key[row])
        other = SpanHashes(mix(_BYTE_VALUES[data])).of(at, at + min_bytes)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c).take(rows) for c in ("alone", "_id", "_h")), _as_long(value), _as_long(other), _as_long(((start[row] + step) << 16) | min_bytes)],
            ["alone", "_id", "_h", "value", "other", "span"])


def _group_ends(batch: pa.RecordBatch | pa.Table) -> np.ndarray:
    key = batch.column("key").to_numpy()
    return np.append(np.flatnonzero(key[1:] != key[:-1]) + 1, len(key))


def _repeated_windows(table: pa.Table, min_bytes: int) -> pa.RecordBatch | None:
    """Runs of windows, in stretches met once, that stand in another stretch of their group too."""
    place = table.column("place").to_numpy()
    key = table.column("key").to_numpy()
    alone = table.column("alone").to_numpy(zero_copy_only=False)
    start, _, last = _unpacked(place)
    blob = table.column("bytes").combine_chunks()
    blob = pa.concat_arrays(blob.chunks) if isinstance(blob, pa.ChunkedArray) else blob
    data, ends = _laid_out(blob)
    row = np.repeat(np.arange(len(place)), last + 1)
    step = np.arange(len(row)) - np.repeat(np.cumsum(last + 1) - (last + 1), last + 1)
    if not len(row):
        return None
    at = ends[row] + step
    value = mix(SpanHashes(data).of(at, at + min_bytes) ^ mix(key.view(np.uint64)[row]))
    order = np.argsort(value, kind="stable")  # the suffix order of the windows, up to min_bytes
    alike = value[order][1:] == value[order][:-1]
    repeated = np.zeros(len(row), dtype=bool)
    repeated[order[1:][alike]] = True
    repeated[order[:-1][alike]] = True
    keep = repeated & alone[row]
    row, step = row[keep], step[keep]
    if not len(row):
        return None
    new = np.concatenate(([True], (row[1:] != row[:-1]) | (step[1:] != step[:-1] + 1)))
    first = np.flatnonzero(new)
    final = np.append(first[1:], len(row)) - 1
    rows = pa.array(row[first])
    span = ((start[row[first]] + step[first]) << 16) | (step[final] - step[first] + min_bytes)
    return pa.RecordBatch.from_arrays(
        [table.column("_id").take(rows).combine_chunks(), table.column("_h").take(rows).combine_chunks(), pa.array(span)], ["_id", "_h", "span"])


def _edge_spans(batches: Iterator[pa.RecordBatch], min_bytes: int) -> Iterator[pa.RecordBatch]:
    """Batches are sorted by key; a group may go over several batches."""
    waiting: list[pa.RecordBatch] = []

    def flush(table: pa.Table) -> Iterator[pa.RecordBatch]:
        ends, begin, size = _group_ends(table), 0, 0
        lengths = np.cumsum(pc.binary_length(table.column("bytes")).to_numpy())
        for end in ends:
            if int(lengths[end - 1]) - size > 2 << 20 or end == ends[-1]:
                found = _repeated_windows(table.slice(begin, end - begin), min_bytes)
                if found is not None:
                    yield found
                begin, size = end, int(lengths[end - 1])

    for batch in batches:
        if not batch.num_rows:
            continue
        ends = _group_ends(batch)
        last = int(ends[-2]) if len(ends) > 1 else 0
        if waiting:
            tail = waiting[-1].slice(waiting[-1].num_rows - 1)
            same = tail.column("key")[0].as_py() == batch.column("key")[0].as_py()
            if same and not last:
                waiting.append(batch)
                continue
        if last or waiting:
            head = [*waiting, batch.slice(0, last)] if last else waiting
            yield from flush(pa.Table.from_batches(head))
        waiting = [batch.slice(last)]
    if waiting:
        yield from flush(pa.Table.from_batches(waiting))


def _large_spans(contexts: DataFrame, schema: str, path: str, min_bytes: int) -> DataFrame:
    """Windows that are met again, under prefixes with very many stretches: dealt by window, never by prefix."""
    contexts.mapInArrow(lambda b: _sides(b, min_bytes), f"{schema}, before long, after long").write.parquet(f"{path}/stretches")
    stretches = contexts.sparkSession.read.parquet(f"{path}/stretches")

    def repeated(rows: DataFrame, *by: str) -> DataFrame:
        return rows.groupBy(*by).agg(F.count("*").alias("_n")).where("_n >= 2").repartition(*by, "_n")

    side = F.explode(F.array("before", "after")).alias("side")
    again = repeated(stretches.select(side).where("side is not null"), "side").select("side")
    kept = (stretches.select("*", side).where("side is not null").join(again, "side")
            .drop("side", "before", "after").dropDuplicates(["_id", "_h", "key", "place"]))
    kept.write.parquet(f"{path}/kept")
    id_type = contexts.schema["_id"].dataType.simpleString()
    windows = contexts.sparkSession.read.parquet(f"{path}/kept").mapInArrow(
        lambda b: _windows(b, min_bytes), f"alone boolean, _id {id_type}, _h binary, value long, other long, span long")
    return windows.where("alone").join(repeated(windows, "value", "other"), ["value", "other"]).select("_id", "_h", "span")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = 200, index: SuffixIndex | None = None) -> DataFrame:
    """Row per text with repeats: ``_id``, ``_h`` (128 bits of the text) and ``spans``, a list
    of longs holding start (upper bits) and length (lower 16 bits) of covered runs, which may
    overlap. ``min_bytes`` is from SEED to 30,000. ``index`` holds just these texts; without one, one is made."""
    spark = docs.sparkSession
    if index is None:
        index = SuffixIndex(spark, scratch_dir(spark, "suffix-index"), min_bytes)
        index.add(docs, text_col)
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("_id"), text_mark(text_col).alias("_h"), F.col(text_col).alias("_text"))
    repeated = index.repeated().repartition("key", "mixed")  # dealt anew, so that the join below can split a hot key
    entries = rows.mapInArrow(lambda b: _entries(b, min_bytes), f"_id {id_type}, _h binary, key long, stretch long, place long")
    path = scratch_dir(spark, "suffix-matches")
    entries.join(repeated, "key").write.parquet(f"{path}/matches")
    matches = spark.read.parquet(f"{path}/matches")
    whole = ((F.shiftright("place", 32) * 65536) + F.col("place").bitwiseAND(0xFFFF) + min_bytes).alias("span")
    alike = matches.where("not mixed").select("_id", "_h", whole)

    mixed = matches.where("mixed")
    (mixed.groupBy("key", "stretch").agg(F.count("*").alias("n"), F.min(F.struct("_id", "_h", "place")).alias("one"))
     .write.parquet(f"{path}/stretches"))
    stretches = spark.read.parquet(f"{path}/stretches")
    copied = mixed.join(stretches.where("n >= 2").select("key", "stretch"), ["key", "stretch"]).select("_id", "_h", whole)

    # As many windows at most are compared in one task as STRETCHES_PER_GROUP stretches of 200 bytes have.
    most = max(1, min(STRETCHES_PER_GROUP, STRETCHES_PER_GROUP * 169 // (min_bytes - SEED + 1)))
    sizes = stretches.groupBy("key").agg((F.count("*") > most).alias("large")).repartition("key", "large")
    blobs = rows.mapInArrow(lambda b: _squeeze(b, "_text"), f"_id {id_type}, _h binary, _text binary")
    same = [F.col("w._id").eqNullSafe(F.col("b._id")), F.col("w._h") == F.col("b._h")]
    context = f"key long, alone boolean, large boolean, _id {id_type}, _h binary, place long, bytes binary"
    wanted = (stretches.join(sizes, "key").groupBy(F.col("one._id").alias("_id"), F.col("one._h").alias("_h"))
              .agg(F.collect_list(F.struct("key", "n", "large", F.col("one.place").alias("place"))).alias("wanted")))
    # All texts that hold a stretch move once; the stretches cut from them are stored for both ways on.
    (blobs.alias("b").join(wanted.alias("w"), same).select("w._id", "w._h", "b._text", "w.wanted")
     .mapInArrow(lambda b: _contexts(b, min_bytes), context).write.parquet(f"{path}/contexts"))
    contexts = spark.read.parquet(f"{path}/contexts")
    small, large = (contexts.where(c).drop("large") for c in ("not large", "large"))
    edges = small.repartition("key").sortWithinPartitions("key").mapInArrow(lambda b: _edge_spans(b, min_bytes), f"_id {id_type}, _h binary, span long")
    if not sizes.where("large").isEmpty():
        edges = edges.unionAll(_large_spans(large, context.replace("large boolean, ", ""), f"{path}/large", min_bytes))
    # Equal rows bring the same spans, each of which counts once.
    return alike.unionAll(copied).unionAll(edges).groupBy("_id", "_h").agg(F.collect_set("span").alias("spans"))


def _cut(batches: Iterator[pa.RecordBatch], text_at: int) -> Iterator[pa.RecordBatch]:
    expand = zstandard.ZstdDecompressor().decompress
    for batch in some_rows(batches):
        kept, sizes, removed, runs = [], [], [], []
        for blob, spans in zip(batch.column(text_at), batch.column(batch.num_columns - 1), strict=True):
            text = expand(blob.as_py()) if blob.is_valid else b""
            sizes.append(len(text))
            if not spans.is_valid:
                kept.append(text)
                removed.append(0)
                runs.append(0)
                continue
            span = np.sort(spans.values.to_numpy())
            start, end = span >> 16, np.maximum.accumulate((span >> 16) + (span & 0xFFFF))
            first = np.flatnonzero(np.concatenate(([True], start[1:] > end[:-1])))
            start, end = start[first], end[np.append(first[1:], len(end)) - 1]
            pieces = zip(np.append(0, end), np.append(start, len(text)), strict=True)
            kept.append(b"".join(text[a:b] for a, b in pieces))
            removed.append(int((end - start).sum()))
            runs.append(len(start))
        out = [*batch.columns[:text_at], pa.array(kept, pa.binary()), *batch.columns[text_at + 1 : -1],
               pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64())]
        yield pa.RecordBatch.from_arrays(out, [*batch.schema.names[:-1], "n_bytes", "n_removed", "n_spans"])


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = 200, index: SuffixIndex | None = None) -> DataFrame:
    """``docs`` with the text replaced by its remaining bytes (binary; empty for null), and
    n_bytes, n_removed, n_spans at the end. Cuts may fall inside a character."""
    spans = repeated_spans(docs, id_col, text_col, min_bytes, index)
    names = docs.columns
    at = names.index(text_col)
    # Positional names: extra columns may bear any name.
    plain = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)), text_mark(text_col).alias("_h"))
    kinds = [T.StructField(f"c{i}", T.BinaryType() if i == at else f.dataType) for i, f in enumerate(docs.schema)]
    blobs = plain.mapInArrow(lambda b: _squeeze(b, f"c{at}"), T.StructType([*kinds, T.StructField("_h", T.BinaryType())]))
    same = [F.col(f"b.c{names.index(id_col)}").eqNullSafe(F.col("s._id")), F.col("b._h") == F.col("s._h")]
    joined = blobs.alias("b").join(spans.alias("s"), same, "left").select(*(f"b.c{i}" for i in range(len(names))), "s.spans")
    counts = [T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")]
    out = joined.mapInArrow(lambda b: _cut(b, at), T.StructType([*kinds, *counts]))
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(names)), "n_bytes", "n_removed", "n_spans")


def op7_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    index = SuffixIndex(spark, scratch_dir(spark, "suffix-index"))
    index.add(docs)
    return index.cut(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("text", 256).alias("kept_sha256"))
