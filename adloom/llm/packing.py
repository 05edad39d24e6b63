"""Best-fit packing of tokenised documents by large-item matching.

Documents are tokenised whole, end with id 0, and only those longer than ``capacity`` are cut:
into full pieces, with what is left as a shorter first piece. The packing plan needs the
histogram of piece lengths alone (at most ``capacity`` numbers, whatever the table's
size): pieces above a third of the capacity are matched greedily, longest first, each with
the longest pieces that still fit (two in a bin, a third where it fits), and smaller pieces
then fill the gaps, longest first, each in the tightest gap. Bins of one pattern are planned in runs, so the plan is a
short list too. Every piece gets a rank among the pieces of its length (counted in
parallel over hash buckets), and finds its bin and offset in the plan by that rank.

A null text is an empty one (one piece: id 0). Equal documents are told apart by their
rank only; repeated rows are packed as often as they occur. No rows give no pieces.
"""

from __future__ import annotations

import json
import re
import sys
import zlib
from array import array
from bisect import bisect_right, insort
from collections.abc import Iterator
from functools import cached_property
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.llm.textops import some_rows
from adloom.session import scratch_dir

END_ID = 0
_CACHE_WORDS = 600_000  # parts with their ids, some 100 MB
_KEPT_WORDS = 100_000  # of them between tasks
_SPACE_RUN = re.compile(r"\s |  |\s$| \s")
_SINGLE_SPACE = re.compile(r"(?<=\S) (?=\S)")


# Fixed value: how byte-level BPE files of this kind cut a text before merging.
CUT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_signs() -> dict[str, int]:
    """The signs that stand for the 256 bytes in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = {chr(b): b for b in plain}
    signs.update({chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)})
    return signs


def _rank_encoder(path: str):
    """The same ids by merge ranks, which is faster for single words; None if the file's ids
    are not its merge order or its settings differ from plain byte-level BPE."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    cut, model = spec.get("pre_tokenizer") or {}, spec["model"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
    vocab = model["vocab"]
    order = [vocab.get("".join(m), -1) for m in merges]
    if (model.get("type", "BPE") != "BPE" or spec.get("normalizer") or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space")
            or not cut.get("use_regex", True) or model.get("dropout") or model.get("ignore_merges") or order != sorted(order)):
        return None
    signs, special = byte_signs(), {t["content"] for t in spec.get("added_tokens", [])}
    ranks = {bytes(signs[c] for c in token): i for token, i in vocab.items() if token not in special}
    return tiktoken.Encoding("byte-level", pat_str=CUT_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


class Tokenizer:
    """Ids of a byte-level BPE file as packed little-endian 32-bit numbers.

    The tokenizer never joins across a single blank between two visible characters, so
    texts are encoded in such parts and the parts' ids are kept for the next time. Texts that
    contain an added token of the file (such as an end-of-text mark) are encoded whole by its own model."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            added = {t["content"] for t in json.load(file).get("added_tokens", [])}
        self._path = path
        self._added = re.compile("|".join(map(re.escape, sorted(added)))) if added else None
        self._fast = _rank_encoder(path)
        self._known: dict[str, bytes] = {}

    @cached_property
    def _model(self):
        """The library's own model, made only when a text needs it."""
        from tokenizers import Tokenizer as Model

        return Model.from_file(self._path)

    def forget(self, kept: int) -> None:
        """Keeps the ids of that many parts; frequent ones came first."""
        self._known = dict(islice(self._known.items(), kept))

    def encode(self, text: str) -> bytes:
        if self._added and self._added.search(text):
            return self._packed(self._model.encode(text, add_special_tokens=False).ids)
        parts = _SINGLE_SPACE.split(text) if _SPACE_RUN.search(text) else text.split(" ")
        parts[1:] = [" " + p for p in parts[1:]]
        known = self._known
        try:
            return b"".join([known[p] for p in parts])
        except KeyError:
            pass
        if len(known) > _CACHE_WORDS:
            self.forget(_CACHE_WORDS // 2)
            known = self._known
        out = []
        for part in parts:
            ids = known.get(part)
            if ids is None:
                ids = self._encode(part)
                if len(part) <= 100:
                    known[part] = ids
            out.append(ids)
        return b"".join(out)

    def _encode(self, part: str) -> bytes:
        return self._packed(self._fast(part) if self._fast else self._model.encode(part, add_special_tokens=False).ids)

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        return array("I", ids).tobytes() if sys.byteorder == "little" else np.array(ids, dtype="<u4").tobytes()


_loaded: dict[str, Tokenizer] = {}  # a worker process serves many tasks


def _tokenizer(path: str) -> Tokenizer:
    if path not in _loaded:
        _loaded[path] = Tokenizer(path)
    return _loaded[path]


def _pieces(batches: Iterator[pa.RecordBatch], path: str, capacity: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    tokenizer = _tokenizer(path)
    end = np.array([END_ID], dtype="<u4").tobytes()
    for batch in some_rows(batches):
        rows, piece, start, length, crc, ids = [], [], [], [], [], []
        for row, text in enumerate(batch.column(1).to_pylist()):
            data = tokenizer.encode(text or "") + end
            n = len(data) // 4
            at, k = 0, 0
            while at < n:
                size = capacity if (n - at) % capacity == 0 else (n - at) % capacity
                part = data[4 * at : 4 * (at + size)]
                rows.append(row)
                piece.append(k)
                start.append(at)
                length.append(size)
                crc.append(zlib.crc32(part))
                if with_ids:
                    ids.append(np.frombuffer(part, dtype="<u4").astype(np.int32))
                at, k = at + size, k + 1
        columns = [batch.column(0).take(pa.array(rows, pa.int64())), *(pa.array(x, pa.int64()) for x in (piece, start, length, crc))]
        names = ["_id", "piece", "start", "length", "ids_crc32"]
        if with_ids:
            columns.append(pa.array(ids, pa.list_(pa.int32())))
            names.append("ids")
        yield pa.RecordBatch.from_arrays(columns, names)
    tokenizer.forget(_KEPT_WORDS)


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """(lengths in a bin, number of such bins) from the number of pieces of each length.

    Matches pieces above a third of the capacity first, then best-fits the rest, always in
    runs of equal bins: the number of runs depends on the number of lengths only."""
    left = {n: c for n, c in counts.items() if c > 0}
    third = capacity / 3
    large = sorted(n for n in left if n > third)
    runs: list[list] = []  # [lengths, gap, bins]

    def take(length: int, number: int, pool: list[int]) -> None:
        left[length] -= number
        if not left[length]:
            del left[length]
            pool.remove(length)

    while large:
        a = large[-1]
        gap = capacity - a
        if 2 * a <= capacity:
            bins, odd = divmod(left[a], 2)
            if bins:
                runs.append([[a, a], gap - a, bins])
                take(a, 2 * bins, large)
            if odd:
                others = [n for n in large if n <= gap and (n != a or left.get(a, 0) > 1)]
                partner = others[-1] if others else None
                take(a, 1, large)
                if partner is None:
                    runs.append([[a], gap, 1])
                else:
                    take(partner, 1, large)
                    runs.append([[a, partner], gap - partner, 1])
            continue
        at = bisect_right(large, gap) - 1
        if at < 0:
            runs.append([[a], gap, left[a]])
            take(a, left[a], large)
            continue
        b = large[at]
        bins = min(left[a], left[b])
        runs.append([[a, b], gap - b, bins])
        take(a, bins, large)
        take(b, bins, large)

    # Gaps in order; the small pieces, longest first, each to the tightest gap.
    gaps: dict[int, list[list]] = {}
    for run in runs:
        gaps.setdefault(run[1], []).append(run)
    order = sorted(gaps)
    done: list[list] = []
    for length in sorted((n for n in left), reverse=True):
        number = left[length]
        while number:
            at = bisect_right(order, length - 1)
            if at == len(order):
                per = capacity // length
                whole, rest = divmod(number, per)
                for size, bins in ((per, whole), (rest, 1)):
                    if size and bins:
                        run = [[length] * size, capacity - size * length, bins]
                        if run[1] not in gaps:
                            gaps[run[1]] = []
                            insort(order, run[1])
                        gaps[run[1]].append(run)
                break
            gap = order[at]
            run = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap]
                order.pop(at)
            fit = gap // length
            bins, rest = run[2], 0
            if number >= bins * fit:
                filled = [(fit, bins)]
            else:
                full, rest = divmod(number, fit)
                filled = [(fit, full), (rest, 1 if rest else 0), (0, bins - full - (1 if rest else 0))]
            for size, n in filled:
                if not n:
                    continue
                number -= size * n
                new = [run[0] + [length] * size, gap - size * length, n]
                if new[1] == 0:
                    done.append(new)
                    continue
                if new[1] not in gaps:
                    gaps[new[1]] = []
                    insort(order, new[1])
                gaps[new[1]].append(new)
    done.extend(run for runs_of in gaps.values() for run in runs_of)
    return [(run[0], run[2]) for run in done]


def _segments(plan: list[tuple[list[int], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """By length: first rank, pieces per bin, first bin and offset of each stretch of ranks."""
    found: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    first = 0
    for lengths, bins in plan:
        offset = 0
        for length in sorted(set(lengths), reverse=True):
            per = lengths.count(length)
            found.setdefault(length, []).append((used.get(length, 0), per, first, offset))
            used[length] = used.get(length, 0) + per * bins
            offset += per * length
        first += bins
    return {n: tuple(np.array(x, dtype=np.int64) for x in zip(*rows, strict=True)) for n, rows in found.items()}


def _placed(batches: Iterator[pa.RecordBatch], segments: dict[int, tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
        sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        order = np.argsort(length, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
            if not len(rows):
                continue
            begin, per, first, base = segments[int(length[rows[0]])]
            at = np.searchsorted(begin, rank[rows], side="right") - 1
            within = rank[rows] - begin[at]
            sequence[rows] = first[at] + within // per[at]
            offset[rows] = base[at] + within % per[at] * length[rows]
        keep = [n for n in batch.schema.names if n != "rank"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in keep), pa.array(sequence), pa.array(offset)], [*keep, "sequence_id", "offset"])


def pack(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = 2048, with_ids: bool = False) -> DataFrame:
    """Row per piece: the id column, piece, start, length, ids_crc32, (ids,) sequence_id, offset."""
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType
    kinds = T.StructType([T.StructField("_id", id_type), *(T.StructField(x, T.LongType()) for x in ("piece", "start", "length", "ids_crc32"))])
    if with_ids:
        kinds.add("ids", T.ArrayType(T.IntegerType()))
    path = scratch_dir(spark, "pieces")
    (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
     .mapInArrow(lambda b: _pieces(b, tokenizer_path, capacity, with_ids), kinds).write.parquet(path))
    pieces = spark.read.parquet(path)

    # Ranks among the pieces of a length: counts by hash bucket, then places inside a bucket.
    buckets = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = [c for c in pieces.columns if c != "ids"]
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64(*spread), F.lit(buckets)))
    counts = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("length", "bucket").orderBy(*spread)
    ranked = (dealt.withColumn("within", F.row_number().over(inside) - 1).join(starts, ["length", "bucket"])
              .select(*pieces.columns, (F.col("first") + F.col("within")).alias("rank")))

    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    shared = spark.sparkContext.broadcast(_segments(plan_bins(histogram, capacity)))
    out = T.StructType([*kinds, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    placed = ranked.mapInArrow(lambda b: _placed(b, shared.value), out)
    return placed.withColumnRenamed("_id", id_col)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
