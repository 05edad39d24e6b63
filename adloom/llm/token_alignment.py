"""Alignment of the tokens that two tokenizers make of the same text.

Both token sequences of a text end at byte offsets. One NumPy state vector holds an A and a B pointer for every
lane; each step links the tokens all lanes point at, marks a cut where both end at the same byte, and advances
the pointer whose token ends first (both at a cut). Lanes that are through are dropped from the vector. A document is one lane; a long
one is dealt into several at offsets where both tokenizers cut, so the number of steps
does not follow the longest text.

Token links of a corpus are counted by the number of documents that hold a pair of ids. Each document's pairs are
written once, as sorted differences; counts are broadcast if the repeated pairs are few enough (``PAIRS``), else pairs
and counts are joined. Both give the same rows.

Texts that are null or empty, or that a tokenizer does not give back byte for byte, have no tokens: zeros and an empty
string. Special tokens are plain text. Repeated rows and ids are documents of their own. Very long texts are encoded in pieces cut
before a blank between two word signs, which neither tokenizer joins. Columns of the input are
kept; those named like a result are replaced by it. An empty table gives none.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.llm.packing import CUT_PATTERN, byte_signs
from adloom.llm.textops import by_bytes
from adloom.session import scratch_dir

LANE = 512  # A tokens of a lane, about
PIECE = 1 << 15  # characters encoded at once, about
PAIRS = 4_000_000  # repeated pairs broadcast at most, 16 bytes each
_GROUPED = 1 << 20  # links counted together in a task
_BREAK = re.compile(r"(?<=\w) (?=\w)")
RESULTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


class ByteBpe:
    """Byte-level BPE by merge ranks, with the bytes of every token."""

    def __init__(self, path: str) -> None:
        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        signs, special = byte_signs(), {t["content"] for t in spec.get("added_tokens", [])}
        self.tokens = {i: bytes(signs[c] for c in token) for token, i in spec["model"]["vocab"].items() if token not in special}
        self.size = max(spec["model"]["vocab"].values()) + 1
        self._encode = tiktoken.Encoding("byte-level", pat_str=CUT_PATTERN, mergeable_ranks={t: i for i, t in self.tokens.items()}, special_tokens={}).encode_ordinary

    def ids(self, piece: str) -> list[int]:
        return self._encode(" " + piece)


class PieceBpe:
    """Sentence pieces with byte fallback; the model puts the blank before a text itself."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self._model.get_piece_size()
        self.tokens = {i: self._bytes(i) for i in range(self.size) if not self._model.is_control(i) and not self._model.is_unknown(i)}

    def _bytes(self, i: int) -> bytes:
        piece = self._model.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if self._model.is_byte(i) else piece.replace("▁", " ").encode()

    def ids(self, piece: str) -> list[int]:
        return self._model.encode(piece, num_threads=1)


class Tokens:
    """Ids of one text with the byte offsets at which they end, or None if they don't give the text back."""

    def __init__(self, model: ByteBpe | PieceBpe) -> None:
        self.model = model
        self.size = model.size
        self.bytes = [model.tokens.get(i, b"") for i in range(model.size)]
        self.lengths = np.array([len(x) for x in self.bytes], np.int64)

    @cached_property
    def names(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids as text, ending with a comma or with the sign after the last of a group."""
        return tuple(np.array([f"{i}{sign}" for i in range(self.size)], dtype=object) for sign in (",", "|;"[isinstance(self.model, PieceBpe)]))

    def of(self, text: str) -> np.ndarray | None:
        parts, expected = [], " " + text
        for piece in _pieces(text):
            ids = self.model.ids(piece)
            if b"".join([self.bytes[i] for i in ids]) != (" " + piece).encode():
                return None
            parts.append(np.array(ids, np.int64))
        return np.concatenate(parts) if len(expected) > 1 else None


def _pieces(text: str) -> Iterator[str]:
    """Parts of a text, joined by single blanks."""
    start = 0
    while len(text) - start > 2 * PIECE:
        found = _BREAK.search(text, start + PIECE)
        if found is None:
            break
        yield text[start : found.start()]
        start = found.end()
    yield text[start:]


def _lanes(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[list[int], list[int]]:
    """First A and B tokens of the lanes of one document: about every ``LANE`` A tokens, after an offset where
    both cut."""
    first_a, first_b = [0], [0]
    at = LANE
    while at < len(ends_a) - LANE // 2:
        width, found = 32, None
        while found is None and at < len(ends_a):
            some = ends_a[at : at + width]
            place = np.searchsorted(ends_b, some)
            same = np.flatnonzero(ends_b[np.minimum(place, len(ends_b) - 1)] == some)
            if len(same):
                found = at + same[0] + 1, place[same[0]] + 1
            at += len(some)
            width *= 2
        if found is None or found[0] >= len(ends_a):
            break
        first_a.append(int(found[0]))
        first_b.append(int(found[1]))
        at = found[0] + LANE
    return first_a, first_b


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray, stop_a: np.ndarray) -> tuple[np.ndarray, ...]:
    """Links (A place, B place) and cuts (A place, B place) of all lanes, ordered by place.

    A lane runs from its first tokens to before A place ``stop_a``; both sequences of a lane end
    at the same offset."""
    a, b, stop = first_a.copy(), first_b.copy(), stop_a.copy()
    links_a, links_b, cuts_a, cuts_b = [], [], [], []
    while len(a):
        links_a.append(a)
        links_b.append(b)
        end_a, end_b = ends_a[a], ends_b[b]
        cut = end_a == end_b
        cuts_a.append(a[cut])
        cuts_b.append(b[cut])
        a, b = a + (end_a <= end_b), b + (end_b <= end_a)
        going = a < stop
        if not going.all():
            a, b, stop = a[going], b[going], stop[going]
    none = np.zeros(0, np.int64)
    links_a, links_b, cuts_a, cuts_b = (np.concatenate([none, *x]) for x in (links_a, links_b, cuts_a, cuts_b))
    order = np.lexsort((links_b, links_a))
    return links_a[order], links_b[order], np.sort(cuts_a), np.sort(cuts_b)


def _starts(lengths: list[int]) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(np.array(lengths, np.int64))))


class Aligned:
    """Tokens, links and cuts of some texts."""

    def __init__(self, texts: list[str | None], a: Tokens, b: Tokens) -> None:
        none = np.zeros(0, np.int64)
        ids_a, ids_b = [], []
        for text in texts:
            own_b = b.of(text) if text else None
            own_a = None if own_b is None else a.of(text)
            ids_a.append(none if own_a is None else own_a)
            ids_b.append(none if own_a is None else own_b)
        self.first_a, self.first_b = _starts([len(x) for x in ids_a]), _starts([len(x) for x in ids_b])
        self.a, self.b = np.concatenate([none, *ids_a]), np.concatenate([none, *ids_b])
        ends_a, ends_b = np.cumsum(a.lengths[self.a]), np.cumsum(b.lengths[self.b])  # the texts laid end to end
        lane_a, lane_b = [none], [none]
        for k in range(len(texts)):
            if len(ids_a[k]):
                own = _lanes(ends_a[self.first_a[k] : self.first_a[k + 1]], ends_b[self.first_b[k] : self.first_b[k + 1]])
                lane_a.append(self.first_a[k] + np.array(own[0], np.int64))
                lane_b.append(self.first_b[k] + np.array(own[1], np.int64))
        lane_a, lane_b = np.concatenate(lane_a), np.concatenate(lane_b)
        self.link_a, self.link_b, self.cut_a, self.cut_b = lockstep(ends_a, ends_b, lane_a, lane_b, np.append(lane_a[1:], len(self.a)) if len(lane_a) else lane_a)

    def per_text(self, places: np.ndarray) -> np.ndarray:
        """Bounds, in a sorted list of A places, of every text."""
        return np.searchsorted(places, self.first_a)

    def group_texts(self, a: Tokens, b: Tokens) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of every text."""
        parts = []
        for ids, cuts, names in ((self.a, self.cut_a, a.names), (self.b, self.cut_b, b.names)):
            last = np.zeros(len(ids), bool)
            last[cuts] = True
            parts.append((np.cumsum(last) - last, np.where(last, names[1][ids], names[0][ids])))
        groups = np.concatenate([2 * parts[0][0], 2 * parts[1][0] + 1])
        signs = np.concatenate([parts[0][1], parts[1][1]])[np.argsort(groups, kind="stable")].tolist()
        bounds = self.first_a + self.first_b
        return ["".join(signs[s:e])[:-1] for s, e in zip(bounds[:-1], bounds[1:], strict=True)]


_models: dict[tuple[str, str], tuple[Tokens, Tokens]] = {}  # of this worker; bounded by the vocabularies


def _loaded(path_a: str, path_b: str) -> tuple[Tokens, Tokens]:
    if (path_a, path_b) not in _models:
        _models.clear()
        _models[path_a, path_b] = Tokens(ByteBpe(path_a)), Tokens(PieceBpe(path_b))
    return _models[path_a, path_b]


_ALIGNED = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"


def _aligned(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str) -> Iterator[pa.RecordBatch]:
    a, b = _loaded(path_a, path_b)
    for batch in by_bytes(batches, column=1, limit=1 << 19, rows=512):
        found = Aligned(batch.column(1).to_pylist(), a, b)
        n = batch.num_rows
        links, cuts = found.per_text(found.link_a), found.per_text(found.cut_a)
        digests = [hashlib.sha256(x.encode()).hexdigest() if x else "" for x in found.group_texts(a, b)]
        code = found.a[found.link_a] * b.size + found.b[found.link_b]
        pairs, times = [], []
        for s, e in zip(links[:-1], links[1:], strict=True):
            own, often = np.unique(code[s:e], return_counts=True)
            pairs.append(np.diff(own, prepend=0).astype(np.uint32 if a.size * b.size < 1 << 32 else np.uint64).tobytes())
            times.append(often.astype(np.uint32).tobytes())
        long = lambda x: pa.array(x, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), long(np.diff(found.first_a)), long(np.diff(found.first_b)), long(np.diff(cuts)), long(np.diff(links)),
             pa.array(digests, pa.string()), pa.array(pairs, pa.binary()), pa.array(times, pa.binary())],
            ["row", *(x.split(" ")[0] for x in _ALIGNED.split(", "))])
        assert n == len(digests)


def _codes(pairs: bytes, wide: bool) -> np.ndarray:
    return np.cumsum(np.frombuffer(pairs, np.uint64 if wide else np.uint32).astype(np.int64))


def _counted(batches: Iterator[pa.RecordBatch], wide: bool) -> Iterator[pa.RecordBatch]:
    def counted(held: list[np.ndarray]) -> pa.RecordBatch:
        codes, n = np.unique(np.concatenate([np.zeros(0, np.int64), *held]), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n.astype(np.int64))], ["code", "n"])

    held, size = [], 0
    for batch in batches:
        for pairs in batch.column(0):
            held.append(_codes(pairs.as_buffer(), wide))
            size += len(held[-1])
            if size >= _GROUPED:
                yield counted(held)
                held, size = [], 0
    yield counted(held)


def _summed(batches: Iterator[pa.RecordBatch], counts: tuple[np.ndarray, np.ndarray], best: np.ndarray, size_b: int, wide: bool) -> Iterator[pa.RecordBatch]:
    """Sums over the links of a text; pairs without a count are held by one document."""
    known, often = counts
    for batch in batches:
        best_of, sums = [], []
        for pairs, times in zip(batch.column(1), batch.column(2), strict=True):
            code, n = _codes(pairs.as_buffer(), wide), np.frombuffer(times.as_buffer(), np.uint32).astype(np.int64)
            count = np.ones(len(code), np.int64)
            if len(known):
                at = np.minimum(np.searchsorted(known, code), len(known) - 1)
                count = np.where(known[at] == code, often[at], 1)
            best_of.append(int(n[count == best[code // size_b]].sum()))
            sums.append(int((n * count).sum()))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best_of, pa.int64()), pa.array(sums, pa.int64())], ["row", "n_best", "count_sum"])


def _exploded(batches: Iterator[pa.RecordBatch], wide: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for number, pairs, times in zip(*batch.columns, strict=True):
            code, n = _codes(pairs.as_buffer(), wide), np.frombuffer(times.as_buffer(), np.uint32).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(code), number.as_py(), np.int64)), pa.array(code), pa.array(n)], ["number", "code", "times"])


def align(docs: DataFrame, path_a: str, path_b: str, text_col: str = "text", pairs: int = PAIRS) -> DataFrame:
    """Documents with the sizes of their alignment, and sums of the corpus-wide counts of their links."""
    spark = docs.sparkSession
    path = scratch_dir(spark, "alignment")
    kept = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns if c.lower() not in RESULTS)).alias("row"), F.col(text_col).cast("string").alias("t"))
    schema = kept.select("row").schema
    for field in _ALIGNED.split(", "):
        schema = schema.add(*field.split(" "))
    (kept.mapInArrow(lambda b: _aligned(b, path_a, path_b), schema).withColumn("number", F.monotonically_increasing_id())
     .write.option("compression", "zstd").parquet(f"{path}/aligned"))
    aligned = spark.read.parquet(f"{path}/aligned")
    size_a, size_b = ByteBpe(path_a).size, PieceBpe(path_b).size
    wide = size_a * size_b >= 1 << 32
    (aligned.select("pairs").mapInArrow(lambda b: _counted(b, wide), "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
     .write.parquet(f"{path}/counts"))
    counts = spark.read.parquet(f"{path}/counts")
    id_a = F.expr(f"code div {size_b}")
    best = counts.groupBy(id_a.alias("a")).agg(F.max("n").alias("best"))  # a row per id of A at most
    repeated = counts.where("n > 1")
    if repeated.count() <= pairs:
        found, top = repeated.orderBy("code").toArrow(), best.toArrow()
        best_of = np.zeros(size_a, np.int64)
        best_of[np.array(top["a"], np.int64)] = np.array(top["best"], np.int64)
        sent = spark.sparkContext.broadcast(((np.array(found["code"], np.int64), np.array(found["n"], np.int64)), best_of))
        plain = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")
        rows = aligned.select(F.struct("row", *plain).alias("row"), "pairs", "times")
        schema = rows.select("row").schema.add("n_best", "long").add("count_sum", "long")
        out = rows.mapInArrow(lambda b: _summed(b, *sent.value, size_b, wide), schema)
        return out.select("row.row.*", *(F.col(c) if c in ("n_best", "count_sum") else F.col(f"row.{c}").alias(c) for c in RESULTS))
    judged = counts.withColumn("a", id_a).join(best, "a").select("code", "n", (F.col("n") == F.col("best")).alias("is_best"))
    links = aligned.select("number", "pairs", "times").mapInArrow(lambda b: _exploded(b, wide), "number long, code long, times long")
    sums = links.join(judged, "code").groupBy("number").agg(
        F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    out = aligned.drop("pairs", "times").join(sums, "number", "left")
    return out.select("row.*", *(F.coalesce(c, F.lit(0)).alias(c) if c in ("n_best", "count_sum") else F.col(c) for c in RESULTS))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return found.select("doc_id", *RESULTS)
