"""Benchmark decontamination with a generalised suffix automaton of the test items.

Words are runs of a-z, 0-9 and non-ASCII bytes after lower-casing A-Z. All items of a block go
into one automaton over word ids; document words are streamed through it, tracking the
state and the length of the longest item substring that ends at each word. Where that length
reaches ``window`` words, the last ``window`` words occur in an item; items shorter than a
window match as a whole. A hash test of short word runs first picks the stretches in which a
match is possible at all (it has no false negatives), so the automaton sees only those.

Items that say the same under one id count once, and long ones are cut into pieces that share all but one word of a
window. They are collected in blocks of about ``BLOCK_BYTES`` of text (split by hash). One block is scanned
lazily. Of several, each is collected, broadcast, scanned against the texts, its hits are written below the scratch
folder, and it is dropped before the next one: the driver and the executors hold one block at a time. The
hits of all blocks are then merged by text (by 128-bit fingerprint) and joined to the documents, which are read once a block.

Null or wordless texts and items have no words. Repeated item ids count once, a null item id is
written ``null``. Empty tables, repeated rows and extra columns of any name are fine.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.llm.textops import LETTERS_DIGITS, LOWER, SpanHashes, by_bytes, some_rows, text_chunks, word_spans
from adloom.session import scratch_dir

BLOCK_BYTES = 2 << 20
GRAM = 4

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

HIT = "array<struct<first:bigint,words:bigint,start:bigint,end:bigint>>"


def item_words(text: str | None) -> list[bytes]:
    data = np.frombuffer((text or "").encode(), dtype=np.uint8)
    return _WORD.findall(LOWER[data].tobytes())


class ItemAutomaton:
    """Suffix automaton of several word sequences; answers what ends at each word of a text."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int) -> None:
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.go: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        holders: list[set[str]] = [set()]
        own: list[list[tuple[int, str]]] = [[]]
        self._holders, self._own = holders, own
        grams: dict[int, set[tuple[bytes, ...]]] = {}
        self.least = window
        for name, words in items:
            if not words:
                continue
            self._insert(name, [self.ids.setdefault(w, len(self.ids)) for w in words])
            size = min(GRAM, len(words))
            if size == GRAM:
                self.least = min(self.least, len(words))
            grams.setdefault(size, set()).update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
        # Items whose whole text ends here, and items holding the last `window` words.
        order = sorted(range(1, len(self.go)), key=self.length.__getitem__)
        self.short: list[list[tuple[int, str]]] = own
        self.long: list[frozenset[str]] = [frozenset()] * len(self.go)
        for v in order:
            up = self.link[v]
            own[v] = own[v] + own[up]
            if self.length[v] >= window:
                self.long[v] = frozenset(holders[v]) if self.length[up] < window else self.long[up]
        self.grams = {n: np.unique(np.concatenate([_gram_hashes(g) for g in found])) for n, found in sorted(grams.items())}
        del self._holders, self._own

    def _state(self, length: int, link: int, go: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.go.append(go)
        self._holders.append(set())
        self._own.append([])
        return len(self.go) - 1

    def _clone(self, source: int, length: int, word: int, at: int) -> int:
        twin = self._state(length, self.link[source], dict(self.go[source]))
        self._holders[twin] |= self._holders[source]
        # Whole items no longer than the twin's strings are the twin's.
        self._own[twin] = [x for x in self._own[source] if x[0] <= length]
        self._own[source] = [x for x in self._own[source] if x[0] > length]
        while at >= 0 and self.go[at].get(word) == source:
            self.go[at][word] = twin
            at = self.link[at]
        self.link[source] = twin
        return twin

    def _step(self, last: int, word: int) -> int:
        known = self.go[last].get(word)
        if known is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            return self._clone(known, self.length[last] + 1, word, last)
        new = self._state(self.length[last] + 1, 0, {})
        at = last
        while at >= 0 and word not in self.go[at]:
            self.go[at][word] = new
            at = self.link[at]
        if at >= 0:
            target = self.go[at][word]
            self.link[new] = target if self.length[target] == self.length[at] + 1 else self._clone(target, self.length[at] + 1, word, at)
        return new

    def _insert(self, name: str, words: list[int]) -> None:
        last = 0
        for word in words:
            last = self._step(last, word)
        if len(words) < self.window:
            self._own[last].append((len(words), name))
        at = 0
        for word in words:  # every state that holds a substring of this item
            at = self.go[at][word]
            up = at
            while up > 0 and name not in self._holders[up]:
                self._holders[up].add(name)
                up = self.link[up]

    def walk(self, words: list[int]) -> Iterator[tuple[int, int, frozenset[str] | list[str]]]:
        """(position of the last word, words hit, items) for every match."""
        go, link, length, window = self.go, self.link, self.length, self.window
        state = size = 0
        for at, word in enumerate(words):
            while state and word not in go[state]:
                state = link[state]
                size = length[state]
            if word in go[state]:
                state, size = go[state][word], size + 1
            if size >= window:
                yield at, window, self.long[state]
            for n, name in self.short[state]:
                if n <= size:
                    yield at, n, [name]


def _gram_hashes(words: tuple[bytes, ...]) -> np.ndarray:
    data = np.frombuffer(b" ".join(words), dtype=np.uint8)
    starts, ends, _ = word_spans(data, np.array([0, len(data)]), LETTERS_DIGITS)
    return SpanHashes(SpanHashes(data).of(starts, ends)).of_length(len(words))


def _stretches(automaton: ItemAutomaton, hashes: SpanHashes, n_words: int, text_of_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word ranges in which an item can match."""
    lows, highs = [], []
    for size, known in automaton.grams.items():
        if n_words < size:
            continue
        found = hashes.of_length(size)
        seen = np.zeros(1 << 16, dtype=bool)
        seen[known >> np.uint64(48)] = True
        at = np.flatnonzero(seen[found >> np.uint64(48)])
        place = np.minimum(np.searchsorted(known, found[at]), len(known) - 1)
        at = at[known[place] == found[at]]
        at = at[text_of_word[at] == text_of_word[at + size - 1]]
        if not len(at):
            continue
        first = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1] + 1) | (text_of_word[at[1:]] != text_of_word[at[:-1]]))))
        run = np.diff(np.append(first, len(at)))
        # A match of n words holds n - size + 1 such runs in a row.
        keep = run >= (automaton.least - GRAM + 1 if size == GRAM else 1)
        lows.append(at[first[keep]])
        highs.append(at[first[keep]] + run[keep] - 1 + size)
    if not lows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(lows), np.concatenate(highs)


def _scan(batches: Iterator[pa.RecordBatch], at: int, automaton: ItemAutomaton) -> Iterator[pa.RecordBatch]:
    hit_type = pa.list_(pa.struct([(x, pa.int64()) for x in ("first", "words", "start", "end")]))
    for batch in by_bytes(batches, at, 4 << 20):
        n = batch.num_rows
        counts = np.zeros(n, dtype=np.int64)
        hits: list[list] = [[] for _ in range(n)]
        items: list[set] = [set() for _ in range(n)]
        for row, data, offsets in text_chunks(batch.column(at)):
            data = LOWER[data]
            starts, ends, index = word_spans(data, offsets, LETTERS_DIGITS)
            counts[row : row + len(offsets) - 1] = np.diff(index)
            if not len(starts):
                continue
            text = np.repeat(np.arange(len(offsets) - 1), np.diff(index))
            low, high = _stretches(automaton, SpanHashes(SpanHashes(data).of(starts, ends)), len(starts), text)
            for a, b in zip(low.tolist(), high.tolist(), strict=True):
                words = [automaton.ids.get(data[s:e].tobytes(), -1) for s, e in zip(starts[a:b], ends[a:b], strict=True)]
                t = int(text[a])
                for last, size, names in automaton.walk(words):
                    hits[row + t].append((a + last - size + 1, a + last + 1))
                    items[row + t].update(names)
            for t in {int(text[a]) for a in low.tolist()}:
                merged: list[list[int]] = []
                for a, b in sorted(hits[row + t]):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], b)
                    else:
                        merged.append([a, b])
                hits[row + t] = [{"first": int(a - index[t]), "words": b - a, "start": int(starts[a] - offsets[t]),
                                  "end": int(ends[b - 1] - offsets[t])} for a, b in merged]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(counts), pa.array(hits, hit_type), pa.array([sorted(x) for x in items], pa.list_(pa.string()))],
            [*batch.schema.names, "n_words", "hits", "items"])


def _item_pieces(batches: Iterator[pa.RecordBatch], window: int, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Items as their words; one of over ``most_bytes`` in pieces, of which each window of its words is in one."""
    for batch in some_rows(batches):
        names, texts = [], []
        for name, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            words = item_words(text)
            if not words:
                continue
            first, end, size = 0, 0, 0
            while end < len(words):
                size += len(words[end]) + 1
                end += 1
                if end == len(words) or (size > most_bytes and end - first >= window):
                    names.append(name)
                    texts.append(b" ".join(words[first:end]).decode())
                    first, size = end - window + 1, 0
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.string())], ["id", "text"])


def _item_blocks(items: DataFrame, id_col: str, text_col: str, window: int) -> tuple[DataFrame, int]:
    """Different items as pieces (id, text), and the number of blocks they make."""
    rows = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("id"), F.col(text_col).alias("text"))
    most = max(1, BLOCK_BYTES // 4)
    pieces = rows.mapInArrow(lambda b: _item_pieces(b, window, most), "id string, text string").distinct()
    total = pieces.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return pieces, -(-total // BLOCK_BYTES)


def _automaton(pieces: DataFrame, window: int) -> ItemAutomaton:
    return ItemAutomaton([(r.id, item_words(r.text)) for r in pieces.collect()], window)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hits of all blocks as disjoint runs, in the order of the text."""
    for batch in some_rows(batches):
        out = []
        for hits in batch.column("hits").to_pylist():
            runs: list[dict] = []
            for h in sorted(hits, key=lambda h: (h["first"], h["words"])):
                if runs and h["first"] <= runs[-1]["first"] + runs[-1]["words"]:
                    last = runs[-1]
                    last["words"] = max(last["words"], h["first"] + h["words"] - last["first"])
                    last["end"] = max(last["end"], h["end"])
                else:
                    runs.append(dict(h))
            out.append(runs)
        at = batch.schema.get_field_index("hits")
        yield batch.set_column(at, "hits", pa.array(out, batch.schema.field("hits").type))


def _hits_by_text(texts: DataFrame, pieces: DataFrame, blocks: int, window: int) -> DataFrame:
    """Row per different text with hits: ``_a``, ``_b`` (its fingerprint), hits and items."""
    spark = texts.sparkSession
    path = scratch_dir(spark, "item-hits")
    pieces.write.parquet(f"{path}/pieces")
    pieces = spark.read.parquet(f"{path}/pieces")
    schema = f"_a long, _b long, text string, n_words long, hits {HIT}, items array<string>"
    for block in range(blocks):
        part = pieces.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block)
        shared = spark.sparkContext.broadcast(_automaton(part, window))
        (texts.mapInArrow(lambda b, a=shared: _scan(b, 2, a.value), schema).where(F.size("hits") > 0)
         .select("_a", "_b", "hits", "items").write.parquet(f"{path}/hits/block={block}"))
        shared.destroy()
    # Copies of a text hold the same hits, so one of each block does.
    found = spark.read.schema(f"_a long, _b long, hits {HIT}, items array<string>, block int").parquet(f"{path}/hits").dropDuplicates(["_a", "_b", "block"])
    return (found.groupBy("_a", "_b").agg(F.flatten(F.collect_list("hits")).alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
            .mapInArrow(_merged, f"_a long, _b long, hits {HIT}, items array<string>").repartition("_a", "_b"))  # dealt anew, so that the join can split a hot text


def match_items(docs: DataFrame, items: DataFrame, *, text_col: str = "text", item_id: str = "item_id",
                item_text: str = "text", window: int = 10) -> DataFrame:
    """``docs`` with n_words, hits (disjoint runs of hit words: first word, words, byte range) and
    items (ids, sorted as strings) at the end."""
    spark = docs.sparkSession
    names = docs.columns
    at = names.index(text_col)
    out = docs.toDF(*(f"c{i}" for i in range(len(names))))
    base = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema)])
    kinds = T.StructType([*base, T.StructField("n_words", T.LongType()), *T._parse_datatype_string(f"hits {HIT}, items array<string>").fields])
    pieces, blocks = _item_blocks(items, item_id, item_text, window)
    shared = spark.sparkContext.broadcast(_automaton(pieces, window) if blocks == 1 else ItemAutomaton([], window))
    found = out.mapInArrow(lambda b: _scan(b, at, shared.value), kinds)
    if blocks > 1:
        text = F.col(f"c{at}")
        prints = [F.xxhash64(text).alias("_a"), F.xxhash64(F.lit(1), text).alias("_b")]
        hits = _hits_by_text(out.where(text.isNotNull()).select(*prints, text.alias("text")), pieces, blocks, window)
        found = (found.drop("hits", "items").select("*", *prints).join(hits, ["_a", "_b"], "left")
                 .select(*base.names, "n_words", *(F.coalesce(x, F.array().cast(kinds[x].dataType)).alias(x) for x in ("hits", "items"))))
    return found.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(names)), "n_words", "hits", "items")


def _union_words(hits: str = "hits") -> F.Column:
    """Words in the union of the runs."""
    ordered = F.array_sort(F.transform(hits, lambda h: F.struct(h["first"].alias("a"), (h["first"] + h["words"]).alias("b"))))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    return F.aggregate(ordered, start, lambda acc, h: F.struct(
        (acc["n"] + F.greatest(h["b"] - F.greatest(h["a"], acc["end"]), F.lit(0))).alias("n"),
        F.greatest(acc["end"], h["b"]).alias("end")), lambda acc: acc["n"])


def _without_hits(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
    for batch in some_rows(batches):
        texts = batch.column(at).to_pylist()
        for row, hits in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
            if not hits:
                continue
            data, kept, done = texts[row].encode(), [], 0
            for h in sorted(hits, key=lambda h: h["start"]):
                kept.append(data[done : max(done, h["start"])])
                done = max(done, h["end"])
            texts[row] = b"".join([*kept, data[done:]]).decode()
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:at], pa.array(texts, pa.string()), *batch.columns[at + 1 : -1]], batch.schema.names[:-1])


def decontaminate(docs: DataFrame, items: DataFrame, *, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
                  window: int = 10, max_run: int = 200, max_coverage: float = 0.5) -> DataFrame:
    """``docs`` without benchmark passages: hit runs are cut out, and a document goes as a whole
    if one run is longer than ``max_run`` words or over ``max_coverage`` of its words are hit."""
    names = docs.columns
    at = names.index(text_col)
    found = match_items(docs, items, text_col=text_col, item_id=item_id, item_text=item_text, window=window)
    found = found.toDF(*(f"c{i}" for i in range(len(names))), "n_words", "hits", "items")
    kept = found.where((F.size("hits") == 0) | (
        (F.aggregate("hits", F.lit(0).cast("long"), lambda m, h: F.greatest(m, h["words"])) <= max_run)
        & (_union_words() <= F.col("n_words") * max_coverage)))
    schema = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema)])
    cut = kept.select(*schema.names, "hits").mapInArrow(lambda b: _without_hits(b, at), schema)
    return cut.toDF(*names)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = match_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    n_hit = _union_words()
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"))
