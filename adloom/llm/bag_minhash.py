"""Near-duplicates of word shingles by BagMinHash signatures, bands and exact verification.

A text is the multiset of its ``shingle``-word shingles (words are runs without white space;
a shorter text is one shingle; a text without words is like no other). Similarity is the
weighted Jaccard index of two multisets: common shingles over all shingles, with
multiplicities.

*Signature.* Each shingle starts Poisson processes over its weight, which is discretised in
dyadic ranges (1, 2, 3-4, 5-8, ...). Points of the process of a range go to a random level of
the range and count only if the weight reaches it, so two texts see the same points
as far as their weights agree; each point also picks a random signature place. A place keeps
its earliest point. Processes are followed only until every place of the text is
taken by an earlier point, which needs about places * ln(places) points a text.

*Candidates.* Texts with equal multisets collapse first. Places are cut into bands; texts
that share a band meet in its bucket. Each member is compared with the bucket's leader (the
text with the most copies); where this leaves several groups, with two more leaders taken by
chance; and then, among members still in different groups, all remaining pairs are compared, but
for those whose bitmaps of shingles show that too few can be common (an exact bound).
So a bucket of n alike texts costs about n comparisons, and no two texts that meet in a bucket
and are similar are left in different classes. (Of n texts in one bucket that are unlike each
other nothing but all pairs can tell; six agreeing places make such buckets small.)

*Verification* counts common shingles exactly; links join texts into classes (connected
components). Null texts have no words. Repeated rows and ids are kept. Empty tables are fine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.llm.components import components
from adloom.llm.textops import NOT_BLANK, SpanHashes, by_bytes, mix, some_rows, text_chunks, text_mark, word_spans
from adloom.session import scratch_dir

BANDS = 24
ROWS_PER_BAND = 6  # 0.8 is missed by all bands once in 1,400 pairs, 0.9 never in practice
SHINGLE = 5
SIMILARITY = 0.8

BITMAP_WORDS = 32  # of 64 bits

_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_multisets(data: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle hash, multiplicity), sorted by text and hash."""
    starts, ends, index = word_spans(data, offsets, NOT_BLANK)
    words = np.diff(index)
    counts = np.where(words >= shingle, words - shingle + 1, np.minimum(words, 1))
    text = np.repeat(np.arange(len(words)), counts)
    if not len(text):
        return text, np.zeros(0, np.uint64), text
    place = index[:-1][text] + np.arange(len(text)) - (np.cumsum(counts) - counts)[text]
    hashes = SpanHashes(SpanHashes(data).of(starts, ends)).of(place, place + np.minimum(words[text], shingle))
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    first = np.flatnonzero(np.concatenate(([True], (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1]))))
    return text[first], hashes[first], np.diff(np.append(first, len(text)))


def bag_signatures(text: np.ndarray, element: np.ndarray, weight: np.ndarray, n_texts: int, places: int) -> np.ndarray:
    """(n_texts, places) identities of the earliest points; texts without elements keep zeros."""
    # Processes: a shingle of weight w runs in the ranges (0, 1], (1, 2], (2, 4], ... below w.
    parts = [(text, mix(element), np.zeros(len(text), np.int64), np.ones(len(text), np.int64), weight)]
    low = 1
    while True:
        more = weight > low
        if not more.any():
            break
        text, element, weight = text[more], element[more], weight[more]
        n = len(text)
        parts.append((text, mix(element + np.uint64(low)), np.full(n, low), np.full(n, low), weight))
        low *= 2
    owner, seed, below, size, top = (np.concatenate(x) for x in zip(*parts, strict=True))

    earliest = np.full(n_texts * places, np.inf)
    identity = np.zeros(n_texts * places, dtype=np.uint64)
    now = np.zeros(len(owner))
    drawn = 0
    while len(owner):
        draws = max(1, min(64, 200_000 // len(owner)))
        point = mix(seed[:, None] + np.arange(drawn + 1, drawn + draws + 1, dtype=np.uint64)[None, :] * _STEP)
        gaps = -np.log(((point >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / (places * size)[:, None]
        times = now[:, None] + np.cumsum(gaps, axis=1)
        other = mix(point ^ _STEP)
        place = ((other >> np.uint64(32)) * np.uint64(places)) >> np.uint64(32)
        level = below[:, None] + 1 + ((other & np.uint64(0xFFFFFFFF)) % size[:, None].astype(np.uint64)).astype(np.int64)
        slot = (owner[:, None] * places + place.astype(np.int64)).ravel()
        counts = (level <= top[:, None]).ravel() & (times.ravel() < earliest[slot])
        slot, when, what = slot[counts], times.ravel()[counts], point.ravel()[counts]
        order = np.argsort(-when, kind="stable")  # of several points for a slot the earliest is written last
        earliest[slot[order]], identity[slot[order]] = when[order], what[order]
        now, drawn = times[:, -1], drawn + draws
        limit = earliest.reshape(n_texts, places).max(axis=1)
        going = now < limit[owner]
        owner, seed, below, size, top, now = (x[going] for x in (owner, seed, below, size, top, now))
    return identity.reshape(n_texts, places)


def _signed(batches: Iterator[pa.RecordBatch], shingle: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    for batch in by_bytes(batches, column=2):
        for first, data, offsets in text_chunks(batch.column(2)):
            n = len(offsets) - 1
            text, element, weight = shingle_multisets(data, offsets, shingle)
            total = np.bincount(text, weights=weight, minlength=n).astype(np.int64)
            identity = bag_signatures(text, element, weight, n, bands * rows).reshape(n, bands, rows)
            band = np.full((n, bands), 0, dtype=np.uint64) + np.arange(bands, dtype=np.uint64)[None, :]
            for k in range(rows):
                band = mix(band * _STEP + identity[:, :, k])
            # The multiset as a whole, in 128 bits.
            whole = np.zeros((n, 2), dtype=np.uint64)
            for side, value in enumerate((mix(element ^ _STEP), mix(element + _STEP))):
                np.add.at(whole[:, side], text, value * weight.astype(np.uint64))
            # A bitmap of the shingles bounds what two texts can have in common.
            bit = (mix(element + np.uint64(17)) >> np.uint64(53)).astype(np.int64) % (64 * BITMAP_WORDS)
            bits = np.zeros((n, BITMAP_WORDS), dtype=np.uint64)
            np.bitwise_or.at(bits, (text, bit >> 6), np.uint64(1) << (bit & 63).astype(np.uint64))
            raw = whole.tobytes()
            group = [raw[16 * i : 16 * i + 16] if total[i] else None for i in range(n)]
            at = slice(first, first + n)
            flat = pa.array(band.view(np.int64).ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * bands), flat)
            maps = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * BITMAP_WORDS), pa.array(bits.view(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[at], batch.column(1)[at], pa.array(group, pa.binary()), pa.array(total), lists, maps],
                ["_id", "_h", "grp", "n", "bands", "bits"])


def _blobs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor(level=3).compress
    for batch in some_rows(batches):
        blobs = [squeeze((x or "").encode()) for x in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(blobs, pa.binary())], ["_id", "_h", "blob"])


def _multiset(blob: bytes, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8)
    _, element, weight = shingle_multisets(data, np.array([0, len(data)]), shingle)
    return element, weight


def _verified(batches: Iterator[pa.RecordBatch], shingle: int, least: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        u, v, keep = batch.column("u"), batch.column("v"), []
        last, known = None, None
        for row in range(batch.num_rows):
            if v[row] != last:
                last, known = v[row], _multiset(batch.column("blob_v")[row].as_py(), shingle)
            element, weight = _multiset(batch.column("blob_u")[row].as_py(), shingle)
            _, a, b = np.intersect1d(element, known[0], assume_unique=True, return_indices=True)
            common = np.minimum(weight[a], known[1][b]).sum()
            if common >= least * (weight.sum() + known[1].sum() - common) - 1e-9:
                keep.append(row)
        rows = pa.array(keep, pa.int64())
        yield pa.RecordBatch.from_arrays([u.take(rows), v.take(rows)], ["u", "v"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = SHINGLE,
                    similarity: float = SIMILARITY, bands: int = BANDS, rows_per_band: int = ROWS_PER_BAND) -> DataFrame:
    """Row per input row: ``_id``, ``_h`` (128 bits of the text), ``class_id`` (least id of the class, null only if all are; a
    text without words is its own class), ``n_shingles`` and ``head``: rows of one id and text in each class have it, so
    keeping one row of these keeps one row of the class, also where ids are null or repeat. A row without words has it."""
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    path = scratch_dir(spark, "near-duplicates")
    first = F.struct(F.col("_id").isNull().alias("no_id"), "_id", "_h")  # null ids come last
    rows = docs.select(F.col(id_col).alias("_id"), text_mark(text_col).alias("_h"), F.col(text_col).alias("_text"))
    rows.mapInArrow(lambda b: _signed(b, shingle, bands, rows_per_band),
                    f"_id {id_type}, _h binary, grp binary, n long, bands array<long>, bits array<long>").write.parquet(f"{path}/signed")
    signed = spark.read.parquet(f"{path}/signed")
    worded = signed.where(F.col("grp").isNotNull())
    (worded.groupBy("grp").agg(F.min(first).alias("one"), F.min("_id").alias("least"), F.count("*").alias("copies"),
                               F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("bits").alias("bits"))
     .write.parquet(f"{path}/groups"))
    groups = spark.read.parquet(f"{path}/groups")

    members = groups.select("grp", "copies", "n", F.explode("bands").alias("bucket"))
    leaders = (members.groupBy("bucket").agg(F.count("*").alias("size"), F.max(F.struct("copies", "grp")).alias("lead"))
               .where("size > 1").select("bucket", F.col("lead.grp").alias("lead"))
               .repartition("bucket", "lead"))  # so that the join below has plain shuffles, which Spark can split
    members.join(leaders, "bucket").select("bucket", "grp", "n", "lead").write.parquet(f"{path}/buckets")
    buckets = spark.read.parquet(f"{path}/buckets")

    wanted = buckets.select("grp").distinct().join(groups.select("grp", "one"), "grp")
    packed = rows.mapInArrow(_blobs, f"_id {id_type}, _h binary, blob binary")
    same = [F.col("b._id").eqNullSafe(F.col("w.one._id")), F.col("b._h") == F.col("w.one._h")]
    packed.alias("b").join(wanted.alias("w"), same).select("w.grp", "b.blob").dropDuplicates(["grp"]).write.parquet(f"{path}/texts")
    texts = spark.read.parquet(f"{path}/texts")

    def verify(pairs: DataFrame, to: str) -> DataFrame:
        (pairs.join(texts.select(F.col("grp").alias("u"), F.col("blob").alias("blob_u")), "u")
         .join(texts.select(F.col("grp").alias("v"), F.col("blob").alias("blob_v")), "v")
         .mapInArrow(lambda b: _verified(b, shingle, similarity), "u binary, v binary").write.parquet(f"{path}/{to}"))
        return spark.read.parquet(f"{path}/{to}")

    led = (buckets.where("grp <> lead").select(F.col("grp").alias("u"), F.col("lead").alias("v")).distinct())
    edges = verify(led, "led")

    def apart(edges: DataFrame, to: str) -> DataFrame:
        """Members of the buckets that still hold several components."""
        label = components(edges)
        labelled = (buckets.join(label.select(F.col("node").alias("grp"), "component"), "grp", "left")
                    .select("bucket", "grp", "n", "lead", F.coalesce("component", "grp").alias("component")))
        several = (labelled.groupBy("bucket").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a <> b")
                   .repartition("bucket", "a").select("bucket"))
        labelled.join(several, "bucket").write.parquet(f"{path}/{to}")
        return spark.read.parquet(f"{path}/{to}")

    def alike_in_size(a: str, b: str) -> F.Column:
        return F.least(a, b) >= F.lit(similarity - 1e-9) * F.greatest(a, b)

    # Two more leaders by chance for each bucket: other ones in each, so components meet.
    rest = apart(edges, "apart")  # empty if all is linked, and then so is what follows
    chance = F.struct(F.xxhash64("bucket", "grp"), "grp", "n", "component")
    picks = (rest.groupBy("bucket").agg(F.array(F.min(chance), F.max(chance)).alias("picks"))
             .select("bucket", F.explode("picks").alias("pick")).repartition("bucket", "pick"))
    mixed = (rest.join(picks, "bucket").where((F.col("component") != F.col("pick.component")) & alike_in_size("n", "pick.n"))
             .select(F.least("grp", "pick.grp").alias("u"), F.greatest("grp", "pick.grp").alias("v")).distinct())
    edges = edges.unionAll(verify(mixed, "mixed"))

    # What is left: every pair of a bucket across different components, but for pairs whose bitmaps
    # rule out enough common shingles.
    def set_bits(words: F.Column) -> F.Column:
        return F.aggregate(words, F.lit(0), lambda n, w: n + F.bit_count(w))

    known = groups.select("grp", "bits", (F.col("n") - set_bits(F.col("bits"))).alias("extra"))
    rest = apart(edges, "left").join(known, "grp")
    rest.write.parquet(f"{path}/left-bits")
    rest = spark.read.parquet(f"{path}/left-bits")
    a, b = rest.alias("a"), rest.alias("b")
    shared = set_bits(F.zip_with("a.bits", "b.bits", lambda x, y: x.bitwiseAND(y)))
    possible = (shared + F.least("a.extra", "b.extra")) * (1 + similarity) >= (F.col("a.n") + F.col("b.n")) * similarity - 1e-6
    across = (a.join(b, F.col("a.bucket") == F.col("b.bucket"))
              .where((F.col("a.grp") < F.col("b.grp")) & (F.col("a.component") != F.col("b.component"))
                     & (F.col("a.grp") != F.col("a.lead")) & (F.col("b.grp") != F.col("b.lead")) & alike_in_size("a.n", "b.n") & possible)
              .select(F.col("a.grp").alias("u"), F.col("b.grp").alias("v")).distinct())
    edges = edges.unionAll(verify(across, "across"))
    final = components(edges)

    classed = (groups.select("grp", "least", "one").join(final.withColumnRenamed("node", "grp"), "grp", "left")
               .select("grp", "least", "one", F.coalesce("component", "grp").alias("component")))
    heads = classed.groupBy("component").agg(F.min("least").alias("class_id"), F.min("one").alias("head"))
    named = classed.join(heads, "component").select("grp", "class_id", "head")
    is_head = F.col("_id").eqNullSafe(F.col("head._id")) & (F.col("_h") == F.col("head._h"))
    return (worded.join(named, "grp").select("_id", "_h", "class_id", F.col("n").alias("n_shingles"), is_head.alias("head"))
            .unionAll(signed.where(F.col("grp").isNull()).select("_id", "_h", F.col("_id").alias("class_id"),
                                                                 F.col("n").alias("n_shingles"), F.lit(True).alias("head"))))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = near_duplicates(docs)
    return found.select(F.col("_id").alias("doc_id"), "class_id", F.col("head").alias("is_representative"), "n_shingles")
