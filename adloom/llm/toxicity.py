"""Toxicity severity by cumulative-link ordinal regression on sparse text features.

Features are hashed words and word beginnings of 4, 5 and 6 bytes (lower-cased a-z, and
non-ASCII letters), valued log(1 + occurrences). One weight per feature is shared by all
thresholds: P(grade > k) = sigmoid(w.x - threshold_k), thresholds in ascending order.

Fitting uses at most ``sample_rows`` labelled documents (20,000 unless given) and keeps the
``n_features`` features most unevenly spread over clean and graded documents; the rest of
the fit is a proximal gradient descent on that bounded matrix. Scoring reads every document whole.

Where labels tell only clean from toxic, the top grade is refined into ``refine`` grades by how
dense its typical features are (quantiles among its sampled documents).

Null and wordless texts have no features (their score follows from the thresholds alone).
Without labelled rows of two grades nothing can be told: severity 0, nothing rejected.
Repeated rows are scored alike; extra columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.llm.labels import labelled_sample
from adloom.llm.textops import LOWER, SpanHashes, by_bytes, byte_class, text_chunks, word_spans
from adloom.session import scratch_dir

SAMPLE_ROWS = 20_000
N_FEATURES = 3_000
_LETTERS = byte_class((0x61, 0x7A), (0x80, 0xFF))
_BEGINNINGS = (4, 5, 6)


@dataclass
class Severity:
    """Features (hashes in order), their weights, and ascending thresholds of the grades above 0."""

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray


def _occurrences(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, row of each feature occurrence, feature hash) per chunk."""
    for first, data, offsets in text_chunks(column):
        data = LOWER[data]
        starts, ends, index = word_spans(data, offsets, _LETTERS)
        hashes = SpanHashes(data)
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(index))
        rows, found = [row], [hashes.of(starts, ends)]
        for n in _BEGINNINGS:
            long = ends - starts > n
            rows.append(row[long])
            found.append(hashes.of(starts[long], starts[long] + n) ^ np.uint64(n))
        yield first, len(offsets) - 1, np.concatenate(rows), np.concatenate(found)


def _counted(row: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((feature, row))
    row, feature = row[order], feature[order]
    at = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (feature[1:] != feature[:-1])))) if len(row) else np.zeros(0, np.int64)
    return row[at], feature[at], np.diff(np.append(at, len(row)))


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, clean documents, graded documents) of each batch."""
    for batch in batches:
        grade = batch.column(0).to_numpy()
        parts = []
        for first, _, row, feature in _occurrences(batch.column(1)):
            row, feature, _ = _counted(row, feature)
            parts.append((feature, grade[first + row] > 0))
        if not parts:
            continue
        feature, graded = (np.concatenate(x) for x in zip(*parts, strict=True))
        names, place = np.unique(feature, return_inverse=True)
        counts = [np.bincount(place, weights=x, minlength=len(names)).astype(np.int64) for x in (~graded, graded)]
        yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), *map(pa.array, counts)], ["feature", "clean", "graded"])


def _lookup(known: np.ndarray, row: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place in ``known``, occurrences) of the occurrences of known features."""
    if not len(known):
        return row[:0], row[:0], row[:0]
    seen = np.zeros(1 << 20, dtype=bool)
    seen[known >> np.uint64(44)] = True
    maybe = np.flatnonzero(seen[feature >> np.uint64(44)])
    row, feature = row[maybe], feature[maybe]
    place = np.minimum(np.searchsorted(known, feature), len(known) - 1)
    hit = known[place] == feature
    return _counted(row[hit], place[hit])


def _vectors(batches: Iterator[pa.RecordBatch], known: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        places: list[list[int]] = [[] for _ in range(batch.num_rows)]
        counts: list[list[int]] = [[] for _ in range(batch.num_rows)]
        total = np.zeros(batch.num_rows, np.int64)
        for first, n, row, feature in _occurrences(batch.column(1)):
            total[first : first + n] = np.bincount(row, minlength=n)
            for r, p, c in zip(*(x.tolist() for x in _lookup(known, row, feature)), strict=True):
                places[first + r].append(p)
                counts[first + r].append(c)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(total), pa.array(places, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))],
            ["grade", "total", "places", "counts"])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit_cumulative(row: np.ndarray, place: np.ndarray, value: np.ndarray, grade: np.ndarray, n_features: int, n_grades: int,
                   *, l1: float = 2e-4, steps: int = 400) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds minimising the cumulative-link negative log-likelihood
    plus an l1 penalty, by accelerated proximal gradient steps. Entries are (row, feature, value)."""
    n = len(grade)
    below = np.array([(grade <= k).mean() for k in range(n_grades - 1)]).clip(1e-4, 1 - 1e-4)
    thresholds, weights = np.log(below / (1 - below)), np.zeros(n_features)
    norm = np.bincount(row, weights=value * value, minlength=n)
    rate = 4.0 / (1 + np.quantile(norm, 0.99)) if n else 1.0
    w, t, momentum = weights, thresholds, 1.0
    for _ in range(steps):
        score = np.bincount(row, weights=value * w[place], minlength=n)
        up = np.concatenate((t, [np.inf]))[grade] - score
        down = np.concatenate(([-np.inf], t))[grade] - score
        high, low = _sigmoid(up), _sigmoid(down)
        slope = 1 - high - low
        grad = np.bincount(place, weights=value * slope[row], minlength=n_features) / n
        width = np.maximum(high - low, 1e-12)
        grad_t = np.array([((low * (1 - low) / width)[grade == k + 1].sum() - (high * (1 - high) / width)[grade == k].sum()) / n
                           for k in range(n_grades - 1)])
        new_w = w - rate * n_features**0.25 * grad
        new_w = np.sign(new_w) * np.maximum(np.abs(new_w) - rate * n_features**0.25 * l1, 0)
        new_t = np.sort(t - rate * grad_t)
        faster = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        push = (momentum - 1) / faster
        w, t = new_w + push * (new_w - weights), np.sort(new_t + push * (new_t - thresholds))
        weights, thresholds, momentum = new_w, new_t, faster
    return weights, thresholds


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", grade_col: str = "toxic",
        refine: int = 1, sample_rows: int = SAMPLE_ROWS, n_features: int = N_FEATURES) -> Severity:
    spark = docs.sparkSession
    path = scratch_dir(spark, "toxicity-sample")
    labelled_sample(docs, labels, id_col, grade_col, sample_rows, [F.col(text_col).alias("_text")]).select("grade", "_text").write.parquet(path)
    sample = spark.read.parquet(path)
    sizes = {r.graded: r.n for r in sample.groupBy((F.col("grade") > 0).alias("graded")).agg(F.count("*").alias("n")).collect()}
    nothing = Severity(np.zeros(0, np.uint64), np.zeros(0), np.full(1, 35.0))
    if len(sizes) < 2:
        return nothing
    counts = (sample.mapInArrow(_document_frequencies, "feature long, clean long, graded long")
              .groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("graded").alias("graded")))
    share = F.col("graded") / sizes[True] - F.col("clean") / sizes[False]
    spread = (F.col("graded") + F.col("clean") + 4) / (sizes[True] + sizes[False])
    chosen = (counts.where("graded + clean >= 4").withColumn("strength", share * share / spread)
              .orderBy(F.desc("strength"), "feature").limit(n_features).select("feature").collect())
    known = np.sort(np.array([r.feature for r in chosen], dtype=np.int64).view(np.uint64))
    if not len(known):
        return nothing
    rows = sample.mapInArrow(lambda b: _vectors(b, known), "grade int, total long, places array<int>, counts array<int>").toArrow()
    grade = np.clip(rows["grade"].to_numpy(), 0, None).astype(np.int64)
    places = rows["places"].combine_chunks()
    lengths = np.diff(places.offsets.to_numpy())
    row = np.repeat(np.arange(len(grade)), lengths)
    place, count = places.flatten().to_numpy(), rows["counts"].combine_chunks().flatten().to_numpy()
    _, grade = np.unique(grade, return_inverse=True)
    top = int(grade.max())
    if refine > 1:
        graded, clean = (np.bincount(place[grade[row] > 0], minlength=len(known)), np.bincount(place[grade[row] == 0], minlength=len(known)))
        typical = graded / max(1, sizes[True]) > 4 * (clean + 1) / max(1, sizes[False])
        density = np.bincount(row, weights=count * typical[place], minlength=len(grade)) / np.maximum(rows["total"].to_numpy(), 1)
        cuts = np.unique(np.quantile(density[grade == top], np.arange(1, refine) / refine))
        grade = grade + np.where(grade == top, np.searchsorted(cuts, density, side="left"), 0)
    _, grade = np.unique(grade, return_inverse=True)
    weights, thresholds = fit_cumulative(row, place, np.log1p(count), grade, len(known), int(grade.max()) + 1)
    used = weights != 0
    return Severity(known[used], weights[used], thresholds)


def _scores(batches: Iterator[pa.RecordBatch], at: int, model: Severity) -> Iterator[pa.RecordBatch]:
    for batch in by_bytes(batches, at, 4 << 20):
        score = np.zeros(batch.num_rows)
        for first, n, row, feature in _occurrences(batch.column(at)):
            row, place, count = _lookup(model.features, row, feature)
            score[first : first + n] = np.bincount(row, weights=np.log1p(count) * model.weights[place], minlength=n)
        above = _sigmoid(score[:, None] - model.thresholds[None, :])
        shares = -np.diff(np.concatenate((np.ones((len(score), 1)), above, np.zeros((len(score), 1))), axis=1), axis=1)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(score) + 1, dtype=np.int32) * above.shape[1]), pa.array(above.ravel()))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, lists, pa.array(above.sum(axis=1)), pa.array(shares.argmax(axis=1).astype(np.int32))],
            [*batch.schema.names, "p_above", "severity", "grade"])


def score(docs: DataFrame, model: Severity, text_col: str = "text") -> DataFrame:
    """``docs`` with p_above (probability of exceeding each threshold), severity (expected
    grade) and grade (the most probable) at the end."""
    names = docs.columns
    at = names.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # n_features at most
    base = [T.StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema)]
    kinds = T.StructType([*base, *T._parse_datatype_string("p_above array<double>, severity double, grade int").fields])
    out = docs.toDF(*(f.name for f in base)).mapInArrow(lambda b: _scores(b, at, shared.value), kinds)
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(names)), "p_above", "severity", "grade")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), refine=2)
    return score(docs, model).select("doc_id", "severity", "grade", F.col("p_above")[0].alias("p_toxic"),
                                     (F.col("p_above")[0] >= 0.5).alias("rejected"))
