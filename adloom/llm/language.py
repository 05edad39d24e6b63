"""Language identification by compression.

Each language is a zstandard dictionary of raw content, taken from a bounded sample of
its labelled texts. A text is compressed whole with every dictionary, in blocks so that its
own earlier words do not outweigh the dictionary; the one that makes it smallest names the
language. Texts and dictionaries are lower-cased, and what is not a letter counts as a blank. Where the two smallest sizes lie closer than ``least_margin``
the prediction is marked as not confident.

Null texts and texts without letters are ``und`` with score 0, as is everything when there is
nothing to learn from. Ties go to the language first in alphabetical order. Repeated rows are
judged alike, and extra columns of any name stay. Very long texts are judged whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DICTIONARY_BYTES = 100_000
SAMPLE_TEXTS = 120  # of each language
PART = 2_000  # characters of a text that are learned from, from a place chosen by its hash
LANGUAGES = 200  # with the most texts; others are not learned
LEVEL = 9
BLOCK_BYTES = 4096
LEAST_MARGIN = 0.01
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")
_OTHER = re.compile(r"[\W\d_]+")


def _letters(text: str) -> bytes:
    return _OTHER.sub(" ", text.lower()).strip().encode()


def learn(docs: DataFrame, *, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id") -> dict[str, bytes]:
    """Dictionaries by language, each from parts of at most ``SAMPLE_TEXTS`` texts (least hashes first), which share
    its ``DICTIONARY_BYTES`` evenly."""
    rows = (docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
            .select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), F.xxhash64(text_col, id_col).alias("h")))
    first = F.pmod("h", F.greatest(F.length("text") - PART, F.lit(0)) + 1).cast("int") + 1
    rows = rows.select("lang", F.substr("text", first, F.lit(PART)).alias("text"), "h")
    common = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).select("lang")
    rows = rows.join(common, "lang", "left_semi")
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))).where(F.col("rank") <= SAMPLE_TEXTS)
    texts: dict[str, dict[bytes, None]] = {}
    for r in ranked.orderBy("lang", "rank").collect():
        if _LETTER.search(r.text):
            texts.setdefault(r.lang, {})[_letters(r.text)] = None
    return {lang: _shared(list(found)) for lang, found in sorted(texts.items())}


def _shared(texts: list[bytes]) -> bytes:
    """All texts, each cut to its share of the bytes; what short ones leave goes to the longer ones."""
    left, out = DICTIONARY_BYTES, []
    for k, text in enumerate(sorted(texts, key=len)):
        out.append(text[: left // (len(texts) - k)])
        left -= len(out[-1]) + 1
    return b" ".join(out)


def _sizes(batches: Iterator[pa.RecordBatch], at: int, dictionaries: dict[str, bytes], least_margin: float) -> Iterator[pa.RecordBatch]:
    coders = []
    for lang, data in dictionaries.items():
        raw = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        raw.precompute_compress(level=LEVEL)
        coders.append((lang, zstandard.ZstdCompressor(level=LEVEL, dict_data=raw, write_content_size=False, write_dict_id=False).compress))
    for batch in batches:
        best, score, sure = [], [], []
        for value in batch.column(at):
            text = value.as_py()
            if text is None or not coders or not _LETTER.search(text):
                best.append(UNKNOWN)
                score.append(0.0)
                sure.append(False)
                continue
            data = _letters(text)
            blocks = [data[i : i + BLOCK_BYTES] for i in range(0, len(data), BLOCK_BYTES)]
            sizes = sorted((sum(len(code(b)) for b in blocks), lang) for lang, code in coders)
            margin = 1 - sizes[0][0] / sizes[1][0] if len(sizes) > 1 else 1.0
            best.append(sizes[0][1])
            score.append(margin)
            sure.append(margin >= least_margin)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(best, pa.string()), pa.array(score, pa.float64()), pa.array(sure, pa.bool_())],
            [*batch.schema.names, "lang_pred", "score", "confident"])


def identify(docs: DataFrame, dictionaries: dict[str, bytes], *, text_col: str = "text", least_margin: float = LEAST_MARGIN) -> DataFrame:
    """``docs`` with lang_pred, score (how much smaller the best is than the second) and confident."""
    names = docs.columns
    at = names.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)  # DICTIONARY_BYTES for each language
    base = [T.StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema)]
    kinds = T.StructType([*base, *T._parse_datatype_string("lang_pred string, score double, confident boolean").fields])
    out = docs.toDF(*(f.name for f in base)).mapInArrow(lambda b: _sizes(b, at, shared.value, least_margin), kinds)
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(names)), "lang_pred", "score", "confident")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))  # a null id is not held out
    dictionaries = learn(docs.where(~held_out))
    return identify(docs.select("doc_id", held_out.alias("held_out"), "text"), dictionaries).select(
        "doc_id", "held_out", "lang_pred", "score", "confident")
