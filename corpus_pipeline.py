"""Cleaning of a document table in five stages, each by one operator of ``adloom.llm``.

Every stage takes (session, documents, folder of tables) and returns a DataFrame; its result is
written as Parquet below the shared scratch folder and read again as the next stage's
documents. All stages but the last return the columns of their documents.

Null texts count as empty; rows without words are kept by the first four stages (they are like no
other and hold nothing to remove) and become one-token sequences. Rows with the same id
are told apart by their text; of exact repeats one stays.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.llm import bag_minhash, decontaminate, packing, suffix_dedup, toxicity
from adloom.llm.textops import text_mark
from adloom.session import scratch_dir


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _small_batches(spark: SparkSession) -> None:
    """Texts are long: with fewer rows to a batch than Spark's 10,000, tasks hold a few megabytes of them. Another
    setting than that stays."""
    if spark.conf.get(BATCH_ROWS) == "10000":
        spark.conf.set(BATCH_ROWS, "2000")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are more likely clean than toxic."""
    _small_batches(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), refine=2)
    scored = toxicity.score(docs.toDF(*(f"c{i}" for i in range(len(docs.columns)))), model, f"c{docs.columns.index('text')}")
    kept = scored.where(scored["p_above"][0] < 0.5)
    return kept.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)))


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each near-duplicate class (null ids come last); of rows that
    repeat both id and text one."""
    _small_batches(spark)
    found = bag_minhash.near_duplicates(docs)
    heads = found.where("head").groupBy("_id", "_h").agg(F.count("*").alias("_rows"), (F.max("n_shingles") > 0).alias("_worded"))
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))  # extra columns may bear any name
    doc_id, text = f"c{docs.columns.index('doc_id')}", f"c{docs.columns.index('text')}"
    same = [F.col(doc_id).eqNullSafe(F.col("_id")), text_mark(text) == F.col("_h")]
    kept = plain.join(heads, same)
    repeated = (F.col("_rows") > 1) & F.col("_worded")
    one = kept.where(repeated).dropDuplicates(["_id", "_h"])
    return kept.where(~repeated).unionByName(one).select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)))


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without strings of 200 bytes that also stand elsewhere. What a cut leaves of a
    character is dropped; texts keep their white space."""
    _small_batches(spark)
    cut = suffix_dedup.cut_repeats(docs)
    text = F.when(F.col("n_removed") > 0, _valid_text(F.col("text"))).otherwise(F.decode("text", "UTF-8"))
    return cut.select(*(text.alias(c) if c == "text" else F.length(text).cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns))


def _valid_text(data):
    return F.replace(F.make_valid_utf8(data.cast("string")), F.lit("\ufffd"), F.lit(""))


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without benchmark passages; documents that consist of them mostly are dropped."""
    _small_batches(spark)
    kept = decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return kept.select(*(F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 2048 tokens."""
    _small_batches(spark)
    return packing.pack(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash near-dedup", one_of_each_class),
    ("suffix-array dedup", cut_repeated_passages),
    ("benchmark decontamination", drop_benchmark_passages),
    ("best-fit packing", pack_sequences),
]

# SQL can express neither the learned scores nor the signatures; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = scratch_dir(spark, "corpus-pipeline")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{path}/{k}")
        docs = spark.read.parquet(f"{path}/{k}")
    return docs
