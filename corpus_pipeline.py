"""The corpus pipeline: documents to training token files, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result
as Parquet under the shared checkpoint folder and reads it back as the next stage's docs.
All but the last return the columns of documents:

  toxicity          rejects documents scored 0.7 or higher by the attention GRU
  near_duplicates   keeps one document (the smallest doc_id) of each component of near copies
  decontamination   rejects documents that hold benchmark passages
  mixing            repeats and drops documents towards the sources' target weights, in
                    training order; a copy that is taken in part counts if half of it is
  tokens            encodes to token files in that order and returns their rows: doc_id, start,
                    n_tokens, ids_crc32

Training order goes from the fourth stage to the fifth by the files: the fourth is sorted, so
its part files follow each other in order, and a row's place is its part's number and its
number in the part. Documents that are no files are encoded in ascending doc_id order.

Rows with a null doc_id: judged by their text in the first and third stage, linked with
nothing and kept in the second, taken once and last by the fourth. Rows with equal doc_id
are one document to the second stage (one stays); the fourth repeats each alike. Further
columns pass through, whatever they are called.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innkeeper.llm import curriculum, minhash_dedup, suffix_decontam, token_files, toxicity
from innkeeper.llm.common import free_name, table
from innkeeper.llm.components import stored
from innkeeper.session import scratch_path


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    score = free_name(docs.columns, "_score")
    return toxicity.score_documents(docs, model, score=score).where(F.col(score) < toxicity.REJECT_AT).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = minhash_dedup.near_duplicates(docs)
    key = free_name(docs.columns, "_kept")
    kept = judged.where("kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias(key)).distinct()
    one_each = docs.join(kept, F.col("doc_id") == F.col(key), "left_semi").dropDuplicates(["doc_id"])
    return one_each.union(docs.where("doc_id IS NULL"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_decontam.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = curriculum.mix(stored(curriculum.sized(docs, "doc_id", "source"), "sizes"))
    copies = F.filter(F.arrays_zip("times", "words_each"), lambda c: 2 * c["words_each"] >= F.col("size"))
    times = mixed.where("doc_id IS NOT NULL").select("doc_id", F.transform(copies, lambda c: c["times"]).alias("t"))
    key, all_times, time = (free_name(docs.columns, n) for n in ("_id", "_times", "_time"))
    times = times.groupBy(F.col("doc_id").alias(key)).agg(F.max("t").alias(all_times))
    placed = docs.join(times, F.col("doc_id") == F.col(key)).select(*docs.columns, F.explode(all_times).alias(time))
    return placed.union(docs.where("doc_id IS NULL").withColumn(time, F.lit(2.0))).orderBy(time, "doc_id", F.xxhash64("text")).drop(time)


def in_order(docs: DataFrame) -> DataFrame:
    """key (place, doc_id) and text: the place of each row in the part files that docs was read from."""
    if not docs.inputFiles() or "_metadata" in docs.columns:
        return docs.select(F.struct("doc_id").alias("key"), "text")
    part = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1)
    return docs.select(F.struct(F.try_to_number(part, F.lit("9999999999")).cast("long").alias("part"), F.col("_metadata.file_name").alias("file"),
                                F.col("_metadata.row_index").alias("row"), "doc_id").alias("key"), "text")


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(in_order(docs), path, public_tokenizers.path("word_bpe_49k.json"), key="key")
    rows = token_files.checksums(token_files.read_tokens(spark, path))
    return rows.select(F.col("key.doc_id").alias("doc_id"), *[c for c in rows.columns if c != "key"])


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("tokens", write_tokens),
]

# Trained scores and a tokenizer are beyond SQL; tests/llm holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
