"""A corpus pipeline of the llm operators: STAGES are applied in order, each to all rows its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duskwatch.llm.common import ranked, staged, table
from duskwatch.llm.linededup import dedup_lines
from duskwatch.llm.minhash import near_duplicates
from duskwatch.llm.mixing import poisson_mix
from duskwatch.llm.packing import pack_documents
from duskwatch.llm.toxicity import is_held_out, scored, train

# Near duplicates here share five-word shingles.
SHINGLE_WORDS, PERCENT = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from ``labels``.

    A score depends on the text alone, so texts are judged, not ids: rows with a null or repeated doc_id stay or go each by its own text.
    """
    known = table(spark, sf_dir, "labels").where(~is_held_out()).select("doc_id", F.col("toxic").alias("label"))
    text = F.coalesce("text", F.lit(""))
    key = F.xxhash64(text)
    judged = scored(docs.select(key.alias("doc_id"), "text"), train(docs, known))
    toxic = judged.where("predicted = 1").select(F.col("doc_id").alias("__key")).distinct()
    return docs.join(toxic, key == F.col("__key"), "left_anti").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines with an earlier match go; a document that loses all its words goes with them.

    Rows with a null doc_id take no part; texts of one doc_id are told apart (``dedup_lines``).
    """
    out = dedup_lines(docs).where("n_removed = 0 or text rlike '[^ \\\\t\\\\r\\\\n]'")
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one with the least doc_id.

    Where ids are missing or repeated, rows are numbered by (doc_id, hash of the text) and the least number stays.
    """
    ids = docs.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("ids")).first()
    if ids["n"] == ids["ids"]:
        gone = near_duplicates(docs, SHINGLE_WORDS, PERCENT).where("not kept").select("doc_id")
        return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    whole = docs.select(F.struct(*docs.columns).alias("whole"), F.lit(0).alias("all"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("mark"))
    numbered = ranked(whole, "all", [F.col("id"), F.col("mark")], "pipeline-rows").select("pos", "whole")
    gone = near_duplicates(numbered.select(F.col("pos").alias("doc_id"), "whole.text"), SHINGLE_WORDS, PERCENT).where("not kept")
    return numbered.join(gone.select(F.col("doc_id").alias("pos")), "pos", "left_anti").select("whole.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target weights of their sources, in a random order."""
    return poisson_mix(docs).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents with their places in sequences."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("minhash_near_dedup", drop_near_duplicates),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack),
]

# Learnt weights, MinHash and packing have no SQL restatement; tests/llm compares with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between stages the rows are written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, name)
    return docs
