"""Training-data pipeline over ``documents``: each stage works on all rows that the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as Parquet and reads again as the
docs of the next. All but the last return the columns of ``docs``; the last returns the encoded documents.

Defined cases: null and empty texts pass all stages (no n-grams, lines, shingles, windows or tokens); equal rows share
one fate; extra columns pass through up to the encoder, which returns doc_id and its results; empty tables give empty
results; a stage whose side table is empty removes nothing.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.llm import byte_bpe, importance, line_chunks, prefix_join, templates
from lectern.llm.common import staged, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Importance resampling towards documents labelled good; what the sample leaves out goes."""
    return importance.keep_resampled(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated line chunks leave the texts of all documents but the first; n_chars follows."""
    out = line_chunks.dedup_lines(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast(
            docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents joined by Jaccard similarity of at least 0.8 over five-word shingles the smallest doc_id stays."""
    return prefix_join.keep_one(docs, width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, re-parameterised ones included, go."""
    return templates.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of the texts, with digests of the ids and of what they decode to."""
    return byte_bpe.bpe_digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN,
                                with_ids=True)


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("encoding", encoding)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs


ORACLE_SQL = None  # the models, hashes and merges have no SQL form; tests compare with a brute-force version
QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
