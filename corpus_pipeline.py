"""The corpus pipeline: documents pass five stages, each written as Parquet and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import byte_bpe, decontaminate, line_runs, queries, simhash, toxicity
from ledgerline.llm.common import Scratch, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go."""
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels"), fold=5))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of 50 words or more go; a document left without a word goes with them."""
    cut = line_runs.without_copies(docs, min_words=50)
    emptied = (F.col("n_deleted") > 0) & ~F.col("kept").rlike(line_runs.WORD)
    changed = {"text": F.when(F.col("n_deleted") > 0, F.col("kept")).otherwise(F.col("_row.text"))}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(F.col("n_deleted") > 0, F.char_length("kept").cast(kind)).otherwise(F.col("_row.n_chars"))
    return cut.filter(~emptied).select(*[changed.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.keep_one(docs, shingle=3, radius=3)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"), min_similarity=0.8)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ranks = byte_bpe.read_ranks(public_tokenizers.path(queries.VOCABULARY))
    return byte_bpe.digests(byte_bpe.round_trip(docs, ranks, public_tokenizers.PATTERN))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("simhash near dedup", dedup_near),
    ("benchmark decontamination", drop_benchmark),
    ("byte-level BPE", tokens),
]

# The toxicity stage's score has no SQL form; tests hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over all that its predecessor kept."""
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"stage{n}")
    return docs
