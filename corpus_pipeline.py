"""Corpus pipeline: quality classifier, line dedup, SimHash near-dedup, source mix, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
every stage's rows as Parquet in the shared checkpoint folder and rereads them
as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carbonledger.llm import bpe, line_dedup, mixing, quality_model, simhash
from carbonledger.llm.common import cut, table
from carbonledger.session import checkpoints_written, release_checkpoints


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from all labelled rows it is given."""
    return quality_model.accept(docs, table(spark, sf_dir, "labels"), F.lit(True))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the line runs that repeat earlier ones; a document that loses all its words goes."""
    return line_dedup.drop_repeated_runs(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated (or left out) so that the sources reach their target weights."""
    return mixing.apply_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the mixed documents, with counts and digests: one row per copy."""
    import public_tokenizers
    vocab = bpe.vocabulary(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.round_trip(docs, vocab, public_tokenizers.PATTERN, keep_ids=True)


STAGES = [("quality_classifier", quality), ("line_dedup", lines), ("simhash_near_dedup", near_duplicates),
          ("source_mix", mix), ("byte_bpe", encode)]

#: The classifier is trained and cannot be written in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table; only the last stage's table is left in the checkpoint folder."""
    before, docs = checkpoints_written(), table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
        release_checkpoints(spark, before, keep=docs)
    return docs
