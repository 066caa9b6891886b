"""A corpus pipeline of five stages; each works on all that the one before kept.

Quality rules drop documents, line dedup deletes later copies of repeated line runs (and documents of which
nothing is left), SimHash near-dedup keeps one document of each group, mixing repeats sources toward their
target weights without dropping any document, and BPE encoding turns the texts into ids.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import bpe_words, line_suffixes, quality_ledger, simhash_tiles, temperature_mix
from cadenza.llm.common import delete, scratch, shared_dir
from cadenza.llm.queries import RANKS


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_ledger.keep(docs, "v2")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_suffixes.keep(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_tiles.keep_one(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return temperature_mix.realise(docs, repeats=1.5)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe_words.encode(docs, bpe_words.read_ranks(public_tokenizers.path(RANKS)), public_tokenizers.PATTERN, ids=True, once=True)


STAGES = [("quality rules", quality), ("line dedup", lines), ("SimHash near-dedup", near_copies), ("mixing to target weights", mixture), ("byte-level BPE", encode)]
#: Line runs, SimHash and byte-level BPE have no SQL form; line runs, near-dedup and BPE are tested against brute
#: force, quality rules by op4's measurements, mixing by totals set by hand.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`: token ids and digests of each text kept, as often as it is used.

    Each result is written to the shared folder and read again; a stage's own tables, and the stage before, are
    deleted once it is written.  The last one stays, for the caller to read.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES:
        path = f"{shared_dir(spark)}/stage_{uuid.uuid4().hex}"
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete(spark, before)
        before = path
    return docs
