"""The corpus pipeline: language ID, exact dedup, near-duplicate removal,
benchmark decontamination, byte-level BPE.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor
kept, and returns the columns of ``documents``; the last returns the
encoding's digests.  ``run`` writes each stage's rows as Parquet in the
shared folder and reads them back for the next one; what a stage stored on
the way, and its predecessor's rows, go when its own are written.

No ``ORACLE_SQL``: language ID is a trained model.  ``tests/llm`` holds the
stages against brute force.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metroflux.llm import bpe, decontaminate, exact_dedup, langid, ngram_join
from metroflux.llm.common import discard, materialise, scratch, table
from metroflux.llm.linear import fold

#: a document whose most likely language is less likely than this is rejected
MIN_LANGUAGE_SCORE = 0.35
#: bytes of rows that go to Python at a time.  Spark's 10,000 rows are 20 MB of
#: texts and more, and an executor keeps such buffers from stage to stage.
BATCH_BYTES = 4 << 20


def _by_small_batches(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
        return stage(spark, docs, sf_dir)
    return run


@_by_small_batches
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters or without a likely language."""
    model = langid.train(docs, fold(F.col("doc_id"), 4) != 2)
    return langid.keep_identified(docs, model, MIN_LANGUAGE_SCORE)


@_by_small_batches
def drop_exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id stays."""
    return exact_dedup.drop_exact_duplicates(docs)


@_by_small_batches
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of documents linked by 5-word shingles at a similarity
    of 0.8 or more the one with the smallest id stays."""
    return ngram_join.drop_near_duplicates(docs, width=5, percent=80)


@_by_small_batches
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which benchmark passages make up a twentieth."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


@_by_small_batches
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of what is left."""
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_duplicates),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("byte_bpe", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, stored = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with scratch() as keep:
            docs = keep(materialise(stage(spark, docs, sf_dir), name))
        discard(*stored)
        stored = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
