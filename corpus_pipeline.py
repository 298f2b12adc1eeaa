"""A training corpus from ``documents``: five stages, each written as Parquet and read by the next.

1. quality: documents that the rule ensemble rejects go.
2. exact_dedup: of equal texts the document with the largest id stays.
3. near_dedup: of documents linked by five-word shingles at a similarity of 0.8
   or more, one per group stays.
4. mixing: each document appears as often as the capped source weights say.
5. bpe: the mix as token ids, with digests of the ids and of the decoded bytes.

A stage is a function (spark, docs, sf_dir) -> DataFrame.  All but the last
return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from basalt.llm import bpe, exact_dedup, minhash_dedup, mixing, quality
from basalt.llm.common import materialize, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_exact(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash_dedup.keep_one(docs, shingle_words=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.apply_mix(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("quality", keep_quality), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies),
          ("mixing", mix_sources), ("bpe", tokenize)]

#: SQL cannot express the classifier or the tokenizer; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; all but the last are written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
