"""A training-data pipeline of five stages, each by one operator of ``rillmart.llm``."""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rillmart.llm import queries, toxicity  # noqa: E402
from rillmart.llm.bpe_trie import encode_decode  # noqa: E402
from rillmart.llm.common import shared_folder, table  # noqa: E402
from rillmart.llm.decontaminate import decontaminate  # noqa: E402
from rillmart.llm.near_copies import deduplicate  # noqa: E402
from rillmart.llm.secret_scan import redact  # noqa: E402


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; columns named like its own, ``score`` and ``predicted``, keep their values."""
    net = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    aside = {c: f"kept aside {c}" for c in docs.columns if c in ("score", "predicted")}
    kept = toxicity.score(docs.withColumnsRenamed(aside), net).where("predicted = 0").drop("score", "predicted")
    return kept.withColumnsRenamed({b: a for a, b in aside.items()}).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-copies the document with the smallest id stays."""
    return deduplicate(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text; all documents stay."""
    return redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens and digests of the ids and the decoded text of each document."""
    vocabulary = queries.vocabulary("word_bpe_49k.json")
    return queries.bpe_digests(encode_decode(docs, vocabulary, slice_bytes=2 << 20, known_bytes=64 << 20, keep=False))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("secrets", mask_secrets),
    ("encoding", encode),
]

#: SQL expresses none of the stages; they are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, each over the written result of the one before."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
