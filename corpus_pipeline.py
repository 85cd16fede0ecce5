"""The corpus pipeline: quality, near duplicates, decontamination, mixing,
token ids.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which ``run`` writes as Parquet and reads back as
the next stage's documents. Every stage works on all that its predecessor
kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontam, groupjoin, mixing, rules, wavelet
from tidemark.llm.common import discard, folders, prepare, shield, store, table
from tidemark.llm.queries import END_ID, quality_model, tokenizer_path
from tidemark.session import delete_path

#: SQL cannot express the classifier, the similarity join and the tokenizer;
#: tests hold the stages against brute-force versions.
ORACLE_SQL = None


#: Working folders of the last stage. Its output has been written when the
#: next stage begins, so nothing reads them any more.
_LEFT: list[str] = []


def _stage(fn):
    """A stage that starts by deleting the last one's working folders."""

    @functools.wraps(fn)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        prepare(spark)
        while _LEFT:
            delete_path(spark, _LEFT.pop())
        with folders() as made:
            out = fn(spark, docs, sf_dir)
        _LEFT.extend(made)
        return out

    return run


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the rule classifier rejects."""
    return rules.keep_good(docs, quality_model(spark, sf_dir))


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return groupjoin.keep_one(docs)


@_stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark passage."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


@_stage
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    own, name, restore = shield(docs)
    parts = {"doc_id": name["doc_id"], "source": name["source"], "text": name["text"]}
    named = own.select("*", *[F.col(n).alias(c) for c, n in parts.items()])
    taken = mixing.mix(named, keep=tuple(own.columns)).where("copies > 0")
    return restore(taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))))


@_stage
def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token shards and returns each document's digest from them."""
    return wavelet.document_digests(spark, wavelet.write_shards(docs, tokenizer_path(), END_ID))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixture", mixture),
    ("token_ids", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        last, docs = docs, store(stage(spark, docs, sf_dir), f"pipeline_{name}")
        discard(last)
    return docs
