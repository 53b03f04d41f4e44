"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. What a stage writes on its way
belongs to its own ``scratch.Run``, which its result carries as ``scratch_run``: whoever has written the result may delete it.

Defined cases, for all stages: a null text is an empty one and a null doc_id stays one; texts are read whole, however
long; repeated rows are documents of their own until the exact dedup; an empty table gives an empty table; columns beyond
those of documents are kept by all stages but the last, whatever their names.
"""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmill.llm import ngram_join, ordinal, packing, radix_dedup, scratch, secrets


def stage(f):
    """A stage with a run of its own for its tables."""

    @functools.wraps(f)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        own = scratch.Run(spark)
        out = f(spark, docs, sf_dir, own)
        out.scratch_run = own
        return out

    return run_stage


@stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str, run: scratch.Run) -> DataFrame:
    """Documents that the quality classifier rejects go. Labels that decide no grade are no rating; with no ratings, all stay."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return ordinal.select_good(docs, labels.select("doc_id", ordinal.grade_of(F.col("quality"), F.col("toxic")).alias("grade")), run=run)


@stage
def exact(spark: SparkSession, docs: DataFrame, sf_dir: str, run: scratch.Run) -> DataFrame:
    """Of equal texts one document stays, that with the smallest doc_id; one of them, if its row is repeated."""
    return radix_dedup.drop_copies(docs, run=run)


@stage
def near(spark: SparkSession, docs: DataFrame, sf_dir: str, run: scratch.Run) -> DataFrame:
    """Of documents linked by five-word shingles at a similarity of 0.8 one stays; empty texts link with nothing and stay."""
    return ngram_join.keep_one(docs, n=5, percent=80, run=run)


@stage
def secret(spark: SparkSession, docs: DataFrame, sf_dir: str, run: scratch.Run) -> DataFrame:
    """Owner-specific credentials are masked; the documents stay. A null source or lang is an owner or repository of its own."""
    repository = F.concat(F.coalesce("source", F.lit("")), F.lit("/"), F.coalesce("lang", F.lit("")))
    out = secrets.mask_live(docs, repository, F.col("source"), run=run)
    return out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.coalesce(F.length("text"), F.lit(0)).cast("long")))


@stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str, run: scratch.Run) -> DataFrame:
    """Pieces of training sequences; an empty document is its end id alone."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality classifier", quality), ("exact dedup", exact), ("n-gram Jaccard join", near), ("secret scans", secret), ("packing", packed)]

#: Fitting, the join's components and the tokenizer are beyond SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents; each stage's result is written and read again, and what it was made of deleted."""
    whole, docs = scratch.Run(spark), spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, f in STAGES[:-1]:
        out = f(spark, docs, sf_dir)
        kept = whole.keep(out, name.replace(" ", "-"))
        out.scratch_run.delete()
        if hasattr(docs, "scratch_path"):
            whole.drop(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
