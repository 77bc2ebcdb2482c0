"""Stages of the corpus pipeline, each (spark, docs, sf_dir) -> DataFrame.

``docs`` has the columns of ``documents``, and any others; all stages but the last return
these again. Columns beside those that a stage uses have other names within it, so theirs
may be any. Rows with null columns, repeated rows and empty tables pass through every stage.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.llm import op1_bpe, op2_secrets, op4_ngram_join, op7_decontaminate, op9_toxicity
from tallybrook.llm.common import table
from tallybrook.llm.queries import tokenizer


_USED = ("doc_id", "text", "lang", "source", "n_chars")


def _others_apart(stage: Callable) -> Callable:
    """The stage, for documents with further columns of any name."""

    @functools.wraps(stage)
    def apart(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = [c if c in _USED else f"_other{i}" for i, c in enumerate(docs.columns)]
        out = stage(spark, docs.toDF(*names), sf_dir)
        return out.select(*names).toDF(*docs.columns)

    return apart


@_others_apart
def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the toxicity score rejects."""
    model = op9_toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = op9_toxicity.score(docs, model, keep=docs.columns)
    return scored.where("predicted = 0").select(docs.columns)


@_others_apart
def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of the smallest id of each group of near copies.

    Five words and a similarity of 0.8. Rows that repeat an id are one document, of which
    one row stays, the same one in every run: that of the least hash. Rows without an id
    belong to no group and stay.
    """
    groups = op4_ngram_join.near_duplicates(docs, words=5, num=80, den=100)
    first = groups.where("doc_id = component_id").select("doc_id").distinct()
    hashed = [F.col(c).cast("binary") if c == "text" else F.col(c) for c in _USED]
    marked = docs.withColumn("_hash", F.xxhash64(*hashed))
    least = marked.where("doc_id is not null").groupBy("doc_id").agg(F.min("_hash").alias("_hash"))
    least = least.join(first, "doc_id", "left_semi")
    kept = marked.join(least, ["doc_id", "_hash"], "left_semi").dropDuplicates(["doc_id"])
    return kept.drop("_hash").union(docs.where("doc_id is null"))


@_others_apart
def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that contain a benchmark item."""
    marked = op7_decontaminate.mark(docs, table(spark, sf_dir, "benchmark"), leaks="_leaks")
    return marked.where(F.size("_leaks") == 0).select(docs.columns)


@_others_apart
def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put a placeholder in the place of each secret; all documents stay."""
    model = op2_secrets.train(op2_secrets.labelled_samples(docs))
    found = op2_secrets.find(docs, model, keep=docs.columns)
    hit = F.size("spans") > 0
    text = op2_secrets.redacted(F.col("text"), F.col("spans"))
    found = found.withColumn("_text", text)
    changed = {"text": F.col("_text"), "n_chars": F.when(hit, F.length("_text").cast("long")).otherwise(F.col("n_chars"))}
    return found.select(*[changed.get(c, F.col(c)).alias(c) for c in docs.columns])


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each document: doc_id, lang, source, n_tokens, ids."""
    ids = op1_bpe.encode(docs, *tokenizer(), keep=("doc_id", "lang", "source"))
    return ids.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", without_toxic),
    ("ngram_jaccard_join", without_near_copies),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("bpe", encoded),
]
