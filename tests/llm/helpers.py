"""Documents that are odd in every way, and small oracles shared by the tests."""

from __future__ import annotations

from pyspark.sql import types as T

ODD_TEXTS = [
    None,
    "",
    "   \n\t ",
    "one",
    "one two three",
    "ÄÖ é日本 😀 mixed İ K text " * 3,
    "long " * 30_000,
    "x" * 50_000,
]
DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators might use themselves
        T.StructField("id", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("n_tokens", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("_k0", T.StringType()),
    ]
)


def docs(spark, texts, ids=None, schema=DOCS):
    ids = range(len(texts)) if ids is None else ids
    rows = [
        (i, t, None if i is None or i % 2 else "en", "s", None if t is None else len(t), "x", "y", "z", "w", "k")
        for i, t in zip(ids, texts, strict=True)
    ]
    return spark.createDataFrame(rows, schema)


def odd_docs(spark):
    """Odd texts, a repeated row, a null id."""
    return docs(spark, [*ODD_TEXTS, "one", "one"], [*range(len(ODD_TEXTS)), 3, None])


def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
