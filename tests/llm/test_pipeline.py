from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallybrook.llm import pipeline_stages as stages
from tests.llm import test_op1_bpe, test_op2_secrets, test_op4_ngram_join, test_op7_decontaminate
from tests.llm.helpers import docs, odd_docs, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return {r["doc_id"]: r for r in df.select(COLUMNS).collect()}


def test_toxic_documents_go(spark, sf_dir):
    """On the table with some hundreds of toxic labels: a few dozen, as in the smallest, teach few words."""
    sf_dir = sf_dir.replace("sf0.01", "sf0.1")
    kept = stages.without_toxic(spark, table(spark, sf_dir, "documents"), sf_dir)
    assert kept.columns == COLUMNS
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, sf_dir, "labels").collect()}
    before = {r["doc_id"] for r in table(spark, sf_dir, "documents").select("doc_id").collect()}
    after = {r["doc_id"] for r in kept.select("doc_id").collect()}
    clean = [i for i in before if labels.get(i) == 0]
    toxic = [i for i in before if labels.get(i) == 1]
    assert sum(i in after for i in clean) >= 0.98 * len(clean)
    assert sum(i in after for i in toxic) <= 0.1 * len(toxic)


def test_stages_by_brute_force(spark, sf_dir):
    """Each stage on what its predecessor kept."""
    current = spark.createDataFrame(stages.without_toxic(spark, table(spark, sf_dir, "documents"), sf_dir).collect())
    after = rows_of(current)
    groups = test_op4_ngram_join.brute([(i, r["text"]) for i, r in after.items()], 5, 80, 100)
    current = spark.createDataFrame(stages.without_near_copies(spark, current, sf_dir).collect())
    assert set(rows_of(current)) == {i for i, (_, c) in groups.items() if c == i}

    items = [(r["item_id"], r["text"]) for r in table(spark, sf_dir, "benchmark").collect()]
    leaking = {d for d, _ in test_op7_decontaminate.brute([(i, r["text"]) for i, r in rows_of(current).items()], items)}
    before = rows_of(current)
    current = spark.createDataFrame(stages.without_benchmark(spark, current, sf_dir).collect())
    assert set(rows_of(current)) == set(before) - leaking

    before = rows_of(current)
    current = spark.createDataFrame(stages.without_secrets(spark, current, sf_dir).collect())
    after = rows_of(current)
    assert set(after) == set(before)
    for i, row in after.items():
        found = test_op2_secrets.base_spans(before[i]["text"])
        assert test_op2_secrets.base_spans(row["text"]) == [] or found == []
        assert ("[SECRET]" in row["text"]) >= bool(found)
        assert row["n_chars"] == len(row["text"])

    for row in stages.encoded(spark, current, sf_dir).collect():
        assert row["ids"] == test_op1_bpe.ORACLE.encode_ordinary(after[row["doc_id"]]["text"])
        assert row["n_tokens"] == len(row["ids"])


CLASHING = ["score", "predicted", "base", "spans", "_leaks", "component_id", "ids", "_k0", "Doc_Id2", "_hash", "_text"]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_odd_documents_pass_with_columns_of_any_name(spark, sf_dir, name, stage):
    for df in (odd_docs(spark), odd_docs(spark).limit(0)):
        df = df.select(*COLUMNS, *[F.lit(f"own {c}").alias(c) for c in CLASHING])
        out = stage(spark, df, sf_dir)
        rows = out.collect()
        assert len(rows) == df.count() - (name == "ngram_jaccard_join" and not df.isEmpty())
        if name != "bpe":
            assert out.columns == df.columns
            assert all(r[c] == f"own {c}" for r in rows for c in CLASHING)
            if name != "secrets":
                texts = {r["doc_id"]: r["text"] for r in df.collect()}
                assert all(texts[r["doc_id"]] == r["text"] for r in rows)


def test_the_row_that_stays_of_a_repeated_id_is_always_the_same(spark):
    rows = [(1, f"words that differ {i} " * 9, None, "s", i) for i in range(20)]
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    kept = set()
    for order in (rows, rows[::-1], rows[7:] + rows[:7]):
        df = spark.createDataFrame(order, kind).repartition(3)
        kept.add(tuple(tuple(r) for r in stages.without_near_copies(spark, df, "").collect()))
    assert len(kept) == 1 and len(kept.pop()) == 1


def test_nothing_but_the_result_is_left(spark, sf_dir):
    place = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = set(place.iterdir())
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.count() > 500
    assert [p.name.rsplit("-", 1)[0] for p in set(place.iterdir()) - before] == ["pipeline-bpe"]


def test_one_row_stays_of_copies(spark, sf_dir):
    df = docs(spark, ["a b c d e f", "a b c d e f", "a b c d e f", "x y z"], [4, 4, 7, None]).select(COLUMNS)
    got = stages.without_near_copies(spark, df, sf_dir).collect()
    assert sorted((r["doc_id"] or -1) for r in got) == [-1, 4]


def test_stage_list():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "decontamination", "secrets", "bpe"]
