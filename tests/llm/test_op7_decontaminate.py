from __future__ import annotations

from collections import Counter

import pytest

from tallybrook.llm import op7_decontaminate as leaks
from tallybrook.llm.queries import op7_benchmark_leaks
from tests.llm.helpers import docs, no_docs, odd_docs, table


def runs(text, n=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def brute(rows, items):
    sets = {i: runs(t, min(5, max(1, len((t or "").split())))) for i, t in items}
    size = {i: min(5, len((t or "").split())) for i, t in items}
    out = set()
    for d, text in rows:
        of = {n: runs(text, n) for n in set(size.values()) if n}
        for i, s in sets.items():
            if s and len(s & of[size[i]]) / len(s) >= 0.8:
                out.add((d, i))
    return out


def test_every_document(spark, sf_dir):
    items = [(r["item_id"], r["text"]) for r in table(spark, sf_dir, "benchmark").collect()]
    rows = [(r["doc_id"], r["text"]) for r in table(spark, sf_dir, "documents").collect()]
    got = op7_benchmark_leaks(spark, sf_dir).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == brute(rows, items)
    assert len(got) == len({(r["doc_id"], r["item_id"]) for r in got})


def passage(n, name):
    return " ".join(f"{name}{k}" for k in range(n))


ITEMS = [
    (1, passage(30, "a")), (2, passage(300, "b")), (3, passage(900, "c")), (4, "Just Three words"), (5, None), (6, ""),
    (7, passage(30, "a")), (8, "one"),
]


def changed(text, places):
    w = text.split()
    for p in places:
        w[p] = "changed"
    return " ".join(w)


@pytest.mark.parametrize("chunk_bytes", [leaks.CHUNK_BYTES, 300])
def test_short_items_in_long_documents(spark, chunk_bytes):
    filler = passage(20_000, "f")
    texts = [
        f"{filler} {ITEMS[0][1]} {filler}",
        f"{filler} {changed(ITEMS[0][1], [0])}",  # 25 of 26 shingles
        f"{filler} {changed(ITEMS[0][1], [10, 20])}",  # 16 of 26
        f"{filler} {changed(ITEMS[1][1], range(0, 300, 30))} {filler}",
        f"{changed(ITEMS[1][1], range(0, 300, 12))} {filler}",
        f"{filler} {changed(ITEMS[2][1], range(0, 900, 40))}",
        "it has just  three\nWORDS in it", "just three", "", None, "One",
    ]
    bench = spark.createDataFrame([(*i, "x") for i in ITEMS], "item_id long, text string, leaks string")
    got = leaks.contained(docs(spark, texts), bench, chunk_bytes=chunk_bytes).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == brute(list(enumerate(texts)), ITEMS)


def test_containment_is_exact(spark):
    bench = spark.createDataFrame([(1, passage(14, "a"))], "item_id int, text string")
    df = docs(spark, [changed(passage(14, "a"), [0]), changed(passage(14, "a"), [0, 13]), changed(passage(14, "a"), [2])])
    got = {r["doc_id"]: r["containment"] for r in leaks.contained(df, bench).collect()}
    assert got == {0: 0.9, 1: 0.8}


def test_odd_documents(spark):
    bench = spark.createDataFrame([(1, "one"), (2, "one two three"), (3, "long long long long long long")], "item_id long, text string")
    df = odd_docs(spark)
    got = Counter((r["doc_id"], r["item_id"]) for r in leaks.contained(df, bench).collect())
    assert got == {(3, 1): 2, (None, 1): 1, (4, 1): 1, (4, 2): 1, (6, 3): 1}
    marked = leaks.mark(df, bench)
    assert marked.columns == [*df.columns, "leaks"]
    assert marked.count() == df.count()
    assert leaks.mark(no_docs(spark), bench).collect() == []
    empty = spark.createDataFrame([], "item_id long, text string")
    assert leaks.contained(df, empty).collect() == []
    with pytest.raises(ValueError, match="column"):
        leaks.mark(df, bench, leaks="TEXT")
