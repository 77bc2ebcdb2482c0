from __future__ import annotations

import numpy as np
import pytest

from tallybrook.llm import op3_embeddings
from tallybrook.llm.queries import op3_embedding_duplicates
from tests.llm.helpers import table


def brute(rows, least=0.98):
    """Links and components of (id, label, vector) rows with one row per id."""
    n = len(rows)
    links = {i: 0 for i, _, _ in rows}
    root = {i: i for i, _, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    unit = []
    for _, label, v in rows:
        v = None if v is None or any(x is None for x in v) else np.array(v, float)
        fine = v is not None and label is not None and len(v) and np.isfinite(v).all() and v.any()
        unit.append(v / np.linalg.norm(v) if fine else None)
    for a in range(n):
        for b in range(a):
            x, y = unit[a], unit[b]
            if x is None or y is None or len(x) != len(y) or rows[a][1] != rows[b][1] or x @ y < least:
                continue
            i, j = rows[a][0], rows[b][0]
            links[i] += 1
            links[j] += 1
            i, j = find(i), find(j)
            root[max(i, j)] = min(i, j)
    return {i: (links[i], find(i), find(i) == i) for i, _, _ in rows}


def got(df):
    return {r["vec_id"]: tuple(r)[1:] for r in df.collect()}


def made(seed, clusters, size, spread, dim=16, alone=60):
    rng = np.random.default_rng(seed)
    vectors = []
    for _ in range(clusters):
        base = rng.normal(size=dim)
        vectors += [base + rng.normal(size=dim) * spread for _ in range(size)]
    vectors += list(rng.normal(size=(alone, dim)))
    order = rng.permutation(len(vectors))
    return [(int(k), int(i % 2), [float(np.float32(x)) for x in vectors[i]]) for k, i in enumerate(order)]


SCHEMA = "vec_id long, label int, embedding array<float>"


@pytest.mark.parametrize("shard", [3000, 60])
def test_links_and_components(spark, shard):
    rows = made(3, clusters=12, size=9, spread=0.05)
    rows += [(1000, 1, rows[0][2]), (1001, rows[0][1], rows[0][2]), (1002, rows[0][1], rows[0][2])]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(op3_embeddings.near_duplicates(df, shard=shard)) == brute(rows)


def test_a_large_group_of_near_copies_is_compared_in_blocks(spark):
    rows = [(i, 0, v) for i, _, v in made(5, clusters=1, size=150, spread=0.02, alone=0)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(op3_embeddings.near_duplicates(df, shard=40)) == brute(rows)


def test_odd_vectors_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0, 0.0], [nan, 1.0], [inf, 1.0], [None, 1.0], [1.0, 2.0], [1.0, 2.0], [2.0, 4.0], [1.0, 2.0, 0.0]]
    rows = [(i, 1, v) for i, v in enumerate(odd)] + [(20, None, [1.0, 2.0]), (21, 2, [1.0, 2.0])]
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA + ", id string, n int, shard string")
    assert got(op3_embeddings.near_duplicates(df)) == brute(rows)


def test_repeated_rows_and_ids_and_no_rows(spark):
    rows = [(1, 0, [1.0, 0.0]), (1, 0, [1.0, 0.0]), (2, 0, [0.0, 1.0]), (2, 0, [1.0, 0.01]), (None, 0, [1.0, 0.0])]
    res = op3_embeddings.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(res) == 5
    assert {r["component_id"] for r in res} == {1, None}
    assert op3_embeddings.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_recall_on_the_table(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    result = op3_embedding_duplicates(spark, sf_dir)
    assert result.count() == vectors.count()
    assert op3_embeddings.recall(vectors, result, every=1) >= 0.9


def test_graph_is_pruned_and_leads_to_every_node():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 12))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    lists = op3_embeddings.graph(x)
    reached, todo = {0}, [0]
    while todo:
        for v in lists[todo.pop()]:
            if v not in reached:
                reached.add(v)
                todo.append(v)
    assert len(reached) == 400
    assert np.mean([len(v) for v in lists]) < 2 * op3_embeddings.DEGREE


def test_shards_that_cannot_be_split_link_with_others(spark):
    """Vectors close together along an arc: each shard is all alike, and links cross the borders."""
    angles = np.random.default_rng(7).uniform(0, 1.5, size=300)
    rows = [(i, 0, [float(np.cos(a)), float(np.sin(a))]) for i, a in enumerate(angles)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    assert got(op3_embeddings.near_duplicates(df, shard=50)) == brute(rows)
