from __future__ import annotations

import numpy as np
import pytest

from tallybrook.llm import op4_ngram_join as join
from tallybrook.llm.queries import op4_ngram_jaccard
from tests.llm.helpers import docs, no_docs, odd_docs, table


def shingle_sets(rows, words):
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        runs = [tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))] if w else []
        sets.setdefault(i, frozenset(runs))
    return sets


def brute(rows, words, num, den):
    sets = shingle_sets(rows, words)
    holders = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    tried = set()
    for own in holders.values():
        for k, a in enumerate(own):
            for b in own[:k]:
                if (a, b) not in tried:
                    tried.add((a, b))
                    common = len(sets[a] & sets[b])
                    if den * common >= num * (len(sets[a]) + len(sets[b]) - common):
                        x, y = find(a), find(b)
                        root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def got(df):
    return {r["doc_id"]: tuple(r)[1:] for r in df.collect()}


def near_copies(seed=4, families=12, size=14, words=80):
    rng = np.random.default_rng(seed)
    common = [f"c{k}" for k in range(30)]
    texts = []
    for f in range(families):
        base = [f"w{f}x{rng.integers(500)}" for _ in range(words)] + common
        for _ in range(size):
            own = list(base)
            for at in rng.integers(0, words, rng.integers(0, 5)):
                own[at] = f"n{rng.integers(10**6)}"
            texts.append(" ".join(own[: rng.integers(words, len(own) + 1)]))
    return texts


@pytest.mark.parametrize(("block", "words", "num"), [(join.BLOCK_SHINGLES, 4, 85), (300, 4, 85), (300, 5, 80)])
def test_components_of_near_copies(spark, block, words, num):
    texts = near_copies()
    df = docs(spark, texts)
    result = join.near_duplicates(df, words=words, num=num, den=100, block_shingles=block)
    assert got(result) == brute(list(enumerate(texts)), words, num, 100)


def test_every_document(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, sf_dir, "documents").collect()]
    assert got(op4_ngram_jaccard(spark, sf_dir)) == brute(rows, 4, 85, 100)


def test_odd_documents(spark):
    rows = join.near_duplicates(odd_docs(spark)).collect()
    assert len(rows) == odd_docs(spark).count()
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows} == {
        (0, 0, 0), (1, 0, 1), (2, 0, 2), (3, 1, 3), (None, 1, None), (4, 1, 4), (5, 7, 5), (6, 1, 6), (7, 1, 7),
    }
    assert join.near_duplicates(no_docs(spark)).collect() == []


def test_an_id_with_two_texts_joins_their_groups(spark):
    texts = ["a b c d e f", "g h i j k l", "a b c d e f", "g h i j k l", "a b c d e f"]
    rows = join.near_duplicates(docs(spark, texts, [5, 6, 9, 9, 2])).collect()
    assert {(r["doc_id"], r["component_id"]) for r in rows} == {(5, 2), (6, 2), (9, 2), (2, 2)}


def test_tiles_find_what_all_pairs_find():
    rng = np.random.default_rng(2)
    base = np.unique(rng.integers(0, 2**60, 200).astype(np.uint64))
    sets = [np.unique(np.concatenate([rng.choice(base, 185, replace=False), rng.integers(0, 2**60, 4).astype(np.uint64)]))
            for _ in range(60)]
    def parts(links):
        root = list(range(60))
        def find(i):
            while root[i] != i:
                i = root[i]
            return i
        for a, b in links:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
        return [find(i) for i in range(60)]
    every = []
    for a in range(60):
        for b in range(a):
            common = len(np.intersect1d(sets[a], sets[b]))
            if 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
                every.append((a, b))
    links = join.tile_links(sets, 85, 100)
    assert parts(links) == parts(every)
    assert {tuple(sorted(x)) for x in links} <= {tuple(sorted(x)) for x in every}
    side = np.arange(60) % 2
    crossing = [(a, b) for a, b in every if side[a] != side[b]]
    assert parts(join.tile_links(sets, 85, 100, side)) == parts(crossing)
