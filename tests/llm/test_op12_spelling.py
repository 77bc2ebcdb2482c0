from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tallybrook.llm import op12_spelling as op12
from tallybrook.llm.common import stored
from tallybrook.llm.queries import SQL, op12_spelling_variants
from tests.llm.helpers import docs, no_docs, odd_docs
from tests.oracle import normal, sql_rows


def near(a, b):
    """Exactly one insertion, deletion or replacement."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    short, long = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def by_hand(counts, ratio=5):
    rows = {}
    for word, n in counts.items():
        close = sorted((-m, w) for w, m in counts.items() if near(word, w))
        form = close[0][1] if close and -close[0][0] >= ratio * n else None
        rows[word] = [form, n, len(close), counts[form] if form else None]
    out = []
    for word, (form, *rest) in rows.items():
        root = word
        while rows[root][0]:
            root = rows[root][0]
        out.append((word, form, root, *rest))
    return sorted(out, key=str)


def found(spark, counts, **options):
    vocabulary = spark.createDataFrame(list(counts.items()), "word string, n long")
    return sorted((tuple(r) for r in op12.variants(stored(vocabulary, "test"), **options).collect()), key=str)


def test_agrees_with_sql(spark, sf_dir):
    df = op12_spelling_variants(spark, sf_dir)
    names, want = sql_rows(SQL["op12_spelling_variants"], sf_dir)
    assert sorted(names) == sorted(df.columns)
    got = normal([tuple(r) for r in df.collect()], df.columns)
    assert got == normal(want, names)
    assert len(got) > 1000 and sum(r[df.columns.index("form")] is not None for r in got) > 10


def words_near_each_other(seed, n, letters="abé", sizes=(6, 7, 8)):
    dealer = np.random.default_rng(seed)
    made = ["".join(dealer.choice(list(letters), dealer.choice(sizes))) for _ in range(n)]
    return {w: int(5 * 6 ** dealer.integers(0, 5)) for w in made}


def test_many_neighbours(spark):
    counts = words_near_each_other(1, 400)
    assert found(spark, counts) == by_hand(counts)


def test_large_groups_are_split(spark):
    counts = words_near_each_other(2, 300) | {"prefix" + w: n for w, n in words_near_each_other(3, 60, "ab", (3, 4)).items()}
    assert found(spark, counts, group_words=3) == by_hand(counts)


def test_prefixes_ties_and_long_words(spark):
    long = "lang" * 300
    counts = {
        "abcdef": 5, "abcdefg": 25, "abcdefgh": 125, "xabcdef": 25, "aabcdef": 25, "abcdeff": 25, "bcdefg": 7,
        long: 5, long + "a": 30, long[:-1]: 30, long[:600] + "x" + long[601:]: 30, "aaaaaa": 5, "aaaaaaa": 24,
        "😀bcdefg": 9, "ÿabcdef": 25,
    }
    assert found(spark, counts) == by_hand(counts)


@given(st.lists(st.text("abc", min_size=1, max_size=7), min_size=1, max_size=40, unique=True))
@settings(max_examples=200, deadline=None)
def test_scan_finds_all_at_one_edit(lines):
    lines = sorted(lines)
    lists = op12._Lists(lines, np.zeros(len(lines), int))
    a, b = op12.near_pairs(lists, np.arange(len(lines)))
    got = sorted(zip(a.tolist(), b.tolist()))
    n = range(len(lines))
    assert got == [(i, j) for i in n for j in n if near(lines[i], lines[j])]


def test_words_of_texts(spark):
    texts = ["Grün-Straße strasse STRASSE ététété x", None, "", "strasse " * 40_000, "a" * 60_000] * 2
    got = {r["word"]: r["n"] for r in op12.words(docs(spark, texts), min_count=1).collect()}
    want = Counter()
    for i, text in enumerate(texts):
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{i}:{run}".encode())
            at = h % len(run)
            want[run[:at] + run[at + 1 :] if h % 199 == 0 else run] += 1
    assert got == {w: n for w, n in want.items() if len(w) >= 6}


def test_odd_and_empty_tables(spark):
    for make in (odd_docs, no_docs):
        vocabulary = stored(op12.words(make(spark)), "test")
        assert op12.variants(vocabulary).count() == vocabulary.count()
