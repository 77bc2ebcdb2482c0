from __future__ import annotations

import math
from collections import Counter

import pytest

from tallybrook.llm import op6_lm_scores as lm
from tallybrook.llm.queries import op6_lm_scores_by_quality
from tests.llm.helpers import docs, no_docs, odd_docs, table

TEXTS = ["the cat sat", "The cat ran", "a dog sat on the cat", "", None, "rare words here", "the the the"]


def brute(texts, target, text, size):
    """The model with exact pairs, which so few words don't collide in."""
    split = lambda t: (t or "").lower().split()
    counts = Counter(w for t in texts for w in split(t))
    words = [w for w in counts if sum(n >= counts[w] for n in counts.values()) <= size]
    norm = lambda t: [w if w in words else "?" for w in split(t)]
    out = []
    for chosen in ([t for i, t in enumerate(texts) if i in target], texts):
        single, pair = Counter(), Counter()
        for t in chosen:
            for a, b in zip(["^", *norm(t)], norm(t)):
                single[b] += 1
                pair[a, b] += 1
            single["^"] += bool(norm(t))
        total = sum(n for w, n in single.items() if w != "^") + lm.SMOOTHING * (len(words) + 1)
        losses = [
            -math.log(lm.PAIR_WEIGHT * min(1, pair[a, b] / max(1, single[a]))
                      + (1 - lm.PAIR_WEIGHT) * (single[b] + lm.SMOOTHING) / total)
            for a, b in zip(["^", *norm(text)], norm(text))
        ]
        out.append(sum(losses) / len(losses) if losses else 0.0)
    return out


@pytest.mark.parametrize("size", [3, 100])
def test_losses(spark, size):
    target = spark.createDataFrame([(0,), (2,), (2,), (None,), (77,)], "i long")
    df = docs(spark, TEXTS)
    rows = lm.score(df, lm.train(df, target, size=size), keep=("doc_id", "text")).collect()
    assert len(rows) == len(TEXTS)
    for row in rows:
        a, b = brute(TEXTS, {0, 2}, row["text"], size)
        assert row["n_tokens"] == len((row["text"] or "").split())
        assert row["target_loss"] == pytest.approx(a, rel=1e-5)
        assert row["background_loss"] == pytest.approx(b, rel=1e-5)
        assert row["score"] == pytest.approx(a - b, rel=1e-4, abs=1e-6)


def test_odd_documents(spark):
    none = spark.createDataFrame([], "i long")
    df = odd_docs(spark)
    rows = lm.score(df, lm.train(df, none)).collect()
    assert len(rows) == df.count()
    assert all(math.isfinite(r["score"]) for r in rows)
    assert lm.score(no_docs(spark), lm.train(no_docs(spark), none)).collect() == []


def test_good_documents_score_lower(spark, sf_dir):
    scores = op6_lm_scores_by_quality(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id")
    mean = {r["quality"]: r["avg(score)"] for r in scores.groupBy("quality").avg("score").collect()}
    assert mean[1] < mean[0]


def test_every_word_and_pair_counts(spark, monkeypatch):
    """More words and pairs than any fixed table: rare ones are told apart, and small chunks agree."""
    texts = [" ".join(f"w{i}x{k} w{i}y{k}" for k in range(900)) for i in range(20)] + TEXTS
    target = spark.createDataFrame([(0,), (22,)], "i long")
    df = docs(spark, texts)
    rows = {r["doc_id"]: r for r in lm.score(df, lm.train(df, target)).collect()}
    n, total = 1 + 20 * 1800 + 10, 20 * 1800 + 18
    # each word of document 1 occurs once, and so does each pair; the start has 25 documents
    alone = 0.5 / (1800 + 6 + 0.5 * n)
    assert sum(r["n_tokens"] for r in rows.values()) == total
    once = 1.5 / (total + 0.5 * n)
    first, rest = 0.7 / 25 + 0.3 * once, 0.7 + 0.3 * once
    assert rows[1]["background_loss"] == pytest.approx(-(math.log(first) + 1799 * math.log(rest)) / 1800, rel=1e-9)
    assert rows[1]["target_loss"] == pytest.approx(-math.log(0.3 * alone), rel=1e-9)
    monkeypatch.setattr(lm, "CHUNK_BYTES", 50_000)
    monkeypatch.setattr(lm, "BUCKET_BYTES", 100_000)
    for other in (df, df.select("*")):  # the model's documents, and the same as other ones
        for r in lm.score(other, lm.train(df, target)).collect():
            assert tuple(r) == pytest.approx(tuple(rows[r["doc_id"]]), rel=1e-9)
