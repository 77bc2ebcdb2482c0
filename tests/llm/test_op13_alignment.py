from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallybrook.llm import op13_alignment as op13
from tallybrook.llm.common import stored
from tallybrook.llm.queries import op13_token_alignment, two_tokenizers
from tests.llm.helpers import ODD_TEXTS, docs, no_docs, odd_docs, table

PATH, MODEL = two_tokenizers()
A = Tokenizer.from_file(PATH)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
BYTE_OF = {c: b for b, c in enumerate(op13.byte_characters())}


def a_bytes(i):
    return bytes(BYTE_OF[c] for c in A.id_to_token(i))


def b_bytes(i):
    piece = B.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if B.is_byte(i) else piece.replace("▁", " ").encode()


def by_hand(text):
    """Groups [(a ids, b ids)] and links [(a, b)] of a text, token by token."""
    a = A.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
    b = B.encode(text) if text else []
    whole = b" " + (text or "").encode()
    if b"".join(map(a_bytes, a)) != whole or b"".join(map(b_bytes, b)) != whole:
        return [], []

    def spans(ids, bytes_of):
        out, at = [], 0
        for i in ids:
            out.append((at, at + len(bytes_of(i)), i))
            at = out[-1][1]
        return out

    sa, sb = spans(a, a_bytes), spans(b, b_bytes)
    both = sorted({e for _, e, _ in sa} & {e for _, e, _ in sb})
    groups, start = [], 0
    ia = ib = 0
    for end in both:
        ga, gb = [], []
        while ia < len(sa) and sa[ia][1] <= end:
            ga.append(sa[ia][2])
            ia += 1
        while ib < len(sb) and sb[ib][1] <= end:
            gb.append(sb[ib][2])
            ib += 1
        groups.append((ga, gb))
        start = end
    links, first = [], 0
    for s, e, i in sa:
        while sb[first][1] <= s:
            first += 1
        at = first
        while at < len(sb) and sb[at][0] < e:
            links.append((i, sb[at][2]))
            at += 1
    assert start == len(whole)
    return groups, links


def expected(texts):
    found = [by_hand(t) for t in texts]
    count = Counter(pair for _, links in found for pair in set(links))
    top = {}
    for (a, _), n in count.items():
        top[a] = max(top.get(a, 0), n)
    rows = []
    for groups, links in found:
        shown = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        rows.append((
            sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
            hashlib.sha256(shown.encode()).hexdigest() if groups else "",
            sum(count[p] == top[p[0]] for p in links), sum(count[p] for p in links),
        ))
    return rows, count


def test_every_document(spark, sf_dir):
    rows = op13_token_alignment(spark, sf_dir).collect()
    given = {r["doc_id"]: r["text"] for r in table(spark, sf_dir, "documents").collect()}
    want, _ = expected(list(given.values()))
    assert {r["doc_id"]: tuple(r)[1:] for r in rows} == dict(zip(given, want))
    assert len(rows) == len(given)


ODD = [*ODD_TEXTS, "a  b   c \n\n d ", "two  spaces", " led", "▁ odd ▁", "<|endoftext|> <s> </s>", "x\u0000y", "é ﬁ   z"]


def test_odd_documents(spark):
    texts = [*ODD, "one", "one"]
    found = stored(op13.linked(docs(spark, texts), PATH, MODEL, keep=("doc_id", "score", "n_tokens"), chunk_bytes=50), "test")
    rows = sorted(op13.scored(found, keep=("doc_id", "score", "n_tokens")).collect())
    want, count = expected(texts)
    assert [tuple(r)[3:] for r in rows] == want
    assert {(r["score"], r["n_tokens"]) for r in rows} == {("w", "z")}
    assert {(r["a"], r["b"]): r["n_docs"] for r in op13.pair_counts(found).collect()} == count
    for make in (odd_docs, no_docs):
        found = stored(op13.linked(make(spark), PATH, MODEL), "test")
        assert op13.scored(found).count() == make(spark).count()


def test_groups(spark):
    rows = op13.aligned(docs(spark, ODD), PATH, MODEL).collect()
    for row, text in zip(sorted(rows), ODD):
        assert [(g["a"], g["b"]) for g in row["groups"]] == by_hand(text)[0]


@given(st.text(st.sampled_from("ab' slr\n\tév日😀12.,-_ABetin▁"), max_size=40))
@settings(max_examples=200, deadline=None)
def test_tokens_are_those_of_the_libraries(text):
    (a,), (b,) = op13.sides(PATH, MODEL).encode([text])
    assert np.frombuffer(a, "<i4").tolist() == A.encode(" " + text, add_special_tokens=False).ids
    if text:
        assert np.frombuffer(b, "<i4").tolist() == B.encode(text)


@given(st.lists(st.integers(1, 5), min_size=1, max_size=60), st.lists(st.integers(1, 5), min_size=1, max_size=60))
@settings(max_examples=200, deadline=None)
def test_terminals_are_common_ends(a, b):
    a, b = list(a), list(b)
    short, gap = (a, sum(b) - sum(a)) if sum(a) < sum(b) else (b, sum(a) - sum(b))
    if gap:
        short.append(gap)
    ends = [np.cumsum(x) for x in (a, b)]
    both = np.intersect1d(*ends)
    got = op13.terminals(*ends)
    for end, found in zip(ends, got):
        assert ends[0][found].tolist() == [int(both[np.searchsorted(both, e)]) for e in end]


def test_chains_longer_than_a_batch_of_rounds():
    a = np.cumsum([1, *[2] * 5000])
    b = np.cumsum([*[2] * 5000, 1])
    for side in op13.terminals(a, b):
        assert (side == len(a) - 1).all()
