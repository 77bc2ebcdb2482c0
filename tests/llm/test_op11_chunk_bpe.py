from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallybrook.llm import op11_chunk_bpe as op11
from tallybrook.llm.queries import op11_chunk_bpe_round_trip
from tests.llm.helpers import ODD_TEXTS, docs, no_docs, odd_docs, table

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
ODD = [
    *ODD_TEXTS, "A <|startoftext|>b<|endoftext|> <|START", "é e ́ H̱ İΣ ΑΣ Σ", " a b\x1cc\x85d​e",
    "DON'T 'LL x'll '' 's 12345 ½ ②", "日本語" * 3000, "word " * 3000 + "x" * 9000 + " é" * 5000, "\x00\x07 ß ÀÖ×÷", "'" * 200,
]


def library(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def expected(text):
    ids = library(text)
    decoded = LIBRARY.decode(ids, skip_special_tokens=False)
    return (
        len(ids),
        hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
        hashlib.sha256(decoded.encode()).hexdigest(),
    )


def test_every_document(spark, sf_dir):
    got = {r["doc_id"]: tuple(r)[1:] for r in op11_chunk_bpe_round_trip(spark, sf_dir).collect()}
    assert got == {r["doc_id"]: expected(r["text"]) for r in table(spark, sf_dir, "documents").collect()}


def test_odd_documents(spark):
    rows = sorted(op11.digests(docs(spark, ODD), PATH, keep=("doc_id", "n_tokens", "score")).collect(), key=lambda r: r[0])
    assert [tuple(r)[3:] for r in rows] == [expected(t) for t in ODD]
    assert {tuple(r)[1:3] for r in rows} == {("z", "w")}
    assert op11.digests(odd_docs(spark), PATH).count() == odd_docs(spark).count()
    assert op11.digests(no_docs(spark), PATH).collect() == []


def test_ids_and_texts(spark):
    rows = op11.decode(op11.encode(docs(spark, ODD), PATH, keep=("text", "score")), PATH).collect()
    for row in rows:
        assert row["ids"] == library(row["text"])
        assert row["decoded"] == LIBRARY.decode(row["ids"], skip_special_tokens=False)
    with pytest.raises(ValueError, match="choose another"):
        op11.decode(op11.encode(docs(spark, ODD), PATH).selectExpr("*", "1 Decoded"), PATH)


@given(st.lists(st.sampled_from(["a", "Bc", "'s", " ", "  ", "\n", "é", "😀", "12", ".,", "日", "́", "<|endoftext|>", "xyz" * 50]), max_size=80))
@settings(max_examples=200, deadline=None)
def test_any_cut_is_repaired(parts):
    text = "".join(parts)
    old = op11.SHORTEST, op11.LONGEST, op11.CUT_BITS
    op11.SHORTEST, op11.LONGEST, op11.CUT_BITS = 2, 9, 1  # joins nearly everywhere
    try:
        packed = op11.encoder(PATH).encode([text.encode(), b"", text.encode()])
    finally:
        op11.SHORTEST, op11.LONGEST, op11.CUT_BITS = old
    assert [np.frombuffer(p, "<i4").tolist() for p in packed] == [library(text), [], library(text)]


def test_every_character():
    encode = op11.encoder(PATH).encode
    texts = [f"x{c}y {c}" for c in map(chr, [*range(0xD800), *range(0xE000, 0x11000), *range(0x1F300, 0x1F700)])]
    got = encode([t.encode() for t in texts])
    want = LIBRARY.encode_batch_fast(texts, add_special_tokens=False)
    assert [np.frombuffer(p, "<i4").tolist() for p in got] == [w.ids for w in want]


def test_shared_passages_are_cut_alike_and_encoded_once():
    dealer = np.random.default_rng(0)
    passage, *own = (" ".join(f"w{x}" for x in dealer.integers(0, 10**6, 800)).encode() for _ in range(4))
    texts = [passage, own[0] + passage, own[1] + b"z" + passage + own[2]]
    chunks = []
    for text, bounds in zip(texts, op11.chunk_bounds(texts)):
        assert bounds == sorted(set(bounds)) and bounds[0] == 0 and bounds[-1] == len(text)
        sizes = np.diff(bounds)
        assert (sizes[:-1] >= op11.SHORTEST).all() and (sizes <= op11.LONGEST).all()
        chunks.append({text[a:b] for a, b in zip(bounds, bounds[1:])})
    assert len(chunks[0] & chunks[1] & chunks[2]) >= len(chunks[0]) - 4
    maker, asked = op11.ChunkEncoder(PATH), []
    plain = maker._encode_chunks
    maker.chunks._compute = lambda keys: asked.extend(keys) or plain(keys)
    maker.encode(texts)
    maker.encode(texts)
    assert len(asked) == len(set(asked)) == len(set().union(*chunks))
