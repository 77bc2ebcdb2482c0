from __future__ import annotations

import base64
import hashlib

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tallybrook.llm import op1_bpe
from tallybrook.llm.queries import op1_bpe_round_trip, tokenizer
from tests.llm.helpers import ODD_TEXTS, no_docs, odd_docs, table

RANKS, PATTERN = tokenizer()
ENCODER = op1_bpe.Encoder(op1_bpe.Vocabulary(RANKS, PATTERN))
ORACLE = tiktoken.Encoding(
    "own", pat_str=PATTERN, special_tokens={},
    mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, RANKS.splitlines())},
)
PIECES = st.text(st.sampled_from("ab' slr\n\tév日😀12.,-_ABetin"), max_size=40)


def expected(text):
    ids = ORACLE.encode_ordinary(text or "")
    return (
        len(ids),
        hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest(),
        hashlib.sha256((text or "").encode()).hexdigest(),
    )


@given(PIECES)
@settings(max_examples=300, deadline=None)
def test_encodes_as_the_oracle_does(text):
    assert ENCODER.encode(text) == ORACLE.encode_ordinary(text)
    assert ENCODER.decode(ENCODER.encode(text)) == text.encode()


@given(PIECES, PIECES, PIECES, st.data())
@settings(max_examples=200, deadline=None)
def test_edits_and_appends_give_the_whole_text_encoding(text, put, more, data):
    start = data.draw(st.integers(0, len(text)))
    end = data.draw(st.integers(start, len(text)))
    edited = op1_bpe.EditedText(ENCODER, text)
    edited.edit(start, end, put)
    edited.append(more)
    assert edited.encode() == ORACLE.encode_ordinary(text[:start] + put + text[end:] + more)


def test_an_edit_encodes_few_pieces():
    edited = op1_bpe.EditedText(ENCODER, "some words in a row " * 500)
    assert edited.edit(5000, 5001, "x") < 8


@given(st.binary(max_size=30), st.binary(max_size=12), st.integers(0, 30))
@settings(max_examples=200, deadline=None)
def test_prefix_table_is_that_of_the_whole_string(data, more, cut):
    table = op1_bpe.PrefixTable(ENCODER.vocabulary, data)
    table.append(more)
    assert table.last == op1_bpe.PrefixTable(ENCODER.vocabulary, data + more).last
    cut = min(cut, len(data))
    table.edit(cut, len(data), b"!?")
    assert table.last == op1_bpe.PrefixTable(ENCODER.vocabulary, data[:cut] + b"!?" + more).last
    assert b"".join(ENCODER.vocabulary.token[t] for t in table.tokens(cut)) == data[:cut]


@given(st.lists(st.one_of(st.binary(max_size=20), PIECES.map(str.encode)), max_size=12))
@settings(max_examples=200, deadline=None)
def test_tables_filled_together_are_those_filled_alone(pieces):
    arrays = ENCODER._arrays
    last, lengths = arrays.fill(pieces)
    alone = [op1_bpe.PrefixTable(ENCODER.vocabulary, p) for p in pieces]
    assert [row[:n].tolist() for row, n in zip(last, lengths)] == [t.last for t in alone]
    packed = arrays.encode(pieces)
    assert [np.frombuffer(p, "<u4").tolist() for p in packed] == [t.tokens() for t in alone]


def test_neighbours_asked_together_are_those_asked_alone():
    dealer = np.random.default_rng(3)
    tokens = np.array(list(ENCODER.vocabulary.token))
    left, right = (dealer.choice(tokens, 20_000) for _ in range(2))
    # mostly apart at random; halves of tokens are the others
    whole = [t for t in ENCODER.vocabulary.token if ENCODER.vocabulary.parts(t)]
    halves = np.array([ENCODER.vocabulary.parts(t) for t in whole])
    left, right = np.concatenate([left, halves[:, 0]]), np.concatenate([right, halves[:, 1]])
    got = ENCODER._arrays._stay_apart(left, right)
    assert got.tolist() == [ENCODER.vocabulary._stay_apart(a, b) for a, b in zip(left.tolist(), right.tolist())]
    assert not got[20_000:].any() and got[:20_000].any()


def test_memory_gives_way_and_comes_back():
    encoder = op1_bpe.Encoder(ENCODER.vocabulary)
    encoder._words._most = 5
    texts = ["some few words", "other words than some", "some few words"] * 3
    packed = encoder.packed_all(texts) + [encoder.packed(t) for t in texts]
    assert [np.frombuffer(p, "<u4").tolist() for p in packed] == [ORACLE.encode_ordinary(t) for t in texts * 2]
    assert len(encoder._words) <= 8


SPLIT = ["", " ", "  ", "\n", "\t", "\r\n", "\x0b", "\x1c", "\x85", "\xa0", "\u2003", "\u3000", "\u200b", "'", "''", "'s",
         "'ll", "'S", "a", "re", "é", "日", "\u0301", "1", "٣", "½", ".", "—", "😀", "\x00", "\ud800", "?"]


def assert_cut_as_matches(texts):
    pieces, count = op1_bpe.cut(texts)
    pieces, start = [p.decode() for p in pieces.to_pylist()], 0
    for text, end in zip(texts, count.tolist(), strict=True):
        own, start = pieces[start:end], end
        assert "".join(own) == text.encode("utf-8", "replace").decode()
        matches = [ENCODER.vocabulary.pattern.findall(p) for p in own]
        assert [m.encode("utf-8", "replace").decode() for m in ENCODER.vocabulary.pattern.findall(text)] == sum(matches, [])
        assert all(len(m) == 1 for m, p in zip(matches, own) if "'" not in p)
    assert start == len(pieces)


@given(st.lists(st.lists(st.sampled_from(SPLIT), max_size=12).map("".join), max_size=6))
@settings(max_examples=1000, deadline=None)
def test_texts_are_cut_at_the_matches_of_the_pattern(texts):
    assert_cut_as_matches(texts)
    packed = ENCODER.packed_all(texts)
    whole = [t.encode("utf-8", "replace").decode() for t in texts]
    assert [np.frombuffer(p, "<u4").tolist() for p in packed] == [ORACLE.encode_ordinary(t) for t in whole]
    assert ENCODER.decode_packed_all(packed) == [t.encode() for t in whole]


def test_all_neighbours_are_cut_at_the_matches_of_the_pattern():
    assert_cut_as_matches([a + b + c + d for a in SPLIT for b in SPLIT for c in SPLIT[:16] for d in ("", "a", " ")])


def test_every_code_point_is_cut_at_the_matches_of_the_pattern():
    assert_cut_as_matches([f"a{chr(c)}1{chr(c)}.{chr(c)} {chr(c)}'{chr(c)}" for c in range(0x110000) if not 0xD800 <= c < 0xE000])


def test_pieces_are_encoded_once_while_they_are_used():
    encoder = op1_bpe.Encoder(ENCODER.vocabulary)
    encoder._words._most = 400
    asked, compute = [], encoder._words._compute
    encoder._words._compute = lambda pieces: (asked.extend(pieces), compute(pieces))[1]
    for batch in range(40):
        rare = " ".join(f"{chr(97 + batch % 26)}{chr(97 + i)}{'xyz'[batch // 26]}q" for i in range(26))
        text = f"frequent words, frequent; words. (frequent)\n{rare}"
        assert np.frombuffer(encoder.packed(text), "<u4").tolist() == ORACLE.encode_ordinary(text)
    asked = [p.decode() if isinstance(p, bytes) else p for p in asked]
    assert [asked.count(p) for p in ("frequent", " frequent", " words")] == [1, 1, 1]
    assert not [p for p in asked if "frequent" in p and p.strip() != "frequent"]
    assert len(encoder._words) <= 400 + 40


def test_long_pieces_are_not_remembered():
    encoder = op1_bpe.Encoder(ENCODER.vocabulary)
    text = "x" * 5000 + " y"
    assert np.frombuffer(encoder.packed(text), "<u4").tolist() == ORACLE.encode_ordinary(text)
    assert len(encoder._words) == 1


def test_other_patterns_are_matched_text_by_text():
    encoder = op1_bpe.Encoder(op1_bpe.Vocabulary(RANKS, r"\p{L}{1,3}|[^\p{L}]"))
    other = tiktoken.Encoding("other", pat_str=r"\p{L}{1,3}|[^\p{L}]", special_tokens={}, mergeable_ranks=ENCODER.vocabulary.ranks)
    texts = ["", "some words, don't", "  a\n\nb", "日本語のテキスト"]
    assert [np.frombuffer(p, "<u4").tolist() for p in encoder.packed_all(texts)] == [other.encode_ordinary(t) for t in texts]


def test_empty_batches_and_unknown_ids():
    for texts in ([], [""], ["", ""]):
        assert ENCODER.packed_all(texts) == ENCODER.decode_packed_all([b""] * len(texts)) == [b""] * len(texts)
    with pytest.raises(KeyError):
        ENCODER.decode_packed((10**6).to_bytes(4, "little"))


def test_every_document(spark, sf_dir):
    got = {r["doc_id"]: tuple(r)[1:] for r in op1_bpe_round_trip(spark, sf_dir).collect()}
    assert got == {r["doc_id"]: expected(r["text"]) for r in table(spark, sf_dir, "documents").collect()}


def test_odd_documents(spark):
    rows = op1_bpe.digests(odd_docs(spark), RANKS, PATTERN).collect()
    assert len(rows) == len(ODD_TEXTS) + 2
    got = sorted(tuple(r)[1:] for r in rows)
    assert got == sorted(expected(t) for t in [*ODD_TEXTS, "one", "one"])
    assert op1_bpe.digests(no_docs(spark), RANKS, PATTERN).collect() == []


def test_ids_round_trip(spark):
    encoded = op1_bpe.encode(odd_docs(spark), RANKS, PATTERN, keep=("doc_id", "text"))
    for row in op1_bpe.decode(encoded, RANKS, PATTERN).collect():
        assert bytes(row["decoded"]).decode() == (row["text"] or "")
        assert row["ids"] == ORACLE.encode_ordinary(row["text"] or "")


def test_a_vocabulary_needs_all_bytes():
    with pytest.raises(ValueError, match="single byte"):
        op1_bpe.Vocabulary(base64.b64encode(b"a") + b" 0", PATTERN)
