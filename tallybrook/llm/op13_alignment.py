"""Alignment of two tokenizers' tokens by pointer jumping, and how common each aligned pair is.

Both tokenizers cut the same bytes. Every token points to its farthest-right overlapping
token of the other side, or to itself if both end at one place (of such a pair the A token
is the terminal one). Doubling the pointers of a whole batch, ``p = p[p]``, ends after as
many rounds as the longest chain has binary digits; each token then knows the terminal
token of its component, and tokens with one terminal token are a group: the smallest run
of bytes at whose ends both tokenizers cut.

How many documents hold an id pair linked is counted over the corpus in three steps. Documents
are dealt to chunks of a bounded size and stored with their pairs; each chunk asks once for
each of its pairs; the sums go back to the chunk. No pair meets its documents one by one,
so a pair that occurs everywhere costs one row a chunk.

Null and empty texts, and texts whose joined token bytes on either side are not a space and
the text, have no tokens: zeros and empty lists. Repeated rows are documents of their own.
Other columns are not looked at.
"""

from __future__ import annotations

import functools
import hashlib
import re
from array import array
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.llm.common import map_texts, stored
from tallybrook.llm.merge_arrays import ByteMerges, Memory, byte_characters

# A space before other white space or at the end: such a run of white space is one piece.
_ODD_SPACE = re.compile(r" (?:\s|\Z)")
# Fixed value: how the byte-level tokenizer cuts a text into pieces.
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# Texts of a chunk, in bytes; a longer text is a chunk of its own.
CHUNK_BYTES = 4 << 20


class ByteLevelTokens:
    """Side A: a byte-level BPE file; strings of special tokens are plain text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_file(path)
        self._whole.encode_special_tokens = True
        self._merges = ByteMerges(path)
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        vocabulary = self._whole.get_vocab()
        self.bytes = np.full(max(vocabulary.values()) + 1, b"", object)
        for token, i in vocabulary.items():
            plain = all(c in byte_of for c in token)
            self.bytes[i] = bytes(map(byte_of.get, token)) if plain else token.encode()
        self.lengths = _lengths(self.bytes)

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Packed ids of a space and each word, which has no space; the words are distinct."""
        plain, found = [], {}
        for word in words:
            if word.isalpha() and len(word) < 40:  # one piece
                plain.append(word)
            else:
                found[word] = _PIECES.findall(" " + word)
        distinct = list({p for pieces in found.values() for p in pieces})
        data = [p.encode("utf-8", "replace") for p in distinct]
        short = [i for i, d in enumerate(data) if len(d) <= ByteMerges.LONGEST]
        ids = self._merges.encode([*(b" " + w.encode() for w in plain), *[data[i] for i in short]])
        known = dict(zip((distinct[i] for i in short), ids[len(plain) :]))
        for i, d in enumerate(data):
            if len(d) > ByteMerges.LONGEST:
                known[distinct[i]] = self._library(distinct[i])
        whole = dict(zip(plain, ids))
        whole.update((w, b"".join([known[p] for p in pieces])) for w, pieces in found.items())
        return list(map(whole.__getitem__, words))

    def _library(self, text: str) -> bytes:
        return np.asarray(self._whole.encode(text, add_special_tokens=False).ids, "<i4").tobytes()

    def encode_whole(self, text: str) -> bytes:
        """Packed ids of a space and any text."""
        return self._library(" " + text)


class SentencePieces:
    """Side B: a sentencepiece model, which puts the space before the text itself."""

    def __init__(self, model: bytes):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [self._model.id_to_piece(i) for i in range(self._model.get_piece_size())]
        self.bytes = np.full(len(pieces), b"", object)
        for i, piece in enumerate(pieces):
            byte = re.fullmatch("<0x([0-9A-F]{2})>", piece) if self._model.is_byte(i) else None
            self.bytes[i] = bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()
        self.lengths = _lengths(self.bytes)
        # words can be encoded apart only if no piece spans two
        self.apart = not any(re.search("[^▁]▁", p) for p in pieces)

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Packed ids of a space and each word."""
        return [array("i", x).tobytes() for x in self._model.encode(words, num_threads=1)]

    def encode_whole(self, text: str) -> bytes:
        return self.encode_words([text])[0]


class Sides:
    """Both tokenizers, and what they made of words that they met."""

    def __init__(self, a: ByteLevelTokens, b: SentencePieces):
        self.a, self.b = a, b
        self._words = Memory(lambda words: list(zip(a.encode_words(words), b.encode_words(words))))

    def encode(self, texts: Sequence[str]) -> tuple[list[bytes], list[bytes]]:
        """Packed ids of a space and each text, by both."""
        cut: list = []
        for text in texts:
            # words can be encoded apart where they stand between single spaces; U+2581 is a space to B
            apart = self.b.apart and "▁" not in text and not _ODD_SPACE.search(" " + text)
            cut.append(text.split(" ") if apart else None)
        found = self._words.get_all([w for words in cut if words for w in words])
        of_a, of_b, at = [], [], 0
        for text, words in zip(texts, cut):
            if words is None:
                of_a.append(self.a.encode_whole(text))
                of_b.append(self.b.encode_whole(text))
                continue
            mine = found[at : at + len(words)]
            of_a.append(b"".join([x for x, _ in mine]))
            of_b.append(b"".join([y for _, y in mine]))
            at += len(words)
        return of_a, of_b


def _lengths(tokens: np.ndarray) -> np.ndarray:
    return np.array([len(t) for t in tokens], np.int64)


def terminals(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each A token, then each B token, the A token that ends its component.

    The ends are increasing byte offsets; the last of both are equal.
    """
    n = len(end_a)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return _terminals(end_a, end_b, _token_of_byte(end_a), _token_of_byte(end_b))


def _token_of_byte(ends: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))


def _terminals(end_a, end_b, a_of_byte, b_of_byte) -> tuple[np.ndarray, np.ndarray]:
    n = len(end_a)
    # the farthest-right overlapping token holds the last byte
    farthest_b, farthest_a = b_of_byte[end_a - 1], a_of_byte[end_b - 1]
    points = np.concatenate([np.where(end_b[farthest_b] == end_a, np.arange(n), n + farthest_b), farthest_a])
    while True:
        doubled = points[points]
        if (doubled == points).all():
            return points[:n], points[n:]
        points = doubled


class _Batch:
    """The tokens of a batch of texts, one after the other, and their components and links."""

    def __init__(self, texts: list[str], both: Sides):
        a, b = both.a, both.b
        ids = [[np.frombuffer(p, "<i4") for p in packed] for packed in both.encode(texts)]
        wholes = [b" " + text.encode("utf-8", "replace") if text else b"" for text in texts]
        sides_whole = [b"".join(s.bytes[np.concatenate(x)].tolist()) if x else b"" for s, x in zip((a, b), ids)]
        if not all(texts) or any(b"".join(wholes) != w for w in sides_whole):
            for i, whole in enumerate(wholes):
                if not whole or any(b"".join(s.bytes[x[i]].tolist()) != whole for s, x in zip((a, b), ids)):
                    ids[0][i] = ids[1][i] = np.empty(0, np.int32)
        self.n_a, self.n_b = (np.array([len(x) for x in side], np.int64) for side in ids)
        self.a, self.b = (np.concatenate([np.empty(0, np.int32), *side]) for side in ids)
        end_a, end_b = (np.cumsum(s.lengths[x]) for s, x in zip((a, b), (self.a, self.b)))
        a_of_byte, b_of_byte = _token_of_byte(end_a), _token_of_byte(end_b)
        self.group_a, self.group_b = _terminals(end_a, end_b, a_of_byte, b_of_byte)
        n = len(texts)
        self.doc_a, self.doc_b = (np.repeat(np.arange(n), c) for c in (self.n_a, self.n_b))
        last_of_group = self.group_a == np.arange(len(self.a))
        self.n_groups = np.bincount(self.doc_a[last_of_group], minlength=n)
        # token i of A overlaps the B tokens from that holding its first byte to that holding its last
        first = b_of_byte[end_a - a.lengths[self.a]]
        linked = b_of_byte[end_a - 1] - first + 1
        self.link_a = np.repeat(np.arange(len(self.a)), linked)
        offset = np.arange(len(self.link_a)) - np.repeat(np.cumsum(linked) - linked, linked)
        self.link_b = np.repeat(first, linked) + offset
        self.n_links = np.bincount(self.doc_a[self.link_a], minlength=n)
        self._width = len(b.bytes)

    def pairs(self) -> list[bytes]:
        """Per text its distinct pairs ``a << 32 | b``, increasing, then how often each is linked."""
        if not len(self.n_links):
            return []
        pair = self.a[self.link_a].astype(np.int64) * self._width + self.b[self.link_b]
        most = int(pair.max(initial=0)) + 1
        keys = np.sort(self.doc_a[self.link_a] * most + pair)
        new = np.flatnonzero(np.diff(keys, prepend=-1))
        often = np.diff(new, append=len(keys)).astype("<i4")
        keys = keys[new]
        doc, pair = keys // most, keys % most
        packed = (pair // self._width << 32 | pair % self._width).astype("<i8").tobytes()
        often = often.tobytes()
        ends = np.cumsum(np.bincount(doc, minlength=len(self.n_links))).tolist()
        return [packed[8 * i : 8 * j] + often[4 * i : 4 * j] for i, j in zip([0, *ends], ends)]

    def texts_of_groups(self, decimals: np.ndarray) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` per text."""
        n_a, n_b = len(self.a), len(self.b)
        of_a, of_b = (np.bincount(g, minlength=n_a) for g in (self.group_a, self.group_b))
        through_a, through_b = np.cumsum(of_a), np.cumsum(of_b)
        # within a group all of A stand before all of B
        place_a = np.arange(n_a) + (through_b - of_b)[self.group_a]
        place_b = np.arange(n_b) + through_a[self.group_b]
        token, follows = np.empty(n_a + n_b, np.int64), np.zeros(n_a + n_b, np.int8)
        token[place_a], token[place_b] = self.a, self.b
        # what follows: 0 ',', 1 '|', 2 ';', 3 nothing
        ends = np.flatnonzero(self.group_a == np.arange(n_a))
        follows[through_a[ends] + (through_b - of_b)[ends] - 1] = 1
        follows[through_a[ends] + through_b[ends] - 1] = 2
        doc_ends = np.cumsum(self.n_a + self.n_b)
        follows[doc_ends[doc_ends > 0] - 1] = 3
        shown = decimals[follows, token].tolist()
        ends = doc_ends.tolist()
        return [b"".join(shown[start:end]) for start, end in zip([0, *ends], ends)]

    def groups(self, doc_count: int) -> list[list[dict]]:
        """Per text its groups, in order: the ids of both sides."""
        out: list[list[dict]] = [[] for _ in range(doc_count)]
        ends = np.flatnonzero(self.group_a == np.arange(len(self.a)))
        cut_a = np.searchsorted(self.group_a, ends, "right").tolist()
        cut_b = np.searchsorted(self.group_b, ends, "right").tolist()
        docs = self.doc_a[ends].tolist()
        for doc, a0, a1, b0, b1 in zip(docs, [0, *cut_a], cut_a, [0, *cut_b], cut_b):
            out[doc].append({"a": self.a[a0:a1].tolist(), "b": self.b[b0:b1].tolist()})
        return out


@functools.lru_cache(maxsize=2)
def sides(a_path: str, b_model: bytes) -> Sides:
    """Both tokenizers, made once in a worker; the byte-level file is where every worker has it."""
    return Sides(ByteLevelTokens(a_path), SentencePieces(b_model))


def _in_workers(docs: DataFrame, a_path: str, b_model: bytes) -> Callable[[], Sides]:
    shared = docs.sparkSession.sparkContext.broadcast(b_model)
    return lambda: sides(a_path, shared.value)


def _decimals(size: int) -> np.ndarray:
    numbers = [str(i).encode() for i in range(size)]
    table = np.empty((4, size), object)
    for i, mark in enumerate((b",", b"|", b";", b"")):
        table[i] = [n + mark for n in numbers]
    return table


def aligned(docs: DataFrame, a_path: str, b_model: bytes, *, keep=("doc_id",), text: str = "text") -> DataFrame:
    """The ``keep`` columns and ``groups``: per group the ids of A (``a``) and of B (``b``), in order."""
    both = _in_workers(docs, a_path, b_model)
    kind = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))

    def columns(texts):
        return [pa.array(_Batch(texts, both()).groups(len(texts)), kind)]

    schema = "groups array<struct<a:array<int>,b:array<int>>>"
    return map_texts(docs, columns, schema, keep=keep, text=text)


_LINKED = (
    "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
    "chunk bigint, pairs binary"
)


def linked(docs: DataFrame, a_path: str, b_model: bytes, *, keep=("doc_id",), text: str = "text",
           chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Per document the counts and the digest of its groups, its chunk, and its linked id pairs, packed.

    Store the result before it is used twice: chunks are numbered as the rows are met.
    """
    sides_of = _in_workers(docs, a_path, b_model)
    tables: dict[int, np.ndarray] = {}
    state = {"task": None, "chunk": 0, "bytes": 0}

    def columns(texts):
        both = sides_of()
        if not tables:
            tables[0] = _decimals(max(len(both.a.bytes), len(both.b.bytes)))
        context = TaskContext.get()
        if state["task"] != context.taskAttemptId():
            state.update(task=context.taskAttemptId(), chunk=context.partitionId() << 32, bytes=0)
        chunks = []
        for t in texts:
            if state["bytes"] and state["bytes"] + len(t) > chunk_bytes:
                state.update(chunk=state["chunk"] + 1, bytes=0)
            state["bytes"] += len(t) + 200
            chunks.append(state["chunk"])
        batch = _Batch(texts, both)
        shown = batch.texts_of_groups(tables[0])
        digests = [hashlib.sha256(s).hexdigest() if s else "" for s in shown]
        counts = [pa.array(x, pa.int64()) for x in (batch.n_a, batch.n_b, batch.n_groups, batch.n_links)]
        return [*counts, pa.array(digests, pa.string()), pa.array(chunks, pa.int64()),
                pa.array(batch.pairs(), pa.binary())]

    return map_texts(docs, columns, _LINKED, keep=keep, text=text)


def _unpacked(pairs: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(pairs) // 12
    return np.frombuffer(pairs, "<i8", n), np.frombuffer(pairs, "<i4", n, 8 * n)


def _requests(found: DataFrame) -> DataFrame:
    """(chunk, pair, n_docs): each distinct pair of a chunk and in how many of its documents it is."""

    def run(batches):
        for batch in batches:
            chunks = batch.column(0).to_numpy()
            lists = [_unpacked(p)[0] for p in batch.column(1).to_pylist()]
            for chunk in np.unique(chunks).tolist():
                mine = [lists[i] for i in np.flatnonzero(chunks == chunk)]
                pair, n = np.unique(np.concatenate(mine), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(pair), chunk)), pa.array(pair), pa.array(n.astype(np.int64))],
                    ["chunk", "pair", "n_docs"],
                )

    return found.select("chunk", "pairs").mapInArrow(run, "chunk bigint, pair bigint, n_docs bigint")


def pair_counts(found: DataFrame) -> DataFrame:
    """(a, b, n_docs): in how many documents of ``linked`` each id pair is linked."""
    counted = _requests(found).groupBy("pair").agg(F.sum("n_docs").alias("n_docs"))
    b = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).cast("int")
    return counted.select(_side_a(F.col("pair")).alias("a"), b.alias("b"), "n_docs")


def _side_a(pair: Column) -> Column:
    return F.shiftright(pair, 32).cast("int")


def scored(found: DataFrame, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Per document of ``linked``: ``keep``, its counts and digest, ``n_best`` and ``count_sum``.

    ``found`` is stored. Counts are joined to the chunks' requests, so a pair's rows are as
    many as the chunks that hold it, and go back by chunk.
    """
    asked = stored(_requests(found), "pair-requests")
    counts = asked.groupBy("pair").agg(F.sum("n_docs").alias("total"))
    top = F.max("total").over(Window.partitionBy(_side_a(F.col("pair"))))
    counts = counts.select("pair", "total", (F.col("total") == top).alias("best"))
    answers = asked.select("chunk", "pair").join(counts, "pair")
    own = [F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(keep)]
    results = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    rows = found.select("chunk", "pairs", *own, *results)
    names = [*[f"_k{i}" for i in range(len(keep))], *results]
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[2:]]

    def answer(docs: pa.Table, counted: pa.Table) -> pa.Table:
        pair, total = counted.column("pair").to_numpy(), counted.column("total").to_numpy()
        best = counted.column("best").to_numpy()
        order = np.argsort(pair)
        pair, total, best = pair[order], total[order], best[order].astype(np.int64)
        n_best, sums = [], []
        for packed in docs.column("pairs").to_pylist():
            mine, often = _unpacked(packed)
            at = np.searchsorted(pair, mine)
            n_best.append(int((best[at] * often).sum()))
            sums.append(int((total[at] * often).sum()))
        out = docs.select(names)
        return out.append_column("n_best", pa.array(n_best, pa.int64())).append_column(
            "count_sum", pa.array(sums, pa.int64())
        )

    done = rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        answer, ", ".join([*kinds, "n_best bigint", "count_sum bigint"])
    )
    return done.select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], *results, "n_best", "count_sum"
    )
