"""BPE with word ends, encoded by content-defined chunks that documents share.

A rolling hash over the last 32 bytes decides where a text is cut, so equal passages are
cut alike wherever they stand. A worker encodes each distinct chunk once while it remembers
it, in all documents of its tasks. Between the spaces nearest to its ends a chunk's ids are final.
What stands across a join, from the last space before it to the first space after it, is
put together and encoded again; the span grows over chunks without a space until it has a
space on both sides. There both encodings agree whatever follows: neither the normalization
nor the pattern that cuts words reaches over a space.

Spans between spaces are encoded once while remembered as well: common ones by merging the
pieces of many spans at once in arrays, those with letters for which normalization is not plain
lower-casing, very long ones, and those with special tokens by the library.

Null and empty texts have no tokens. Repeated rows stay; other columns are not looked at.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import map_texts, mixed
from tallybrook.llm.merge_arrays import ByteMerges, Memory

# Bytes of a chunk: never fewer (but the last), never more, and how often the hash cuts between.
SHORTEST, LONGEST, CUT_BITS = 64, 4096, 8
# Fixed value: the pattern by which the tokenizer cuts words.
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
# Spans for which the tokenizer's normalization is lower-casing letter by letter.
_PLAIN = re.compile("[\t-\r!-~À-ÿ]*")
_GEAR = (mixed(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def rolling_hashes(data: np.ndarray) -> np.ndarray:
    """For each byte a 32-bit hash of it and the 31 before it, those nearer shifted less."""
    h, width = _GEAR[data], 1
    while width < 32:
        before = np.zeros_like(h)
        before[width:] = h[:-width]
        h = h + (before << np.uint32(width))
        width *= 2
    return h


def chunk_bounds(texts: Sequence[bytes]) -> list[list[int]]:
    """Per text the offsets of its chunks' starts, and its end; cuts stand between characters."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts]).tolist()
    # the bits that all 32 bytes reach
    marked = (rolling_hashes(data) >> np.uint32(32 - CUT_BITS)) == 0
    marked[:-1] &= (data[1:] & 0xC0) != 0x80
    cuts = (np.flatnonzero(marked) + 1).tolist()
    out, at, i = [], 0, 0
    for end in ends:
        start, bounds = at, [0]
        while i < len(cuts) and cuts[i] < end:
            cut = cuts[i]
            i += 1
            while cut - at > LONGEST:
                at = _character(data, at + LONGEST)
                bounds.append(at - start)
            if cut - at >= SHORTEST:
                bounds.append(cut - start)
                at = cut
        while end - at > LONGEST:
            at = _character(data, at + LONGEST)
            bounds.append(at - start)
        if end > at:
            bounds.append(end - start)
        while i < len(cuts) and cuts[i] <= end:
            i += 1
        out.append(bounds)
        at = end
    return out


def _character(data: np.ndarray, at: int) -> int:
    """The start of the character at an offset."""
    while data[at] & 0xC0 == 0x80:
        at -= 1
    return at


class ChunkEncoder:
    """Encodes texts as the library does without special tokens around them, and decodes ids."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        self._library.no_padding()
        self._library.no_truncation()
        self._merges = ByteMerges(path)
        self._special = [t.content for t in self._library.get_added_tokens_decoder().values()]
        size = self._library.get_vocab_size()
        self.tokens = np.array([self._library.id_to_token(i).encode() for i in range(size)], object)
        self.decimals = np.array([str(i).encode() for i in range(size)], object)
        self.spans = Memory(self._encode_spans)
        self.chunks = Memory(self._encode_chunks, most=30_000)

    def _encode_spans(self, spans: list[bytes]) -> list[bytes]:
        texts = [s.decode("utf-8", "replace") for s in spans]
        pieces: list = [None] * len(texts)
        for i, text in enumerate(texts):
            if _PLAIN.fullmatch(text) and not any(t in text for t in self._special):
                cut = _PIECES.findall(text.lower())
                if max(map(len, cut), default=0) * 2 <= ByteMerges.LONGEST:
                    pieces[i] = cut
        distinct = list({p for cut in pieces if cut for p in cut})
        known = dict(zip(distinct, self._merges.encode([p.encode() for p in distinct])))
        rest = [i for i, cut in enumerate(pieces) if cut is None]
        found = self._library.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False)
        by_library = {i: np.asarray(e.ids, "<i4").tobytes() for i, e in zip(rest, found)}
        return [
            by_library[i] if cut is None else b"".join([known[p] for p in cut]) for i, cut in enumerate(pieces)
        ]

    def _encode_chunks(self, chunks: list[bytes]) -> list[tuple[bytes, bytes, bytes, bool]]:
        """What stands before a chunk's first space, the ids up to its last one, what stands behind.

        A chunk without a space is all before; the last field tells which it is.
        """
        cut = [c.split(b" ") for c in chunks]
        ids = self.spans.get_all([s for spans in cut for s in spans[1:-1]])
        out, at = [], 0
        for spans in cut:
            if len(spans) == 1:
                out.append((spans[0], b"", b"", False))
                continue
            n = len(spans) - 2
            out.append((spans[0], b"".join(ids[at : at + n]), spans[-1], True))
            at += n
        return out

    def encode(self, texts: Sequence[bytes]) -> list[bytes]:
        """Packed ids (little-endian, 32 bits) of each text."""
        chunks = []
        for text, bounds in zip(texts, chunk_bounds(texts)):
            chunks.append([text[a:b] for a, b in zip(bounds, bounds[1:])])
        known = iter(self.chunks.get_all([c for of_text in chunks for c in of_text]))
        parts, joins = [], []
        for of_text in chunks:
            made: list = []
            across = []  # what stands since the last space
            for _ in of_text:
                before, ids, behind, spaced = next(known)
                across.append(before)
                if spaced:
                    joins.append(b"".join(across))
                    made.extend((None, ids))
                    across = [behind]
            joins.append(b"".join(across))
            made.append(None)
            parts.append(made)
        repaired = iter(self.spans.get_all(joins))
        return [b"".join([next(repaired) if p is None else p for p in made]) for made in parts]

    def decode(self, ids: np.ndarray) -> bytes:
        """What the library's decode gives, special tokens kept."""
        return b" ".join(self.tokens[ids].tolist())

    def shown(self, ids: np.ndarray) -> bytes:
        return b" ".join(self.decimals[ids].tolist())


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


def _mapped(docs: DataFrame, path: str, schema: str, columns: Callable, keep, text) -> DataFrame:
    def of_texts(texts: list[str]) -> list[pa.Array]:
        packed = encoder(path).encode([t.encode("utf-8", "replace") for t in texts]) if texts else []
        return columns([np.frombuffer(p, "<i4") for p in packed], encoder(path))

    return map_texts(docs, of_texts, schema, keep=keep, text=text)


def encode(docs: DataFrame, path: str, *, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """The ``keep`` columns and ``ids``, the token ids of each whole text.

    ``path`` is the tokenizer's file, where every worker has it.
    """

    def columns(ids, _):
        ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
        flat = np.concatenate([np.empty(0, np.int32), *ids]).astype(np.int32)
        return [pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))]

    return _mapped(docs, path, "ids array<int>", columns, keep, text)


def decode(encoded: DataFrame, path: str, *, ids: str = "ids", output: str = "decoded") -> DataFrame:
    """All columns and the text of ``ids`` (null: empty) as ``output``, which must be a new name."""
    if output.casefold() in map(str.casefold, encoded.columns):
        raise ValueError(f"there is a column {output!r}; choose another name")

    @F.pandas_udf("string")
    def decoded(column):
        return column.map(lambda x: "" if x is None else encoder(path).decode(np.asarray(x, int)).decode())

    return encoded.withColumn(output, decoded(F.col(f"`{ids}`")))


def digests(docs: DataFrame, path: str, *, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """The ``keep`` columns, n_tokens, ids_sha256 (of decimal ids joined by spaces), decoded_sha256."""

    def columns(ids, e):
        return [
            pa.array([len(x) for x in ids], pa.int64()),
            pa.array([hashlib.sha256(e.shown(x)).hexdigest() for x in ids], pa.string()),
            pa.array([hashlib.sha256(e.decode(x)).hexdigest() for x in ids], pa.string()),
        ]

    return _mapped(docs, path, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", columns, keep, text)
