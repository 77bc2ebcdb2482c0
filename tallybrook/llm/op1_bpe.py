"""Byte-level BPE by prefix dynamic programming.

For every prefix of a byte string there is exactly one token that ends its encoding.
``PrefixTable`` stores that token per prefix. A token ending at a prefix is the valid
one if the token that ends the remaining, shorter prefix may stand before it, that is,
if merging the two would not have happened earlier. So an encoding is read backwards
from its end, an append only adds entries, and an edit re-encodes from the edited byte.

Special tokens are never produced. Ranks need be complete over the 256 single bytes.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Callable, Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import map_texts
from tallybrook.llm.merge_arrays import HashedNumbers

# Entries per worker: encodings of pieces, and answers for pairs of tokens.
CACHED_WORDS, CACHED_PAIRS = 150_000, 200_000
# Pieces whose tables are filled together; longer ones have a table of their own each.
_TOGETHER, _LONGEST_TOGETHER = 8192, 64
# Bytes of text that are cut at once, and of the longest piece that is remembered.
_CUT_TOGETHER, _LONGEST_REMEMBERED = 4_000_000, 128
# Fixed value: the pattern whose matches are found by looking at neighbouring characters.
SPACE_LED_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
_SPACE, _WHITE, _LETTER, _NUMBER, _OTHER, _APOSTROPHE = range(6)


class Vocabulary:
    """Token bytes by id, the automaton that finds tokens, and which tokens may be neighbours."""

    def __init__(self, ranks: bytes, pattern: str):
        pairs = (line.split() for line in ranks.splitlines() if line.strip())
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        missing = [b for b in range(256) if bytes([b]) not in self.ranks]
        if missing:
            raise ValueError(f"no token for single byte(s) {missing[:5]}")
        self.token = {rank: token for token, rank in self.ranks.items()}
        self.packed = {token: rank.to_bytes(4, "little") for token, rank in self.ranks.items()}
        self.longest = max(map(len, self.ranks))
        self.pattern = regex.compile(pattern)
        self._automaton = ahocorasick.Automaton()
        for token, rank in self.ranks.items():
            self._automaton.add_word(token.decode("latin-1"), (rank, len(token)))
        self._automaton.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.length = {rank: len(token) for rank, token in self.token.items()}
        self._parts: dict[int, tuple[int, int] | None] = {}

    def ends(self, data: bytes) -> Iterator[tuple[int, tuple[int, int]]]:
        """(last byte, (token, length)) of all tokens that occur in the data."""
        return self._automaton.iter(data.decode("latin-1"))

    def parts(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a single byte."""
        if token not in self._parts:
            data = self.token[token]
            self._parts[token] = None if len(data) == 1 else self._last_merge(data, token)
        return self._parts[token]

    def _last_merge(self, data: bytes, limit: int) -> tuple[int, int]:
        """Merge pairs of lesser rank than ``limit``, lowest first; two tokens must remain."""
        run = [bytes([b]) for b in data]
        while len(run) > 2:
            rank, at = min(
                (self.ranks.get(run[i] + run[i + 1], limit), i) for i in range(len(run) - 1)
            )
            if rank >= limit:
                raise ValueError(f"token {limit} is not the merge of two tokens of lesser rank")
            run[at : at + 2] = [run[at] + run[at + 1]]
        return self.ranks[run[0]], self.ranks[run[1]]

    def may_follow(self, left: int, right: int) -> bool:
        """Whether the encoding of left's bytes and right's bytes together is (left, right)."""
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= CACHED_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._stay_apart(left, right)
        return known

    def _stay_apart(self, left: int, right: int) -> bool:
        # Undo the later of the two merges at the boundary, step by step. Had the
        # tokens now facing each other a merge of lower rank than the one undone
        # last, it would have come first. Left of equal rank merges first.
        bound = None  # (rank, 1 if what was undone stands right)
        while True:
            joint = self.ranks.get(self.token[left] + self.token[right])
            if joint is not None and (bound is None or (joint, 0) < bound):
                return False
            left_parts, right_parts = self.parts(left), self.parts(right)
            if left_parts is None and right_parts is None:
                return True
            undo_left = right_parts is None or (left_parts is not None and left > right)
            if undo_left:
                bound, left = (left, 0), left_parts[1]
            else:
                bound, right = (right, 1), right_parts[0]


class PrefixTable:
    """The last token of the encoding of each prefix of a growing byte string."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary = vocabulary
        self.data = b""
        self.last: list[int] = []  # last[i] ends the encoding of data[: i + 1]
        self.append(data)

    def append(self, more: bytes) -> None:
        """Extend the string; entries of the old prefixes stay as they are."""
        old = len(self.data)
        self.data += more
        start = max(0, old - self.vocabulary.longest + 1)
        self._fill(start, old)

    def edit(self, start: int, end: int, replacement: bytes) -> None:
        """Replace data[start:end]; prefixes before ``start`` keep their entries."""
        tail = replacement + self.data[end:]
        self.data = self.data[:start]
        del self.last[start:]
        self.append(tail)

    def _fill(self, start: int, first: int) -> None:
        last, known, may = self.last, self.vocabulary.pairs.get, self.vocabulary.may_follow
        filled = first - start
        for at, (token, length) in self.vocabulary.ends(self.data[start:] if start else self.data):
            if at < filled:
                continue
            before = start + at - length
            if before >= 0:
                left = last[before]
                ok = known(left << 32 | token)
                if ok is None:
                    ok = may(left, token)
                if not ok:
                    continue
            last.append(token)
            filled += 1
        filled += start
        if filled != len(self.data):
            raise ValueError("the vocabulary can't encode these bytes")

    def tokens(self, length: int | None = None) -> list[int]:
        """The encoding of the first ``length`` bytes (all by default)."""
        at = len(self.data) if length is None else length
        out, last, length_of = [], self.last, self.vocabulary.length
        while at > 0:
            token = last[at - 1]
            out.append(token)
            at -= length_of[token]
        return out[::-1]


class PrefixArrays:
    """The tables of many short pieces, filled together, one byte position after the other.

    The same recurrence as in ``PrefixTable``. Tokens are found by walking the trie of the
    vocabulary from every position at once; which of those that end at a position is the valid one
    is asked for all pieces at once.
    """

    def __init__(self, vocabulary: Vocabulary):
        top = max(vocabulary.token) + 1
        self.length = np.zeros(top, np.int32)
        self._first, self._second = np.full(top, -1, np.int64), np.full(top, -1, np.int64)
        joints = []
        for rank, token in vocabulary.token.items():
            self.length[rank] = len(token)
            parts = vocabulary.parts(rank)
            if parts is not None:
                self._first[rank], self._second[rank] = parts
            for cut in range(1, len(token)):
                left, right = vocabulary.ranks.get(token[:cut]), vocabulary.ranks.get(token[cut:])
                if left is not None and right is not None:
                    joints.append((left << 32 | right, rank))
        # the token that two tokens side by side spell, if there is one
        self._joint = HashedNumbers(*zip(*joints)) if joints else HashedNumbers([], [])
        nodes: dict[bytes, int] = {b"": 0}
        steps = []
        for token in vocabulary.ranks:
            for end in range(1, len(token) + 1):
                if token[:end] not in nodes:
                    nodes[token[:end]] = len(nodes)
                    steps.append((nodes[token[: end - 1]] << 8 | token[end - 1], nodes[token[:end]]))
        self._step = HashedNumbers(*zip(*steps))
        self._token = np.full(len(nodes), -1, np.int64)
        for token, rank in vocabulary.ranks.items():
            self._token[nodes[token]] = rank

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of each piece."""
        out: list = [None] * len(pieces)
        order = sorted(range(len(pieces)), key=lambda i: len(pieces[i]))
        for start in range(0, len(order), _TOGETHER):
            block = order[start : start + _TOGETHER]
            for i, packed in zip(block, self._block([pieces[i] for i in block])):
                out[i] = packed
        return out

    def fill(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The last token of each prefix, a row per piece, and the pieces' lengths."""
        lengths = np.array([len(p) for p in pieces], np.int64)
        width = int(lengths.max(initial=0))
        data = np.full((len(pieces), width + 1), -1, np.int64)
        data[np.arange(width + 1) < lengths[:, None]] = np.frombuffer(b"".join(pieces), np.uint8)
        last = np.full((len(pieces), width), -1, np.int64)
        # candidates: every token that occurs, by its last byte
        row, at = np.nonzero(data >= 0)
        node = np.zeros(len(row), np.int64)
        ends: list[list[tuple]] = [[] for _ in range(width)]
        size = 0
        while len(row):
            node = self._step.get(node << 8 | data[row, at + size])
            on = np.flatnonzero(node >= 0)
            row, at, node, size = row[on], at[on], node[on], size + 1
            token = self._token[node]
            hit = np.flatnonzero(token >= 0)
            by_end = np.argsort(at[hit], kind="stable")
            hit = hit[by_end]
            cuts = np.searchsorted(at[hit], np.arange(width + 1))
            for i in range(width - size + 1):
                if cuts[i] < cuts[i + 1]:
                    part = hit[cuts[i] : cuts[i + 1]]
                    ends[i + size - 1].append((row[part], token[part], size))
            more = data[row, at + size] >= 0
            row, at, node = row[more], at[more], node[more]
        for end, found in enumerate(ends):
            if not found:
                continue
            rows = np.concatenate([r for r, _, _ in found])
            tokens = np.concatenate([t for _, t, _ in found])
            before = end - np.concatenate([np.full(len(r), n) for r, _, n in found])
            left = np.where(before >= 0, last[rows, before], -1)
            # the remaining prefix may be all of the piece, or have no encoding
            valid = before < 0
            ask = np.flatnonzero((before >= 0) & (left >= 0))
            valid[ask] = self._stay_apart(left[ask], tokens[ask])
            last[rows[valid], end] = tokens[valid]
        return last, lengths

    def _stay_apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``Vocabulary.may_follow`` for pairs of tokens."""
        apart = np.ones(len(left), bool)
        open_ = np.arange(len(left))
        bound = np.full(len(left), 1 << 40)  # twice the rank undone last, and 1 if it stood right
        while len(open_):
            joint = self._joint.get(left << 32 | right)
            met = (joint >= 0) & (2 * joint < bound)
            apart[open_[met]] = False
            whole_left, whole_right = self._first[left] < 0, self._first[right] < 0
            go = np.flatnonzero(~met & ~(whole_left & whole_right))
            open_, left, right = open_[go], left[go], right[go]
            undo_left = whole_right[go] | (~whole_left[go] & (left > right))
            bound = np.where(undo_left, 2 * left, 2 * right + 1)
            left, right = np.where(undo_left, self._second[left], left), np.where(undo_left, right, self._first[right])
        return apart

    def _block(self, pieces: list[bytes]) -> list[bytes]:
        last, at = self.fill(pieces)
        rows = np.flatnonzero(at > 0)
        backwards = []
        while len(rows):
            token = last[rows, at[rows] - 1]
            if (token < 0).any():
                raise ValueError("the vocabulary can't encode these bytes")
            column = np.full(len(pieces), -1, np.int64)
            column[rows] = token
            backwards.append(column)
            at[rows] -= self.length[token]
            rows = rows[at[rows] > 0]
        if not backwards:
            return [b""] * len(pieces)
        ids = np.stack(backwards[::-1], 1)
        there = ids >= 0
        packed = ids[there].astype("<u4").tobytes()
        ends = (4 * np.cumsum(there.sum(1))).tolist()
        return [packed[a:b] for a, b in zip([0, *ends], ends)]


@functools.cache
def _kinds() -> np.ndarray:
    """What each code point is to ``SPACE_LED_PATTERN``."""
    kinds = np.full(0x110000, _OTHER, np.uint8)
    every = "".join(map(chr, range(len(kinds))))
    for kind, pattern in ((_WHITE, r"\s+"), (_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+")):
        for match in regex.finditer(pattern, every):
            kinds[match.start() : match.end()] = kind
    kinds[ord(" ")], kinds[ord("'")] = _SPACE, _APOSTROPHE
    return kinds


def _always_cut() -> np.ndarray:
    """Whether a match ends between two characters of these kinds, whatever stands around them.

    A match holds one kind of character, but for a space before it and letters behind an apostrophe;
    an apostrophe is like other signs to those ahead of it. Where a run of white space is cut
    depends on what follows, see ``cut``.
    """
    cuts = np.zeros((8, 8), bool)
    words = [_LETTER, _NUMBER, _OTHER, _APOSTROPHE]
    cuts[np.ix_(words, [_SPACE, _WHITE])] = cuts[_WHITE, words] = True
    cuts[_LETTER, [_NUMBER, _OTHER, _APOSTROPHE]] = cuts[_NUMBER, [_LETTER, _OTHER, _APOSTROPHE]] = True
    cuts[_OTHER, [_LETTER, _NUMBER]] = True
    return cuts.ravel()


_ALWAYS_CUT = _always_cut()


def cut(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """All matches of ``SPACE_LED_PATTERN`` in UTF-8, and how many there are up to the end of each text.

    Only a match of an apostrophe and the letters behind it are left together.
    """
    joined = "".join(texts)
    data = joined.encode("utf-8", "replace")
    plain = len(data) == len(joined)
    code = np.frombuffer(data if plain else joined.encode("utf-32-le", "replace"), "u1" if plain else "<u4")
    kind = _kinds()[code]
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    first = np.zeros(len(kind) + 1, bool)  # of a text
    first[ends] = first[0] = True
    start = first[:-1].copy()
    start[1:] |= _ALWAYS_CUT[kind[:-1] << 3 | kind[1:]]
    # the last of several white characters before others is not in the match of those ahead of it
    white = kind <= _WHITE
    start[1:-1] |= white[:-2] & white[1:-1] & ~white[2:] & ~first[2:-1]
    at = np.flatnonzero(start)
    count = np.searchsorted(at, ends)
    offsets = np.append(at, len(data))
    if not plain and len(at):
        width = np.ones(len(code), np.uint8)  # bytes of each character
        for more in (0x80, 0x800, 0x10000):
            width += code >= more
        offsets[1:] = np.cumsum(np.add.reduceat(width, at, dtype=np.int64))
    return pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data)]), count


def _joined(values: pa.Array, count: np.ndarray) -> list[bytes]:
    """The values up to each count, but for those of the count before, one behind the other."""
    offsets = np.frombuffer(values.buffers()[1], np.int64, len(values) + 1, 8 * values.offset)
    data = memoryview(values.buffers()[2] or b"")
    ends = offsets[count].tolist()
    return [bytes(data[a:b]) for a, b in zip([int(offsets[0]), *ends], ends)]


class Recent:
    """What was computed for keys; what was not used for a while is forgotten first.

    At most ``most`` entries stay, and those of a batch: as soon as the younger half is full,
    the older one is dropped. Keys longer than ``longest`` are not kept.
    """

    def __init__(self, compute: Callable[[list], list], most: int, longest: int):
        self._compute, self._most, self._longest = compute, most, longest
        self._young: dict = {}
        self._old: dict = {}

    def __len__(self) -> int:
        return len(self._young) + len(self._old)

    def get_all(self, keys: list) -> list:
        """The value of each of the distinct keys, in order."""
        found = list(map(self._young.get, keys))
        absent = [i for i, value in enumerate(found) if value is None]
        missing = []
        for i in absent:
            value = found[i] = self._old.get(keys[i])
            if value is None:
                missing.append(i)
        for i, value in zip(missing, self._compute([keys[i] for i in missing])):
            found[i] = value
        self._young.update((keys[i], found[i]) for i in absent if len(keys[i]) <= self._longest)
        if len(self._young) > self._most // 2:
            self._young, self._old = {}, self._young
        return found


class Encoder:
    """Encodes texts, each match of the pattern separately, and remembers pieces."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._arrays = PrefixArrays(vocabulary)
        table = [vocabulary.token.get(i) for i in range(max(vocabulary.token) + 1)]
        self._table = pa.array(table, pa.large_binary())
        self._cuts = vocabulary.pattern.pattern == SPACE_LED_PATTERN
        compute = self._encode_words if self._cuts else self._encode
        self._words = Recent(compute, CACHED_WORDS, _LONGEST_REMEMBERED)

    def pieces(self, pieces: list[str]) -> list[bytes]:
        """Packed ids of pieces, each on its own."""
        data = [p.encode("utf-8", "replace") for p in pieces]
        distinct = list(dict.fromkeys(data))
        ids = dict(zip(distinct, self._encode(distinct)))
        return [ids[d] for d in data]

    def _encode(self, pieces: list[bytes]) -> list[bytes]:
        whole = list(map(self.vocabulary.packed.get, pieces))
        together = []
        for i, ids in enumerate(whole):
            if ids is None:
                if len(pieces[i]) <= _LONGEST_TOGETHER:
                    together.append(i)
                else:
                    whole[i] = np.asarray(PrefixTable(self.vocabulary, pieces[i]).tokens(), "<u4").tobytes()
        for i, ids in zip(together, self._arrays.encode([pieces[i] for i in together])):
            whole[i] = ids
        return whole

    def _encode_words(self, words: list[bytes]) -> list[bytes]:
        """Pieces of ``cut``: a match each, but for letters behind an apostrophe."""
        out = self._encode([b"" if b"'" in w else w for w in words])
        several = [i for i, w in enumerate(words) if b"'" in w]
        split = [self.vocabulary.pattern.findall(words[i].decode()) for i in several]
        ids = iter(self.pieces([p for pieces in split for p in pieces]))
        for i, pieces in zip(several, split):
            out[i] = b"".join([next(ids) for _ in pieces])
        return out

    def packed_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if not self._cuts:
            split = [[p.encode("utf-8", "replace") for p in self.vocabulary.pattern.findall(t)] for t in texts]
            distinct = list(dict.fromkeys(p for pieces in split for p in pieces))
            ids = dict(zip(distinct, self._words.get_all(distinct)))
            return [b"".join([ids[p] for p in pieces]) for pieces in split]
        out, start, size = [], 0, 0
        for end, text in enumerate(texts, 1):
            size += len(text)
            if size >= _CUT_TOGETHER or end == len(texts):
                out += self._packed_together(texts[start:end])
                start, size = end, 0
        return out

    def _packed_together(self, texts: list[str]) -> list[bytes]:
        pieces, count = cut(texts)
        coded = pieces.dictionary_encode()
        ids = pa.array(self._words.get_all(coded.dictionary.to_pylist()), pa.large_binary())
        return _joined(ids.take(coded.indices), count)

    def packed(self, text: str) -> bytes:
        return self.packed_all([text])[0]

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), "<u4").tolist()

    def decode(self, ids) -> bytes:
        """The bytes of the ids; an id without a token raises KeyError."""
        return b"".join(map(self.vocabulary.token.__getitem__, ids))

    def decode_packed_all(self, packed: list[bytes]) -> list[bytes]:
        """The bytes of each of the packed encodings; an id without a token raises KeyError."""
        count = np.cumsum([len(p) // 4 for p in packed], dtype=np.int64)
        ids = np.frombuffer(b"".join(packed), "<u4")
        if len(ids) and ids.max() >= len(self._table):
            raise KeyError(int(ids.max()))
        tokens = self._table.take(pa.array(ids))
        if tokens.null_count:
            raise KeyError(int(ids[np.flatnonzero(tokens.is_null())[0]]))
        return _joined(tokens, count)

    def decode_packed(self, packed: bytes) -> bytes:
        return self.decode_packed_all([packed])[0]


class EditedText:
    """A text whose encoding follows appends and edits.

    Only pieces that an edit can change are split and encoded anew: those from a few
    characters before it until the splits fall together with the old ones again.
    """

    _REACH = 4  # characters that a match of the usual patterns looks ahead, and one more

    def __init__(self, encoder: Encoder, text: str = ""):
        self.encoder, self.text, self.pieces = encoder, "", []
        self.edit(0, 0, text)

    def append(self, more: str) -> None:
        self.edit(len(self.text), len(self.text), more)

    def edit(self, start: int, end: int, replacement: str) -> int:
        """Replace text[start:end]; returns how many pieces were encoded."""
        keep = position = 0
        for piece in self.pieces:
            if position + len(piece) + self._REACH > start:
                break
            position += len(piece)
            keep += 1
        shift = len(replacement) - (end - start)
        old_starts, at = {}, position
        for i, piece in enumerate(self.pieces[keep:], keep):
            if at >= end + self._REACH:
                old_starts[at + shift] = i
            at += len(piece)
        self.text = self.text[:start] + replacement + self.text[end:]
        fresh, rest = [], []
        for match in self.encoder.vocabulary.pattern.finditer(self.text, position):
            if match.start() in old_starts:
                rest = self.pieces[old_starts[match.start()] :]
                break
            fresh.append(match.group())
        self.pieces[keep:] = fresh + rest
        return len(fresh)

    def encode(self) -> list[int]:
        return np.frombuffer(b"".join(self.encoder.pieces(self.pieces)), "<u4").tolist()


@functools.lru_cache(maxsize=2)
def _encoder(ranks: bytes, pattern: str) -> Encoder:
    return Encoder(Vocabulary(ranks, pattern))


def _mapped(docs: DataFrame, text: str, keep: Sequence[str], schema: str, ranks: bytes, pattern: str,
            columns: Callable[[list[bytes], Encoder], list[pa.Array]]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def of_texts(texts: list[str]) -> list[pa.Array]:
        encoder = _encoder(shared.value, pattern)
        return columns(encoder.packed_all(texts), encoder)

    return map_texts(docs, of_texts, schema, keep=keep, text=text)


def encode(docs: DataFrame, ranks: bytes, pattern: str, *, keep=("doc_id",), text: str = "text") -> DataFrame:
    """The ``keep`` columns and ``ids``, the token ids of each whole text; null is empty."""
    return _mapped(docs, text, keep, "ids array<int>", ranks, pattern, lambda packed, _: [_lists(packed)])


def _lists(packed: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *(len(v) // 4 for v in packed)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), "<i4")))


def decode(encoded: DataFrame, ranks: bytes, pattern: str, *, ids: str = "ids", output: str = "decoded") -> DataFrame:
    """All columns and the bytes of ``ids`` (null: empty) as ``output``, a new name; unknown ids raise."""
    if output.casefold() in map(str.casefold, encoded.columns):
        raise ValueError(f"there is a column {output!r}; choose another name")
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)

    @F.pandas_udf("binary")
    def decoded(column):
        encoder = _encoder(shared.value, pattern)
        return column.map(lambda x: b"" if x is None else encoder.decode(x))

    return encoded.withColumn(output, decoded(F.col(f"`{ids}`")))


def digests(docs: DataFrame, ranks: bytes, pattern: str, *, keep=("doc_id",), text: str = "text") -> DataFrame:
    """Encode each whole text, decode the ids, and return counts and digests of both.

    One row per row of ``docs``: the ``keep`` columns, n_tokens, ids_sha256 (of the ids as
    little-endian unsigned 32-bit integers) and decoded_sha256. A null text is empty and
    has no tokens. Repeated rows stay; other columns are not looked at.
    """

    def columns(packed, encoder):
        decoded = encoder.decode_packed_all(packed)
        return [
            pa.array([len(p) // 4 for p in packed], pa.int64()),
            pa.array([hashlib.sha256(p).hexdigest() for p in packed], pa.string()),
            pa.array([hashlib.sha256(d).hexdigest() for d in decoded], pa.string()),
        ]

    schema = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return _mapped(docs, text, keep, schema, ranks, pattern, columns)
