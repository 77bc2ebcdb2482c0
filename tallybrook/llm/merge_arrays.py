"""Byte-pair merges of many short strings at once, in arrays, and a memory of encoded pieces.

``MergeArrays`` merges the pair of lowest rank of every string in the same step, leftmost
first, until no string has a pair left: the ids are those of merging each string alone.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

import numpy as np

NONE = np.int32(2**31 - 1)
_EMPTY = np.int64(-1)
_SCATTER = np.uint64(0x9E3779B97F4A7C15)


def byte_characters() -> list[str]:
    """The character that byte-level vocabularies write for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class HashedNumbers:
    """A map from whole numbers, 0 or more, to such numbers, in an open hash table of arrays."""

    def __init__(self, keys, values):
        keys, values = np.asarray(keys, np.int64), np.asarray(values, np.int64)
        self._bits = max(4, int(len(keys) * 4).bit_length())
        self._mask = (1 << self._bits) - 1
        self._keys = np.full(1 << self._bits, _EMPTY)
        self._values = np.full(1 << self._bits, -1, np.int64)
        slots = self._slot(keys)
        while len(keys):  # each round, of the keys that want a free slot, one gets it
            free = self._keys[slots] == _EMPTY
            taken, first = np.unique(slots[free], return_index=True)
            at = np.flatnonzero(free)[first]
            self._keys[taken], self._values[taken] = keys[at], values[at]
            rest = np.ones(len(keys), bool)
            rest[at] = False
            keys, values = keys[rest], values[rest]
            slots = slots[rest] + 1 & self._mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * _SCATTER >> np.uint64(64 - self._bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key of a flat array, -1 where there is none."""
        slots = self._slot(keys)
        there = self._keys[slots]
        found = np.where(there == keys, self._values[slots], -1)
        open_ = np.flatnonzero((there != keys) & (there != _EMPTY))
        while len(open_):
            slots[open_] = slots[open_] + 1 & self._mask
            there = self._keys[slots[open_]]
            hit = there == keys[open_]
            found[open_[hit]] = self._values[slots[open_[hit]]]
            open_ = open_[~hit & (there != _EMPTY)]
        return found


class MergeArrays:
    """Merge ranks by pair of ids."""

    def __init__(self, merges: Iterable[tuple[int, int, int]], size: int):
        """``merges`` are (left id, right id, joint id), lowest rank first; ids are below ``size``."""
        left, right, joint = (np.asarray(x, np.int64) for x in zip(*merges, strict=True))
        self._size = size
        self.joint = joint.astype(np.int32)
        self._ranks = HashedNumbers(left * size + right, np.arange(len(left)))

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; NONE where it has no merge or an id is negative."""
        found = self._ranks.get((left.astype(np.int64) * self._size + right).ravel()).reshape(left.shape)
        return np.where((left < 0) | (right < 0) | (found < 0), NONE, found).astype(np.int32)

    def merge(self, rows: np.ndarray) -> np.ndarray:
        """Merge each row of ids, padded by -1 at the end; the result is padded alike."""
        out = np.full(rows.shape, -1, np.int32)
        tokens, number = rows.astype(np.int32), np.arange(len(rows))
        if rows.shape[1] < 2:
            return tokens
        ranks = self.ranks(tokens[:, :-1], tokens[:, 1:])
        while len(tokens):
            at = ranks.argmin(1)
            each = np.arange(len(tokens))
            least = ranks[each, at]
            done = least == NONE
            if done.any():
                out[number[done], : tokens.shape[1]] = tokens[done]
                go = ~done
                tokens, ranks, number, at, least = tokens[go], ranks[go], number[go], at[go], least[go]
                if not len(tokens):
                    break
                each = np.arange(len(tokens))
            after = np.arange(tokens.shape[1] - 1) > at[:, None]
            shorter = np.where(after, tokens[:, 1:], tokens[:, :-1])
            shorter[each, at] = self.joint[least]
            width = shorter.shape[1]
            if width < 2:
                out[number, :1] = shorter
                break
            new = np.where(after[:, : width - 1], ranks[:, 1:], ranks[:, :-1])
            left = at > 0
            new[each[left], at[left] - 1] = self.ranks(shorter[each[left], at[left] - 1], shorter[each[left], at[left]])
            right = at < width - 1
            new[each[right], at[right]] = self.ranks(shorter[each[right], at[right]], shorter[each[right], at[right] + 1])
            tokens, ranks = shorter, new
        return out


class ByteMerges:
    """A byte-level BPE vocabulary read from the file of a tokenizer, applied to single pieces."""

    LONGEST, BLOCK = 96, 4096

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        ids, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self._arrays = MergeArrays(((ids[a], ids[b], ids[a + b]) for a, b in pairs), len(ids))
        chars = byte_characters()
        self._inner = np.array([ids[c] for c in chars], np.int32)
        self._last = np.array([ids[c + suffix] for c in chars], np.int32)

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids (little-endian, 32 bits) of each piece of 1 to LONGEST bytes, as one word."""
        order = sorted(range(len(pieces)), key=lambda i: len(pieces[i]))
        result: list = [None] * len(pieces)
        for start in range(0, len(order), self.BLOCK):
            block = order[start : start + self.BLOCK]
            lengths = np.array([len(pieces[i]) for i in block])
            width = lengths[-1]
            filled = np.arange(width) < lengths[:, None]
            rows = np.full((len(block), width), -1, np.int32)
            rows[filled] = self._inner[np.frombuffer(b"".join([pieces[i] for i in block]), np.uint8)]
            ends = lengths - 1
            last = np.frombuffer(bytes(pieces[i][-1] for i in block), np.uint8)
            rows[np.arange(len(block)), ends] = self._last[last]
            merged = self._arrays.merge(rows)
            there = merged >= 0
            flat = merged[there].astype("<i4").tobytes()
            first = 0
            for i, end in zip(block, (4 * np.cumsum(there.sum(1))).tolist()):
                result[i] = flat[first:end]
                first = end
        return result


class Memory(dict):
    """What was computed for keys; emptied when full, after which common keys are soon back.

    ``compute`` gives the values of a list of distinct keys. At most ``most`` entries stay,
    and those of a batch: keep single keys small.
    """

    def __init__(self, compute: Callable[[list], list], most: int = 300_000):
        super().__init__()
        self._compute, self._most = compute, most

    def get_all(self, keys: list) -> list:
        """The value of each key, in order."""
        missing = set(keys).difference(self)
        if missing:
            if len(self) + len(missing) > self._most:
                self.clear()
                missing = set(keys)
            fresh = list(missing)
            self.update(zip(fresh, self._compute(fresh)))
        return list(map(self.__getitem__, keys))
