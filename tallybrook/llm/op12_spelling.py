"""Words that differ by one letter, by dynamic programming down a sorted list.

A word's neighbours are found by reading a sorted list of words once and keeping the rows
of the edit matrix for the prefix that a listed word shares with the one before it. Of a
row only the three entries around the diagonal can hold 0 or 1. When all three exceed one
edit, every listed word with that prefix is skipped. The scans of a batch of words run in
step, in arrays.

No task needs the whole list. If one edit turns a word of ``size`` letters into another of
the same size or one more, the edit lies in some segment of positions, before and behind
which the two agree. Words are dealt by what stands before and behind each of two segments,
so both words of any pair meet in exactly one group (the words of a group are read from
the side on which they agree longer). A group with too many words is dealt anew by halves
of its segment, if need be until the segment is one position; such a group holds no more
words than there are letters, twice.

Null texts have no words; a null id counts as an empty one. Repeated rows count each time.
Other columns are not looked at. Words are compared by code points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import stored

# Letters, and how often a deletion is planted.
_LETTERS = "[A-Za-zÀ-ÿ]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PLANTED_EVERY = 199
# Words that one group may hold, and rows times letters that are scanned in step.
GROUP_WORDS = 20_000
_BATCH_ROWS, _BATCH_CELLS = 20_000, 2_000_000


def words(docs: DataFrame, *, min_length: int = 6, min_count: int = 5, text: str = "text",
          doc_id: str = "doc_id") -> DataFrame:
    """(word, n): the words of all texts, planted deletions applied, and how often they occur."""
    lowered = F.translate(F.col(f"`{text}`").cast("string"), _UPPER, _LOWER)
    own_id = F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))
    runs = docs.select(own_id.alias("id"), F.explode(F.regexp_extract_all(lowered, F.lit(_LETTERS), F.lit(0))).alias("run"))
    runs = runs.where(F.length("run") >= min_length)
    mark = F.crc32(F.concat("id", F.lit(":"), "run"))
    runs = runs.select("run", mark.alias("mark"))
    at = F.pmod("mark", F.length("run")).cast("int")
    run = F.col("run")
    shorter = F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))
    word = F.when(F.pmod("mark", F.lit(_PLANTED_EVERY)) == 0, shorter).otherwise(run)
    counted = runs.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where((F.col("n") >= min_count) & (F.length("word") >= min_length))


def _dealt(rows: DataFrame) -> DataFrame:
    """``key`` and ``line`` for rows (word, n, size, low, high): their group, and how it reads them.

    ``low`` to ``high`` is the segment of the edit; ``line`` is the word from the side on
    which the group's words agree longer.
    """
    word, size, low, high = (F.col(c) for c in ("word", "size", "low", "high"))
    behind = F.greatest(size - high, F.lit(0))
    before, after = F.substr(word, F.lit(1), low), F.when(behind > 0, F.substr(word, -behind)).otherwise("")
    back = behind > low
    key = F.concat_ws(":", size, low, high, before, after)
    return rows.select("word", "n", "size", "low", "high", key.alias("key"), back.alias("back"),
                       F.when(back, F.reverse(word)).otherwise(word).alias("line"))


def _in_groups(vocabulary: DataFrame, group_words: int) -> DataFrame:
    """Every word in its groups, none of which holds more than ``group_words`` if it can be split."""
    length = F.length("word")
    sizes = F.explode(F.array(length, length - 1)).alias("size")
    rows = vocabulary.select("word", "n", sizes)
    half = F.ceil((F.col("size") - 1) / 2).cast("int")
    segments = F.array(F.struct(F.lit(0).alias("low"), half.alias("high")),
                       F.struct(half.alias("low"), (F.col("size") + 1).alias("high")))
    rows = _dealt(rows.select("*", F.explode(segments).alias("s")).select("word", "n", "size", "s.low", "s.high"))
    finished = []
    while True:
        # groups that are too large and can still be split; most often none
        counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.first(F.col("high") - F.col("low")).alias("w"))
        large = stored(counts.where((F.col("m") > group_words) & (F.col("w") > 1)).select("key"), "large-groups")
        if large.isEmpty():
            break
        finished.append(rows.join(large, "key", "left_anti"))
        split = rows.join(large, "key", "left_semi")
        middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
        halves = F.array(F.struct(F.col("low").alias("l"), middle.alias("h")), F.struct(middle.alias("l"), F.col("high").alias("h")))
        split = split.select("word", "n", "size", F.explode(halves).alias("s")).select(
            "word", "n", "size", F.col("s.l").alias("low"), F.col("s.h").alias("high"))
        rows = stored(_dealt(split), "split-groups")
    for part in finished:
        rows = rows.unionByName(part)
    return rows


class _Lists:
    """Sorted lists of words, one after the other, and what their scans need."""

    def __init__(self, lines: list[str], group: np.ndarray):
        self.size = np.array([len(x) for x in lines], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.size)[:-1]]).astype(np.int64)
        self.letters = np.frombuffer("".join(lines).encode("utf-32-le"), "<u4")
        n = len(lines)
        first = np.concatenate([[True], group[1:] != group[:-1]])
        starts = np.flatnonzero(first)
        self.begin = starts[np.cumsum(first) - 1]
        self.end = np.concatenate([starts[1:], [n]])[np.cumsum(first) - 1]
        self.shared = self.common(np.arange(n) - 1, np.arange(n), ~first)
        # following[d, i]: the next word after i that shares fewer than d letters with its predecessor
        deepest = int(self.size.max()) + 1
        at = np.where(self.shared[None, :] < np.arange(deepest + 1)[:, None], np.arange(n), n).astype(np.int32)
        nearest = np.minimum.accumulate(at[:, ::-1], 1)[:, ::-1]
        self.following = np.concatenate([nearest[:, 1:], np.full((deepest + 1, 1), n, np.int32)], 1)

    def common(self, left: np.ndarray, right: np.ndarray, where: np.ndarray) -> np.ndarray:
        """Letters that both words of each pair begin with; 0 where not asked."""
        out, open_ = np.zeros(len(left), np.int64), np.flatnonzero(where)
        depth = 0
        while len(open_):
            a, b = left[open_], right[open_]
            open_ = open_[(self.size[a] > depth) & (self.size[b] > depth)]
            a, b = left[open_], right[open_]
            open_ = open_[self.letters[self.start[a] + depth] == self.letters[self.start[b] + depth]]
            depth += 1
            out[open_] = depth
        return out


def near_pairs(lists: _Lists, asking: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, neighbour): for each asking word the words of its list at exactly one edit."""
    size, start, letters, shared = lists.size, lists.start, lists.letters, lists.shared
    deepest = int(size.max()) + 2
    # of the matrix row at depth d: the edits to turn d - 1, d, d + 1 letters of the asking word
    rows = np.full((len(asking), deepest + 1, 3), 2, np.int8)
    rows[:, 0, 1], rows[:, 0, 2] = 0, 1
    slot, word = np.arange(len(asking)), asking
    at, depth = lists.begin[asking], np.zeros(len(asking), np.int64)
    found_a, found_b = [], []
    while len(slot):
        letter = letters[start[at] + depth]
        old = rows[slot, depth]
        new = np.empty_like(old)
        for k in range(3):
            j = depth + k  # letters of the asking word
            inside = (j >= 1) & (j <= size[word])
            own = letters[np.where(inside, start[word] + j - 1, 0)]
            best = old[:, k] + (own != letter)
            if k < 2:
                best = np.minimum(best, old[:, k + 1] + 1)
            best = np.where(inside, best, np.where(j == 0, old[:, min(k + 1, 2)] + 1, 2))
            if k:
                best = np.where(inside, np.minimum(best, new[:, k - 1] + 1), best)
            new[:, k] = np.minimum(best, 2)
        depth = depth + 1
        rows[slot, depth] = new
        dead = new.min(1) > 1
        ended = ~dead & (depth == size[at])
        column = size[word] - depth + 1
        hit = np.flatnonzero(ended & (column >= 0) & (column <= 2))
        hit = hit[new[hit, column[hit]] == 1]
        found_a.append(word[hit])
        found_b.append(at[hit])
        then = np.where(dead, lists.following[depth, at], at + ended)
        moved = dead | ended
        go = then < lists.end[word]
        slot, word, then, moved, depth = slot[go], word[go], then[go], moved[go], depth[go]
        at = then
        depth = np.where(moved, shared[at], depth)
    if not found_a:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found_a), np.concatenate(found_b)


def _neighbours(keys: list[str], lines: list[str], names: list[str], n: np.ndarray, size: np.ndarray,
                low: np.ndarray, high: np.ndarray) -> pa.RecordBatch:
    """(word, n_near, best_n, best) of whole groups: how many neighbours, and the most frequent."""
    changes = np.array([i > 0 and keys[i] != keys[i - 1] for i in range(len(keys))])
    group = np.cumsum(changes)
    lists = _Lists(lines, group)
    asking = np.flatnonzero(lists.size == size)
    a, b = near_pairs(lists, asking)
    # a pair that fits both segments counts where its first difference lies
    forward = _Lists(names, np.arange(len(names))) if len(a) else None
    if forward is not None:
        differs = forward.common(a, b, np.ones(len(a), bool))
        mine = (differs >= low[a]) & (differs < high[a])
        a, b = a[mine], b[mine]
    longer = lists.size[b] > lists.size[a]  # the longer word does not ask in this group
    word, near = np.concatenate([a, b[longer]]), np.concatenate([b, a[longer]])
    used = sorted({names[i] for i in near.tolist()})
    place = {w: i for i, w in enumerate(used)}
    rank = np.array([place[names[i]] for i in near.tolist()], np.int64)
    order = np.lexsort((rank, -n[near], word))
    word, near = word[order], near[order]
    first = np.flatnonzero(np.diff(word, prepend=-1))
    counts = np.diff(first, append=len(word))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([names[i] for i in word[first].tolist()], pa.string()),
            pa.array(counts, pa.int64()),
            pa.array(n[near[first]], pa.int64()),
            pa.array([names[i] for i in near[first].tolist()], pa.string()),
        ],
        ["word", "n_near", "best_n", "best"],
    )


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group come in; whole groups are scanned together."""

    def scanned(columns):
        keys, lines, names, *numbers = columns
        return _neighbours(keys, lines, names, *(np.asarray(x, np.int64) for x in numbers))

    held: list[list] = [[] for _ in range(7)]
    longest = 0
    for batch in batches:
        rows = [c.to_pylist() for c in batch.columns]
        starts = [i for i in range(batch.num_rows) if i == 0 or rows[0][i] != rows[0][i - 1]]
        for begin, end in zip(starts, [*starts[1:], batch.num_rows]):
            count = len(held[0]) + end - begin
            width = max(longest, len(rows[2][begin]) + 1)
            another_group = held[0] and held[0][-1] != rows[0][begin]
            if another_group and (count > _BATCH_ROWS or count * width > _BATCH_CELLS):
                yield scanned(held)
                held, width = [[] for _ in range(7)], len(rows[2][begin]) + 1
            longest = width
            for column, values in zip(held, rows):
                column.extend(values[begin:end])
    if held[0]:
        yield scanned(held)


def neighbours(vocabulary: DataFrame, *, group_words: int = GROUP_WORDS) -> DataFrame:
    """(word, n_near, best_n, best) of each word of (word, n) that has a near word.

    ``best`` is the near word of largest n, of several the first in code-point order.
    """
    rows = _in_groups(vocabulary, group_words)
    dealt = rows.select("key", "line", "word", "n", "size", "low", "high")
    dealt = dealt.repartition(F.col("key")).sortWithinPartitions("key", "line")
    parts = dealt.mapInArrow(_scan, "word string, n_near bigint, best_n bigint, best string")
    top = F.min(F.struct((-F.col("best_n")).alias("m"), "best"))
    joined = parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), top.alias("top"))
    return joined.select("word", "n_near", (-F.col("top.m")).alias("best_n"), F.col("top.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): the last word that following forms leads to.

    Each round doubles how far the pointers reach. Forms must not run in a circle.
    """
    current = stored(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while not current.where("moved").isEmpty():
        ahead = current.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        step = current.join(ahead, "root", "left")
        further: Column = F.coalesce("ahead", "root")
        current = stored(step.select("word", further.alias("root"), F.col("ahead").isNotNull().alias("moved")), "roots")
    return current.select("word", "root")


def variants(vocabulary: DataFrame, *, ratio: int = 5, group_words: int = GROUP_WORDS) -> DataFrame:
    """Each word of (word, n) with its form, root, and near words; ``vocabulary`` is stored.

    ``form`` is the near word of largest n if that is at least ``ratio`` times the word's
    own, else null; ``root`` is where following forms ends, the word itself without a form.
    """
    near = stored(neighbours(vocabulary, group_words=group_words), "near-words")
    known = vocabulary.join(near, "word", "left")
    has = F.coalesce(F.col("best_n") >= ratio * F.col("n"), F.lit(False))
    rows = known.select(
        "word", F.when(has, F.col("best")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(has, F.col("best_n")).alias("form_n"),
    )
    rows = stored(rows, "word-forms")
    last = roots(rows.where("form is not null"))
    return rows.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
