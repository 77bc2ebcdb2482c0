"""Language-model scores: cross-entropy difference between a target and a background model.

Both are interpolated bigram models over all words, or over the most frequent ones if a size
is given, and count all documents that they are of: the target's, and the whole corpus.
Counts are exact for every word and every pair of words; words and pairs are told apart by
64-bit hashes. Nothing that grows with the corpus is broadcast or collected.

1. Texts are written in chunks of a bounded size. A chunk's distinct words and pairs are its
   keys, sorted; a key goes to the bucket that its first bits name.
2. A bucket adds up the counts of its keys over all chunks, and answers each chunk with the
   counts of that chunk's keys, in their order, so that keys are not sent back. A word or
   pair comes once from a chunk, however frequent it is: no bucket is hot.
3. A chunk's texts meet its answers and are scored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import U64, mixed, sliced, stored, word_hashes

PAIR_WEIGHT, SMOOTHING = 0.7, 0.5
# Bytes of text in a chunk, and for which there is a bucket.
CHUNK_BYTES, BUCKET_BYTES = 8 << 20, 12 << 20
# What stands before the first word of a document, and for words outside a bounded vocabulary.
START, UNKNOWN = U64(0x51A7B3C94D2E6F01), U64(0xC3D2E1F0A5B49687)
_FLUSH = 300_000
# Steps per factor e of a word's count; counts below this are told apart.
_LEVELS = 1000


@dataclass(frozen=True)
class Model:
    """What the models count: documents, ids of the target, and the vocabulary if it is bounded."""

    docs: DataFrame
    target: DataFrame
    doc_id: str
    text: str
    words: list[bytes] | None


def _words(text) -> list[bytes]:
    data = text.encode("utf-8", "replace") if isinstance(text, str) else (text or b"")
    return data.lower().split()


def vocabulary(docs: DataFrame, *, text: str = "text", size: int) -> list[bytes]:
    """The most frequent words of all documents, A-Z in lower case, ``size`` at most.

    Words that are equally frequent are in it together or not at all.
    """

    def count(batches):
        counts = Counter()
        for batch in sliced(batches):
            for t in batch.column(0).to_pylist():
                counts.update(_words(t))
                if len(counts) >= _FLUSH:
                    yield _counted(counts)
                    counts = Counter()
        yield _counted(counts)

    words = docs.select(docs[f"`{text}`"].cast("binary").alias("t")).mapInArrow(count, "word binary, n bigint")
    words = stored(words.groupBy("word").agg(F.sum("n").alias("n")), "lm-words")
    # no sort: a histogram of the counts, of bounded size, tells how frequent a word must be
    level = F.floor(F.log(F.col("n").cast("double")) * _LEVELS)
    histogram = words.groupBy(level.alias("level")).count().collect()
    room, least = size, float("inf")
    for row in sorted(histogram, reverse=True):
        room -= row["count"]
        if room < 0:
            break
        least = row["level"]
    return sorted(bytes(r["word"]) for r in words.where(level >= least).collect())


def _counted(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
    )


def train(docs: DataFrame, target: DataFrame, *, doc_id: str = "doc_id", text: str = "text", size: int | None = None) -> Model:
    """Both models: background of all documents, target of those whose id is in ``target``.

    ``target`` has a column of ids; null ids match nothing and repeated ones count once.
    Null and empty texts have no tokens. Without target documents its model is flat. With a
    ``size`` all but that many most frequent words are one. Counting is left to ``score``.
    """
    words = None if size is None else vocabulary(docs, text=text, size=size)
    return Model(docs, target, doc_id, text, words)


# --- chunks -----------------------------------------------------------------


def _chunks(docs: DataFrame, doc_id: str | None, text: str, keep, side: int) -> DataFrame:
    """(chunk, bytes, ids, rows): rows are texts and kept columns as an Arrow stream."""
    kept = [docs[f"`{c}`"].alias(f"_k{i}") for i, c in enumerate(keep)]
    own = docs[f"`{doc_id}`"] if doc_id else F.lit(None).cast("long")
    source = docs.select(own.alias("_id"), docs[f"`{text}`"].cast("binary").alias("_t"), *kept)

    def run(batches):
        held, size, number = [], 0, TaskContext.get().partitionId() << 25

        def chunk():
            rows = pa.Table.from_batches(held)
            sink = pa.BufferOutputStream()
            options = pa.ipc.IpcWriteOptions(compression="zstd")
            texts = rows.drop_columns("_id").combine_chunks()
            with pa.ipc.new_stream(sink, texts.schema, options=options) as writer:
                writer.write_table(texts)
            ids = rows.column("_id").combine_chunks()
            ids = pa.concat_arrays(ids.chunks) if isinstance(ids, pa.ChunkedArray) else ids
            return pa.RecordBatch.from_arrays(
                [pa.array([number * 2 + side]), pa.array([size]), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                 pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                ["chunk", "bytes", "ids", "rows"],
            )

        for batch in sliced(batches):
            for part in sliced([batch], 256 if batch.column(1).nbytes < CHUNK_BYTES else 1):
                held.append(part)
                size += part.column(1).nbytes
                if size >= CHUNK_BYTES:
                    yield chunk()
                    held, size, number = [], 0, number + 1
        if held:
            yield chunk()

    kind = source.schema["_id"].dataType.simpleString()
    return stored(source.mapInArrow(run, f"chunk bigint, bytes bigint, ids array<{kind}>, rows binary"), "lm-chunks")


def _flagged(chunks: DataFrame, target: DataFrame) -> DataFrame:
    """The chunks with ``at``: the places of their documents of the target."""
    ids = target.select(target.columns[0]).toDF("_id").where("_id is not null").distinct()
    placed = chunks.select("chunk", F.posexplode("ids").alias("at", "_id")).join(ids.hint("shuffle_hash"), "_id")
    places = placed.groupBy("chunk").agg(F.collect_list("at").alias("at"))
    return chunks.join(places.hint("shuffle_hash"), "chunk", "left")


def _read(rows: bytes) -> pa.Table:
    return pa.ipc.open_stream(rows).read_all()


def _tokens(texts: pa.ChunkedArray, known: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of all texts in order, what stands before each, and the number of each text's."""
    parts = [np.zeros(0, U64)]
    for piece in texts.chunks:
        for start in range(0, len(piece), 256):
            parts.extend(map(word_hashes, piece.slice(start, 256).to_pylist()))
    lengths = np.array([len(p) for p in parts[1:]], np.int64)
    words = np.concatenate(parts)
    if known is not None:
        words = np.where(np.isin(words, known), words, UNKNOWN)
    before = np.roll(words, 1)
    before[(np.cumsum(lengths) - lengths)[lengths > 0]] = START
    return words, before, lengths


def _pair_keys(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    return mixed(before * U64(0x9E3779B97F4A7C15) + mixed(words * U64(0xD6E8FEB86659FD93)))


def _pack(*columns: np.ndarray) -> bytes:
    """64-bit columns of equal length, byte by byte, so that leading zeros vanish."""
    planes = [np.ascontiguousarray(c.astype(U64).view(np.uint8).reshape(-1, 8).T).ravel() for c in columns]
    return len(columns[0]).to_bytes(8, "little") + pa.compress(np.concatenate(planes), codec="zstd", asbytes=True)


def _unpack(blob: bytes, columns: int) -> list[np.ndarray]:
    n = int.from_bytes(blob[:8], "little")
    raw = pa.decompress(blob[8:], n * 8 * columns, codec="zstd", asbytes=True)
    planes = np.frombuffer(raw, np.uint8).reshape(columns, 8, n)
    return [np.ascontiguousarray(p.T).view(U64).ravel() for p in planes]


def _keys(bits: int, known: np.ndarray | None):
    """The keys of chunks with their counts: (bucket, chunk, scored, keys)."""

    def run(batches):
        for batch in sliced(batches, 1):
            [row] = batch.to_pylist()
            words, before, lengths = _tokens(_read(row["rows"]).column("_t"), known)
            target = np.zeros(len(lengths), bool)
            target[np.array(row["at"] or [], int)] = True
            some = lengths > 0
            of_word = np.repeat(target, lengths)
            pairs = _pair_keys(before, words)
            every = np.concatenate([words, np.full(some.sum(), START)])
            for kind, keys, chosen in ((0, pairs, of_word), (1, every, np.concatenate([of_word, target[some]]))):
                keys, place = np.unique(keys, return_inverse=True)
                b = np.bincount(place, minlength=len(keys)) * row["counted"]
                a = np.bincount(place[chosen], minlength=len(keys)) * row["counted"]
                ends = np.searchsorted(keys >> U64(64 - bits), np.arange((1 << bits) + 1))
                blobs = [(k, _pack(np.diff(keys[i:j], prepend=U64(0)), a[i:j], b[i:j]))
                         for k, (i, j) in enumerate(zip(ends[:-1], ends[1:])) if i < j]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([kind << bits | k for k, _ in blobs], pa.int64()), pa.array([row["chunk"]] * len(blobs), pa.int64()),
                     pa.array([row["scored"]] * len(blobs), pa.bool_()), pa.array([x for _, x in blobs], pa.binary())],
                    ["bucket", "chunk", "scored", "keys"],
                )

    return run


def _add_up(bits: int):
    def run(table: pa.Table) -> pa.Table:
        """A bucket's answers to its chunks; for words also how many there are, and tokens."""
        bucket = table.column("bucket")[0].as_py()
        keys, a, b = [], [], []
        for blob in table.column("keys"):
            steps, x, y = _unpack(blob.as_py(), 3)
            keys.append(np.cumsum(steps, dtype=U64))
            a.append(x)
            b.append(y)
        ends = np.cumsum([len(k) for k in keys])
        own, place = np.unique(np.concatenate(keys), return_inverse=True)
        # sums of whole numbers below 2^53: exact
        a, b = (np.bincount(place, weights=np.concatenate(x)) for x in (a, b))
        out = [
            (chunk, _pack(a[place[end - len(k) : end]], b[place[end - len(k) : end]]), 0, 0, 0)
            for chunk, scored, k, end in zip(table.column("chunk").to_pylist(), table.column("scored").to_pylist(), keys, ends)
            if scored
        ]
        if bucket >> bits:
            real = own != START
            out.append((None, None, int((real & (b > 0)).sum()), int(a[real].sum()), int(b[real].sum())))
        columns = list(zip(*out)) if out else [()] * 5
        types = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
        arrays = [pa.array([bucket] * len(out), pa.int64()), *(pa.array(c, t) for c, t in zip(columns, types))]
        return pa.Table.from_arrays(arrays, ["bucket", "chunk", "counts", "words", "a", "b"])

    return run


def _losses(words, before, counts, bits: int, totals, size: int) -> np.ndarray:
    """Loss of each token (nats): one row for the target, one for the background."""
    answers = [[_unpack(c["counts"], 2) for c in counts if c["bucket"] >> bits == kind] for kind in (0, 1)]
    pair, single = (np.concatenate([np.array(x) for x in kind], axis=1).astype(float) for kind in answers)
    _, at = np.unique(_pair_keys(before, words), return_inverse=True)
    known, now = np.unique(np.append(words, START), return_inverse=True)
    start, now = now[-1], now[:-1]
    last = np.where(before == START, start, np.roll(now, 1))
    if (at.max() + 1, len(known)) != (pair.shape[1], single.shape[1]):
        raise RuntimeError("answers do not fit the chunk")
    out = np.empty((2, len(words)))
    for x in (0, 1):
        ratio = np.minimum(pair[x][at] / np.maximum(single[x][last], 1.0), 1.0)
        alone = (single[x][now] + SMOOTHING) / (totals[x] + SMOOTHING * size)
        out[x] = -np.log(PAIR_WEIGHT * ratio + (1 - PAIR_WEIGHT) * alone)
    return out


def score(docs: DataFrame, model: Model, *, keep=("doc_id",), text: str = "text") -> DataFrame:
    """The ``keep`` columns, n_tokens, target_loss, background_loss and score.

    Losses are means per token; ``score`` is their difference, lower for texts more like
    the target. Texts without tokens have 0 for all. A row per row; others are not read.
    If ``docs`` are those of the model they are read once, otherwise both are.
    """
    same = docs is model.docs and text == model.text
    chunks = _chunks(docs, model.doc_id if same else None, text, keep, 0)
    scored = chunks.select("chunk", "bytes", "rows")
    every = _flagged(chunks, model.target).select("chunk", "rows", "at", F.lit(True).alias("scored"), F.lit(1).alias("counted"))
    size = chunks.agg(F.sum("bytes")).first()[0] or 0
    if not same:
        learned = _chunks(model.docs, model.doc_id, model.text, (), 1)
        size += learned.agg(F.sum("bytes")).first()[0] or 0
        learned = _flagged(learned, model.target).select("chunk", "rows", "at", F.lit(False).alias("scored"), F.lit(1).alias("counted"))
        every = every.withColumn("counted", F.lit(0)).union(learned)
    bits = max(1, int(size // BUCKET_BYTES).bit_length())
    known = None if model.words is None else np.array([word_hashes(w)[0] for w in model.words], U64)
    keys = every.mapInArrow(_keys(bits, known), "bucket bigint, chunk bigint, scored boolean, keys binary")
    counts = keys.groupBy("bucket").applyInArrow(
        _add_up(bits), "bucket bigint, chunk bigint, counts binary, words bigint, a bigint, b bigint"
    )
    counts = stored(counts, "lm-counts")
    n, *totals = counts.where("chunk is null").agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("words", "a", "b")]).first()
    n = 1 + (n if known is None else len(known))
    answers = counts.where("chunk is not null").groupBy("chunk").agg(
        F.sort_array(F.collect_list(F.struct("bucket", "counts"))).alias("counts")
    )
    joined = scored.join(answers.hint("shuffle_hash"), "chunk", "left").select("rows", "counts")

    def run(batches):
        for batch in sliced(batches, 1):
            [row] = batch.to_pylist()
            rows = _read(row["rows"])
            words, before, lengths = _tokens(rows.column("_t"), known)
            out = np.zeros((3, len(lengths)))
            some = lengths > 0
            if some.any():
                a, b = _losses(words, before, row["counts"], bits, totals, n)
                first = (np.cumsum(lengths) - lengths)[some]
                out[:, some] = [np.add.reduceat(x, first) / lengths[some] for x in (a, b, a - b)]
            rows = rows.drop_columns("_t")
            for name, column in zip(("_n", "_a", "_b", "_s"), (lengths, *out)):
                rows = rows.append_column(name, pa.array(column))
            yield from rows.combine_chunks().to_batches()

    types = [f"_k{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)]
    out = joined.mapInArrow(run, ", ".join([*types, "_n bigint, _a double, _b double, _s double"]))
    return out.toDF(*keep, "n_tokens", "target_loss", "background_loss", "score")
