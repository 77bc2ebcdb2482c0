"""What several operators share: reading tables, word hashes, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.scratch import written

U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Python workers find this package where the driver has it, if they have none installed
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared folder and read back: lineage is cut, nothing is recomputed.

    Inside ``scratch.cleared`` the folder is deleted at its end.
    """
    return written(df, purpose)


def as_text(value) -> str:
    """A text cell as str: null is empty, invalid UTF-8 is replaced."""
    if value is None:
        return ""
    return value.decode("utf-8", "replace") if isinstance(value, (bytes, bytearray)) else value


def sliced(batches: Iterable, rows: int = 256) -> Iterator:
    """The rows of Arrow batches in smaller ones, so that few texts are Python objects at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def map_texts(docs: DataFrame, columns: Callable[[list[str]], list[pa.Array]], schema: str, *,
              keep: Sequence[str], text: str) -> DataFrame:
    """The ``keep`` columns, under any names, and those that ``columns`` makes of the texts of a batch.

    ``schema`` names the new columns, "name type, name type".
    """
    fields = [f.split(" ", 1) for f in schema.split(", ")]

    def run(batches):
        for batch in sliced(batches):
            made = columns([as_text(x) for x in batch.column(0).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], *made], [*batch.schema.names[1:], *[f"_r{i}" for i in range(len(made))]]
            )

    kept = [docs[f"`{c}`"].alias(f"_k{i}") for i, c in enumerate(keep)]
    source = docs.select(docs[f"`{text}`"].cast("binary").alias("_text"), *kept)
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in source.schema.fields[1:]]
    made = source.mapInArrow(run, ", ".join([*kinds, *[f"_r{i} {kind}" for i, (_, kind) in enumerate(fields)]]))
    return made.select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)],
        *[F.col(f"_r{i}").alias(name) for i, (name, _) in enumerate(fields)],
    )


class _WordHashes(dict):
    """Hash of a word, computed once per worker; emptied when it grows past its bound."""

    MOST = 120_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.MOST:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _WordHashes()


def word_hashes(text: str | bytes | None) -> np.ndarray:
    """64-bit hashes of the words [^\\x20\\x09-\\x0D]+ of a text, A-Z in lower case."""
    data = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else (text or b"")
    words = data.lower().split()  # bytes: ASCII letters and ASCII white space only
    return np.fromiter(map(_HASHES.__getitem__, words), U64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words, in order; fewer words make one run, none make none."""
    n = len(words)
    if n == 0:
        return words
    used = min(size, n)
    h = np.full(n - used + 1, used, U64)
    for i in range(used):
        h += words[i : n - used + 1 + i] * U64(0x9E3779B97F4A7C15 + 0xD6E8FEB86659FD92 * i & (1 << 64) - 1)
    return mixed(h)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an undirected graph: (id, component), smallest id of each.

    Only ids that occur in an edge come out. Alternates the large-star and small-star
    steps, each a minimum per vertex (combined before the shuffle) and a join, and
    writes each round to the shared folder. Loops, repeated and null edges are ignored.
    """
    x, y = F.col(a).cast("long"), F.col(b).cast("long")
    start = edges.where(x.isNotNull() & y.isNotNull() & (x != y))
    current = stored(
        start.select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct(), "edges"
    )
    seen = None
    while True:
        both = current.union(current.select("v", "u"))
        # large star: larger neighbours of u move to the least of u's neighbours
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        large = large.where("u != v").distinct()
        # small star: smaller neighbours of u, and u, move to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(low.select("u", F.col("m").alias("v"))).where("u != v").distinct()
        current = stored(small, "edges")
        mark = current.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if tuple(mark) == seen:
            break
        seen = tuple(mark)
    labelled = current.select(F.col("u").alias("id"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return labelled.union(roots)
