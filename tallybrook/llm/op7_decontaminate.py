"""Benchmark items inside documents, by size-partitioned MinHash containment search.

An item is contained in a document if the document holds at least 80 % of its distinct
shingles of five words. Items are partitioned by their number of shingles; each partition
has its own length of MinHash signature and its own least number of signature values that
a document must hold. The values are a random sample of the item's shingles, so the share
that a document holds estimates the containment, whatever the document's length. Every
candidate is verified by exact containment.

Signatures of the items, not of the documents, are broadcast, ``CHUNK_BYTES`` of item text
at a time: a larger benchmark is searched chunk by chunk.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tallybrook.llm.common import as_text, mixed, shingles, sliced, word_hashes

SHINGLE_WORDS = 5
LEAST_CONTAINMENT = 0.8
CHUNK_BYTES = 32 * 1024 * 1024


class Partition(NamedTuple):
    """Items of at most ``most`` shingles: length of the signature, hits needed.

    Each value of the signature of a contained item is in the document with a chance of
    0.8 or more, so that fewer hits than needed happen less than once in a million.
    """

    most: float
    values: int
    hits: int


# Up to 16 shingles all of them are compared.
PARTITIONS = (Partition(16, 16, 1), Partition(64, 24, 8), Partition(512, 32, 13), Partition(float("inf"), 48, 23))
_FILTER_BITS = 22


class Index:
    """Signatures and shingles of a bounded number of items."""

    def __init__(self, texts: list[str | None], words: int = SHINGLE_WORDS, least: float = LEAST_CONTAINMENT):
        self.words, self.least = words, least
        self.items, self.needed, self.short = [], [], set()
        values, owners = [], []
        for i, text in enumerate(texts):
            hashes = word_hashes(text)
            own = np.unique(shingles(hashes, words))
            self.items.append(own)
            if 0 < len(hashes) < words:
                self.short.add(len(hashes))
            part = next(p for p in PARTITIONS if len(own) <= p.most)
            if len(own) <= part.values:
                signature, hits = own, max(1, int(np.ceil(least * len(own) - 1e-9)))
            else:
                signature = np.unique([own[np.argmin(mixed(own ^ seed))] for seed in _SEEDS[: part.values]])
                # fewer distinct values: as many hits less
                hits = max(1, part.hits - (part.values - len(signature)))
            self.needed.append(hits)
            values.append(signature)
            owners.append(np.full(len(signature), i))
        values = np.concatenate(values) if values else np.zeros(0, np.uint64)
        owners = np.concatenate(owners) if owners else np.zeros(0, int)
        order = np.argsort(values, kind="stable")
        self.values, self.first = np.unique(values[order], return_index=True)
        self.owners = owners[order]
        self.ends = np.append(self.first[1:], len(self.owners))
        self.needed = np.array(self.needed, int)
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[(self.values >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True

    def find(self, text: str | None) -> list[tuple[int, float]]:
        """(item, containment) of the items that a whole text contains."""
        if not len(self.values):
            return []
        hashes = word_hashes(text)
        own = [shingles(hashes, self.words)] if len(hashes) >= self.words else []
        own += [shingles(hashes, n) for n in self.short if len(hashes) >= n]
        if not own:
            return []
        own = np.concatenate(own)
        likely = own[self.filter[(own >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)]]
        if not len(likely):
            return []
        likely = np.unique(likely)
        at = np.minimum(np.searchsorted(self.values, likely), len(self.values) - 1)
        at = at[self.values[at] == likely]
        if not len(at):
            return []
        owners = np.concatenate([self.owners[self.first[i] : self.ends[i]] for i in at])
        item, hits = np.unique(owners, return_counts=True)
        found = []
        candidates = item[hits >= self.needed[item]]
        if len(candidates):
            own = np.unique(own)
            for i in candidates:
                of_item = self.items[i]
                place = np.minimum(np.searchsorted(own, of_item), len(own) - 1)
                share = np.count_nonzero(own[place] == of_item) / len(of_item)
                if share >= self.least - 1e-12:
                    found.append((int(i), share))
        return found


_SEEDS = mixed(np.arange(1, 1 + max(p.values for p in PARTITIONS), dtype=np.uint64))


def mark(
    docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id",
    item_text: str = "text", leaks: str = "leaks", keep: list[str] | None = None,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """The documents (or their ``keep`` columns) and ``leaks``: struct(item_id, containment).

    A row per row of ``docs``. Items of fewer than five words must stand in the text as
    they are; items without words, or null, are in no document, and nothing is in an empty
    or null one. Items that occur twice are found twice. ``leaks`` may not be a column of
    ``docs`` already.
    """
    keep = docs.columns if keep is None else keep
    if leaks.lower() in {c.lower() for c in keep}:
        raise ValueError(f"the documents have a column {leaks!r} already")
    items = benchmark.select(
        benchmark[f"`{item_id}`"].alias("item_id"), benchmark[f"`{item_text}`"].cast("string").alias("item_text")
    )
    size = items.agg(F.sum(F.octet_length("item_text") + 64)).first()[0] or 0
    chunks = max(1, -(-size // chunk_bytes))
    id_type = items.schema["item_id"].dataType
    found = docs.select(
        docs[f"`{text}`"].cast("string").alias("_text"),
        *[docs[f"`{c}`"].alias(f"_k{i}") for i, c in enumerate(keep)],
        F.array().cast(_leak_type(id_type)).alias("_leaks"),
    )
    for chunk in range(chunks):
        part = items if chunks == 1 else items.where(F.pmod(F.xxhash64("item_id", "item_text"), F.lit(chunks)) == chunk)
        found = _search(found, part.collect(), id_type)  # at most about chunk_bytes
    return found.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], F.col("_leaks").alias(leaks))


def _leak_type(id_type: T.DataType) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField("item_id", id_type), T.StructField("containment", T.DoubleType())]))


def _search(docs: DataFrame, items: list, id_type: T.DataType) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(
        ([r["item_id"] for r in items], Index([r["item_text"] for r in items]))
    )
    leak_type = to_arrow_type(_leak_type(id_type))

    def run(batches):
        ids, index = shared.value
        for batch in sliced(batches):
            at = batch.schema.get_field_index("_leaks")
            known = batch.column(at).to_pylist()
            texts = batch.column(batch.schema.get_field_index("_text")).to_pylist()
            for i, text in enumerate(texts):
                known[i] = (known[i] or []) + [
                    {"item_id": ids[item], "containment": share} for item, share in index.find(as_text(text))
                ]
            yield batch.set_column(at, "_leaks", pa.array(known, leak_type))

    return docs.mapInArrow(run, docs.schema)


def contained(docs: DataFrame, benchmark: DataFrame, *, keep=("doc_id",), **options) -> DataFrame:
    """A row per document and item in it: the ``keep`` columns, item_id, containment."""
    marked = mark(docs, benchmark, keep=list(keep), leaks="_found", **options)
    return marked.select(*keep, F.explode("_found").alias("_leak")).select(
        *keep, F.col("_leak.item_id").alias("item_id"), F.col("_leak.containment").alias("containment")
    )
