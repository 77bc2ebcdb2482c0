"""Exact Jaccard join of documents on word n-grams, by size-banded tiles with bitmaps.

1. Each text becomes its set of distinct shingles (64-bit hashes). Equal sets are one node.
2. Two sets that link share one of their rarest shingles (prefix filter): a set of n has
   n - ceil(share * n) + 1 of them. Rarity is a fixed number of counts by hash; any order
   shared by all sets gives the same links.
3. Sets that share such a shingle are compared by their bitmaps, a bit per hashed shingle
   that is set if an odd number of them falls on it: differing bits bound the overlap from
   above. Sets that may still link, directly or through others, form a cluster.
4. A cluster is compared in one tile if it is small, else in tiles of two blocks each of
   sets whose sizes lie in the same or the next band (sizes that may link). There bitmaps
   come first again, and what may still link is intersected exactly.

Sets that are already connected are not compared, and a tile returns a spanning forest, so
a group of thousands of near copies is neither expanded into pairs nor gathered.

No bucket, cluster or tile is dropped or cut short.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import components, shingles, sliced, stored, word_hashes

CELL_BITS = 17
# Shingles of the sets in a block; a tile holds two blocks.
BLOCK_SHINGLES = 1_000_000
# Sets in a block of those that share a rare shingle.
KEY_BLOCK = 2048
_CELL, _DOC = 1, 0


def shingle_set(text, words: int) -> np.ndarray:
    return np.unique(shingles(word_hashes(text), words))


def bitmap(own: np.ndarray) -> np.ndarray:
    """Parities of the shingles by hash, as bytes: as many bits as shingles, rounded up to 2^k."""
    bits = max(64, 1 << max(0, len(own) - 1).bit_length())
    odd = np.bincount((own & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little")


def prefix_length(n: int, num: int, den: int) -> int:
    return n - -(-num * n // den) + 1


def sets_and_counts(docs: DataFrame, words: int) -> DataFrame:
    """Per row its size and fingerprint; per task how many shingles fall in each cell."""

    def run(batches):
        cells = np.zeros(1 << CELL_BITS, np.int64)
        for batch in sliced(batches):
            sizes, prints = [], []
            for text in batch.column(1).to_pylist():
                own = shingle_set(text, words)
                np.add.at(cells, (own >> np.uint64(64 - CELL_BITS)).astype(np.int64), 1)
                sizes.append(len(own))
                prints.append(xxhash.xxh3_128_digest(own.tobytes()))
            n = len(sizes)
            yield _rows(np.full(n, _DOC), batch.column(0), sizes, prints)
        at = np.flatnonzero(cells)
        yield _rows(np.full(len(at), _CELL), pa.array(at), cells[at], [None] * len(at))

    return docs.mapInArrow(run, "kind int, id bigint, n bigint, print binary")


def _rows(kind, ids, n, prints) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(kind, pa.int32()), ids.cast(pa.int64()), pa.array(n, pa.int64()), pa.array(prints, pa.binary())],
        ["kind", "id", "n", "print"],
    )


def _levels(counts: DataFrame) -> np.ndarray:
    """Per cell how far above the mean its count is, in powers of two."""
    sums = counts.groupBy("id").agg(F.sum("n").alias("n")).toArrow()  # a row per cell
    cells = np.zeros(1 << CELL_BITS)
    cells[sums.column("id").to_numpy()] = sums.column("n").to_numpy()
    mean = max(1.0, cells.mean())
    return np.log2(np.maximum(1.0, cells / mean)).astype(np.uint8)


def prefixes(docs: DataFrame, words: int, num: int, den: int, levels: np.ndarray) -> DataFrame:
    """(id, keys, n, bits): the rarest shingles of each set, as many as the share calls for."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)

    def run(batches):
        level = shared.value
        for batch in sliced(batches):
            keys, sizes, maps = [], [], []
            for text in batch.column(1).to_pylist():
                own = shingle_set(text, words)
                length = prefix_length(len(own), num, den) if len(own) else 0
                rare = level[(own >> np.uint64(64 - CELL_BITS)).astype(np.int64)]
                # sets are sorted by hash, so a stable sort by level orders by both
                keys.append(own[np.argsort(rare, kind="stable")[:length]].view(np.int64))
                sizes.append(len(own))
                maps.append(bitmap(own).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.list_(pa.int64())), pa.array(sizes, pa.int64()), pa.array(maps, pa.binary())],
                ["id", "keys", "n", "bits"],
            )

    return docs.mapInArrow(run, "id bigint, keys array<bigint>, n bigint, bits binary")


class _Bitmaps:
    """Bitmaps of a tile, grouped so that any two sets that may link are compared at one width."""

    def __init__(self, maps: list[np.ndarray]):
        self.width = np.array([len(m) for m in maps])
        self.rows, self.place = {}, {}
        for width in np.unique(self.width):
            # sets of twice the width are folded: halves are parities of the same shingles
            own = np.flatnonzero((self.width == width) | (self.width == 2 * width))
            folded = [maps[i] if len(maps[i]) == width else maps[i][:width] ^ maps[i][width:] for i in own]
            self.rows[width] = np.stack(folded).view(np.uint64)
            place = np.full(len(maps), -1)
            place[own] = np.arange(len(own))
            self.place[width] = place

    def differing(self, p: int, rest: np.ndarray) -> np.ndarray:
        """Differing bits of set p and each of the rest: at most the size of their difference."""
        out = np.empty(len(rest), np.int64)
        width = np.minimum(self.width[rest], self.width[p])
        for w in np.unique(width):
            chosen = width == w
            rows, place = self.rows[w], self.place[w]
            apart = rows[place[rest[chosen]]] ^ rows[place[p]]
            out[chosen] = np.bitwise_count(apart).sum(axis=1, dtype=np.int64)
        return out


def spanning_forest(size, maps, num, den, order, side=None, label=None, linked=None) -> list[tuple[int, int]]:
    """Pairs (i, j) that connect all sets that may link; with ``linked``, that do.

    Compares each set, in order, with those after it that it is not connected with yet.
    ``linked(p)`` gives the function that counts what a set shares with p. With ``side``
    only sets of different sides are compared; sets of equal ``label`` are connected from
    the start.
    """
    m = len(size)
    group = np.arange(m) if label is None else np.unique(label, return_inverse=True)[1]
    links: list[tuple[int, int]] = []
    if m < 2 or (group == group[0]).all():
        return links
    bitmaps = _Bitmaps(maps)
    waiting = np.ones(m, bool)
    for p in order:
        waiting[p] = False
        may = waiting & (group != group[p])
        may &= den * np.minimum(size, size[p]) >= num * np.maximum(size, size[p])
        if side is not None:
            may &= side != side[p]
        rest = np.flatnonzero(may)
        if not len(rest):
            continue
        both = size[rest] + size[p]
        fits = (both - bitmaps.differing(p, rest)) * (num + den) >= 2 * num * both
        rest, both = rest[fits], both[fits]
        if not len(rest):
            continue
        test = linked(p) if linked else None
        for q, total in zip(rest, both):
            if group[q] != group[p] and (test is None or test(q) * (num + den) >= num * total):
                links.append((int(p), int(q)))
                group[group == group[q]] = group[p]
        if (group == group[0]).all():
            break
    return links


def tile_links(
    sets: list[np.ndarray], num: int, den: int, side: np.ndarray | None = None, label: np.ndarray | None = None
) -> list[tuple[int, int]]:
    """Links (i, j) that connect what the sets' links connect, each verified exactly."""
    if len(sets) < 2:
        return []
    size = np.array([len(s) for s in sets])
    shingle, dense, occurs = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    ends = np.cumsum(size)
    own = np.split(dense, ends[:-1])
    # sets full of common shingles first: they are linked with most, and little is left then
    common = np.add.reduceat(occurs[dense], np.concatenate(([0], ends[:-1]))) / size
    mark = np.zeros(len(shingle), bool)

    def intersection_with(p):
        mark[:] = False
        mark[own[p]] = True
        return lambda q: np.count_nonzero(mark[own[q]])

    order = np.argsort(-common, kind="stable")
    return spanning_forest(size, [bitmap(s) for s in sets], num, den, order, side, label, intersection_with)


def _grouped(batches, *keys: str) -> Iterator[list[dict]]:
    """Rows of sorted batches, tile by tile."""

    def rows():
        for batch in sliced(batches):
            yield from batch.to_pylist()

    for _, own in groupby(rows(), key=lambda r: tuple(r[k] for k in keys)):
        yield list(own)


_PAIR = "a bigint, b bigint"


def _pairs(rows: list[dict], links: list[tuple[int, int]]) -> pa.RecordBatch:
    ids = np.array([r["id"] for r in rows])
    a, b = np.array(links).reshape(-1, 2).T
    return pa.RecordBatch.from_arrays([pa.array(ids[a], pa.int64()), pa.array(ids[b], pa.int64())], ["a", "b"])


def _may_link(hits: DataFrame, maps: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) connecting the sets of each key that may link by their bitmaps.

    ``hits`` are (key, id, m), with m ids to the key; a key with many is cut into blocks,
    and each two blocks are compared in a tile.
    """
    blocks = F.ceil(F.col("m") / KEY_BLOCK).cast("int")
    hits = hits.withColumn("blocks", blocks).withColumn("x", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    tiles = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda y: F.struct(
        F.least("x", y).alias("i"), F.greatest("x", y).alias("j"), (F.col("x") > y).cast("int").alias("side")
    ))
    rows = hits.select("key", "id", F.explode(tiles).alias("t")).select("key", "t.i", "t.j", "t.side", "id")

    def run(batches):
        links, size = [], 0
        for own in _grouped(batches, "key", "i", "j"):
            side = np.array([r["side"] for r in own])
            sizes = np.array([r["n"] for r in own])
            maps = [np.frombuffer(r["bits"], np.uint8) for r in own]
            found = spanning_forest(sizes, maps, num, den, np.argsort(sizes), side if side.any() else None)
            if found:
                links.append(_pairs(own, found))
                size += len(found)
            if size >= 10_000:
                yield from links
                links, size = [], 0
        yield from links

    dealt = rows.join(maps, "id").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "id")
    return dealt.mapInArrow(run, _PAIR).distinct()


def _compared(tiles: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """Links (a, b) within the tiles; rows are (tile, side, label, id, text)."""

    def run(batches):
        for rows in _grouped(batches, "tile"):
            sets = [shingle_set(r["text"], words) for r in rows]
            side = np.array([r["side"] for r in rows])
            label = np.array([r["label"] for r in rows])
            two_sided = side.any()
            links = tile_links(sets, num, den, side if two_sided else None, label)
            if links:
                yield _pairs(rows, links)

    dealt = tiles.repartition("tile").sortWithinPartitions("tile", "id")
    return dealt.mapInArrow(run, _PAIR)


def _blocks(nodes: DataFrame, num: int, den: int, block: int) -> DataFrame:
    """Nodes (id, n, cluster) with ``whole`` (cluster fits one tile), ``band`` and ``block``."""
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(den / num))).cast("int")
    nodes = nodes.withColumn("band", band)
    per_band = nodes.groupBy("cluster", "band").agg(F.sum("n").alias("volume"))
    per_cluster = per_band.groupBy("cluster").agg((F.sum("volume") <= block).alias("whole"))
    blocks = per_band.select(
        "cluster", "band", F.ceil(F.col("volume") / block).cast("int").alias("blocks")
    ).join(per_cluster, "cluster")
    near = blocks.select("cluster", "band", "blocks")
    for step, name in ((1, "above"), (-1, "below")):
        other = near.select("cluster", (F.col("band") - step).alias("band"), F.col("blocks").alias(name))
        blocks = blocks.join(other, ["cluster", "band"], "left")
    blocks = blocks.fillna(0, ["above", "below"])
    return nodes.join(blocks, ["cluster", "band"]).withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    )


def _tile(low_band, low_block, high_band, high_block):
    return F.concat_ws("/", "cluster", low_band, low_block, high_band, high_block)


def _own_tiles(placed: DataFrame) -> DataFrame:
    """Round one: whole clusters, and each block by itself."""
    own = F.when(F.col("whole"), F.col("cluster").cast("string")).otherwise(_tile("band", "block", "band", "block"))
    return placed.select("id", own.alias("tile"), F.lit(0).alias("side"), F.col("id").alias("label"))


def _cross_tiles(placed: DataFrame, labels: DataFrame) -> DataFrame:
    """Round two: pairs of blocks of the clusters that round one left in parts."""
    placed = placed.where("not whole").join(
        labels.select(F.col("id"), F.col("component").alias("label")), "id", "left"
    ).withColumn("label", F.coalesce("label", "id"))
    apart = placed.groupBy("cluster").agg((F.min("label") != F.max("label")).alias("apart")).where("apart")
    placed = placed.join(apart.select("cluster"), "cluster", "left_semi")
    each = lambda name: F.filter(F.sequence(F.lit(0), F.greatest(F.col(name), F.lit(1)) - 1), lambda i: i < F.col(name))
    b, x = F.col("band"), F.col("block")
    pairs = F.concat(
        F.transform(F.filter(each("blocks"), lambda y: y != x), lambda y: F.struct(
            _tile(b, F.least(x, y), b, F.greatest(x, y)).alias("tile"), (x > y).cast("int").alias("side"))),
        F.transform(each("above"), lambda y: F.struct(_tile(b, x, b + 1, y).alias("tile"), F.lit(0).alias("side"))),
        F.transform(each("below"), lambda y: F.struct(_tile(b - 1, y, b, x).alias("tile"), F.lit(1).alias("side"))),
    )
    return placed.select("id", F.explode(pairs).alias("p"), "label").select("id", "p.tile", "p.side", "label")


def near_duplicates(
    docs: DataFrame, *, words: int = 5, num: int = 80, den: int = 100, doc_id: str = "doc_id",
    text: str = "text", block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """(doc_id, n_shingles, component_id): a row per row of ``docs``.

    Two documents link when den * intersection >= num * union of their sets of distinct
    ``words``-word shingles; a text of fewer words has its whole sequence as the only one.
    ``component_id`` is the smallest id reachable by links. Texts without words, or null,
    have an empty set and link with nothing. A row with a null id links with nothing and
    has a null component. Rows of one id are one document in the graph, whatever their
    texts. Ids are integers; other columns are not looked at.
    """
    source = docs.select(
        docs[f"`{doc_id}`"].cast("long").alias("id"), docs[f"`{text}`"].cast("string").alias("text")
    )
    first = stored(sets_and_counts(source, words), "join-sets")
    levels = _levels(first.where(F.col("kind") == _CELL))
    base = first.where(F.col("kind") == _DOC)
    copies = base.where("n > 0 and id is not null").groupBy("print").agg(F.min("id").alias("rep"))
    known = stored(base.join(copies, "print", "left").select("id", "n", "rep"), "join-copies")
    named = source.where("id is not null")
    reps = known.where("id = rep").groupBy("id").agg(F.max("n").alias("n"))

    # clusters of sets that share a rare shingle and may link by their bitmaps
    rare = stored(prefixes(named, words, num, den, levels).join(reps, "id", "left_semi"), "join-keys")
    keyed = rare.select("id", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high")
    hits = stored(keyed.join(shared.select("key"), "key"), "join-hits")
    # of keys with the same sets one will do
    of_key = hits.groupBy("key").agg(
        F.count("*").alias("m"), F.min("id").alias("low"),
        F.sum(F.xxhash64("id").cast("decimal(20,0)")).alias("sum"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("xor"),
    )
    one = of_key.groupBy("m", "low", "sum", "xor").agg(F.min("key").alias("key")).select("key", "m")
    close = stored(_may_link(hits.join(one, "key"), rare.select("id", "n", "bits"), num, den), "join-close")
    clusters = components(close)
    nodes = clusters.select("id", F.col("component").alias("cluster")).join(reps, "id")
    placed = stored(_blocks(nodes, num, den, block_shingles), "join-nodes")

    # tiles
    own_texts = stored(named.join(placed.select("id").distinct(), "id", "left_semi"), "join-texts")
    links = stored(_compared(_own_tiles(placed).join(own_texts, "id"), words, num, den), "join-links")
    if not placed.where("not whole").isEmpty():
        cross = _cross_tiles(placed, components(links)).join(own_texts, "id")
        links = links.union(stored(_compared(cross, words, num, den), "join-links"))

    # copies that share an id connect their texts' sets
    same = known.where("rep is not null and id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    repeated = known.groupBy("id").agg(F.min("rep").alias("x"), F.max("rep").alias("y")).where("x <> y")
    same = same.join(repeated, F.col("a") == F.col("id"), "left_semi")
    again = repeated.selectExpr("x as a", "y as b")
    found = components(links.union(same).union(again)).withColumnRenamed("id", "rep")
    return known.join(found, "rep", "left").select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.least(F.coalesce("component", "rep", "id"), F.col("id"))).alias("component_id"),
    )
