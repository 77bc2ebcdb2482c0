"""Near-duplicate vectors of one label, by a robust-pruned graph built on overlapping shards.

1. Vectors that are equal, component by component, become one node with a multiplicity.
2. Nodes are dealt to shards, a label to begin with. A shard above ``SHARD`` nodes is split
   around up to 16 of its own vectors, unlike each other; a node goes to the shards of its
   two nearest ones (the nearest is its own shard). A shard that holds only vectors like
   each other can't be split so: it is compared block by block, exactly, with itself and
   with all vectors of other shards that can be in its range.
3. In each shard nearest and random neighbours of a node are pruned robustly (an edge is
   dropped if a kept neighbour is nearer to its end), and reversed edges are added.
4. The lists of a node from all its shards are united. Each shard is searched with the
   nodes that its own nodes' lists name from other shards: a beam search from the medoid,
   then from what lies in the range on along the lists, as long as more is in the range.
5. Every link is verified by its cosine in double precision. ``recall`` audits the result.

Per shard only counts, links to other shards and a spanning forest come out, so that a
large group of near copies is not expanded into pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import components, stored

LEAST_COSINE = 0.98
SHARD = 3000
CENTRES, SAMPLE, UNLIKE = 16, 512, 0.8
NEAREST, RANDOM, DEGREE, ALPHA = 40, 12, 20, 1.2
BEAM, CHUNK = 24, 256


def usable(vec_id: str, embedding: str, label: str, vectors: DataFrame) -> DataFrame:
    """(id, label, vec) of the rows that can link: vectors of length over 0, all finite."""
    rows = vectors.select(
        vectors[f"`{vec_id}`"].cast("long").alias("id"),
        vectors[f"`{label}`"].cast("string").alias("label"),
        vectors[f"`{embedding}`"].cast("array<double>").alias("vec"),
    ).where("id is not null and label is not null and vec is not null")
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(finite & F.exists("vec", lambda x: x != 0))


def _unit(column: pd.Series) -> np.ndarray:
    x = np.stack(column.to_numpy()).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # neither overflow nor underflow below
    return x / np.linalg.norm(x, axis=1, keepdims=True)


# --- shards -----------------------------------------------------------------


def _centres(group: pd.DataFrame) -> pd.DataFrame:
    """Vectors of a shard's sample that are unlike each other, up to ``CENTRES``."""
    group = group.sort_values("id").head(4 * SAMPLE)
    x = _unit(group["vec"])
    kept = [0]
    for i in range(1, len(x)):
        if len(kept) == CENTRES:
            break
        if (x[kept] @ x[i]).max() < UNLIKE:
            kept.append(i)
    return pd.DataFrame({"shard": [group["shard"].iloc[0]], "centres": [x[kept].tolist()]})


def _deal(batches):
    """Rows (id, own, shard, vec, centres) to the nearest one or two centres."""
    for batch in batches:
        rows = batch.to_pandas()
        out = []
        for shard, group in rows.groupby("shard", sort=False):
            if group["centres"].iloc[0] is None:
                out.append(group[["id", "own", "shard", "vec"]])
                continue
            x, c = _unit(group["vec"]), np.stack([np.asarray(v) for v in group["centres"].iloc[0]])
            order = np.argsort(-(x @ c.T), axis=1, kind="stable")
            for rank in (0, 1):
                part = group[["id", "own", "vec"]].copy()
                if rank:
                    part = part[part["own"].to_numpy()]
                    chosen = order[group["own"].to_numpy(), 1]
                    part["own"] = False
                else:
                    chosen = order[:, 0]
                part["shard"] = [f"{shard}/{k}" for k in chosen]
                out.append(part[["id", "own", "shard", "vec"]])
        if out:
            yield pa.RecordBatch.from_pandas(
                pd.concat(out), schema=_DEALT, preserve_index=False
            )


_DEALT = pa.schema([("id", pa.int64()), ("own", pa.bool_()), ("shard", pa.string()), ("vec", pa.list_(pa.float64()))])
_DEALT_DDL = "id bigint, own boolean, shard string, vec array<double>"


def shards(nodes: DataFrame, most: int = SHARD) -> tuple[DataFrame, DataFrame]:
    """Placements (id, own, shard, vec), and the shards above ``most`` that can't be split."""
    placed = stored(nodes.select("id", F.lit(True).alias("own"),
                                 F.concat_ws("|", "label", F.size("vec")).alias("shard"), "vec"), "shards")
    whole = None
    while True:
        sizes = placed.groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > most)
        large = sizes if whole is None else sizes.join(whole, "shard", "left_anti")
        if large.isEmpty():
            break
        share = F.pmod(F.xxhash64("id", F.lit(1)), F.col("n")) < SAMPLE
        sample = placed.join(large, "shard").where(share).select("shard", "id", "vec")
        centres = stored(
            sample.groupBy("shard").applyInPandas(_centres, "shard string, centres array<array<double>>"), "centres"
        )
        alike = large.join(centres.where(F.size("centres") > 1), "shard", "left_anti").select("shard")
        whole = stored(alike if whole is None else whole.union(alike), "whole")
        split = placed.join(centres.where(F.size("centres") > 1), "shard", "left")
        placed = stored(split.select("id", "own", "shard", "vec", "centres").mapInArrow(_deal, _DEALT_DDL), "shards")
    return placed, placed.sparkSession.createDataFrame([], "shard string") if whole is None else whole


# --- graph ------------------------------------------------------------------


def graph(x: np.ndarray, seed: int = 11) -> list[np.ndarray]:
    """Robust-pruned neighbours of each unit vector, reversed edges included."""
    n = len(x)
    if n < 2:
        return [np.zeros(0, int)] * n
    rng, near = np.random.default_rng(seed), min(NEAREST, n - 1)
    source, target = [], []
    for start in range(0, n, CHUNK):
        rows = np.arange(start, min(n, start + CHUNK))
        like = x[rows] @ x.T
        like[np.arange(len(rows)), rows] = -np.inf
        best = np.argpartition(-like, near - 1, axis=1)[:, :near]
        cand = np.concatenate([best, rng.integers(0, n, (len(rows), RANDOM))], axis=1)
        far = 1 - np.take_along_axis(like, cand, 1)  # own: infinite
        order = np.argsort(far, axis=1, kind="stable")
        cand, far = np.take_along_axis(cand, order, 1), np.take_along_axis(far, order, 1)
        between = 1 - np.einsum("rid,rjd->rij", x[cand], x[cand])
        open_, kept = np.isfinite(far), np.zeros_like(far, bool)
        row = np.arange(len(rows))
        for _ in range(DEGREE):
            first = np.argmax(open_, axis=1)
            live = open_[row, first]
            kept[row[live], first[live]] = True
            open_ &= ALPHA * between[row, first] > far
            open_[row, first] = False
        r, c = np.nonzero(kept)
        source.append(rows[r])
        target.append(cand[r, c])
    a, b = np.concatenate(source), np.concatenate(target)
    edges = np.unique(np.concatenate([a * n + b, b * n + a]))
    return np.split(edges % n, np.searchsorted(edges // n, np.arange(1, n)))


def _edges(group: pd.DataFrame) -> pd.DataFrame:
    ids = group["id"].to_numpy()
    lists = graph(_unit(group["vec"]))
    return pd.DataFrame({"id": ids, "near": [ids[v] for v in lists]})


def search(x: np.ndarray, lists: list[np.ndarray], queries: np.ndarray, entry: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, node) in the range, found from ``entry`` and verified by cosine."""
    n = len(x)
    width = max(1, max(map(len, lists), default=1))
    table = np.full((n, width), -1)
    for i, v in enumerate(lists):
        table[i, : len(v)] = v
    found_q, found_v = [], []
    for start in range(0, len(queries), CHUNK):
        q = queries[start : start + CHUNK]
        m = len(q)
        row = np.arange(m)
        seen = np.zeros((m, n), bool)
        beam = np.full((m, BEAM), -1)
        like = np.full((m, BEAM), -np.inf)
        beam[:, 0], like[:, 0] = entry, x[q] @ x[entry]
        seen[:, entry] = True
        done = np.zeros((m, BEAM), bool)
        inside = np.zeros((m, n), bool)
        inside[row[like[:, 0] >= least], entry] = True
        while True:
            ready = np.where(done | (beam < 0), -np.inf, like)
            at = np.argmax(ready, axis=1)
            live = np.flatnonzero(np.isfinite(ready[row, at]))
            if not len(live):
                break
            done[live, at[live]] = True
            r, v = _unseen(live, table[beam[live, at[live]]], seen)
            if not len(r):
                continue
            s = np.einsum("ij,ij->i", x[q[r]], x[v])
            hit = s >= least
            inside[r[hit], v[hit]] = True
            # the best of beam and newcomers stay
            place = np.arange(len(r)) - np.searchsorted(r, r)
            fresh = np.full((m, place.max() + 1), -np.inf)
            nodes = np.full(fresh.shape, -1)
            fresh[r, place], nodes[r, place] = s, v
            all_like, all_node = np.concatenate([like, fresh], 1), np.concatenate([beam, nodes], 1)
            all_done = np.concatenate([done, np.zeros(fresh.shape, bool)], 1)
            top = np.argsort(-all_like, axis=1, kind="stable")[:, :BEAM]
            like, beam, done = (np.take_along_axis(z, top, 1) for z in (all_like, all_node, all_done))
        # a query is a node itself: its own list is a sure way into its range
        r, v = np.concatenate([row, np.nonzero(inside)[0]]), np.concatenate([q, np.nonzero(inside)[1]])
        seen[row, q] = True
        while len(r):
            next_r, next_v = [], []
            for i in range(0, len(r), 4096):
                a, b = _unseen(r[i : i + 4096], table[v[i : i + 4096]], seen)
                hit = np.einsum("ij,ij->i", x[q[a]], x[b]) >= least
                next_r.append(a[hit])
                next_v.append(b[hit])
            r, v = np.concatenate(next_r), np.concatenate(next_v)
            inside[r, v] = True
        inside[row, q] = False
        r, v = np.nonzero(inside)
        found_q.append(q[r])
        found_v.append(v)
    empty = np.zeros(0, int)
    return np.concatenate([empty, *found_q]), np.concatenate([empty, *found_v])


def _unseen(rows: np.ndarray, neighbours: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, node) of neighbours not seen before by the row, which are marked as seen."""
    r = np.repeat(rows, neighbours.shape[1])
    v = neighbours.ravel()
    real = v >= 0
    r, v = r[real], v[real]
    new = ~seen[r, v]
    key = np.unique(r[new] * seen.shape[1] + v[new])
    r, v = key // seen.shape[1], key % seen.shape[1]
    seen[r, v] = True
    return r, v


_FOUND = "kind string, a bigint, b bigint, n bigint"


def _search_shard(least: float):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        """Counts of links within the shard, links to other shards, a spanning forest."""
        group = group.drop_duplicates("id").sort_values("id").reset_index(drop=True)
        ids, own = group["id"].to_numpy(), group["own"].to_numpy()
        x, times = _unit(group["vec"]), group["times"].to_numpy()
        place = {v: i for i, v in enumerate(ids)}
        lists = [
            np.array([place[k] for k in ([] if v is None else v) if k in place], int) for v in group["near"]
        ]
        # an edge leads back, too, so that nodes of other shards are not dead ends
        back: list[list[int]] = [[] for _ in ids]
        for i, v in enumerate(lists):
            for k in v:
                if not own[k]:
                    back[k].append(i)
        lists = [np.union1d(v, np.array(b, int)) if b else v for v, b in zip(lists, back)]
        mean = x[own].mean(axis=0)
        medoid = int(np.flatnonzero(own)[np.argmax(x[own] @ mean)])
        q, v = search(x, lists, np.flatnonzero(own), medoid, least)
        inner = own[v]
        pairs = np.unique(np.concatenate([q[inner] * len(ids) + v[inner], v[inner] * len(ids) + q[inner]]))
        a, b = pairs // len(ids), pairs % len(ids)
        counts = np.bincount(a, weights=times[b], minlength=len(ids)).astype(int)
        tree_a, tree_b = _forest(len(ids), a, b)
        parts = [
            _frame("count", ids[own], ids[own], counts[own]),
            _frame("tree", ids[tree_a], ids[tree_b], np.zeros(len(tree_a), int)),
            _frame("cross", ids[q[~inner]], ids[v[~inner]], np.zeros((~inner).sum(), int)),
        ]
        return pd.concat(parts)

    return run


def _frame(kind, a, b, n) -> pd.DataFrame:
    return pd.DataFrame({"kind": kind, "a": a, "b": b, "n": n})


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges to the least node that each connected node can reach."""
    label = np.arange(n)
    while True:
        low = label.copy()
        np.minimum.at(low, a, label[b])
        low = low[low]
        if (low == label).all():
            break
        label = low
    rest = np.flatnonzero(label != np.arange(n))
    return rest, label[rest]


def _compare_blocks(least: float):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        """Two blocks of vectors, or one (side -1) with itself, every pair, by matrix products."""
        low, high = group["side"].to_numpy() <= 0, group["side"].to_numpy() > 0
        same = (group["side"].to_numpy() < 0).any()
        a, b = group[low], group[low] if same else group[high]
        if not len(a) or not len(b):
            return _frame("count", [], [], [])
        x, y = _unit(a["vec"]), _unit(b["vec"])
        hit = x @ y.T >= least
        if same:
            np.fill_diagonal(hit, False)
        ids_a, ids_b = a["id"].to_numpy(), b["id"].to_numpy()
        parts = [_frame("count", ids_a, ids_a, hit @ b["times"].to_numpy())]
        if not same:
            parts.append(_frame("count", ids_b, ids_b, hit.T @ a["times"].to_numpy()))
        # rows and columns as one graph; any of its forests connects what the links connect
        i, k = np.nonzero(hit)
        k = k if same else k + len(a)
        ids = ids_a if same else np.concatenate([ids_a, ids_b])
        tree = _forest(len(ids), np.concatenate([i, k]), np.concatenate([k, i]))
        return pd.concat([*parts, _frame("tree", ids[tree[0]], ids[tree[1]], np.zeros(len(tree[0]), int))])

    return run


def _alike(home: DataFrame, whole: DataFrame, least: float, most: int) -> DataFrame:
    """Counts and forests of all links of vectors in shards that could not be split.

    ``home`` has every node once, in its own shard. Tiles of two blocks each compare a shard
    with itself, and with the vectors of other shards that can be in range of any of its own:
    their angle to one of its vectors is at most the widest inside plus that of the range.
    Two such shards are compared once, so that counts add up and no pair comes out.
    """
    own = home.join(whole, "shard")
    middle = own.groupBy("shard").agg(
        F.first("label").alias("label"), F.min_by("vec", "id").alias("middle"), F.count("*").alias("n")
    )
    angle = F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), _cosine("vec", "middle"))))
    width = own.join(middle.select("shard", "middle"), "shard").groupBy("shard").agg(F.max(angle).alias("width"))
    middle = stored(middle.join(width, "shard").select(
        F.col("shard").alias("of"), "label", "middle", F.ceil(F.col("n") / (most // 2)).cast("int").alias("blocks"),
        (F.col("width") + math.acos(max(-1.0, min(1.0, least))) + 1e-6).alias("width"),
    ), "whole-middles")
    marked = home.join(whole.withColumn("whole", F.lit(True)), "shard", "left")
    near = marked.join(middle, (marked["label"] == middle["label"]) & (F.size("vec") == F.size("middle")))
    once = F.col("whole").isNull() | (F.col("shard") > F.col("of"))
    near = stored(near.where((F.col("shard") != F.col("of")) & once & (angle <= F.col("width"))).select(
        F.col("of").alias("shard"), "id", "vec", "times", "blocks"
    ), "whole-near")
    guests = near.groupBy("shard").agg(F.ceil(F.count("*") / (most // 2)).cast("int").alias("others"))
    own = own.join(middle.select(F.col("of").alias("shard"), "blocks"), "shard")
    own = own.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    x = F.col("block")
    inner = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda y: F.struct(
        F.concat_ws("/", "shard", F.least(x, y), F.greatest(x, y)).alias("tile"),
        F.when(x == y, -1).otherwise((x > y).cast("int")).alias("side"),
    ))
    low = F.transform(F.sequence(F.lit(0), F.col("others") - 1), lambda y: F.struct(
        F.concat_ws("/", "shard", x, F.concat(F.lit("o"), y)).alias("tile"), F.lit(0).alias("side")
    ))
    other = F.pmod(F.xxhash64("id"), F.col("others")).cast("int")
    high = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda y: F.struct(
        F.concat_ws("/", "shard", y, F.concat(F.lit("o"), other)).alias("tile"), F.lit(1).alias("side")
    ))
    rows = [own.select("id", "vec", "times", F.explode(inner).alias("t")),
            own.join(guests, "shard").select("id", "vec", "times", F.explode(low).alias("t")),
            near.join(guests, "shard").select("id", "vec", "times", F.explode(high).alias("t"))]
    tiles = rows[0].union(rows[1]).union(rows[2]).select("id", "vec", "times", "t.tile", "t.side")
    return tiles.groupBy("tile").applyInPandas(_compare_blocks(least), _FOUND)


def _cosine(a: str, b: str):
    """Cosine of two columns of vectors; each is scaled first, to neither overflow nor underflow."""

    def scaled(c):
        most = F.array_max(F.transform(c, F.abs))
        return F.transform(c, lambda v: v / most)

    def dot(p, q):
        return F.aggregate(F.zip_with(p, q, lambda v, w: v * w), F.lit(0.0), lambda s, v: s + v)

    p, q = scaled(F.col(a)), scaled(F.col(b))
    return dot(p, q) / F.sqrt(dot(p, p) * dot(q, q))


def near_duplicates(
    vectors: DataFrame, *, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
    least: float = LEAST_COSINE, shard: int = SHARD,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept): a row per row of ``vectors``.

    Vectors link if their labels and lengths are equal, the label is not null, and their
    cosine is ``least`` or more. Those that are null, zero, or hold null or non-finite
    components link with nothing, nor do rows without an id. ``component_id`` is the
    smallest id reachable by links. Ids are integers: rows that repeat an id with an equal
    vector count as copies of each other; with other vectors they are one component, whose
    links add up. Other columns are not looked at.
    """
    rows = usable(vec_id, embedding, label, vectors)
    nodes = rows.groupBy("label", "vec").agg(F.min("id").alias("first"), F.count("*").alias("times"))
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "vectors")
    copies = rows.distinct().join(nodes.select("label", "vec", F.col("node").alias("rep"), "times"), ["label", "vec"])
    copies = stored(copies.select("id", "rep", "times"), "vector-copies")
    firsts = nodes.select(F.col("node").alias("rep"), "first")
    nodes = nodes.select(F.col("node").alias("id"), "label", "vec", "times")

    placed, whole = shards(nodes, shard)
    times = nodes.select("id", "times")
    open_ = placed.join(whole, "shard", "left_anti")
    lists = open_.groupBy("shard").applyInPandas(_edges, "id bigint, near array<bigint>")
    lists = stored(
        lists.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "lists"
    )
    own = stored(open_.where("own").join(lists, "id").join(times, "id"), "own")
    home = own.select("id", "shard")
    reached = own.select("shard", F.explode("near").alias("id")).distinct().join(home, ["id", "shard"], "left_anti")
    guests = reached.join(own.select("id", "vec", "near", "times"), "id")
    search_in = own.select("shard", "id", "own", "vec", "near", "times").unionByName(
        guests.select("shard", "id", F.lit(False).alias("own"), "vec", "near", "times")
    )
    found = search_in.groupBy("shard").applyInPandas(_search_shard(least), _FOUND)
    at_home = placed.where("own").select("id", "shard").join(nodes, "id")
    found = found.union(_alike(at_home, whole, least, shard))
    found = stored(found, "vector-links")

    cross = found.where("kind = 'cross'")
    cross = cross.select("a", "b").union(cross.select("b", "a")).distinct()
    counted = cross.join(times.withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.sum("times").alias("n"))
    counted = counted.union(found.where("kind = 'count'").select("a", "n")).groupBy("a").agg(F.sum("n").alias("n"))
    # an id with several vectors makes one component of them
    several = copies.groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).where("a < z")
    same = copies.join(several, "id").select("a", F.col("rep").alias("b"))
    group = components(found.where("kind <> 'count'").select("a", "b").union(same)).withColumnRenamed("id", "rep")
    least_id = firsts.join(group, "rep").groupBy("component").agg(F.min("first").alias("low"))
    group = group.join(least_id, "component").select("rep", "low")
    linked = copies.join(counted.withColumnRenamed("a", "rep"), "rep", "left").join(group, "rep", "left")
    linked = linked.join(firsts, "rep").groupBy(F.col("id").alias("_id")).agg(
        F.sum(F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("_n"),
        F.min(F.coalesce("low", "first")).alias("_c"),
    )
    every = vectors.select(vectors[f"`{vec_id}`"].cast("long").alias("vec_id"))
    out = every.join(linked, every["vec_id"] == linked["_id"], "left")
    component = F.coalesce("_c", "vec_id")
    return out.select(
        "vec_id", F.coalesce("_n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), (component == F.col("vec_id")).alias("kept"),
    )


def recall(vectors: DataFrame, result: DataFrame, *, every: int = 100, least: float = LEAST_COSINE, chunk: int = 2000) -> float:
    """Share of the links of the vectors whose id is divisible by ``every`` that were found.

    Brute force over all rows, ``chunk`` queries at a time; 1 if there are no links.
    """
    rows = usable("vec_id", "embedding", "label", vectors)
    queries = rows.where(F.col("id") % every == 0)
    parts = max(1, -(-queries.count() // chunk))
    true = 0
    for part in range(parts):
        of = queries.where(F.pmod(F.xxhash64("id"), F.lit(parts)) == part).toPandas()  # about ``chunk`` rows
        if not len(of):
            continue
        shared = vectors.sparkSession.sparkContext.broadcast(of)

        def count(batches):
            own = shared.value
            for batch in batches:
                rows, n = batch.to_pandas(), 0
                for key, group in rows.groupby(["label", rows["vec"].map(len)]):
                    mine = own[(own["label"] == key[0]) & (own["vec"].map(len) == key[1])]
                    if len(mine):
                        hit = _unit(mine["vec"]) @ _unit(group["vec"]).T >= least
                        n += int(hit.sum() - (hit & (mine["id"].to_numpy()[:, None] == group["id"].to_numpy())).sum())
                yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

        true += rows.mapInArrow(count, "n bigint").agg(F.sum("n")).first()[0] or 0
    found = result.where(F.col("vec_id") % every == 0).agg(F.sum("n_links")).first()[0] or 0
    return found / true if true else 1.0
