"""Approximate nearest neighbours by a hierarchical navigable small-world graph for each shard.

Distinct vectors are dealt to shards by hash. A shard's graph is built in one task and stored as one
row of flat arrays: vectors, ids, and for every layer its nodes and their neighbours, ``-1`` where a
list is shorter. Within a shard the neighbour candidates of each layer come from blocked matrix
products, and the usual diversity rule picks among them, so building needs no walk for each insertion.
Queries walk all shards' graphs, many queries at a time, and the shards' nearest are merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratiform.llm.common import staged


@dataclass
class Layer:
    nodes: np.ndarray  # numbers of the shard's vectors, ascending
    neighbours: np.ndarray  # len(nodes) x degree, numbers of vectors; -1 fills up


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` to all rows of ``b``, to rank candidates by."""
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T), 0)


def _candidates(vectors: np.ndarray, count: int, block: int = 512) -> np.ndarray:
    """The ``count`` nearest other rows of every row, nearest first."""
    out = np.empty((len(vectors), count), np.int64)
    for low in range(0, len(vectors), block):
        d = _distances(vectors[low : low + block], vectors)
        d[np.arange(len(d)), np.arange(low, low + len(d))] = np.inf
        near = np.argpartition(d, count - 1, axis=1)[:, :count]
        order = np.take_along_axis(d, near, 1).argsort(1, kind="stable")
        out[low : low + block] = np.take_along_axis(near, order, 1)
    return out


def _far_candidates(vectors: np.ndarray, each: int, rng: np.random.Generator) -> np.ndarray:
    """The nearest rows within ever smaller samples of the rows: the long links of the graph."""
    order, parts = rng.permutation(len(vectors)), []
    size = len(vectors) // 8
    while size > 4 * each:
        some, near = order[:size], np.empty((len(vectors), each), np.int64)
        for low in range(0, len(vectors), 512):
            d = _distances(vectors[low : low + 512], vectors[some])
            near[low : low + 512] = some[np.argpartition(d, each - 1, axis=1)[:, :each]]
        parts.append(near)
        size //= 8
    return np.concatenate(parts, 1) if parts else np.zeros((len(vectors), 0), np.int64)


def _diverse(vectors: np.ndarray, near: np.ndarray, degree: int) -> np.ndarray:
    """Keep a candidate if it is nearer to its node than to every neighbour kept before it."""
    rows = len(vectors)
    own = np.stack([((vectors[near[:, c]] - vectors) ** 2).sum(1) for c in range(near.shape[1])], 1)
    own[near == np.arange(rows)[:, None]] = np.inf
    order = own.argsort(1, kind="stable")
    near, own = np.take_along_axis(near, order, 1), np.take_along_axis(own, order, 1)
    kept = np.full((rows, degree), -1, np.int64)
    filled = np.zeros(rows, np.int64)
    for c in range(near.shape[1]):
        used = kept >= 0
        gap = ((vectors[near[:, c]][:, None, :] - vectors[np.maximum(kept, 0)]) ** 2).sum(2)
        # A candidate that is met again is at distance 0 from itself, so it does not fit.
        fits = (filled < degree) & np.isfinite(own[:, c]) & ~(used & (gap < own[:, c, None])).any(1)
        at = np.flatnonzero(fits)
        kept[at, filled[at]] = near[at, c]
        filled[at] += 1
    return kept


def _both_ways(kept: np.ndarray, vectors: np.ndarray, degree: int) -> np.ndarray:
    """Add reverse links, nearest first, to at most twice the degree; the own links stay."""
    source, at = np.nonzero(kept >= 0)
    target = kept[source, at]
    pairs = np.unique(np.stack([np.concatenate([source, target]), np.concatenate([target, source])], 1), axis=0)
    mine = np.zeros(len(pairs), bool)
    keys = pairs[:, 0] * len(kept) + pairs[:, 1]
    mine[np.searchsorted(keys, np.unique(source * len(kept) + target))] = True
    gap = ((vectors[pairs[:, 0]] - vectors[pairs[:, 1]]) ** 2).sum(1)
    order = np.lexsort((pairs[:, 1], gap, ~mine, pairs[:, 0]))
    pairs = pairs[order]
    rank = np.arange(len(pairs)) - np.searchsorted(pairs[:, 0], pairs[:, 0])
    out = np.full((len(kept), 2 * degree), -1, np.int64)
    few = rank < 2 * degree
    out[pairs[few, 0], rank[few]] = pairs[few, 1]
    return out


def _bridged(lists: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Link every part of the graph that cannot be reached with the nearest row of the rest."""
    rows = np.arange(len(lists))
    label = rows.copy()
    while True:
        new = np.minimum(label, np.where(lists >= 0, label[lists], len(lists)).min(1))
        np.minimum.at(new, lists[lists >= 0], np.broadcast_to(new[:, None], lists.shape)[lists >= 0])
        new = new[new]
        if (new == label).all():
            break
        label = new
    names, sizes = np.unique(label, return_counts=True)
    more: dict[int, list[int]] = {}
    main = label == names[sizes.argmax()]
    for name in names[np.argsort(-sizes, kind="stable")][1:]:
        own, rest = np.flatnonzero(label == name), np.flatnonzero(main)
        best = (np.inf, 0, 0)
        for low in range(0, len(own), 512):
            d = _distances(vectors[own[low : low + 512]], vectors[rest])
            at = np.unravel_index(d.argmin(), d.shape)
            best = min(best, (float(d[at]), int(own[low + at[0]]), int(rest[at[1]])))
        more.setdefault(best[1], []).append(best[2])
        more.setdefault(best[2], []).append(best[1])
        main |= label == name
    if not more:
        return lists
    extra = np.full((len(lists), max(map(len, more.values()))), -1, np.int64)
    for row, targets in more.items():
        extra[row, : len(targets)] = targets
    return np.concatenate([lists, extra], 1)


@dataclass
class Graph:
    """Vectors of one shard and the layers over them, top layer last."""

    vectors: np.ndarray
    layers: list[Layer]

    @classmethod
    def build(cls, vectors: np.ndarray, degree: int = 16, candidates: int = 48, seed: int = 7) -> Graph:
        rng = np.random.default_rng(seed)
        level = np.floor(-np.log(1 - rng.random(len(vectors))) / np.log(degree)).astype(int)
        layers = []
        for at in range(int(level.max(initial=0)) + 1):
            nodes = np.flatnonzero(level >= at)
            own = vectors[nodes].astype(np.float64)
            count = min(candidates, len(nodes) - 1)
            if count < 1:
                layers.append(Layer(nodes, np.full((len(nodes), 1), -1, np.int64)))
                continue
            near = np.concatenate([_candidates(own, count), _far_candidates(own, 4, rng)], 1)
            both = _bridged(_both_ways(_diverse(own, near, degree), own, degree), own)
            layers.append(Layer(nodes, np.where(both >= 0, nodes[both], -1)))
        return cls(vectors, layers)

    def packed(self) -> tuple[bytes, list[int], bytes, bytes]:
        """Flat arrays: vectors; for each layer its size and width; all nodes; all neighbour lists."""
        shape = [n for layer in self.layers for n in layer.neighbours.shape]
        nodes = np.concatenate([layer.nodes for layer in self.layers]).astype("<i4")
        lists = np.concatenate([layer.neighbours.ravel() for layer in self.layers]).astype("<i4")
        return self.vectors.astype("<f4").tobytes(), shape, nodes.tobytes(), lists.tobytes()

    @classmethod
    def unpacked(cls, vectors: bytes, width: int, shape: list[int], nodes: bytes, lists: bytes) -> Graph:
        flat_nodes, flat = np.frombuffer(nodes, "<i4"), np.frombuffer(lists, "<i4")
        layers, node, at = [], 0, 0
        for rows, columns in zip(shape[::2], shape[1::2], strict=True):
            layers.append(Layer(flat_nodes[node : node + rows], flat[at : at + rows * columns].reshape(rows, columns)))
            node, at = node + rows, at + rows * columns
        return cls(np.frombuffer(vectors, "<f4").reshape(-1, width), layers)

    def search(self, queries: np.ndarray, width: int) -> np.ndarray:
        """Numbers of about ``width`` near vectors for every query, nearest first; -1 fills up."""
        top = self.layers[-1]
        best = np.full(len(queries), top.nodes[0])
        for layer in reversed(self.layers[1:]):
            best = self._walk(layer, queries, best, 1)[:, 0]
        return self._walk(self.layers[0], queries, best, width)

    def _walk(self, layer: Layer, queries: np.ndarray, start: np.ndarray, width: int) -> np.ndarray:
        """Best-first search of all queries side by side, each with a beam of ``width``."""
        count, size = len(queries), len(self.vectors)
        place = np.full(size, -1, np.int64)
        place[layer.nodes] = np.arange(len(layer.nodes))
        beam = np.full((count, width), -1, np.int64)
        near = np.full((count, width), np.inf)
        done = np.ones((count, width), bool)
        seen = np.zeros((count, size + 1), bool)  # the last column takes what fills up the lists
        rows = np.arange(count)
        beam[:, 0], done[:, 0] = start, False
        near[:, 0] = ((self.vectors[start] - queries) ** 2).sum(1)
        seen[rows, start] = True
        while len(rows):
            # The nearest of each beam that has not been looked from; queries without one are finished.
            pick = np.where(done[rows], np.inf, near[rows]).argmin(1)
            open_ = ~done[rows, pick]
            rows, pick = rows[open_], pick[open_]
            if not len(rows):
                break
            done[rows, pick] = True
            found = layer.neighbours[place[beam[rows, pick]]]
            fresh = (found >= 0) & ~seen[rows[:, None], found]
            seen[rows[:, None], found] = True
            gap = np.where(fresh, ((self.vectors[found] - queries[rows, None, :]) ** 2).sum(2), np.inf)
            all_near = np.concatenate([near[rows], gap], 1)
            order = np.argpartition(all_near, width - 1, axis=1)[:, :width]
            near[rows] = np.take_along_axis(all_near, order, 1)
            beam[rows] = np.take_along_axis(np.concatenate([beam[rows], np.where(fresh, found, -1)], 1), order, 1)
            shut = np.concatenate([done[rows], ~fresh], 1)
            done[rows] = np.take_along_axis(shut, order, 1)
        return np.take_along_axis(beam, near.argsort(1, kind="stable"), 1)


def usable(frame: DataFrame) -> DataFrame:
    """Rows with an id and a finite vector that is not zero: (vec_id, embedding)."""
    whole = F.col("embedding").cast("array<float>")
    finite = ~F.exists(whole, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return frame.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(finite & F.exists(whole, lambda x: x != 0)).select(
        F.col("vec_id").cast("long"), whole.alias("embedding")
    )


def build_index(vectors: DataFrame, keep: int, shard_vectors: int = 12_000, degree: int = 16) -> DataFrame:
    """A row for each shard: shard, width, ids (the ``keep`` smallest of each distinct vector), graph.

    Equal vectors are one node. It carries its ``keep`` smallest ids: no search for fewer than ``keep``
    neighbours can return another, as ties go to the smaller id.
    """
    order = Window.partitionBy("embedding").orderBy("vec_id")
    first = vectors.distinct().withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= keep)
    nodes = staged(first.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "vectors")
    per_width = {r["w"]: -(-r["n"] // shard_vectors) for r in nodes.groupBy(F.size("embedding").alias("w")).agg(F.count("*").alias("n")).collect()}
    shards = F.lit(1)
    for width, count in per_width.items():
        shards = F.when(F.size("embedding") == width, F.lit(count)).otherwise(shards)
    dealt = nodes.select("embedding", "ids", F.size("embedding").alias("width"), F.pmod(F.xxhash64("embedding"), shards).alias("shard"))

    def build(key, group):
        import pandas as pd

        group = group.sort_values("ids", key=lambda ids: ids.str[0])
        graph = Graph.build(np.stack(group["embedding"].to_list()).astype(np.float32), degree)
        vectors, shape, nodes, lists = graph.packed()
        return pd.DataFrame(
            {"width": [key[0]], "shard": [key[1]], "ids": [[list(map(int, i)) for i in group["ids"]]], "vectors": [vectors], "shape": [shape], "nodes": [nodes], "lists": [lists]}
        )

    schema = "width int, shard long, ids array<array<long>>, vectors binary, shape array<int>, nodes binary, lists binary"
    return staged(dealt.groupBy("width", "shard").applyInPandas(build, schema), "hnsw")


def nearest(
    queries: DataFrame, index: DataFrame, k: int = 10, beam: int = 96, at_once: int = 128, per_group: int = 2000,
) -> DataFrame:
    """The ``k`` nearest indexed vectors of every query, its own id left out.

    Returns query_id, rank (from 1), vec_id, score: Euclidean distance in double precision on the given
    vectors, nearest first, ties to the smaller ``vec_id``. Each group of at most about ``per_group``
    queries meets each shard in one task.
    """
    total = queries.count()
    groups = max(1, -(-total // per_group))
    shards = index.select((F.col("width") + 0).alias("width"), (F.col("shard") + 0).alias("shard"))
    asked = queries.select(
        F.col("vec_id").alias("query_id"), "embedding", F.size("embedding").alias("width"), F.pmod(F.xxhash64("vec_id"), F.lit(groups)).alias("part")
    ).join(shards, "width")
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("part")
    held = index.select("*", parts)

    def search(left, right):
        import pandas as pd

        out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        if len(left) and len(right):
            row = right.iloc[0]
            graph = Graph.unpacked(row["vectors"], int(row["width"]), list(row["shape"]), row["nodes"], row["lists"])
            ids = row["ids"]
            left = left.sort_values("query_id")
            for low in range(0, len(left), at_once):
                some = left.iloc[low : low + at_once]
                own = np.stack(some["embedding"].to_list()).astype(np.float32)
                found = graph.search(own, max(beam, k + 1))
                for query_id, vector, numbers in zip(some["query_id"], own.astype(np.float64), found, strict=True):
                    numbers = numbers[numbers >= 0]
                    gaps = np.sqrt(((graph.vectors[numbers].astype(np.float64) - vector) ** 2).sum(1))
                    near = sorted((gap, int(i)) for gap, n in zip(gaps, numbers, strict=True) for i in ids[n] if i != query_id)[:k]
                    out["query_id"] += [int(query_id)] * len(near)
                    out["vec_id"] += [i for _, i in near]
                    out["score"] += [float(gap) for gap, _ in near]
        return pd.DataFrame(out).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    keys = ["width", "shard", "part"]
    found = asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInPandas(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.distinct().withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search_embeddings(embeddings: DataFrame, every: int = 100, k: int = 10, **options) -> DataFrame:
    """Nearest neighbours of the rows whose ``vec_id`` is divisible by ``every`` among all rows.

    Rows without an id, null or zero vectors and vectors with null or non-finite components take no
    part. Repeated rows count once; equal vectors of different ids are ties. Vectors are only compared
    with vectors of their length. Extra columns are not read. An empty table has no result.
    """
    rows = usable(embeddings)
    index = build_index(rows, k + 1)
    return nearest(rows.where(F.col("vec_id") % every == 0).distinct(), index, k, **options)
