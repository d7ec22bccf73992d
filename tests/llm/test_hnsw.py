"""Recall against comparing every pair; ties, equal vectors, odd rows, several shards."""

import numpy as np
import pytest

from stratiform.llm.catalogue import QUERIES
from stratiform.llm.hnsw import Graph, build_index, nearest, search_embeddings, usable

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, queries, k=10):
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float32).astype(float)
    found = {}
    for query_id, vector in queries:
        gaps = np.sqrt(((vectors - np.array(vector, np.float32).astype(float)) ** 2).sum(1))
        order = [i for i in np.lexsort((ids, gaps)) if ids[i] != query_id][:k]
        found[query_id] = [(int(ids[i]), gaps[i]) for i in order]
    return found


def grouped(frame):
    found = {}
    for r in sorted(frame.collect(), key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(found[r["query_id"]])
    return found


def recall(got, true):
    return np.mean([len({i for i, _ in got.get(q, [])} & {i for i, _ in own}) / max(1, len(own)) for q, own in true.items()])


def test_recall_on_the_whole_table(spark):
    folder = "/root/testdata/sf0.1"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    true = brute(rows, [r for r in rows if r[0] % 100 == 0])
    got = grouped(QUERIES["op2_hnsw"](spark, folder))
    assert set(got) == set(true) and recall(got, true) > 0.95
    for query_id, own in got.items():
        assert [s for _, s in own] == sorted(s for _, s in own)
        assert own[0][1] == pytest.approx(true[query_id][0][1], rel=1e-12)


def test_several_shards_and_groups_of_queries(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(1500, 8)))]
    frame = usable(spark.createDataFrame(rows, SCHEMA))
    index = build_index(frame, 6, shard_vectors=200)
    assert index.count() >= 7
    got = grouped(nearest(frame.where("vec_id % 10 = 0"), index, 5, per_group=40))
    assert recall(got, brute(rows, [r for r in rows if r[0] % 10 == 0], 5)) > 0.95


def test_equal_vectors_are_ties(spark):
    rows = [(i, [1.0, 2.0]) for i in range(300)] + [(300 + i, [1.0 + i, 2.0]) for i in range(1, 4)]
    got = grouped(search_embeddings(spark.createDataFrame(rows, SCHEMA)))
    assert [i for i, _ in got[0]] == list(range(1, 11)) and [i for i, _ in got[100]] == list(range(10))
    assert all(score == 0 for _, score in got[200])


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [3.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]),
        (7, [None, 1.0]), (None, [1.0, 1.0]), (100, [0.0, 1.0]), (200, [1.0, 2.0, 3.0]), (8, []), (300, None),
    ]
    frame = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", rank int")
    got = grouped(search_embeddings(frame))
    assert got == {
        0: [(1, pytest.approx(2**0.5)), (100, pytest.approx(2**0.5)), (2, 2.0)],
        100: [(1, 0.0), (0, pytest.approx(2**0.5)), (2, pytest.approx(10**0.5))],
    }
    assert search_embeddings(spark.createDataFrame([], SCHEMA)).collect() == []


def test_far_clusters_are_reached():
    rng = np.random.default_rng(5)
    vectors = np.concatenate([rng.normal(size=(60, 4)) * 0.01 + 100 * c for c in range(12)]).astype(np.float32)
    graph = Graph.build(vectors, degree=4, candidates=8)
    found = graph.search(vectors, 32)
    assert np.mean(found[:, 0] == np.arange(len(vectors))) > 0.95


def test_flat_arrays_come_back():
    graph = Graph.build(np.random.default_rng(0).normal(size=(300, 5)).astype(np.float32))
    vectors, shape, nodes, lists = graph.packed()
    again = Graph.unpacked(vectors, 5, shape, nodes, lists)
    assert (again.vectors == graph.vectors).all() and len(again.layers) == len(graph.layers)
    for a, b in zip(again.layers, graph.layers):
        assert (a.nodes == b.nodes).all() and (a.neighbours == b.neighbours).all()
