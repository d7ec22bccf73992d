"""The join against all pairs of shingle sets; groups cut into blocks; components; odd rows."""

import random

import numpy as np
import pytest

from stratiform.llm.components import connected_components
from stratiform.llm.ngram_join import jaccard_join, shared_counts, shortened, smallest_connected


def brute(rows, size=5, threshold=0.8):
    """rows: (doc_id, text), ids unique. doc_id to (class, links, shingles)."""
    sets = {}
    for doc_id, text in rows:
        w = "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()
        sets[doc_id] = {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
    ids, links, label = sorted(sets), {i: 0 for i in sets}, {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and sets[a] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-9:
                links[a] += 1
                links[b] += 1
                low, high = sorted((root(a), root(b)))
                label[high] = low
    return {i: (root(i), links[i], len(sets[i])) for i in ids}


def got(frame, **options):
    return {r["doc_id"]: (r["class_id"], r["n_links"], r["n_shingles"]) for r in jaccard_join(frame, **options).collect()}


def near_copies(groups, seed=5):
    rng = random.Random(seed)
    rows, number = [], 0
    for size in groups:
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([30, 80, 200]))]
        for _ in range(size):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                own[rng.randrange(len(own))] = f"v{rng.randrange(9)}"
            rows.append((number, " ".join(own)))
            number += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("options", [{}, {"block_docs": 5}, {"block_shingles": 900}])
def test_equals_all_pairs(spark, options):
    rows = near_copies([1, 1, 2, 3, 8, 40, 1, 5])
    assert got(spark.createDataFrame(rows, "doc_id long, text string"), **options) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (1, None), (2, ""), (3, "?!"), (4, "two words"), (5, "Two, words"), (6, "two words more"), (7, "word " * 30_000),
        (8, "word " * 9), (9, "a b c d e f"), (10, "a b c d e f g"),
    ]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, root int, set_1 string")
    assert got(frame) == brute(rows)


def test_repeated_and_null_ids(spark):
    text, other = "one two three four five six", "seven eight nine ten eleven twelve"
    rows = [(1, text), (1, text), (2, text), (None, text), (3, other), (3, text)]
    result = jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(result) == 6
    by_id = {(r["doc_id"], r["class_id"]) for r in result}
    assert (1, 1) in by_id and (2, 1) in by_id and (None, None) in by_id
    assert {r["n_links"] for r in result if r["doc_id"] in (1, 2)} == {3}


def test_empty_table(spark):
    assert got(spark.createDataFrame([], "doc_id long, text string")) == {}


def test_prefix_is_shortened_until_the_recall_is_met():
    assert shortened(6, 24, 0.8, 0.99999) == 4
    assert shortened(6, 24, 0.8, 0.5) == 6
    assert shortened(6, 1, 0.8, 0.9999) == 1


def test_shared_counts_and_components_of_a_matrix():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 40))).astype(np.uint64) for _ in range(70)]
    counts = shared_counts(sets, chunk=7)
    assert all(counts[i, j] == len(set(sets[i]) & set(sets[j])) for i in range(70) for j in range(70))
    linked = np.zeros((6, 6), bool)
    for a, b in [(5, 3), (3, 4), (1, 0)]:
        linked[a, b] = linked[b, a] = True
    assert list(smallest_connected(linked)) == [0, 0, 2, 3, 3, 3]


def test_connected_components(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(7, i) for i in range(8, 30)]
    edges = spark.createDataFrame([*chain, *star, (3, 3), (None, 5), (2, 1)], "a long, b long")
    roots = {r["node"]: r["root"] for r in connected_components(edges).collect()}
    expected = {i: 100 for i in range(100, 141)} | {i: 7 for i in range(7, 30)} | {1: 1, 2: 1}
    assert roots == expected
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
