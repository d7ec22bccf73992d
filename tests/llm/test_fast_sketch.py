"""Components against all pairs of shingle sets; sketches; blocks; groups that nearly link; odd rows."""

import random

import numpy as np
import pytest

from stratiform.llm.fast_sketch import Sketcher, near_duplicates


def brute(rows, size=4, percent=80):
    """rows: (doc_id, text), ids unique. doc_id to (shingles, component, kept)."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for doc_id, text in rows:
        w = "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in (text or "").translate(lower)).split(" ")
        w = [x for x in w if x]
        sets[doc_id] = {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
    ids, label = sorted(sets), {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                label[high] = low
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def got(frame, **options):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates(frame, **options).collect()}


def copies(groups, edits, seed=5):
    rng = random.Random(seed)
    rows, number = [], 0
    for size in groups:
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([30, 80, 200]))]
        for _ in range(size):
            own = list(base)
            for _ in range(rng.choice(edits)):
                own[rng.randrange(len(own))] = f"v{rng.randrange(99)}"
            rows.append((number, " ".join(own)))
            number += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("options", [{}, {"block_nodes": 5}, {"block_shingles": 900, "rounds": 1}, {"rounds": 0}])
def test_equals_all_pairs(spark, options):
    # Many copies lie on either side of the threshold, so that buckets hold several components after the first comparisons.
    rows = copies([1, 1, 2, 3, 40, 1, 5, 60], [0, 1, 2, 3, 4, 5, 8])
    expected = brute(rows)
    assert 20 < sum(kept for _, _, kept in expected.values()) < 100
    assert got(spark.createDataFrame(rows, "doc_id long, text string"), **options) == expected


def test_templated_pages_stay_apart(spark):
    rng = random.Random(3)
    shared = [f"s{i}" for i in range(60)]
    rows = [(i, " ".join(shared + [f"o{rng.randrange(10**6)}" for _ in range(60)])) for i in range(400)]
    assert all(kept for _, _, kept in got(spark.createDataFrame(rows, "doc_id long, text string")).values())


def test_odd_rows(spark):
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "two words"), (5, "Two\u000bWORDS"), (6, "two words more"), (7, "word " * 30_000),
        (8, "word " * 9), (9, "a b c d e f"), (10, "a b c d e f g"), (11, "É é"), (12, "é é"), (13, "a b c d"),
        (14, " ".join(map(str, range(60_000)))), (15, " ".join(map(str, range(1, 60_000)))),
    ]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, node int, bucket string")
    assert got(frame) == brute(rows)


def test_repeated_and_null_ids(spark):
    text, other = "one two three four five six", "seven eight nine ten eleven twelve"
    rows = [(5, text), (5, text), (2, text), (None, text), (3, other), (3, text)]
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in found if r["doc_id"] is not None) == [
        (2, 2, True), (3, 2, False), (3, 3, True), (5, 2, False), (5, 2, False)
    ]
    assert [(r["component_id"], r["kept"]) for r in found if r["doc_id"] is None] == [(None, True)]


def test_empty_table(spark):
    assert got(spark.createDataFrame([], "doc_id long, text string")) == {}


def test_sketches_estimate_the_similarity():
    rng = np.random.default_rng(1)
    sketcher = Sketcher(160)
    for size in (1, 7, 150, 40_000):
        sketch = sketcher(rng.integers(0, 2**64, size, dtype=np.uint64))
        assert (sketch != np.uint64(2**64 - 1)).all()
    errors = []
    for _ in range(40):
        both = rng.integers(0, 2**64, 80, dtype=np.uint64)
        a, b = (np.concatenate([both, rng.integers(0, 2**64, 10, dtype=np.uint64)]) for _ in range(2))
        errors.append((sketcher(a) == sketcher(b)).mean() - 0.8)
    assert abs(np.mean(errors)) < 0.015 and np.std(errors) < 0.05


def test_rounds_thrown_together_change_nothing():
    values = np.random.default_rng(2).integers(0, 2**64, 30, dtype=np.uint64)
    assert (Sketcher(64)(values) == Sketcher(64)(values, cells=30)).all()
    assert (Sketcher(64)(values) == Sketcher(64)(values, cells=7)).all()
