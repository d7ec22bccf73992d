"""Collocations against counting every phrase; flow, paths, hot words, exact scores; odd rows."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stratiform.llm import collocations as module
from stratiform.llm.collocations import collocations, flow_counts, phrase_graph, score


def counted(rows):
    """rows: (lang, text). Counts of all phrases of one to three words by (lang, words), and of all words by lang."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    seen, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(lower)):
            words = [w for w in re.split("[ \t]", piece) if w]
            total[lang] += len(words)
            for size in (1, 2, 3):
                for i in range(len(words) - size + 1):
                    seen[lang, tuple(words[i : i + size])] += 1
    return seen, total


def brute(rows, least=10, share=50, top=2000):
    seen, total = counted(rows)
    result = []
    candidates = {k: a for k, a in seen.items() if len(k[1]) > 1 and a >= least}
    for lang in total:
        ranked = []
        for (own, words), a in candidates.items():
            if own != lang:
                continue
            if len(words) == 2 and any(
                o == lang and len(w) == 3 and words in (w[:2], w[1:]) and 100 * f >= share * a for (o, w), f in candidates.items()
            ):
                continue
            cuts = [(1_000_000 * a * a // (seen[lang, words[:k]] * seen[lang, words[k:]]), k) for k in range(1, len(words))]
            s, k = min(cuts)
            ranked.append((-s, -a, " ".join(words).encode(), seen[lang, words[:k]], seen[lang, words[k:]]))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(ranked)[:top], 1):
            result.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -s))
    return sorted(result)


def texts(seed=2, count=150):
    rng = random.Random(seed)
    words = ["the", "The", "of", "é", "zebra", "a|b", "x-y"] + [f"w{i}" for i in range(12)]
    rows = []
    for _ in range(count):
        some = []
        for _ in range(rng.randrange(60)):
            some.append(rng.choice(words[:6] if rng.random() < 0.6 else words))
            if rng.random() < 0.2:
                some.append(rng.choice([".", ", ", "\n", " never break this long phrase apart ", "\t"]))
        rows.append((rng.choice(["en", "fr", None]), " ".join(some)))
    return rows


def got(frame, **options):
    names = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in collocations(frame, **options).select(*names).collect())


@pytest.mark.parametrize("options", [{}, {"least": 3, "top": 40}, {"share": 90}])
def test_equals_counting(spark, options):
    rows = texts()
    expected = brute(rows, **options)
    assert len(expected) > 30
    assert got(spark.createDataFrame(rows, "lang string, text string"), **options) == expected


def test_shorter_counts_follow_from_flow(spark, monkeypatch):
    rows = texts(5)
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    seen, total = counted(rows)
    expected = {(lang, " ".join(w[:2]), w[2] if len(w) == 3 else None): n for (lang, w), n in seen.items() if n >= 4}
    expected |= {(lang, None, None): n for lang, n in total.items()}
    for hot in (["the", "of", "é"], [], [f"w{i}" for i in range(12)] + ["zebra", "the", "of", "é", "never", "break"]):
        monkeypatch.setattr(module, "hot_words", lambda docs, partitions, hot=hot: hot)
        assert {(r["lang"], r["node"], r["next"]): r["n"] for r in flow_counts(frame, 4).collect()} == expected


def test_flushed_counts(spark, monkeypatch):
    rows = texts(6)
    whole = module.edge_counts
    for bounds in ({"tokens": 5}, {"types": 4}):
        monkeypatch.setattr(module, "edge_counts", lambda docs, bounds=bounds: whole(docs, **bounds))
        assert got(spark.createDataFrame(rows, "lang string, text string")) == brute(rows)


def test_unary_paths_are_compacted(spark):
    rows = [("en", "alpha beta gamma delta epsilon zeta")] * 12 + [("en", "omega beta gamma")] * 3 + [("en", "zeta eta theta iota")] * 11
    words, pairs, paths, sizes = phrase_graph(spark.createDataFrame(rows, "lang string, text string"))
    found = {" ".join(r["words"]): (r["n"], r["n_in"], r["n_out"]) for r in paths.collect()}
    # Three other pieces enter and end at "beta gamma", so the path parts there.
    assert found == {"alpha beta gamma": (12, 12, 15), "beta gamma delta epsilon zeta": (12, 15, 12), "zeta eta theta iota": (11, 11, 11)}


def test_hot_words_are_few_and_found(spark, monkeypatch):
    monkeypatch.setattr(module, "_LOOKED_AT", 0.9)
    rows = [("en", "the " * 40 + " ".join(f"r{i}x{j}" for j in range(60))) for i in range(50)]
    assert module.hot_words(spark.createDataFrame(rows, "lang string, text string").repartition(4), 8) == ["the"]


def test_scores_beyond_64_bits(spark):
    cases = [(10**12, 10**12 + 7, 10**13), (3, 10, 7), (987_654_321_987, 987_654_321_988, 987_654_321_999), (10, 10, 10)]
    frame = spark.createDataFrame(cases, "a long, l long, r long")
    assert [r[0] for r in frame.select(score(F.col("a"), F.col("l"), F.col("r"))).collect()] == [1_000_000 * a * a // (x * y) for a, x, y in cases]


def test_odd_rows(spark):
    rows = [
        (None, None), ("en", None), (None, ""), ("en", " \t.,;\n"), ("und", "one two three " * 12), (None, "one two three " * 12),
        ("en", "word " * 30_000), ("en", "a b c"), ("de", " x y z  " * 11), ("de", "x y z!" * 11), ("", "x y. " * 10), ("en", "caf\u00c9 caf\u00e9\u00a0x caf\u2003y\u0085z\x1c " * 12),
    ]
    frame = spark.createDataFrame([(*r, "q", 1) for r in rows], "lang string, text string, node string, n int")
    assert got(frame) == brute(rows)


def test_empty_table(spark):
    assert got(spark.createDataFrame([], "lang string, text string")) == []
