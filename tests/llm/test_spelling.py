"""Spelling variants against comparing every word with every other; odd rows; chains of forms."""

import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from stratiform.llm.spelling import followed, near_words, rotations, spelling_variants


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(rows, every=31, min_chars=7, min_count=2, ratio=10):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    seen = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            seen[run[: h % len(run)] + run[h % len(run) + 1 :] if h % every == 0 else run] += 1
    count = {w: n for w, n in seen.items() if len(w) >= min_chars and n >= min_count}
    partners = {w: [v for v in count if near(w, v)] for w in count}
    form = {}
    for w, others in partners.items():
        best = min(others, key=lambda v: (-count[v], v), default=None)
        form[w] = best if best is not None and count[best] >= ratio * count[w] else None
    result = set()
    for w in count:
        root = w
        while form[root]:
            root = form[root]
        result.add((w, form[w], root, count[w], len(partners[w]), count[form[w]] if form[w] else None))
    return result


def got(frame, **options):
    return {tuple(r) for r in spelling_variants(frame, **options).collect()}


def test_equals_all_pairs(spark):
    rng = random.Random(4)
    bases = ["".join(rng.choice("abÀé") for _ in range(rng.choice([7, 8, 9]))) for _ in range(60)]
    rows = []
    for doc_id in range(120):
        some = []
        for _ in range(60):
            word = list(rng.choice(bases))
            if rng.random() < 0.3:
                word[rng.randrange(len(word))] = rng.choice("abÀé")
            some.append("".join(word).title() if rng.random() < 0.2 else "".join(word))
        rows.append((doc_id, " ".join(some)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute(rows)
    assert got(frame) == expected
    assert any(r[1] for r in expected)
    assert got(frame, every=3, min_count=1, ratio=2) == brute(rows, every=3, min_count=1, ratio=2)


def test_long_words_are_hashed(spark):
    rng = random.Random(9)
    words = {"".join(rng.choice("ab") for _ in range(rng.choice([3, 4, 5, 6]))) for _ in range(80)}
    frame = spark.createDataFrame([(w, len(w) + w.count("a")) for w in words], "word string, n long")
    usual = {tuple(r) for r in near_words(frame).collect()}
    assert {tuple(r) for r in near_words(frame, longest=4).collect()} == usual
    assert {tuple(r) for r in near_words(frame, longest=1).collect()} == usual


def test_doubled_letters_and_empty_rest(spark):
    words = spark.createDataFrame([(w, 5) for w in ("aab", "ab", "aaab", "b", "bb", "a")], "word string, n long")
    counts = {r["word"]: r["n_near"] for r in near_words(words).collect()}
    names = [r["word"] for r in words.collect()]
    assert counts == {w: sum(near(w, v) for v in names) for w in names}


def test_groups_are_bounded_by_the_alphabet(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = spark.createDataFrame([(x + y + "mmmmm", 3) for x in letters for y in letters], "word string, n long")
    assert rotations(words).groupBy("prefix").count().agg(F.max("count")).first()[0] == len(letters)
    assert {r["n_near"] for r in near_words(words).collect()} == {50}


def test_chains(spark):
    links = [(f"w{i:02}", f"w{i + 1:02}") for i in range(11)] + [("x", "w05")]
    roots = {r["word"]: r["root"] for r in followed(spark.createDataFrame(links, "word string, form string")).collect()}
    assert roots == {a: "w11" for a, _ in links}


def test_odd_rows(spark):
    rows = [
        (1, None), (2, ""), (3, "short words only"), (None, "spelling spelling spellings"), (4, "spelling " * 30_000),
        (4, "spelling " * 30_000), (5, "Spellíng spellíng ×÷ SPELLÍNG"), (6, "a" * 200_000 + " " + "a" * 200_000),
        (7, " ".join([("ab" * 40_000 + "c ") * 2, ("ab" * 40_000 + "d ") * 20])),
    ]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n int, word string")
    assert got(frame, every=10**10) == brute(rows, every=10**10)


def test_empty_table(spark):
    assert got(spark.createDataFrame([], "doc_id long, text string")) == set()
