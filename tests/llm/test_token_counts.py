"""The automaton against cutting the longest entry off again and again."""

import random

import pytest

from stratiform.llm.catalogue import QUERIES
from stratiform.llm.token_counts import WORDS, PieceCounter, token_counts, vocabulary

FOLDER = "/root/testdata/sf0.001"
BYTES = [bytes([b]) for b in range(256)]


def greedy(word, entries, longest):
    count = 0
    while word:
        size = next(n for n in range(min(longest, len(word)), 0, -1) if word[:n] in entries)
        word, count = word[size:], count + 1
    return count


@pytest.mark.parametrize("seed", range(6))
def test_random_vocabularies(seed):
    rng = random.Random(seed)
    entries = {bytes(rng.choice(b"ab ") for _ in range(rng.randrange(2, 9))) for _ in range(rng.randrange(1, 40))} | set(BYTES)
    automaton = PieceCounter(list(entries))
    for _ in range(800):
        word = bytes(rng.choice(b"abc ") for _ in range(rng.randrange(0, 30)))
        assert automaton.pieces(word) == greedy(word, entries, 9)


def test_whole_table(spark):
    entries = set(vocabulary("byte_bpe_50k"))
    longest = max(map(len, entries))
    rows = {r["doc_id"]: (r["n_words"], r["n_tokens"]) for r in QUERIES["op6_token_counts"](spark, FOLDER).collect()}
    known = {}
    for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect():
        found = WORDS.findall(r["text"])
        for w in found:
            if w not in known:
                known[w] = greedy(b" " + w.encode(), entries, longest)
        assert rows[r["doc_id"]] == (len(found), sum(known[w] for w in found))


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "the the"), (4, "the the"), (None, "é, ß!"), (5, "the " * 100_000), (6, "x" * 50_000)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, n_tokens string")
    got = token_counts(frame, words_at_once=1000)
    assert got.columns == ["doc_id", "text", "n_words", "n_tokens"]
    counts = {r["doc_id"]: (r["n_words"], r["n_tokens"]) for r in got.collect()}
    assert counts[1] == counts[2] == counts[3] == (0, 0)
    assert counts[4] == (2, 2) and counts[5] == (100_000, 100_000)
    assert counts[None][0] == 4 and counts[6][0] == 1 and counts[6][1] < 50_000
    assert got.count() == len(rows)
    assert token_counts(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_all_single_bytes_are_needed():
    with pytest.raises(ValueError):
        PieceCounter([b"a", b"ab"])
