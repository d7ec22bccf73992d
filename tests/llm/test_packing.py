"""Pieces against the texts' own ids: every id once, sequences gapless, little padding."""

import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratiform.llm.cutting_stock import column_generation, rounded
from stratiform.llm.packing import pack


@lru_cache
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def expected_ids(text):
    return [*tokenizer().encode(text or "", add_special_tokens=False).ids, 0]


def check(pieces, texts, capacity=1024):
    """texts: doc_id to text, ids unique."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
    assert set(by_doc) == set(texts)
    for doc_id, own in by_doc.items():
        ids, at = expected_ids(texts[doc_id]), 0
        for p in sorted(own, key=lambda p: p["start"]):
            assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(ids)
            at += p["length"]
            part = np.array(ids[p["start"] : at], "<u4").tobytes()
            assert zlib.crc32(part) == p["crc"]
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(p["length"] for p in pieces)
    return len(by_sequence) * capacity - total, total


def collected(frame, **options):
    return pack(frame, **options).withColumn("crc", F.crc32("ids")).collect()


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    padding, total = check(collected(docs), texts)
    assert padding < 1024 + 0.005 * total


@pytest.mark.parametrize("capacity", [16, 64])
def test_odd_rows(spark, capacity):
    texts = {1: None, 2: "", 3: "one two", 4: "word " * 5000, 5: "one two", 6: "<|endoftext|> é ß", 7: "\n\n \n"}
    docs = spark.createDataFrame([(k, v, k, "x") for k, v in texts.items()], "doc_id long, text string, rank int, ids string")
    padding, _ = check(collected(docs, capacity=capacity), texts, capacity)
    assert padding < capacity


def test_repeated_and_null_ids(spark):
    docs = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "a b c"), (None, None)], "doc_id long, text string")
    rows = collected(docs)
    assert sorted((str(r["doc_id"]), r["length"]) for r in rows) == [("1", 4), ("1", 4), ("None", 1), ("None", 4)]
    places = sorted((r["sequence_id"], r["offset"], r["length"]) for r in rows)
    assert [p[1] for p in places] == [0, *np.cumsum([p[2] for p in places])[:-1]]


def test_empty_table(spark):
    assert collected(spark.createDataFrame([], "doc_id long, text string")) == []


def test_equal_documents_share_patterns(spark):
    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.lit("one two three").alias("text"))
    padding, total = check(collected(docs, capacity=32), {i: "one two three" for i in range(600)}, 32)
    assert padding < 32 and total == 2400


def test_column_generation_reaches_the_bound():
    # 100 of 6, 100 of 4, 60 of 5 in sequences of 10: no waste is needed.
    histogram = {6: 100, 4: 100, 5: 60}
    assert sum(v for _, v in column_generation(histogram, 10)) == pytest.approx(130)
    assert sum(p.times for p in rounded(histogram, 10)) == 130
    # No two of these fit together.
    assert sum(v for _, v in column_generation({6: 10, 7: 5}, 10)) == pytest.approx(15)
    assert column_generation({}, 10) == []


def test_rounded_patterns_use_no_more_than_there_is():
    rng = np.random.default_rng(3)
    histogram = {int(k): int(v) for k, v in zip(range(1, 64), rng.integers(0, 40, 63))}
    used = defaultdict(int)
    for p in rounded(histogram, 64):
        assert p.fill <= 64
        for length in p.lengths:
            used[length] += p.times
    assert all(used[k] <= v for k, v in histogram.items())
