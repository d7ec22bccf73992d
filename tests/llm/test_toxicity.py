"""Noisy-or against a plain version; accuracy on texts that were not learned from; sentences found."""

import math
import zlib

import numpy as np
import pytest

from stratiform.llm.toxicity import SentenceModel, fit, score_toxicity, sentences, train, word_features

FOLDER = "/root/testdata/sf0.1"


def plain(model, text):
    none = 1 - model.leak
    for _, _, own in sentences(text or ""):
        features = {f for w in own for f in word_features(w)}
        none *= 1 - 1 / (1 + math.exp(-(model.bias + sum(model.weights.get(f, 0) for f in features))))
    return 1 - none


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def model(spark, docs):
    return train(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))


def test_held_out_accuracy(spark, docs, model):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    held = [r for r in docs.collect() if r["doc_id"] in labels and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    scores, _ = model.scores([r["text"] for r in held])
    toxic = np.array([labels[r["doc_id"]] for r in held])
    order = scores.argsort().argsort()
    area = (order[toxic == 1].mean() - (toxic.sum() - 1) / 2) / (toxic == 0).sum()
    assert area > 0.95
    assert (scores >= 0.5)[toxic == 1].mean() > 0.8 and (scores >= 0.5)[toxic == 0].mean() < 0.02
    for r in held[:60]:
        assert model.scores([r["text"]])[0][0] == pytest.approx(plain(model, r["text"]), abs=1e-9)


def test_sentences():
    text = "One two. Three?!  four\n\n5. Five"
    assert [(text[a:b], own) for a, b, own in sentences(text)] == [
        ("One two.", ["one", "two"]), ("Three?!", ["three"]), ("four\n\n", ["four"]), ("Five", ["five"]),
    ]


def test_learned_from_documents_the_sentence_is_found():
    rng = np.random.default_rng(0)

    def calm():
        return " ".join(f"w{'abcdefghij'[i]}" for i in rng.integers(0, 10, 6)) + "."

    texts = [" ".join([calm(), calm(), calm()]) for _ in range(60)]
    bad = [f"{calm()} You are awful {n}. {calm()}" for n in range(20)]
    own = fit([*texts, *bad], [0] * 60 + [1] * 20)
    text = "Wa wb wc. You are awful now. Wd we."
    assert [text[a:b] for a, b, _ in own.offending(text, 0.5)] == ["You are awful now."]


def test_odd_rows(spark):
    model = SentenceModel({"bad": 20.0, "bad*": 0.5}, -9.0, 0.02)
    rows = [(1, None), (2, ""), (3, "12 !?"), (4, "bad"), (4, "bad"), (None, "Fine. BAD one\nfine"), (5, "fine. " * 50_000), (6, "badly")]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, score string")
    got = score_toxicity(frame, model)
    assert got.columns == ["doc_id", "text", "score", "predicted", "worst_sentence", "offending"]
    by_id = {r["doc_id"]: r for r in got.collect()}
    assert got.count() == len(rows)
    assert all(by_id[i]["score"] == pytest.approx(0.02) and not by_id[i]["offending"] for i in (1, 2, 3))
    assert by_id[4]["predicted"] == 1 and by_id[6]["predicted"] == 0
    assert [(s["start"], s["end"]) for s in by_id[None]["offending"]] == [(6, 14)]
    assert 0 <= by_id[5]["score"] <= 1
    assert score_toxicity(spark.createDataFrame([], "doc_id long, text string"), model).collect() == []


def test_labels_that_disagree_or_lack(spark):
    docs = spark.createDataFrame([(i, f"some words {i}") for i in range(1, 30)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None), (2, 0), (2, 1), (None, 1), (99, 1)], "doc_id long, toxic int")
    assert train(docs, labels).weights == {}
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert train(docs, none).weights == {}


def test_length_makes_nothing_toxic():
    for bias in (-4.0, -7.0, -9.0, -10.0):
        own = SentenceModel({"bad": 20.0, "rude": -bias - 0.3}, bias, 0.02)
        clean, mild = "all is fine. " * 50_000, "rude. rude. "
        scores, _ = own.scores([clean, mild, clean + mild + clean, clean + "bad. " + clean])
        assert scores[0] < 0.25 and list(scores[1:] >= 0.5) == [True, True, True]


def test_long_clean_texts_are_learned_from(spark):
    ids = [i for i in range(1, 200) if zlib.crc32(str(i).encode()) % 5]
    bad, clean, short = ids[:20], ids[20:60], ids[60:100]
    rows = [(i, f"gloom is here {i}.") for i in bad] + [(i, f"gloom is here {i}. " * 2000) for i in clean] + [(i, f"sun {i}.") for i in short]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i in bad)) for i, _ in rows], "doc_id long, toxic int")
    assert "gloom" not in train(docs, labels).weights
