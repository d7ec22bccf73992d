"""Forward-backward against a word-by-word version; accuracy on texts that were not learned from."""

import zlib

import numpy as np
import pytest

from stratiform.llm.language_crf import LETTERS, fit, identify, train

FOLDER = "/root/testdata/sf0.01/documents.parquet"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(FOLDER)


@pytest.fixture(scope="module")
def model(docs):
    return train(docs, per_label=60)


def word_by_word(model, text):
    emissions = model.emissions(LETTERS.findall(text.lower())).astype(float)
    forward, backward = [model.start + emissions[0]], [np.zeros(len(model.labels))]
    for own in emissions[1:]:
        forward.append(np.logaddexp.reduce(forward[-1][:, None] + model.moves, axis=0) + own)
    for own in emissions[:0:-1]:
        backward.insert(0, np.logaddexp.reduce(model.moves + (own + backward[0])[None, :], axis=1))
    both = np.array(forward) + np.array(backward)
    return np.exp(both - np.logaddexp.reduce(both, axis=1)[:, None])


def test_blocks_give_the_same_as_word_by_word(model, docs):
    texts = [r["text"] for r in docs.orderBy("doc_id").limit(8).collect()] + ["der", "the of and " * 40]
    found = [LETTERS.findall(t.lower()) for t in texts]
    flat = [w for own in found for w in own]
    got = model.posteriors(model.emissions(flat), np.array([len(w) for w in found]), block=7)
    assert np.allclose(got, np.concatenate([word_by_word(model, t) for t in texts]), atol=1e-6)


def test_held_out_accuracy(model, docs):
    held = [r for r in docs.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    names, scores = model.label_texts([r["text"] for r in held])
    assert np.mean([n == r["lang"] for n, r in zip(names, held)]) > 0.98
    assert all(0 <= s <= 1 for s in scores)


def test_switches_inside_a_text(model):
    words = model.label_words("the thing of that was and the der und nicht die auch ist und les des que dans pour le")
    assert [w[1] for w in words[:4]] == ["en"] * 4 and [w[1] for w in words[-3:]] == ["fr"] * 3
    assert "de" in {w[1] for w in words}


def test_odd_rows(spark, model):
    schema = "doc_id long, text string, lang string, lang_pred int, score string"
    rows = [
        (1, None, "en", 1, "x"), (2, "", "en", 1, "x"), (3, "123 ²_!", "en", 1, "x"), (4, "der und die", None, 1, "x"),
        (4, "der und die", None, 1, "x"), (None, "the of and", "en", 1, "x"), (5, "the of and that " * 20_000, "fr", 1, "x"),
    ]
    got = identify(spark.createDataFrame(rows, schema), model)
    assert got.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    by_id = sorted((str(r["doc_id"]), r["lang_pred"], r["score"] > 0.9) for r in got.collect())
    assert by_id == [
        ("1", "und", False), ("2", "und", False), ("3", "und", False), ("4", "de", True), ("4", "de", True),
        ("5", "en", True), ("None", "en", True),
    ]


def test_nothing_to_learn_from(spark):
    schema = "doc_id long, text string, lang string"
    assert identify(spark.createDataFrame([], schema)).collect() == []
    got = identify(spark.createDataFrame([(1, "some words", None)], schema)).collect()
    assert (got[0]["lang_pred"], got[0]["score"]) == ("und", 0.0)


def test_predictions_do_not_see_the_label():
    model = fit(["aa ab aa", "zz zy zz"], ["q", "r"])
    assert model.label_texts(["ab aa", "zy"])[0] == ["q", "r"]


def test_a_thousand_labels_are_drawn_and_more_are_no_refusal(spark):
    from pyspark.sql import functions as F

    from stratiform.llm.common import smallest_draws

    rows = spark.range(0, 30_000).select(
        F.concat(F.lit("l"), F.pmod("id", F.lit(1200)).cast("string")).alias("label"), F.xxhash64("id").alias("draw"), F.col("id").cast("string").alias("text")
    )
    rows = rows.withColumn("label", F.when(F.col("text") != "7", F.col("label")))
    drawn = smallest_draws(rows, "label", 150, 1000, 3000).groupBy("label").count().collect()
    assert len(drawn) == 1000 and {r["count"] for r in drawn} == {3}
    assert smallest_draws(rows, "label", 150).groupBy("label").count().agg(F.min("count")).first()[0] == 25


def test_more_labels_than_were_once_allowed(spark):
    from stratiform.llm.language_crf import identify

    rows = [(i, f"{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}uv{'xyz'[i // 100 % 3]} " * 5, f"l{i % 250}") for i in range(500)]
    found = identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert found.where("lang_pred <> 'und'").count() == 500
