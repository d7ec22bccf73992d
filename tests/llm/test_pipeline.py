"""Each stage against a brute-force version over that stage's own input."""

import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_containment import brute as contained
from tests.llm.test_ngram_join import brute as classes
from tests.llm.test_packing import check

FOLDER = "/root/testdata/sf0.001"


def without_repeated_lines(texts):
    """doc_id to text, by a plain pass over documents in order."""
    blanks, owner, holders = " \t\n\x0b\x0c\r", {}, {}

    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(blanks))

    for doc_id in sorted(texts):
        for k in {key(line) for line in texts[doc_id].split("\n")}:
            owner.setdefault(k, doc_id)
            holders[k] = holders.get(k, 0) + 1
    return {
        doc_id: "\n".join(
            line for line in text.split("\n") if len(key(line)) < 10 or holders[key(line)] < 2 or owner[key(line)] == doc_id
        )
        for doc_id, text in texts.items()
    }


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    """The stages' inputs, and the last one's result. Two rows that have to go are added."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = spark.createDataFrame([(10**6, "12 34 !!", "en", "src0", 8), (10**6 + 1, None, "en", "src0", 0)], docs.schema)
    docs, frames = docs.unionByName(odd), []
    for name, stage in corpus_pipeline.STAGES:
        frames.append(docs)
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, FOLDER).write.parquet(path)
        docs = spark.read.parquet(path)
    return [*frames, docs]


def texts(frame):
    rows = {r["doc_id"]: r["text"] for r in frame.collect()}
    assert len(rows) == frame.count()
    return rows


def test_columns_are_kept(inputs):
    assert all(f.columns == inputs[0].columns for f in inputs[1:5])


def test_language_stage_keeps_clean_documents(inputs):
    before, after = texts(inputs[0]), texts(inputs[1])
    assert set(before) - set(after) == {10**6, 10**6 + 1}
    assert all(before[k] == v for k, v in after.items())


def test_line_stage(inputs):
    assert texts(inputs[2]) == without_repeated_lines(texts(inputs[1]))
    assert inputs[2].where(F.length("text") != F.col("n_chars")).isEmpty()


def test_near_duplicate_stage(inputs):
    before = texts(inputs[2])
    kept = {doc_id for doc_id, (head, _, _) in classes(sorted(before.items())).items() if head == doc_id}
    assert set(texts(inputs[3])) == kept


def test_decontamination_stage(spark, inputs):
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    before = texts(inputs[3])
    assert set(texts(inputs[4])) == set(before) - {f[0] for f in contained(before.items(), items)}


def test_packing_stage(inputs):
    pieces = [r.asDict() | {"crc": r["ids_crc32"]} for r in inputs[5].collect()]
    assert all(zlib.crc32(bytes(p["ids"])) == p["crc"] for p in pieces)
    padding, total = check(pieces, texts(inputs[4]))
    assert padding < 1024 + 0.005 * total


def test_run_gives_the_same(spark):
    result = corpus_pipeline.run(spark, FOLDER)
    assert {"doc_id", "start", "length", "sequence_id", "offset", "doc_tokens", "ids"} <= set(result.columns)
    assert result.where("doc_id IS NULL").isEmpty() and not result.isEmpty()


def test_language_stage_keeps_clean_texts_in_several_languages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    by_lang = {}
    for r in docs.where("lang IS NOT NULL AND length(text) > 400").orderBy("doc_id").collect():
        by_lang.setdefault(r["lang"], " ".join(r["text"].split()[:60]))
    parts = [by_lang[name] for name in sorted(by_lang)]
    assert len(parts) >= 3
    mixed = [" ".join(parts[(i + k) % len(parts)] for k in range(n)) for n in (2, 3) for i in range(len(parts))]
    rows = [(10**6 + i, text, None, "src0", len(text)) for i, text in enumerate(mixed)]
    kept = corpus_pipeline.language_id(spark, docs.unionByName(spark.createDataFrame(rows, docs.schema)), FOLDER)
    assert kept.where(f"doc_id >= {10**6}").count() == len(mixed)


def test_near_duplicates_of_repeated_and_null_ids(spark):
    text, other, third = (" ".join(f"{c}{i}" for i in range(30)) for c in "abc")
    rows = [(1, text), (1, text), (3, text), (3, other), (4, other + " more"), (None, third), (None, third), (None, text), (7, ""), (7, ""), (8, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in corpus_pipeline.near_duplicates(spark, frame, FOLDER).collect()]
    assert sorted(kept, key=repr) == sorted([(1, text), (3, other), (None, third), (7, ""), (8, "")], key=repr)
