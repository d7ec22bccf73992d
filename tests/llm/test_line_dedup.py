"""Levelled runs against a plain pass over documents in order."""

import pytest

from stratiform.llm.line_dedup import LineRuns, line_dedup
from tests.llm.test_pipeline import without_repeated_lines


def lines(rng, count):
    pool = ["short", "", "  ", "A line that is often there", "a LINE that is often there ", "\tanother frequent line\r", "unique"]
    return "\n".join(f"unique line {rng.random()}" if (x := rng.choice(pool)) == "unique" else x for _ in range(count))


@pytest.mark.parametrize("batches, fan_in", [(1, 2), (4, 3), (9, 2)])
def test_equals_a_plain_pass(spark, batches, fan_in):
    import random

    rng = random.Random(batches)
    texts = {i * 3: lines(rng, rng.randrange(0, 12)) for i in range(120)}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    rows = line_dedup(frame, batches, fan_in).collect()
    assert {r["doc_id"]: r["text"] for r in rows} == without_repeated_lines(texts)
    for r in rows:
        before, after = texts[r["doc_id"]].split("\n"), r["text"].split("\n")
        assert r["n_lines"] == len(before)
        assert r["n_dropped"] == len(before) - len(after) or (r["text"] == "" and r["n_dropped"] == len(before))


def test_runs_are_merged_level_by_level(spark):
    runs = LineRuns(spark, fan_in=2, buckets=3)
    for batch in range(5):
        found = spark.createDataFrame([(batch * 10 + i, i, i) for i in range(batch + 2)], "doc_id long, h1 long, h2 long")
        repeated = {(r["h1"], r["owner"]) for r in runs.add(found).collect()}
        assert repeated == {(i, max(0, i - 1) * 10 + i) for i in range(batch + 1 if batch else 0)}
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    held = [r["h1"] for level in runs.levels for name in level for r in runs._run(name).collect()]
    assert sorted(held) == list(range(6))


def test_odd_rows(spark):
    line = "a line of some length"
    rows = [
        (5, None), (6, ""), (7, f"{line}\n{line}\nx"), (7, f"{line}\n{line}\nx"), (8, f"{line.upper()}\n\ny"), (None, f"{line}\nz"),
        (9, "\n".join(f"line number {i}" for i in range(20_000)) + f"\n{line}"), (10, f"\n{line}"),
    ]
    frame = spark.createDataFrame([(*r, 1, "o") for r in rows], "doc_id long, text string, n_lines int, owner string")
    got = line_dedup(frame, batches=3)
    assert got.columns == ["doc_id", "owner", "text", "n_lines", "n_dropped"]
    by_id = {r["doc_id"]: r for r in got.collect()}
    assert got.count() == len(rows)
    assert (by_id[5]["text"], by_id[5]["n_lines"], by_id[6]["text"], by_id[6]["n_lines"]) == ("", 1, "", 1)
    assert by_id[7]["text"] == f"{line}\n{line}\nx" and by_id[8]["text"] == "\ny" and by_id[None]["text"] == f"{line}\nz"
    assert by_id[9]["n_dropped"] == 1 and by_id[10]["text"] == ""
    assert line_dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []
