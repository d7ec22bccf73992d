"""Fingerprints, differing rows, and keys across loads."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stratiform.operators import content, key_history, landing
from stratiform.plans import flow
from stratiform.plans.flow import run_source

from .test_flow import make, tables  # noqa: F401

ROW = "a int, b string, c double"


def test_order_and_partitions_do_not_matter(spark):
    rows = [(i % 7, None if i % 5 == 0 else f"t{i % 11}", i / 3) for i in range(500)]
    frame = spark.createDataFrame(rows, ROW)
    assert content.same_content(frame, frame.repartition(7).orderBy(F.desc("c")))
    assert content.differing_rows(frame, frame.repartition(3)).isEmpty()


@pytest.mark.parametrize(
    "left, right",
    [
        ([(1, None, 2.0)], [(None, "1", 2.0)]), ([(1, "x", None)] * 2, [(1, "x", None)]), ([(1, "a", 1.0), (2, "b", 1.0)], [(1, "b", 1.0), (2, "a", 1.0)]),
        ([(1, "a", 1.0)] * 2 + [(2, "b", 1.0)], [(1, "a", 1.0)] + [(2, "b", 1.0)] * 2), ([], [(1, "", 0.0)]),
    ],
)
def test_differences_are_named(spark, left, right):
    a, b = (spark.createDataFrame(rows, ROW) for rows in (left, right))
    assert not content.same_content(a, b)
    one, two = Counter(left), Counter(right)
    expected = {(*r, one[r], two[r]) for r in one | two if one[r] != two[r]}
    assert {tuple(r) for r in content.differing_rows(a, b).collect()} == expected


def test_random_frames(spark):
    rng = random.Random(1)
    left = [(rng.randrange(40), rng.choice("xyz"), float(rng.randrange(3))) for _ in range(2000)]
    right = list(left)
    for _ in range(9):
        right[rng.randrange(2000)] = (rng.randrange(40), "w", 0.0)
    one, two = Counter(left), Counter(right)
    expected = {(*r, one[r], two[r]) for r in one | two if one[r] != two[r]}
    got = content.differing_rows(spark.createDataFrame(left, ROW), spark.createDataFrame(right, ROW).repartition(5))
    assert {tuple(r) for r in got.collect()} == expected


def test_nested_columns(spark):
    frame = spark.sql("SELECT map('k', 1, 'l', 2) AS m, array(1, null) AS a, parse_json('{\"x\": 1}') AS v, named_struct('f', null) AS s")
    turned = spark.sql("SELECT map('l', 2, 'k', 1) AS m, array(1, null) AS a, parse_json('{\"x\":1}') AS v, named_struct('f', null) AS s")
    assert content.same_content(frame, turned)


def test_keys_of_earlier_loads(spark, new_name):
    history = new_name("keys")
    frame = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c")], "k int, t string")

    def load(rows, name):
        flagged = key_history.flag_seen(rows, ["k", "t"], history, name)
        seen = sorted(tuple(r) for r in flagged.where("seen_before").collect())
        return seen, key_history.record(flagged.where("NOT seen_before"), ["k", "t"], history, name)

    assert load(frame, "L1") == ([], 2)
    assert load(frame, "L1") == ([], 2)  # a repeated load does not find itself
    later = spark.createDataFrame([(1, "a"), (2, "x"), (None, "c"), (1, "a")], "k int, t string")
    assert load(later, "L2") == ([(1, "a", True), (1, "a", True)], 1)
    assert spark.table(history).count() == 3


def test_a_load_reads_only_history_that_meets_its_keys(spark, new_name, monkeypatch):
    history = new_name("keys")
    key_history.record(spark.range(0, 20_000).repartitionByRange(20, "id"), ["id"], history, "L1")
    key_history.flag_seen(spark.range(5), ["id"], history, "L2").count()
    read = []
    real = key_history.table_files.read_files_of
    monkeypatch.setattr(key_history.table_files, "read_files_of", lambda s, t, p: read.append(len(p)) or real(s, t, p))
    flagged = key_history.flag_seen(spark.range(19_990, 20_010), ["id"], history, "L2")
    assert flagged.where("seen_before").count() == 10
    held = len(key_history.table_files.data_files(spark, history))
    assert max(read) < held or held == 1


def test_control_run_with_history_and_content_check(spark, rows, make, tables, new_name):  # noqa: F811
    history, archive = new_name("history"), new_name("archive")
    spec = make([("1", "a", "1"), ("2", "b", "2")], key_history=history, archive_table=archive, verify_content=True)
    run_source(spark, spec, tables, load_id="L1")
    more = flow.with_rules(spec, read=lambda s: s.createDataFrame([("2", "c", "5"), ("3", "d", "6")], "raw_id string, raw_name string, raw_amount string"))
    result = run_source(spark, more, tables, load_id="L2")
    assert (result.valid_rows, result.reject_rows) == (1, 1)
    assert rows(spark.table(spec.silver_table), "id") == [(1,), (2,), (3,)]
    assert rows(spark.table(tables.dq_rule_results).where("run_id = 'L2'"), "dq_failed_rule") == [(key_history.PK_NEW,), (None,)]
    again = run_source(spark, more, tables, load_id="L2", resume=True)
    assert (again.valid_rows, again.reject_rows) == (1, 1)
    events = spark.table(tables.validation_events).where("event_name = 'content_verification'")
    assert {r.event_status for r in events.collect()} == {"PASS"}
    landing.replace_load(spark.table(archive).where("load_id = 'L1'").limit(1), archive, "L1")
    assert not content.same_content(spark.table(spec.landing_table).where("load_id = 'L1'"), spark.table(archive).where("load_id = 'L1'"))
