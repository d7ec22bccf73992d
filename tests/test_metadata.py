"""The declarative validators, and partitions of a merge."""

import datetime as dt
import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from stratiform.operators import landing, publish
from stratiform.operators.conform import MAPPING_ROWS
from stratiform.operators.metadata import RowShape, Value, cell, is_active
from stratiform.operators.rules import RULE_ROWS


def test_rows_with_every_kind_of_fault():
    rows = [
        {"rule_name": "a", "rule_expression": "x > 1"}, {"rule_name": " a ", "rule_expression": "x", "severity": "Warn"},
        {"rule_name": "b"}, "text", {"rule_name": "c", "rule_expression": "y", "severity": "loud"}, {"is_active": "no"},
    ]
    assert RULE_ROWS.problems(rows) == [
        "rule 4: not a mapping", "rule 3: rule_expression not filled in", "rule_name 'a' is used by 2 rule rows",
        "rule 5: severity 'loud' is none of ['critical', 'error', 'high', 'low', 'medium', 'warn', 'warning']",
    ]
    assert MAPPING_ROWS.problems([]) == [] and len(MAPPING_ROWS.problems([{}])) == 1
    assert RowShape("x", (), "n").problems([{}]) == []


@pytest.mark.parametrize("flag, active", [(None, True), ("", True), (" N ", False), ("False", False), (0, False), ("yes", True)])
def test_active_flags(flag, active):
    assert is_active({"is_active": flag}) is active and cell({"a": None}, "a") == ""


def test_nested_values():
    shape = Value(dict, keys={"n": Value(int, low=1)}, each=Value(float, low=0, high=1))
    assert list(shape.problems("c", {"n": "0", "s": 2, "t": None, "u": "x", "v": "nan"})) == [
        "c.n must be >= 1", "c.s must be between 0 and 1", "c.u must be numeric", "c.v must be between 0 and 1",
    ]
    assert list(shape.problems("c", [])) == ["c must be an object"] and list(shape.problems("c", None)) == []


@pytest.mark.parametrize("kind", ["text", "date"])
def test_merge_moves_keys_out_of_odd_partitions(spark, rows, new_name, kind):
    """A key that leaves its partition is not left behind there, whatever the partition is called."""
    if kind == "text":
        values, schema = ["x\\y", "it's", None, "a b=c/d%"], "k long, v string, p string"
    else:
        values, schema = [dt.date(2024, 1, 2), dt.date(1999, 12, 31), None, dt.date(2030, 6, 1)], "k long, v string, p date"
    name = new_name("moved")
    base = spark.createDataFrame([(i, "old", p) for i, p in enumerate(values)], schema)
    publish.merge(base, name, ["k"], ["p"])
    moved = spark.createDataFrame([(i, "new", values[0]) for i in range(1, 4)], schema)
    publish.merge(moved, name, ["k"])
    assert rows(spark.table(name)) == sorted([(0, "old", values[0]), *[(i, "new", values[0]) for i in range(1, 4)]], key=repr)
    publish.merge(spark.createDataFrame([(i, "last", values[1]) for i in range(4)], schema), name, ["k"])
    assert rows(spark.table(name)) == sorted([(i, "last", values[1]) for i in range(4)], key=repr)


def test_partition_conditions_prune_the_scan(spark, new_name):
    name = new_name("pruned")
    spark.range(40).selectExpr("id", "id % 5 as p", "if(id % 2 = 0, null, 'x') as q").write.partitionBy("p", "q").saveAsTable(name)
    target = spark.table(name)
    scope = target.filter(publish._in_partitions(target, [{"p": 1, "q": "x"}, {"p": 1, "q": None}, {"p": 3, "q": None}]))
    with redirect_stdout(io.StringIO()) as plan:
        scope.explain()
    assert "PartitionFilters: []" not in plan.getvalue() and "p#" in plan.getvalue().split("PartitionFilters: [")[1]
    assert scope.count() == target.filter("p = 1 or (p = 3 and q is null)").count() == 12
    assert target.filter(publish._in_partitions(target, [])).isEmpty()
    many = [{"p": n, "q": "x"} for n in range(3000)]
    assert target.filter(publish._in_partitions(target, many)).count() == 20


def test_literals():
    assert landing.partition_literal("a\\b'c") == "'a\\\\b\\'c'"
    assert landing.partition_literal(None) == "null" and landing.partition_literal(3) == "3"
    assert landing.partition_literal(dt.date(2024, 1, 2)) == "DATE '2024-01-02'"
    assert landing.partition_literal(dt.datetime(2024, 1, 2, 3)) == "TIMESTAMP_NTZ '2024-01-02 03:00:00'"


def test_stored_sides_are_removed(spark, new_name, tmp_path):
    from pathlib import Path

    from stratiform.session import shared_root

    folder = Path(shared_root(spark).removeprefix("file:")) / "stratiform"
    before = set(folder.glob("upsert-*")) | set(folder.glob("touched-*"))
    name = new_name("tidy")
    rows = spark.range(10).withColumn("v", F.lit(1))
    publish.merge(rows, name, ["id"])
    publish.merge(rows.limit(3), name, ["id"])
    assert set(folder.glob("upsert-*")) | set(folder.glob("touched-*")) == before
