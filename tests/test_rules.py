import pytest

from stratiform.errors import ConfigError, RuleError
from stratiform.operators import conform, keyed, rules

AMOUNT = {"rule_name": "positive", "rule_expression": "amount > 0"}


def test_pass_and_fail(spark, rows):
    df = spark.createDataFrame([(1, 100), (2, -5), (3, None)], "id int, amount int")
    assert rows(rules.apply(df, [AMOUNT]), "id", "dq_status", "dq_failed_rule") == [
        (1, "PASS", None), (2, "FAIL", "positive"), (3, "PASS", None)]


def test_names_accumulate_in_order(spark):
    df = spark.createDataFrame([(1, -1, "x")], "id int, amount int, status string")
    known = {"rule_name": "known", "rule_expression": "status IN ('a')", "severity": "medium"}
    warn = {"rule_name": "w", "rule_expression": "id > 1", "severity": "low"}
    row = rules.apply(df, [AMOUNT, known, warn]).first()
    assert (row.dq_failed_rule, row.dq_warn_rule) == ("positive,known", "w")


def test_null_key(spark, rows):
    df = spark.createDataFrame([(1, 5), (None, 5)], "id int, amount int")
    assert rows(rules.apply(df, [], "id"), "id", "dq_failed_rule") == [
        (1, None), (None, "primary_key_not_null")]


def test_repeated_keys_fail_all_copies(spark, rows):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 3), (None, 4), (None, 5)], "id int, amount int")
    both = "primary_key_not_null,primary_key_unique"
    assert rows(rules.apply(df, [AMOUNT], "id"), "amount", "dq_failed_rule") == [
        (1, "primary_key_unique"), (2, "primary_key_unique"), (3, None), (4, both), (5, both)]


def test_split_and_counts(spark):
    df = spark.createDataFrame([(1, 1), (1, -1), (2, 3)], "id int, amount int")
    checked = rules.apply(df, [AMOUNT], "id")
    valid, bad = rules.split(checked)
    assert (valid.count(), bad.count()) == (1, 2)
    assert tuple(rules.key_failures(checked).first()) == (0, 2)
    with pytest.raises(ConfigError):
        rules.split(df)


def test_key_columns():
    assert rules.key_columns(" a, b ,a,") == ["a", "b"]
    assert rules.key_columns(None) == []


@pytest.mark.parametrize(
    "bad",
    [
        [{"rule_name": "", "rule_expression": "1=1"}],
        [{"rule_name": "a"}],
        [AMOUNT, AMOUNT],
        [{**AMOUNT, "severity": "fatal"}],
        ["text"],
    ],
)
def test_rule_metadata_errors(spark, bad):
    df = spark.createDataFrame([(1, 1)], "id int, amount int")
    with pytest.raises(ConfigError):
        rules.apply(df, bad)


def test_unknown_key_and_expression(spark):
    df = spark.createDataFrame([(1, 1)], "id int, amount int")
    with pytest.raises(ConfigError):
        rules.apply(df, [], "nope")
    with pytest.raises(RuleError):
        rules.apply(df, [{"rule_name": "x", "rule_expression": "nope > 1"}])


def test_inactive_rules_are_skipped(spark):
    df = spark.createDataFrame([(1, -1)], "id int, amount int")
    assert rules.apply(df, [{**AMOUNT, "is_active": "N"}]).first().dq_status == "PASS"


@pytest.fixture(params=["broadcast", "shuffle", "shuffle with hot keys"])
def path(request, monkeypatch):
    if request.param != "broadcast":
        monkeypatch.setattr(keyed, "BROADCAST_ROWS", -1)
    if request.param == "shuffle with hot keys":
        monkeypatch.setattr(keyed, "HOT_SHARE", 0.01)
    return request.param


def _skewed(spark):
    """A third of the rows share one key, a third have no key, exact copies included."""
    return spark.range(0, 3000, 1, 8).selectExpr(
        "case when id % 3 = 0 then 7 when id % 3 = 1 then null else id end as k",
        "case when id % 3 = 2 then id div 2 else 1 end as g",
        "id % 5 as v",
    )


def test_duplicate_flags_on_every_path(spark, rows, path):
    df = _skewed(spark)
    from collections import Counter

    given = rows(df)
    copies = Counter((k, g) for k, g, _ in given)
    expected = sorted(((k, g, v, copies[(k, g)] > 1) for k, g, v in given), key=repr)
    assert rows(rules.flag_duplicates(df, ["k", "g"], "twice")) == expected


def test_anti_join_on_every_path(spark, rows, path):
    df = _skewed(spark)
    side = keyed.measure(df.filter("k is not null and v < 3").select("k", "g").distinct(), "side")
    gone = set(rows(side.frame))
    expected = [r for r in rows(df) if (r[0], r[1]) not in gone]
    assert rows(keyed.drop_matching(df, side, ["k", "g"])) == expected
    kept = [r for r in rows(df) if (r[0], r[1]) in gone]
    assert rows(keyed.keep_matching(df, side, ["k", "g"])) == kept


def test_shuffle_path_spreads_hot_rows(spark, monkeypatch):
    monkeypatch.setattr(keyed, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(keyed, "HOT_SHARE", 0.01)
    salt = _skewed(spark).withColumn("s", keyed._left_salt(_skewed(spark), keyed.any_null(["k"])))
    biggest = salt.filter("k is null").groupBy("s").count().agg({"count": "max"}).first()[0]
    assert biggest < 1000 / 2
    assert salt.filter("k is not null").select("s").distinct().collect()[0].s == 0


def test_mapping(spark, rows):
    df = spark.createDataFrame([("n", 5)], "src_name string, src_age bigint")
    mapped = conform.apply(df, [
        {"transform_expression": "src_name", "conformance_column": "name"},
        {"transform_expression": "cast(src_age as int)", "conformance_column": "age", "is_active": "true"},
    ])
    assert mapped.dtypes == [("name", "string"), ("age", "int")] and rows(mapped) == [("n", 5)]


def test_passthrough_drops_framework_columns(spark):
    df = spark.createDataFrame(
        [("1", 2.0, "PASS", None, "s")],
        "order_id string, amount double, bronze_dq_status string, bronze_dq_failed_check string,"
        " source_system string",
    )
    assert conform.apply(df, []).columns == ["order_id", "amount"]
    with pytest.raises(ConfigError):
        conform.apply(df, [], passthrough=False)


@pytest.mark.parametrize(
    "bad",
    [
        [{"conformance_column": "a"}],
        [{"transform_expression": "a", "conformance_column": "x"},
         {"transform_expression": "b", "conformance_column": "x"}],
        ["text"],
    ],
)
def test_mapping_errors(spark, bad):
    df = spark.createDataFrame([(1, 2)], "a bigint, b bigint")
    with pytest.raises(ConfigError):
        conform.apply(df, bad)


def test_mapping_expression_error(spark):
    with pytest.raises(RuleError):
        conform.apply(spark.range(1), [{"transform_expression": "nope", "conformance_column": "a"}])


def test_typed_mapping_uses_default(spark, rows):
    df = spark.createDataFrame([("12",), ("x",), (None,)], "v string")
    rule = {"transform_expression": "v", "conformance_column": "n", "target_type_name": "int",
            "default_value": "0"}
    assert rows(conform.apply(df, [rule], typed=True)) == [(0,), (0,), (12,)]


def test_a_load_reads_its_own_rows_only(spark, tmp_path, monkeypatch):
    from stratiform.operators import key_history
    from stratiform.queries import queries

    orders = spark.range(40).selectExpr(
        "id as o_orderkey", "id % 7 as o_custkey", "if(id = 5, null, make_timestamp_ntz(1995 + id % 4, 1, 1, 0, 0, 0)) as o_orderdate")
    orders.coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    real, read = key_history.flag_seen, {}

    def noted(df, keys, history, load_id):
        read[load_id] = {r[0] for r in df.selectExpr("input_file_name()").distinct().collect()}
        return real(df, keys, history, load_id)

    monkeypatch.setattr(key_history, "flag_seen", noted)
    out = queries()["pk_unique_across_loads"](spark, str(tmp_path))
    found = {r.o_orderkey: r.seen_before for r in out.collect()}
    assert len(found) == out.count() == 40 and found[5] is False and found[4] is False and found[11] is True
    assert len(read) == 4 and len(set.union(*read.values())) == sum(len(files) for files in read.values())
