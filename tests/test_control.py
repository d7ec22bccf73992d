import pytest

from stratiform import schemas
from stratiform.errors import ConfigError
from stratiform.functions.columns import row_hash, short_text
from stratiform.operators import advisor, alerts, audit, monitor, verify
from stratiform.plans import control

REGISTRY = {
    "source_registry": "tenant,brand,product_name,source_system,source_entity,source_type,load_type,"
    "landing_table,conformance_table,silver_table,publish_mode,is_active,source_path,source_options_json\n"
    't,b,P1,Crm,acc,FILE,full,m.b.l,m.b.c,m.s.t,append,true,s3://x,"{""header"":true}"\n'
    "t,b,p2,crm,old,FILE,full,m.b.l,m.b.c,m.s.t,append,false,s3://x,{bad\n",
    "column_mapping": "tenant,brand,product_name,source_system,source_entity,conformance_column,"
    "transform_expression,is_active\nt,b,p1,crm,acc,id,ID,true\n",
    "dq_rules": "tenant,brand,product_name,source_system,source_entity,rule_name,rule_expression,is_active\n"
    "t,b,p1,crm,gone,r,\"a IN ('x','y')\",true\n",
    "publish_rules": "tenant,brand,product_name,source_system,source_entity,publish_mode,silver_table,merge_key\n"
    "t,b,p1,crm,acc,merge,m.s.t,\n",
}


@pytest.fixture
def folder(tmp_path):
    for name, text in REGISTRY.items():
        (tmp_path / f"{name}.csv").write_text(text)
    return str(tmp_path)


def test_csv_control_tables(spark, rows, folder):
    registry = control.load(spark, "source_registry", folder)
    assert control.missing_headers(registry, "source_registry") == []
    assert control.missing_headers(registry.drop("tenant"), "source_registry") == ["tenant"]
    assert registry.first().source_options_json == '{"header":true}'
    assert rows(control.select_sources(registry), "source_entity") == [("acc",)]
    assert control.select_sources(registry, product_name=" p1 ", source_system="CRM").count() == 1
    assert control.select_sources(registry, product_name="p9").count() == 0
    assert control.for_entity(registry, "CRM", "ACC").count() == 1
    assert rows(control.registry_errors(registry), "source_entity", "error") == [
        ("old", "invalid source_options_json")]
    publish = control.load(spark, "publish_rules", folder)
    assert rows(control.publish_errors(publish), "error") == [
        ("merge_key is required when publish_mode=merge",)]
    rules = control.load(spark, "dq_rules", folder)
    assert rules.first().rule_expression == "a IN ('x','y')"
    lost = control.reference_errors(registry, dq_rules=rules)
    assert rows(lost, "table_name", "source_entity") == [("dq_rules", "gone")]
    with pytest.raises(ConfigError):
        control.load(spark, "nope", folder)


def test_references_are_counted_before_they_are_shuffled(spark, rows):
    registry = spark.createDataFrame([("crm", "acc"), ("crm", "acc"), (None, "x")], "source_system string, source_entity string")
    named = spark.createDataFrame([("crm", "acc"), ("crm", "gone"), ("crm", "gone"), (None, "x")], registry.schema)
    lost = control.reference_errors(registry, dq_rules=named, publish_rules=named.limit(2))
    assert rows(lost) == sorted(
        [("dq_rules", "crm", "gone", 2), ("dq_rules", None, "x", 1), ("publish_rules", "crm", "gone", 1)], key=repr)
    plan = control.reference_errors(registry, dq_rules=named)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1 and "partial_count" in plan


def test_bootstrap(spark, folder, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS ctl")
    control.bootstrap(spark, folder, "spark_catalog.ctl", str(tmp_path / "backup"))
    counts = {r[0]: r[1] for r in verify.table_counts(
        {n: spark.table(f"spark_catalog.ctl.{n}") for n in schemas.CONTROL_TABLES}).collect()}
    assert counts == {"source_registry": 2, "column_mapping": 1, "dq_rules": 1, "publish_rules": 1}
    assert control.load(spark, "dq_rules", table="spark_catalog.ctl.dq_rules").count() == 1
    (tmp_path / "dq_rules.csv").write_text(REGISTRY["dq_rules"].splitlines()[0] + "\n")
    with pytest.raises(ConfigError, match="dq_rules"):
        control.bootstrap(spark, folder, "spark_catalog.ctl")


def test_first_publish_rule_wins(spark, rows):
    data = [(2, "s", "e", "append"), (1, "s", "e", "merge")]
    df = spark.createDataFrame(data, "ordinal int, source_system string, source_entity string, publish_mode string")
    assert rows(control.first_publish_rule(df), "publish_mode") == [("merge",)]


def test_row_hash(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("a,b:0=", ""), (None, "a")], "x string, y string")
    hashes = [r.h for r in df.select(row_hash(df).alias("h")).collect()]
    assert len(set(hashes)) == 4
    other = df.select("y", "x")
    assert [r.h for r in other.select(row_hash(other).alias("h")).collect()] == hashes


def test_short_text(spark):
    df = spark.createDataFrame([(" a\nb" + "x" * 600,)], "t string")
    text = df.select(short_text(df.t)).first()[0]
    assert text.startswith("a bx") and len(text) == 500


def test_reject_payload_has_source_columns_only(spark):
    cols = ["order_id", "amount", *schemas.FRAMEWORK_COLUMNS, "dq_warn_rule"]
    df = spark.createDataFrame([tuple("x" for _ in cols)], ", ".join(f"{c} string" for c in cols))
    row = audit.rejects(df, audit.RunKey("r", "s", "e")).first()
    assert row.payload_json == '{"order_id":"x","amount":"x","dq_warn_rule":"x"}'


def test_reconcile_finds_losses(spark, rows):
    names = ("raw_rows landing_rows bronze_valid_rows bronze_reject_rows conformance_rows valid_rows "
             "reject_rows silver_before silver_after").split()
    schema = ", ".join(f"{n} bigint" for n in names)
    df = spark.createDataFrame([(5, 5, 3, 1, 3, 2, 1, 10, 13)], schema)
    assert [s for _, s in rows(audit.reconcile(df))] == ["FAIL", "FAIL", "PASS", "PASS"]
    merged = spark.createDataFrame([(5, 5, 3, 2, 3, 2, 1, None, None)], schema)
    assert {s for _, s in rows(audit.reconcile(merged))} == {"PASS"}


def test_layer_counts(spark):
    df = spark.range(3)
    assert audit.layer_counts("a", df, df, df).first().status == "MATCHED"
    assert audit.layer_counts("a", df, df, df, False).first().status == "ROW_COUNTS_OK_LOCATION_DIFFERS"
    part = audit.layer_counts("a", df, None, df).first()
    assert part.status == "INCOMPLETE" and part.conformance_count is None


LOAD = ("product_name string, source_system string, source_entity string, load_id string, "
        "timestamp timestamp_ntz, ")


def test_alert_thresholds(spark, rows):
    base = ("p", "s", "e")
    import datetime as dt

    now = dt.datetime(2024, 1, 1)
    data = [(*base, str(i), now, t, f) for i, (t, f) in enumerate([(0, 0), (100, 10), (100, 11), (100, 50), (100, 51)])]
    found = alerts.dq_failure_rate(spark.createDataFrame(data, LOAD + "total_rows bigint, failed_rows bigint"))
    assert rows(found, "load_id", "severity", "title") == [
        ("2", "WARNING", "High DQ failure rate: 11.0%"), ("3", "WARNING", "High DQ failure rate: 50.0%"),
        ("4", "CRITICAL", "High DQ failure rate: 51.0%")]
    assert alerts.with_severity(found, "CRITICAL").count() == 1
    assert alerts.any_critical(found).first()[0] and not alerts.any_critical(found.limit(0)).first()[0]
    tries = [(*base, "a", now, 2, 3, "x"), (*base, "b", now, 3, 3, "y" * 200)]
    retry = alerts.retry_exhaustion(
        spark.createDataFrame(tries, LOAD + "retry_count int, max_retries int, error string")).collect()
    assert [r.load_id for r in retry] == ["b"] and retry[0].message.endswith(": " + "y" * 100)
    slow = [(*base, "a", now, 600.0), (*base, "b", now, 601.0)]
    late = alerts.slow_loads(spark.createDataFrame(slow, LOAD + "duration_seconds double")).collect()
    assert [r.load_id for r in late] == ["b"] and late[0].message == "Load took 2.0x longer than expected"


def test_performance(spark):
    df = spark.createDataFrame([("q", 0.0, 1, 1048576), ("r", 31.0, 1, 0)],
                               "query_name string, duration_seconds double, rows_processed bigint, bytes_processed bigint")
    metrics = alerts.performance(df)
    assert metrics.first().throughput_mbps == pytest.approx(1000.0)
    assert [r.query_name for r in alerts.slow_executions(metrics).collect()] == ["r"]


def test_windows_of_reports(spark, rows):
    data = [("n", str(i), "s", "e", 1, 1, "SUCCESS", None, f"2024-01-{d:02d} 00:00:00") for i, d in enumerate([1, 24, 30])]
    df = spark.createDataFrame(data, "pipeline_name string, run_id string, source_system string,"
                               " source_entity string, rows_in bigint, rows_out bigint, status string,"
                               " error_message string, t string").selectExpr("*", "cast(t as timestamp) as run_ts")
    assert rows(monitor.run_summary(df, "2024-01-31 00:00:00"), "total_runs") == [(2,)]
    assert rows(monitor.volume_trend(df), "total_loads") == [(3,)]


def test_advice(spark, rows):
    df = spark.range(5000).selectExpr("1 as one", "id as a", "id % 10 as b", "id % 20 as c", "-id as d", "id * 2 as e", "id + 9 as f")
    found = {r.recommendation_type: (r.columns, r.priority) for r in advisor.advise(df, "m.s.t").collect()}
    assert found == {"PARTITIONING": ("b", "HIGH"), "Z_ORDER": ("a,d,e", "MEDIUM"), "STATISTICS": (None, "MEDIUM")}
    few = advisor.advise(df, "m.s.t", ["one"]).collect()
    assert [r.recommendation_type for r in few] == ["STATISTICS"]
    assert few[0].implementation == "ANALYZE TABLE m.s.t COMPUTE STATISTICS"
