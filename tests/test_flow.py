import pytest
from pyspark.sql import functions as F

from stratiform import schemas
from stratiform.errors import ConfigError
from stratiform.operators import landing
from stratiform.plans import flow, resume
from stratiform.plans.flow import AuditTables, SourceSpec, run_all, run_source
from stratiform.session import new_folder
from stratiform.streaming import files as streams

RAW = "raw_id string, raw_name string, raw_amount string"
DATA = [("1", "ann", "10.50"), ("2", "bob", "-3"), ("3", None, "7"), ("4", "dan", "x"), ("4", "eve", "1")]


@pytest.fixture
def tables(new_name):
    return AuditTables(**{k: new_name(k) for k in AuditTables.__dataclass_fields__})


@pytest.fixture
def make(spark, new_name):
    def build(data=DATA, **more):
        base = dict(
            source_system="crm",
            source_entity="orders",
            read=lambda s: s.createDataFrame(data, RAW),
            landing_table=new_name("landing"),
            conformance_table=new_name("conformed"),
            silver_table=new_name("silver"),
            checks={"non_nullable_columns": ["raw_name"], "null_thresholds": {"raw_name": 0.5},
                    "uniqueness_constraints": ["raw_id"], "volume": {"min_rows": 1}},
            mappings=[
                {"transform_expression": "cast(raw_id as int)", "conformance_column": "id"},
                {"transform_expression": "upper(raw_name)", "conformance_column": "name"},
                {"transform_expression": "try_cast(raw_amount as decimal(10,2))", "conformance_column": "amount"},
            ],
            rules=[{"rule_name": "positive", "rule_expression": "amount > 0"},
                   {"rule_name": "known", "rule_expression": "amount is not null", "severity": "WARN"}],
            primary_key="id",
        )
        base.update(more)
        return SourceSpec(**base)

    return build


def test_full_run(spark, rows, make, tables):
    spec = make()
    result = run_source(spark, spec, tables, "nightly", load_id="L1")
    assert result.status == "SUCCESS"
    assert (result.rows_in, result.valid_rows, result.reject_rows) == (5, 1, 3)
    assert rows(spark.table(spec.silver_table), "id", "name", "dq_status") == [(1, "ANN", "PASS")]
    assert spark.table(spec.landing_table).count() == 5
    assert rows(spark.table(spec.conformance_table), "id") == [(1,), (2,), (4,), (4,)]
    assert rows(spark.table(tables.pipeline_runs), "run_id", "rows_in", "rows_out", "status") == [
        ("L1", 5, 1, "SUCCESS")]
    assert rows(spark.table(tables.dq_rule_results), "dq_failed_rule", "row_count") == [
        ("positive", 1), ("primary_key_unique", 2), (None, 1)]
    assert rows(spark.table(tables.bronze_dq_results), "validation_type", "validation_status") == [
        ("data_types", "PASS"), ("null_threshold:raw_name", "PASS"), ("required_columns", "PASS"),
        ("row_level_summary", "FAIL"), ("uniqueness:raw_id", "FAIL"), ("volume", "PASS")]
    assert spark.table(tables.rejects).count() == 3
    events = dict(rows(spark.table(tables.validation_events), "event_name", "event_status"))
    assert events["verification_summary"] == "PASS" and events["landing_raw"] == "PASS"
    assert rows(spark.table(tables.entity_lifecycle_log), "event_type") == [
        ("metadata_resolved",), ("onboarded",)]


def test_audit_schemas(spark, make, tables):
    run_source(spark, make(), tables)
    for kind, table in vars(tables).items():
        wanted = spark.createDataFrame([], schemas.AUDIT_TABLES[kind]).dtypes
        assert spark.table(table).dtypes == wanted


def test_few_jobs_and_one_source_pass(spark, make):
    reads = spark.sparkContext.accumulator(0)

    def touch(batches):
        for batch in batches:
            reads.add(len(batch))
            yield batch

    spec = make(read=lambda s: s.createDataFrame(DATA, RAW).mapInPandas(touch, RAW))
    run_source(spark, spec)
    assert reads.value == len(DATA)


def test_bad_config_lands_rows_as_failed(spark, rows, make, tables):
    spec = make(checks={"volume": []})
    result = run_source(spark, spec, tables)
    assert (result.rows_in, result.valid_rows) == (5, 0)
    assert rows(spark.table(spec.landing_table).select("bronze_dq_failed_check").distinct()) == [
        ("invalid_bronze_dq_config",)]
    assert rows(spark.table(tables.bronze_dq_results), "validation_type") == [("bronze_dq_config",)]


def test_failure_is_audited(spark, rows, make, tables):
    spec = make(mappings=[{"transform_expression": "nope", "conformance_column": "a"}])
    with pytest.raises(Exception, match="nope"):
        run_source(spark, spec, tables)
    result = run_source(spark, spec, tables, fail_fast=False)
    assert result.status == "FAILED" and "nope" in result.error
    run = spark.table(tables.pipeline_runs).collect()
    assert len(run) == 2 and {r.status for r in run} == {"FAILED"} and {r.rows_in for r in run} == {0}
    assert all(len(r.error_message) <= 500 and "\n" not in r.error_message for r in run)
    assert ("failed",) in rows(spark.table(tables.entity_lifecycle_log), "event_type")


def test_merge_twice_is_idempotent(spark, rows, make):
    spec = make([("1", "a", "1"), ("2", "b", "2")], publish_mode="merge", merge_key="id")
    run_source(spark, spec)
    run_source(spark, spec)
    assert rows(spark.table(spec.silver_table), "id") == [(1,), (2,)]
    with pytest.raises(ConfigError):
        run_source(spark, make(publish_mode="merge", primary_key=""))
    with pytest.raises(ConfigError):
        run_source(spark, make(publish_mode="replace"))


def test_options_of_a_run(spark, make, new_name):
    archive = new_name("archive")
    spec = make(
        keep_dq_columns=False, archive_table=archive, archive_hours=24, zorder_by=["id"],
        before_landing=lambda df: df.withColumn("raw_name", __import__("pyspark").sql.functions.lit("x")),
        after_conformance=lambda df: df.withColumn("extra", df.id + 1),
    )
    run_source(spark, spec)
    assert spark.table(spec.silver_table).columns == ["id", "name", "amount", "extra"]
    assert spark.table(archive).count() == 5


def test_resume_does_not_read_again(spark, make, tables):
    spec = make()
    broken = flow.with_rules(spec, publish_mode="replace")
    run_source(spark, broken, tables, load_id="L", fail_fast=False)

    def refuse(_):
        raise AssertionError("read twice")

    again = run_source(spark, flow.with_rules(spec, read=refuse), tables, load_id="L", resume=True)
    assert again.status == "SUCCESS" and spark.table(spec.landing_table).count() == 5


def test_resume_does_not_publish_twice(spark, rows, make, tables, monkeypatch):
    spec = make()

    def lost(*_):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as patch:
        patch.setattr(flow.audit, "rule_summary", lost)
        failed = run_source(spark, spec, tables, load_id="L", fail_fast=False)
    assert failed.status == "FAILED" and spark.table(spec.silver_table).count() == 1
    again = run_source(spark, spec, tables, load_id="L", resume=True)
    assert again.status == "SUCCESS" and spark.table(spec.silver_table).count() == 1
    assert spark.table(spec.conformance_table).count() == 4


def test_scratch_is_removed(spark, make, monkeypatch):
    made = []
    real = flow.new_folder
    monkeypatch.setattr(flow, "new_folder", lambda s, label: made.append(real(s, label)) or made[-1])
    run_source(spark, make())
    import os

    assert made and not any(os.path.exists(p.removeprefix("file:")) for p in made)


def test_from_control_files(spark, rows, tmp_path, new_name):
    from stratiform.plans import control, spec as specs
    from stratiform.schemas import CONTROL_TABLES

    (tmp_path / "data").mkdir()
    (tmp_path / "data" / "x.csv").write_text("ID,NAME\n1,a\n2,\n2,b\n")
    head = "tenant,brand,product_name,source_system,source_entity"
    silver = new_name("silver")
    files = {
        "source_registry": head + ",source_type,source_format,source_path,load_type,landing_table,"
        "conformance_table,silver_table,primary_key,publish_mode,is_active,source_options_json\n"
        f"t,b,P,crm,acc,FILE,csv,{tmp_path}/data,full,{new_name('l')},{new_name('c')},{silver},id,append,true,"
        '"{""header"":true,""bronze_dq"":{""non_nullable_columns"":[""NAME""]}}"\n'
        "t,b,P,crm,off,FILE,csv,/x,full,a.b.c,a.b.c,a.b.c,id,append,false,\n",
        "column_mapping": head + ",conformance_column,transform_expression,is_active\n"
        "t,b,p,CRM,acc,id,cast(ID as int),true\nt,b,p,crm,acc,name,upper(NAME),true\n"
        "t,b,other,crm,acc,no,nope,true\n",
        "dq_rules": head + ",rule_name,rule_expression,severity,is_active\nt,b,p,crm,acc,short,length(name) < 5,high,true\n",
        "publish_rules": head + ",silver_table,publish_mode,merge_key\nt,b,p,crm,acc,x,merge,id\n",
    }
    for name, text in files.items():
        (tmp_path / f"{name}.csv").write_text(text)
    frames = [control.load(spark, n, str(tmp_path)) for n in CONTROL_TABLES]
    assert specs.from_control(spark, *frames, source_entity="none") == []
    [spec] = specs.from_control(spark, *frames, product_name="p")
    assert (spec.publish_mode, spec.merge_key, len(spec.mappings)) == ("merge", "id", 2)
    owners = spark.createDataFrame([("own", "cat", " ")], "publisher_name string, silver_catalog_name string, silver_db_name string")
    registry = frames[0].withColumn("publisher_name", F.lit("own"))
    [moved] = specs.from_control(spark, registry, *frames[1:], product_name="p", publishers=owners)
    assert moved.silver_table == "cat." + silver.split(".", 1)[1] and len(moved.rules) == 1
    report = run_all(spark, [spec])
    assert rows(report, "status", "rows_in", "valid_rows") == [("SUCCESS", 3, 2)]
    assert rows(spark.table(silver), "id", "name") == [(1, "A"), (2, "B")]

    from stratiform.__main__ import main

    assert main(["--config-dir", str(tmp_path)]) == 0
    assert main(["--config-dir", str(tmp_path), "--execute", "--product-name", "P"]) == 0


def test_streaming_source_from_control(spark, rows, tmp_path, new_name):
    from stratiform.plans import spec as specs

    data = tmp_path / "in" / "2024"
    data.mkdir(parents=True)
    (data / "a.json").write_text('[{"id": 1, "v": "a"},\n {"id": 2, "v": "b"}]')
    silver = new_name("silver")
    row = {
        "tenant": "t", "product_name": "p", "source_system": "crm", "source_entity": "mixed",
        "source_type": "FILE", "source_format": "json_jsonl_mixed", "source_path": str(tmp_path / "in"),
        "load_type": "incremental", "landing_table": new_name("l"), "conformance_table": new_name("c"),
        "silver_table": silver, "primary_key": "id", "publish_mode": "append",
        "source_options_json": '{"file_ingest_mode":"autoloader","pathGlobFilter":"*/*.json",'
        '"cloudFiles.schemaEvolutionMode":"addNewColumns","schema_ddl":"id int, v string"}',
    }
    mapping = [{"transform_expression": e, "conformance_column": e} for e in ("id", "v", "_source_id")]
    spec = specs.build(row, mapping, checkpoint_root=new_folder(spark, "state"))
    assert spec.checkpoint.endswith("/t/p/crm/mixed")
    assert rows(run_all(spark, [spec]), "status", "rows_in", "valid_rows") == [("SUCCESS", 2, 2)]
    (data / "b.json").write_text('{"id": 3, "v": "c"}\n{"id": 4, "v": "d"}\n')
    assert rows(run_all(spark, [spec]), "rows_in") == [(2,)]
    assert run_all(spark, [spec]).count() == 0
    assert rows(spark.table(silver), "id", "_source_id") == [(i, "crm.mixed") for i in (1, 2, 3, 4)]
    lost = specs.build(row, mapping)
    assert rows(run_all(spark, [lost]), "status") == [("FAILED",)]


def test_api_pages_source(spark, rows, new_name):
    from stratiform.plans import spec as specs

    pages, silver = new_name("pages"), new_name("silver")
    landing.write_table(
        spark.createDataFrame([('{"data":[{"id":1},{"id":2}]}',), ('[{"id":3}]',)], "body string"), pages)
    row = {
        "source_system": "web", "source_entity": "users", "source_type": "API", "api_endpoint": pages,
        "landing_table": new_name("l"), "conformance_table": new_name("c"), "silver_table": silver,
        "publish_mode": "append",
    }
    mapping = [{"transform_expression": "try_variant_get(record, '$.id', 'int')", "conformance_column": "id"}]
    run_source(spark, specs.build(row, mapping))
    assert rows(spark.table(silver), "id") == [(1,), (2,), (3,)]


def test_ansi_of_a_run(spark, rows, make):
    cast = [{"transform_expression": "cast(raw_amount as int)", "conformance_column": "id"}]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        run_source(spark, make(mappings=cast, rules=[], checks={}))
    spec = make(mappings=cast, rules=[], checks={}, primary_key="", ansi=False, optimize=True)
    run_source(spark, spec)
    assert rows(spark.table(spec.silver_table), "id") == [(-3,), (1,), (10,), (7,), (None,)]
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_run_all_reports_failures(spark, rows, make):
    good = make()
    bad = make(source_entity="bad", mappings=[{"transform_expression": "nope", "conformance_column": "a"}])
    report = run_all(spark, [good, bad])
    assert rows(report, "source", "status", "valid_rows") == [
        ("crm.bad", "FAILED", 0), ("crm.orders", "SUCCESS", 1)]
    with pytest.raises(Exception, match="nope"):
        run_all(spark, [bad], fail_fast=True)


def test_resume_point(spark, rows):
    events = [("r", 1, "SUCCESS", 1), ("r", 2, "FAILED", 2), ("r", 2, "CHECKPOINT_SAVED", 3),
              ("r", 3, "IN_PROGRESS", 4), ("q", 1, "FAILED", 5)]
    df = spark.createDataFrame(events, "run_id string, stage_sequence int, state string, event_ts int")
    points = resume.resume_point(df)
    assert rows(points) == [("q", 0, 1, 5), ("r", 2, 0, 4)]
    assert rows(resume.newest_runs(points, 1), "run_id") == [("q",)]


def _write(spark, path, data):
    spark.createDataFrame(data, RAW).coalesce(1).write.mode("append").json(path)


def test_stream_takes_each_file_once(spark, rows, new_name):
    path, state, table = new_folder(spark, "in"), new_folder(spark, "state"), new_name("landed")

    def go():
        frame = streams.read_stream(spark, path, "json", "crm", "orders", {"metadata_source_name": "m"}, RAW)
        streams.land_stream(frame, table, state, "crm", "orders", "L")

    _write(spark, path, DATA[:2])
    go()
    go()
    assert spark.table(table).count() == 2
    _write(spark, path, DATA[2:])
    go()
    landed = spark.table(table)
    assert landed.count() == 5
    assert set(schemas.STREAM_COLUMNS + schemas.LANDING_COLUMNS) <= set(landed.columns)
    first = landed.first()
    assert first._source_id == "crm.orders" and first._metadata_source_name == "m"
    assert first._source_file.startswith("file:") and first._source_format == "json"
    assert rows(landed, *[c.split()[0] for c in RAW.split(", ")]) == sorted(DATA, key=repr)


def test_stream_rescue(spark):
    path, state = new_folder(spark, "in"), new_folder(spark, "state")
    _write(spark, path, DATA[:1])
    given = {"cloudFiles.schemaEvolutionMode": "rescue", "add_metadata_columns": False}
    frame = streams.read_stream(spark, path, "json", "crm", "orders", given, "raw_id string")
    assert frame.columns == ["raw_id", "_rescued_data"]
    got = []
    frame.writeStream.foreachBatch(lambda df, _: got.extend(df.collect())).option(
        "checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    assert got[0].raw_id == "1" and "raw_amount" in got[0]._rescued_data


def test_stream_learns_new_columns(spark, rows, new_name):
    """Two starts: the second file has a key more, which the stored table then has as well."""
    path, state, known, name = (new_folder(spark, x) for x in ("in", "state", "schema", "t"))
    name = new_name("evolved")
    for text in ('{"a": "1"}', '{"a": "2", "b": "x", "c": {"d": 1}}', '{"a": "3"}'):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("append").text(path)
        frame = streams.read_stream(spark, path, "json", "s", "e", {"add_metadata_columns": False}, "a string", known)
        streams.land_stream(frame, name, state, "s", "e", "L")
    assert rows(spark.table(name), "a", "b", "c") == [("1", None, None), ("2", "x", '{"d":1}'), ("3", None, None)]
    narrow = streams.read_stream(spark, path, "json", "s", "e", {"add_metadata_columns": False}, "a string, z int", known)
    streams.land_stream(narrow, name, new_folder(spark, "state"), "s", "e", "L", {"mergeSchema": "false"})
    assert "z" not in spark.table(name).columns


def test_whole_flow_per_batch(spark, rows, make, tables):
    path, state = new_folder(spark, "in"), new_folder(spark, "state")
    spec = make(publish_mode="merge", merge_key="id")
    seen = []

    def go():
        frame = streams.read_stream(
            spark, path, "json", "crm", "orders",
            {"cloudFiles.maxFilesPerTrigger": 1, "add_metadata_columns": False}, RAW)
        streams.run_stream(frame, spec, state, tables, on_result=seen.append)

    _write(spark, path, [("1", "a", "1")])
    _write(spark, path, [("2", "b", "2")])
    go()
    go()
    assert [r.status for r in seen] == ["SUCCESS", "SUCCESS"]
    _write(spark, path, [("1", "z", "9")])
    go()
    assert rows(spark.table(spec.silver_table), "id", "name") == [(1, "Z"), (2, "B")]
    # A batch that runs again is recognised by its load id.
    assert spark.table(tables.pipeline_runs).count() == 3


def test_alerts_metrics_and_watermark_of_a_run(spark, rows, make, tables):
    spec = make(product="shop", watermark_column="raw_id")
    assert flow.last_watermark(spark, tables, "crm", "orders") is None
    run_source(spark, spec, tables, load_id="L1")
    assert rows(spark.table(tables.alerts), "load_id", "alert_type", "severity", "product_name") == [
        ("L1", "DQ_FAILURE_RATE", "CRITICAL", "shop")]
    metric = spark.table(tables.performance_metrics).first()
    assert (metric.query_name, metric.rows_processed) == ("crm.orders:L1", 5) and metric.bytes_processed > 0
    assert flow.last_watermark(spark, tables, "crm", "orders", product="shop") == "4"
    assert flow.last_watermark(spark, tables, "crm", "orders") is None
    assert flow.last_watermark(spark, tables, "crm", "orders", "north", "shop") is None
    run_source(spark, spec, tables, load_id="L1", resume=True)
    assert spark.table(tables.alerts).count() == 1 and spark.table(tables.performance_metrics).count() == 1


def test_archive_retention_of_a_run(spark, make, tables, new_name):
    spec = make(archive_table=new_name("archive"), archive_hours=1)
    run_source(spark, spec, tables, load_id="old")
    run_source(spark, flow.with_rules(spec, as_of="2100-01-01 00:00:00"), tables, load_id="new")
    assert spark.table(spec.archive_table).count() == 0


def test_merge_clusters_and_flags_deleted_keys(spark, rows, make):
    spec = make([("1", "a", "1"), ("2", "b", "2")], publish_mode="merge", merge_key="id", zorder_by=["name"])
    run_source(spark, spec)
    gone = flow.with_rules(
        spec, read=lambda s: s.createDataFrame([("2", "b", "9")], RAW), soft_delete="amount = 9", keep_dq_columns=False
    )
    run_source(spark, gone)
    assert rows(spark.table(spec.silver_table), "id", "is_deleted") == [(1, None), (2, True)]


def test_new_checkpoint_takes_all_files_again(spark, make, tables):
    """Another query's finished batches do not count, though they have the same numbers."""
    path = new_folder(spark, "in")
    spec = make()
    _write(spark, path, [("1", "a", "1")])
    for _ in range(2):
        frame = streams.read_stream(spark, path, "json", "crm", "orders", {"add_metadata_columns": False}, RAW)
        streams.run_stream(frame, spec, new_folder(spark, "state"), tables)
    assert spark.table(spec.silver_table).count() == 2


def test_products_with_one_entity_keep_their_batches(spark, rows, make, tables):
    for product in ("p1", "p2"):
        path = new_folder(spark, "in")
        spec = make(product=product)
        _write(spark, path, [("1", product, "1")])
        frame = streams.read_stream(spark, path, "json", "crm", "orders", {"add_metadata_columns": False}, RAW)
        streams.run_stream(frame, spec, new_folder(spark, "state"), tables)
        assert rows(spark.table(spec.silver_table), "name") == [(product.upper(),)]


def test_finished_batch_of_one_checkpoint_is_skipped(spark, make, tables, monkeypatch):
    """The run was stored, but the query died before it could note the batch as done."""
    path, state = new_folder(spark, "in"), new_folder(spark, "state")
    spec = make()
    _write(spark, path, [("1", "a", "1")])

    def once():
        frame = streams.read_stream(spark, path, "json", "crm", "orders", {"add_metadata_columns": False}, RAW)
        streams.run_stream(frame, spec, state, tables, on_result=seen)

    def seen(_):
        raise RuntimeError("driver lost")

    with pytest.raises(Exception):
        once()
    seen = lambda _: None
    once()
    assert spark.table(spec.silver_table).count() == 1
    assert spark.table(tables.pipeline_runs).filter("status = 'SUCCESS'").count() == 1


STAGES = ["conform.apply", "rules.apply", "landing.archive", "publish.append", "after append", "audit.check_rows",
          "audit.rule_summary", "audit.rejects", "_Log.finish"]


@pytest.mark.parametrize("stage", STAGES)
def test_resume_after_a_failure_at_any_stage(spark, rows, make, tables, new_name, monkeypatch, stage):
    """Every table holds the load once, as if the first attempt had come through."""
    spec = make(archive_table=new_name("archive"))

    def lost(*_, **__):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as patch:
        if stage == "after append":
            append = flow.publish.append
            patch.setattr(flow.publish, "append", lambda *a, **b: (append(*a, **b), lost()))
        else:
            owner, name = stage.split(".")
            finish = flow._Log.finish
            failing = lost if stage != "_Log.finish" else lambda self, status, *a: lost() if status == "SUCCESS" else finish(self, status, *a)
            patch.setattr(getattr(flow, owner), name, failing)
        assert run_source(spark, spec, tables, load_id="L", resume=True, fail_fast=False).status == "FAILED"
        second = run_source(spark, spec, tables, load_id="L", resume=True, fail_fast=False).status
        assert second == ("SUCCESS" if stage == "after append" else "FAILED")  # what is there is not appended again
    again = run_source(spark, spec, tables, load_id="L", resume=True)
    assert again.status == "SUCCESS" and (again.rows_in, again.valid_rows, again.reject_rows) == (5, 1, 3)
    counts = {"landing": spec.landing_table, "archive": spec.archive_table, "conformed": spec.conformance_table,
              "silver": spec.silver_table, "rejects": tables.rejects, "checks": tables.bronze_dq_results,
              "rules": tables.dq_rule_results}
    got = {k: spark.table(v).count() for k, v in counts.items()}
    assert got == {"landing": 5, "archive": 5, "conformed": 4, "silver": 1, "rejects": 3, "checks": 6, "rules": 3}
    assert rows(spark.table(tables.pipeline_runs).filter("status = 'SUCCESS'"), "rows_in", "rows_out") == [(5, 1)]
    events = spark.table(tables.validation_events).filter("event_name = 'verification_summary' and event_status = 'PASS'")
    assert not events.isEmpty()


def test_stream_options():
    made = streams.stream_options({"cloudFiles.maxFilesPerTrigger": 5, "header": True,
                                   "schema_ddl": "a string", "cloudFiles.schemaHints": "a int, b date"})
    assert made.reader == {"header": "true", "maxFilesPerTrigger": "5"}
    assert made.schema_ddl == "`a` int, `b` date"
    assert made.available_now and not made.once and made.merge_schema
    once = streams.stream_options({"trigger_once": True})
    assert once.once and not once.available_now
    assert "modifiedAfter" in streams.stream_options({"cloudFiles.includeExistingFiles": "false"}).reader
    for wrong in ({"cloudFiles.useNotifications": True}, {"nope": 1}, {"outputMode": "x"},
                  {"trigger_once": True, "trigger_available_now": True},
                  {"cloudFiles.schemaEvolutionMode": "x"}):
        with pytest.raises(ConfigError):
            streams.stream_options(wrong)


def test_landing_table_name_is_checked(spark, make):
    with pytest.raises(ConfigError):
        run_source(spark, make(landing_table="t"))
    assert landing.checked_table("a.b.c") == "a.b.c"


def test_marks_of_two_products(spark, make, tables, new_name):
    seen = []
    for product in ("shop", "mall"):
        for data in (DATA[:3], DATA):
            mark = flow.last_watermark(spark, tables, "crm", "orders", product=product)
            new = [r for r in data if mark is None or r[0] > mark]
            spec = make(new, product=product, watermark_column="raw_id", publish_mode="append")
            run_source(spark, spec, tables, load_id=f"{product}-{len(data)}")
            seen.append((product, mark, len(new)))
    assert seen == [("shop", None, 3), ("shop", "3", 2), ("mall", None, 3), ("mall", "3", 2)]


def test_mixed_json_keeps_its_bad_text_in_control_runs(spark, rows, tables, new_name, tmp_path):
    from stratiform.plans import spec as specs

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('[{"id":1},\n{"id":2}]\n')
    (tmp_path / "in" / "b.json").write_text('{"id":3}\nno json\n{"id":\n4}')
    row = {
        "source_system": "crm", "source_entity": "notes", "source_type": "FILE", "source_format": "json_jsonl_mixed",
        "source_path": str(tmp_path / "in"), "load_type": "full", "publish_mode": "append",
        **{k: new_name(k) for k in ("landing_table", "conformance_table", "silver_table")},
    }
    expected = sorted([(1, None), (2, None), (3, None), (4, None), (None, "no json")], key=repr)
    for mode in ("batch", "autoloader"):
        options = f'{{"schema_ddl": "id int", "file_ingest_mode": "{mode}"}}'
        names = {k: new_name(k) for k in ("landing_table", "conformance_table", "silver_table")}
        spec = specs.build(row | names | {"source_options_json": options}, checkpoint_root=str(tmp_path / f"state-{mode}"))
        report = run_all(spark, [spec], tables, fail_fast=True)
        assert [r.status for r in report.collect()] == ["SUCCESS"]
        assert rows(spark.table(spec.silver_table), "id", "_corrupt_record") == expected


def test_update_and_complete_need_what_they_need(spark, new_name):
    path = new_folder(spark, "in")
    _write(spark, path, DATA[:2])
    frame = streams.read_stream(spark, path, "json", "crm", "orders", {"add_metadata_columns": False}, RAW)
    with pytest.raises(ConfigError):
        streams.land_stream(frame.groupBy("raw_id").count(), new_name("t"), new_folder(spark, "s"), "crm", "o", "L", {"outputMode": "update"})
