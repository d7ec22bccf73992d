import hashlib
import itertools
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from stratiform.errors import ConfigError
from stratiform.plans import spec as specs
from stratiform.queries import queries
from stratiform.session import new_folder
from stratiform.sources import files, jdbc, options, payload, rescue, stores


def test_formats():
    assert options.resolve_format("JSONL", options.BATCH_FORMATS) == "jsonl"
    assert options.resolve_format("", options.BATCH_FORMATS) == "binaryfile"
    assert options.BATCH_FORMATS[options.resolve_format(None, options.BATCH_FORMATS)] == "binaryFile"
    assert options.STREAM_FORMATS[options.resolve_format("xlsx", options.STREAM_FORMATS)] == "binaryFile"
    with pytest.raises(ConfigError):
        options.resolve_format("delta", options.BATCH_FORMATS)


def test_reader_options():
    assert options.chosen({"header": True, "sep": None, "x": 1}, options.READER_OPTIONS) == {"header": "true"}
    with pytest.raises(ConfigError):
        options.spark_text([1])
    flow, rest = options.by_consumer({"bronze_dq": {"volume": {}}, "header": True})
    assert flow == {"bronze_dq": {"volume": {}}} and rest == {"header": True}


def test_file_reader_refuses(spark):
    for bad in (
        {"path": ""},
        {"path": "/tmp", "fmt": "json", "options": {"nope": 1}},
        {"path": "/tmp", "fmt": "json", "load_type": "sometimes"},
    ):
        with pytest.raises(ConfigError):
            files.read_files(spark, **bad)


def test_directory_glob_moves_into_the_path():
    given = {"pathGlobFilter": "*/2024/*.json"}
    assert files.glob_into_path("/data", given) == "/data/*/2024/*.json" and given == {}
    given = {"pathGlobFilter": "*.json"}
    assert files.glob_into_path("/data", given) == "/data" and given


def test_binary_and_xml(spark):
    path = new_folder(spark, "bin")
    spark.createDataFrame([("<r><row><a>1</a></row></r>",)], "value string").write.text(path)
    raw = files.read_files(spark, path, "json_jsonl_mixed", load_type="full")
    assert raw.columns == ["path", "modificationTime", "length", "content"]
    profile = files.file_profile(files.listing(spark, path)).first()
    assert profile.file_count == raw.count() and profile.total_bytes > 0
    assert files.raw_sample(files.listing(spark, path), 1).count() == 1


def test_incremental_bound_is_strict(spark):
    path = new_folder(spark, "inc")
    spark.range(3).write.json(path)
    newest = files.listing(spark, path).selectExpr("cast(max(modificationTime) as string)").first()[0]
    schema = "id bigint"
    assert files.read_files(spark, path, "json", since=newest, schema=schema).count() == 0
    assert files.read_files(spark, path, "json", since="2000-01-01", schema=schema).count() == 3
    assert files.read_files(spark, path, "json", load_type="full", since=newest, schema=schema).count() == 3


def test_fixed_width(spark, rows):
    lines = spark.createDataFrame([("0012abc  ",), ("00x3de",)], "value string")
    cut = files.fixed_width(lines, [("n", 1, 4, "int"), ("t", 5, 5, "string")])
    assert rows(cut) == [(12, "abc"), (None, "de")]


def test_mixed_json_files(spark, rows, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": 1},\n {"a": 2}]\n')
    (tmp_path / "b.json").write_text('{"a": 3}\n\n{"a": 4}\nbroken\n')
    (tmp_path / "c.json").write_text('﻿{\n "a": 5\n}')
    (tmp_path / "d.json").write_text("[]")
    assert rows(files.read_mixed_json(spark, str(tmp_path), "a int")) == [
        (1,), (2,), (3,), (4,), (5,), (None,)]


def test_layout(spark, rows):
    paths = ["/r/x/1.snappy.parquet", "/r/x/_delta_log/0.json", "/r/y/1.parquet", "/r/y/2.csv"]
    folders = files.layout(spark.createDataFrame([(p,) for p in paths], "path string"))
    assert rows(folders) == [("/r/x", 2, 1, 1, 1), ("/r/y", 2, 1, 0, 0)]
    summary = files.layout_summary(folders, 2).first()
    assert tuple(summary) == (2, 1, False, True)


def test_attachments(spark, rows, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    (source / "a.txt").write_bytes(b"A")
    (source / "b.txt").write_bytes(b"B")
    here, gone = str(source / "a.txt"), str(source / "none.txt")
    df = spark.createDataFrame([(here,), (here,), (gone,), (None,), (" ",)], "f string")
    refs = files.attachment_refs(df, "f")
    assert rows(refs) == sorted([(here,), (gone,)])
    scan = spark.read.format("binaryFile").load(str(source))
    done = {r.ref: r for r in files.copy_attachments(refs, scan, str(target)).collect()}
    assert open(done[here].new_path, "rb").read() == b"A"
    assert done[gone].new_path is None and "not found" in done[gone].error
    assert len(os.listdir(target)) == 1
    with pytest.raises(Exception, match="not found"):
        files.copy_attachments(refs, scan, str(target), fail_on_error=True).collect()
    with pytest.raises(ConfigError):
        files.attachment_refs(df, "nope")


def test_large_attachments_are_copied_in_chunks(spark, tmp_path, monkeypatch):
    source, target = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    sizes = {"a b%20.bin": 5_000_000, "c.bin": 1, "d.bin": 700_001}
    for name, size in sizes.items():
        (source / name).write_bytes(os.urandom(size))
    monkeypatch.setattr(files, "COPY_BYTES", 1_000_000)
    monkeypatch.setattr(files, "COPY_CHUNK", 4096)
    refs = spark.createDataFrame([(str(source / n),) for n in (*sizes, "none.bin")], "ref string")
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1000")
    try:
        frame = files.copy_attachments(refs, files.listing(spark, str(source)), str(target))
        assert "content" not in files.listing(spark, str(source)).columns
        done = {os.path.basename(r.ref): r for r in frame.collect()}
        assert not [r.error for n, r in done.items() if r.error and n != "none.bin"]
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    for name in sizes:
        assert open(done[name].new_path, "rb").read() == (source / name).read_bytes()
    assert "not found" in done["none.bin"].error and len(os.listdir(target)) == 3


def test_attachments_of_a_cluster_go_to_the_shared_folder(spark, tmp_path, monkeypatch):
    (tmp_path / "a.txt").write_bytes(b"A")
    refs = spark.createDataFrame([(str(tmp_path / "a.txt"),)], "ref string")
    scan = spark.read.format("binaryFile").load(str(tmp_path / "a.txt"))
    target = f"file://{new_folder(spark, 'copied').removeprefix('file:')}"
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    done = files.copy_attachments(refs, scan, target).first()
    assert spark.read.format("binaryFile").load(done.new_path).first().content == b"A"
    for elsewhere in (str(tmp_path / "out"), f"file://{tmp_path}/out", f"{target}/../../../out"):
        with pytest.raises(ConfigError, match="do not share"):
            files.copy_attachments(refs, scan, elsewhere)


def test_attachments_of_one_name_do_not_meet(spark, tmp_path):
    seen = {}
    for n in itertools.count():  # two paths whose hashes begin alike
        path = f"{tmp_path}/{n}/a.txt"
        other = seen.setdefault(hashlib.sha256(path.encode()).hexdigest()[:8], path)
        if other != path:
            break
    for name in (path, other):
        os.makedirs(os.path.dirname(name))
        with open(name, "w") as out:
            out.write(name)
    refs = spark.createDataFrame([(path,), (other,)], "ref string")
    scan = spark.read.format("binaryFile").load([path, other])
    done = files.copy_attachments(refs, scan, str(tmp_path / "out")).collect()
    assert [open(r.new_path).read() for r in done] == [r.ref for r in done] and len(done) == 2


def test_many_small_attachments_are_dealt_to_tasks(spark, tmp_path, monkeypatch):
    source, target = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    for n in range(60):
        (source / f"{n}.txt").write_text(str(n))
    monkeypatch.setattr(files, "COPY_FILES", 5)
    held = stores.listing(spark, str(source))
    refs = held.selectExpr("regexp_replace(path, '^file:/+', '/') AS ref")
    done = files.copy_attachments(refs, held, str(target)).withColumn("task", F.spark_partition_id()).collect()
    assert len({r.task for r in done}) > 6
    assert sorted(open(r.new_path).read() for r in done) == sorted(str(n) for n in range(60))


def test_tasks_list_folders_as_spark_does(spark, rows, tmp_path, monkeypatch):
    names = [
        "a.txt", "b c%20+.txt", "empty", ".hidden", "_hidden", "_k=1", "_metadata", "x._COPYING_", "d/é.txt", "d/e/f.txt", "d/e/g.txt", "d/e/h.txt",
        "k=1/a", "_k=2/b", ".h/a", "_h/a", "_metadata.d/a", "y._COPYING_/a", "none/empty",
    ]
    for name in names:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("" if name.endswith("empty") else name)
    (tmp_path / "gone").symlink_to(tmp_path / "nothing")
    monkeypatch.setattr(stores, "BATCH_ROWS", 2)
    held = stores.listing(spark, str(tmp_path))
    usual = files.listing(spark, str(tmp_path))
    assert held.dtypes == usual.dtypes and rows(held) == rows(usual)
    assert held.count() > 6 and not any(p.startswith(f"file://{tmp_path}") for p in held.inputFiles())


def test_contents_are_read_by_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stores, "BATCH_BYTES", 3)
    for n in range(5):
        (tmp_path / f"{n} %").write_bytes(bytes([n]) * n)
    named = [(n, f"{how}{tmp_path}/{n} %") for n in range(5) for how in ("", "file:", "file://")]
    frame = spark.createDataFrame([*named, (8, None), (9, f"{tmp_path}/none")], "n int, path string").coalesce(1)
    found = stores.with_contents(frame, "path")
    assert found.columns == ["n", "path", "content"]
    expected = sorted([(n, bytes([n]) * n) for n, _ in named] + [(8, None), (9, None)], key=repr)
    assert sorted(((r.n, r.content if r.content is None else bytes(r.content)) for r in found.collect()), key=repr) == expected


def test_copied_pages_have_no_entry_in_the_driver(spark, rows, tmp_path):
    ids = [*range(40), 3, 20]  # repeated pages have files of their own
    spark.createDataFrame([(n,) for n in ids], "page_id bigint").write.parquet(str(tmp_path / "pages.parquet"))
    done = queries()["attachment_copy"](spark, str(tmp_path))
    assert rows(done) == sorted([(f"page {n}", True) for n in ids] + [(None, False)] * 4, key=repr)
    assert not any(p.endswith(".txt") for p in done.inputFiles())


PROFILE = {"url": "jdbc:x:y", "driver": "org.x.Driver", "fetchsize": 100}


def test_jdbc_options(monkeypatch):
    monkeypatch.setenv("T_USER", "u")
    monkeypatch.setenv("T_PASS", "")
    made = jdbc.jdbc_options(
        {**PROFILE, "user_env": "T_USER", "password_env": "T_PASS"}, "dbo.t",
        {"numPartitions": 4, "partitionColumn": "id", "lowerBound": 0, "upperBound": 9,
         "pushDownLimit": True},
    )
    assert made == {
        "url": "jdbc:x:y", "driver": "org.x.Driver", "fetchsize": "100", "dbtable": "dbo.t", "user": "u",
        "numPartitions": "4", "partitionColumn": "id", "lowerBound": "0", "upperBound": "9",
        "pushDownLimit": "true"}
    by_query = jdbc.jdbc_options(PROFILE, "dbo.t", {"query": "select 1"})
    assert by_query["query"] == "select 1" and "dbtable" not in by_query


@pytest.mark.parametrize(
    "profile, table, given",
    [
        ({}, "t", {}),
        ({**PROFILE, "fetchsize": -1}, "t", {}),
        (PROFILE, "", {}),
        (PROFILE, "t", {"numPartitions": 4}),
        (PROFILE, "t", {"numPartitions": 0, "partitionColumn": "i", "lowerBound": 0, "upperBound": 1}),
        (PROFILE, "t", {"nope": 1}),
    ],
)
def test_jdbc_refuses(profile, table, given):
    with pytest.raises(ConfigError):
        jdbc.jdbc_options(profile, table, given)


def test_watermark(spark, rows):
    df = spark.createDataFrame([("a'b",), ("a'c",)], "w string")
    assert rows(jdbc.beyond(df, "w", "a'b")) == [("a'c",)]
    assert jdbc.beyond(df, "w", "").count() == 2
    assert jdbc.next_watermark(df, "w").first()[0] == "a'c"
    with pytest.raises(ConfigError):
        jdbc.beyond(df, "w; drop", 1)


def _records(spark, bodies, envelope=None):
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    out = payload.explode_records(df, "body", envelope)
    return [
        (r.pos, None if r.record is None else json.loads(r.record.toJson()), r.payload_error)
        for r in out.collect()
    ]


@pytest.mark.parametrize(
    "body, expected",
    [
        ('[{"a":1},{"a":2}]', [{"a": 1}, {"a": 2}]),
        ('[1,{"a":2}]', [{"value": 1}, {"value": {"a": 2}}]),
        ('{"data":[{"a":1}]}', [{"a": 1}]),
        ('{"data":{"x":1},"items":[{"a":1}]}', [{"a": 1}]),
        ('{"value":["x"]}', [{"value": "x"}]),
        ('{"a":1}', [{"a": 1}]),
        ("[]", []),
        ('{"data":[]}', []),
        ("5", []),
        ('{"data":null,"items":[{"a":1}]}', [{"a": 1}]),
        ("[null]", [{"value": None}]),
    ],
)
def test_payload_shapes(spark, body, expected):
    assert [r for _, r, _ in _records(spark, [body])] == expected


@pytest.mark.parametrize(
    "body, expected",
    [
        ('{"a":{"b":[{"x":1}]}}', [{"x": 1}]),
        ('{"a":{"b":[1,2]}}', [{"value": 1}, {"value": 2}]),
        ('{"a":{"b":{"x":1}}}', [{"x": 1}]),
        ('{"a":{"b":7}}', [{"value": 7}]),
    ],
)
def test_payload_envelope(spark, body, expected):
    assert [r for _, r, _ in _records(spark, [body], "a.b")] == expected


def test_payload_errors(spark):
    assert _records(spark, ["nope"])[0][2] == "body is not JSON"
    for body in ('{"a":1}', '{"a":{"b":null}}'):
        assert "not found" in _records(spark, [body], "a.b")[0][2]


def test_pages(spark, rows):
    pages = [("s", 0, 2, "t1"), ("s", 2, 2, "t2"), ("s", 5, 1, "t1"), ("s", 6, 0, None),
             ("u", 10, 1, "t1"), ("v", 0, 0, None)]
    df = spark.createDataFrame(pages, "source string, at int, n int, token string")
    report = payload.check_pages(df, "source", "at", "n", "token")
    assert rows(report) == [("s", 4, 5, 1, 6, 1), ("u", 1, 1, 0, None, 0), ("v", 1, 0, 0, 0, 0)]


LINES = ['{"a":1}', '{"a":2,"b":"x","c":{"d":1}}', "broken"]


def _lines(spark):
    return spark.createDataFrame([(v,) for v in LINES], "value string")


def test_rescue_modes(spark, rows):
    none = rescue.parse_lines(_lines(spark), "value", "a int")
    assert rows(none) == [(1,), (2,), (None,)]
    kept = {r.a: r._rescued_data for r in rescue.parse_lines(_lines(spark), "value", "a int", "rescue").collect()}
    assert kept[1] is None and json.loads(kept[2]) == {"b": "x", "c": '{"d":1}'}
    with pytest.raises(Exception, match="unknown columns: b,c"):
        rescue.parse_lines(_lines(spark), "value", "a int", "failOnNewColumns").collect()
    wide = rescue.widened_schema(_lines(spark), "value", "a int")
    assert wide.fieldNames() == ["a", "b", "c"]
    with pytest.raises(ConfigError):
        rescue.parse_lines(_lines(spark), "value", "a int", "other")


def test_widening_is_bounded_on_request(spark):
    with pytest.raises(ConfigError):
        rescue.widened_schema(_lines(spark), "value", "a int", most=1)


def test_rescue_keeps_what_does_not_fit(spark):
    lines = ['{"a": "abc", "b": 1}', "broken {", '{"a": null}', "", '{"a": 3}', "[1]"]
    frame = spark.createDataFrame([(i, text) for i, text in enumerate(lines)], "n int, value string")
    got = {r.n: (r.a, r._rescued_data) for r in rescue.parse_lines(frame, "value", "a int", "rescue").collect()}
    assert json.loads(got[0][1]) == {"a": "abc", "b": "1"} and got[0][0] is None
    assert got[1] == (None, "broken {") and got[5] == (None, "[1]")
    assert got[2] == got[3] == (None, None) and got[4] == (3, None)


SHAPES = {
    "a": 'not json\n{"a":1}\n{"a":2}\n', "b": '[{"a":3}]\n[{"a":4},{"a":5}]\n', "c": '{\n "a": 6\n}\n{\n "a": 7\n}\n',
    "d": '\ufeff[\n{"a":8},\n{"a":9}\n]', "e": '\ufeff{"a":10}\n\n{"a":11}\r\n{"a":', "f": "", "g": '{"a":12}',
    "h": '[{"a":13},{"a":14}]', "i": '{"a": 15,\n "b": {"c":\n 1}}\n{"a": 16,\n"b":2}', "j": '{"a":\n17}',
    "k": '{"a":18}{"a":19}\n', "l": '1\n"x"\nnull\n{"a":20}\n', "m": '{"a":7\n{"a":8\n{"a":21}', "n": '[{"a":22},{"a":23},{"a"',
    "o": '{"a":24,"s":"}{\\"}[\\\\"}\n{"a":25,"s":"open\n{"a":26}\n', "p": '{"a":9,\n{"a":27}\n{"a":28}\n', "q": "[]", "r": '[1, {"a":29}, "t"]',
    "s": '{"a":30} rest\n{"a":"é}"}', "t": '{"a":\n{"a":31}\n{"a":32}\n',
}
BAD = [
    "not json", '{"a":', "1", '"x"', "null", '{"a":7', '{"a":8', '{"a"', '{"a":25,"s":"open', '{"a":9,', "1", '"t"', "rest", '{"a":',
]


def _expected():
    return sorted([*[(n, None) for n in range(1, 33) if n != 25], (None, None), *[(None, t) for t in BAD]], key=repr)


def test_mixed_json_loses_nothing(spark, rows, tmp_path):
    for name, text in SHAPES.items():
        (tmp_path / f"{name}.json").write_text(text)
    assert rows(files.read_mixed_json(spark, str(tmp_path), "a int", bad="bad")) == _expected()
    bodies = spark.createDataFrame([(v,) for v in SHAPES.values()], "body string")
    assert rows(files.mixed_records(bodies, "body", "a int", bad="bad")) == _expected()


@pytest.mark.parametrize("size", ["7b", "16b", "61b"])
def test_mixed_json_in_tiny_splits(spark, rows, tmp_path, size):
    for name, text in SHAPES.items():
        (tmp_path / f"{name}.json").write_text(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert rows(files.read_mixed_json(spark, str(tmp_path), "a int", bad="bad")) == _expected()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_json_is_read_in_splits(spark, tmp_path):
    """An array on one line, objects over lines, and lines, each of several splits; no split reads much more than its bytes."""
    pad = "x" * 90
    (tmp_path / "array.json").write_text("[" + ",".join(f'{{"a": {n}, "b": {{"c": "{pad}}}"}}}}' for n in range(20_000)) + "]")
    (tmp_path / "lines.json").write_text("".join(f'{{"a": {n}, "pad": "{pad}"}}\n' for n in range(20_000)))
    (tmp_path / "long.json").write_text("".join(f'{{\n "a": {n},\n "b": [{{"c": "{pad}"}},\n {{"c": "{pad}"}}]\n}}\n' for n in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300k")
    try:
        frame = files.read_mixed_json(spark, str(tmp_path), "a int", bad="bad")
        assert frame.rdd.getNumPartitions() > 20
        assert frame.where("bad IS NOT NULL").count() == 0
        assert {r["count"] for r in frame.groupBy("a").count().collect()} == {3} and frame.count() == 60_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_values_beyond_the_bound_go_line_by_line(spark, rows, tmp_path):
    (tmp_path / "x.json").write_text('{"a": 1}\n{"a": 2,\n"b": [\n' + "1,\n" * 300 + '{"a": 3}\n')
    frame = files.read_mixed_json(spark, str(tmp_path), "a int", bad="bad", max_value=200)
    assert rows(frame.where("a IS NOT NULL"), "a") == [(1,), (3,)]
    assert frame.where("bad = '1,'").count() == 300  # a text that cannot be parsed stays as it is


def test_no_json_file_has_to_fit_a_row(spark, tmp_path):
    (tmp_path / "x.json").write_text("".join(f'{{"a": {n}}}\n' for n in range(2000)))
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "100")
    try:
        assert files.read_mixed_json(spark, str(tmp_path), "a int").count() == 2000
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")


def test_fixed_width_files(spark, rows, tmp_path):
    (tmp_path / "f.txt").write_text("0012abc  \n00x3de\n")
    schema = "n int COMMENT '1:4', t string COMMENT '5:5'"
    assert rows(files.read_files(spark, str(tmp_path), "fixed-width", schema=schema)) == [(12, "abc"), (None, "de")]
    with pytest.raises(ConfigError):
        files.read_files(spark, str(tmp_path), "fixed_width", schema="n int")


def test_substitution():
    values = {"A": "x", "C": "z"}
    assert specs.substitute("${A}/${B:y}/${B}", values) == "x/y/"
    assert specs.substitute("${B:${C:q}}", values) == "z"
    assert specs.substitute("${B:s3://b/p}", {}) == "s3://b/p"


def test_json_cells():
    assert specs.json_object('{"a":1}') == {"a": 1}
    assert specs.json_object("[1]") == specs.json_object("{") == specs.json_object(None) == {}
    assert specs.json_list('["a",""]') == ["a"] and specs.json_list("{}") == specs.json_list("x") == []


ROW = {
    "source_system": "crm", "source_entity": "accounts", "source_type": "FILE", "source_format": "csv",
    "source_path": "/data", "load_type": "full", "landing_table": "${CAT:main}.b.l",
    "conformance_table": "main.b.c", "silver_table": "main.s.t", "primary_key": "id",
    "publish_mode": "append",
    "source_options_json": '{"header":true,"bronze_dq":{"volume":{"min_rows":1}},"archive_table":"main.b.a",'
    '"archive_retention_days":2}',
}


def test_spec_from_control_rows():
    rule = {"publish_mode": "merge", "merge_key": "id", "partition_columns_json": '["d"]',
            "optimize_zorder_json": "bad"}
    built = specs.build(ROW, [{"x": 1}], [], rule)
    assert built.landing_table == "main.b.l" and built.checks == {"volume": {"min_rows": 1}}
    assert (built.publish_mode, built.merge_key, built.partition_by, built.zorder_by) == (
        "merge", "id", ["d"], [])
    assert (built.archive_table, built.archive_hours) == ("main.b.a", 48)
    for change in ({"source_type": "FTP"}, {"silver_table": ""}, {"source_type": "JDBC"},
                   {"silver_table_type": "external", "silver_table_path": "/mnt/x"}):
        with pytest.raises(ConfigError):
            specs.build({**ROW, **change})


def test_spec_reads_files(spark, tmp_path):
    (tmp_path / "x.csv").write_text("id,v\n1,a\n")
    built = specs.build({**ROW, "source_path": str(tmp_path)})
    assert built.read(spark).columns == ["id", "v"]
    custom = specs.build({**ROW, "source_type": "custom"}, custom={"accounts": lambda s: s.range(3)})
    assert custom.read(spark).count() == 3


def test_new_file_modified_later_only(spark):
    path = new_folder(spark, "later")
    spark.range(2).write.json(path)
    seen = files.listing(spark, path).selectExpr("cast(max(modificationTime) as string)").first()[0]
    time.sleep(0.05)
    spark.range(10, 13).write.mode("append").json(path)
    assert files.read_files(spark, path, "json", since=seen, schema="id bigint").count() == 3
