import pytest

from stratiform.errors import ConfigError, DuplicateKeyError
from stratiform.operators import cluster, export, landing, publish, table_files
from stratiform.session import new_folder

ORDER = "order_id string, customer_id string, amount double, status string"


def test_landing_metadata(spark):
    df = spark.createDataFrame([("1", "n", 5)], "customer_id string, name string, age bigint")
    row = landing.add_metadata(df, " crm ", "customers", "load").first()
    assert (row.source_system, row.source_entity, row.load_id) == ("crm", "customers", "load")
    assert row.ingest_ts is not None
    with pytest.raises(ConfigError):
        landing.add_metadata(df, " ", "customers", "load")


@pytest.mark.parametrize("name", ["t", "a.b", "a.b.c.d", "a.b.c;drop", "1a.b.c", ""])
def test_table_names(name):
    with pytest.raises(ConfigError):
        landing.checked_table(name)


def test_external_paths():
    assert landing.checked_path("managed", "ignored") is None
    assert landing.checked_path(None, None) is None
    assert landing.checked_path("External", "s3://b/t") == "s3://b/t"
    assert landing.checked_path("external", "/tmp/t", ("/tmp/",)) == "/tmp/t"
    for kind, path in (("external", ""), ("external", "/mnt/t"), ("view", "s3://b")):
        with pytest.raises(ConfigError):
            landing.checked_path(kind, path)


def test_retention_settings():
    assert landing.retention_hours(days=2) == 48
    assert landing.retention_hours(hours=5) == 5
    assert landing.retention_hours() is None
    for wrong in ({"days": 1, "hours": 1}, {"days": 0}, {"hours": -1}):
        with pytest.raises(ConfigError):
            landing.retention_hours(**wrong)


def test_purge_drops_old_loads(spark, rows, new_name):
    table = new_name("archive")
    df = spark.createDataFrame([(1,), (2,)], "id int")
    for load, ts in (("old", "2024-01-01 00:00:00"), ("new", "2024-01-09 00:00:00")):
        landing.archive(landing.add_metadata(df, "s", "e", load, ts), table, days=2)
    assert landing.purge_loads(spark, table, 48, "2024-01-10 00:00:00") == ["old"]
    assert rows(spark.table(table), "id", "load_id") == [(1, "new"), (2, "new")]


def test_append_grows_and_evolves(spark, rows, new_name):
    table = new_name("orders")
    first = spark.createDataFrame([("O1", 1.0), ("O2", 2.0)], "order_id string, amount double")
    publish.append(first, table)
    publish.append(spark.createDataFrame([(3.0, "O3", "web")], "amount double, order_id string, ch string"), table)
    assert rows(spark.table(table)) == [("O1", 1.0, None), ("O2", 2.0, None), ("O3", 3.0, "web")]


def test_write_modes(spark, new_name):
    table = new_name("modes")
    landing.write_table(spark.range(2), table, "overwrite")
    landing.write_table(spark.range(5), table, "ignore")
    assert spark.table(table).count() == 2
    landing.write_table(spark.range(5), table, "overwrite")
    assert spark.table(table).count() == 5
    with pytest.raises(Exception, match="already exists"):
        landing.write_table(spark.range(1), table, "error")
    with pytest.raises(ConfigError):
        landing.write_table(spark.range(1), table, "replace")


def _orders(spark, *rows_):
    return spark.createDataFrame(list(rows_), ORDER)


@pytest.mark.parametrize("partition_by", [(), ("status",)])
def test_merge_updates_and_inserts(spark, rows, new_name, partition_by):
    table = new_name("merge")
    publish.merge(_orders(spark, ("O1", "c", 1.0, "new"), ("O2", "c", 2.0, "new")), table, ["order_id"], partition_by)
    publish.merge(_orders(spark, ("O1", "c", 9.0, "paid"), ("O3", "c", 3.0, "new")), table, ["order_id"])
    assert rows(spark.table(table), *["order_id", "amount", "status"]) == [
        ("O1", 9.0, "paid"), ("O2", 2.0, "new"), ("O3", 3.0, "new")]


def test_merge_leaves_other_partitions_alone(spark, rows, new_name):
    table = new_name("parts")
    publish.merge(_orders(spark, *[(f"O{i}", "c", 1.0, s) for i, s in enumerate("aabbcc")]), table,
                  ["order_id"], ["status"])
    before = {r[0] for r in spark.table(table).filter("status = 'c'").select("_metadata.file_path").collect()}
    # O0 moves to b and O1 too, so that partition a has to go.
    publish.merge(_orders(spark, ("O0", "c", 5.0, "b"), ("O1", "c", 5.0, "b")), table, ["order_id"])
    after = {r[0] for r in spark.table(table).filter("status = 'c'").select("_metadata.file_path").collect()}
    assert before == after
    assert rows(spark.table(table), "order_id", "status") == [
        ("O0", "b"), ("O1", "b"), ("O2", "b"), ("O3", "b"), ("O4", "c"), ("O5", "c")]


@pytest.mark.parametrize("kind", ["bigint", "string", "date", "timestamp_ntz", "decimal(10,2)"])
def test_merge_by_key_type(spark, rows, new_name, kind):
    value = {"bigint": "id", "string": "cast(id as string)", "date": "date_add(date'2024-01-01', id)",
             "timestamp_ntz": "timestamp_ntz'2024-01-01' + make_interval(0,0,0,0,id)",
             "decimal(10,2)": "cast(id as decimal(10,2))"}[kind]
    table = new_name("typed")

    def part(low, high, v):
        return spark.range(low, high).selectExpr("cast(id as int) as id").selectExpr(
            f"{value} as k", "id % 2 as p", f"'{v}' as v").filter("k is not null")

    publish.merge(part(0, 10, "old"), table, ["k"], ["p"])
    publish.merge(part(8, 12, "new"), table, ["k"])
    assert spark.table(table).filter("v = 'new'").count() == 4 and spark.table(table).count() == 12
    nothing = part(0, 1, "null").selectExpr(f"cast(null as {kind}) as k", "p", "v")
    publish.merge(nothing, table, ["k"])
    assert spark.table(table).count() == 13


def test_merge_adds_new_columns(spark, rows, new_name):
    table = new_name("widen")
    publish.merge(_orders(spark, ("O1", "c", 1.0, "new")), table, ["order_id"])
    delta = _orders(spark, ("O2", "c", 1.0, "new")).selectExpr("*", "'x' as channel")
    publish.merge(delta, table, ["order_id"])
    assert rows(spark.table(table), "order_id", "channel") == [("O1", None), ("O2", "x")]


def test_null_keys_are_added(spark, rows):
    target = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    src = spark.createDataFrame([(None, "c"), (1, "d")], "k int, v string")
    assert rows(publish.upsert(target, src, ["k"])) == [(1, "d"), (None, "b"), (None, "c")]


def test_composite_keys(spark, rows):
    target = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "k int, j int, v string")
    src = spark.createDataFrame([(1, 2, "c")], "k int, j int, v string")
    assert rows(publish.upsert(target, src, ["k", "j"])) == [(1, 1, "a"), (1, 2, "c")]


def test_repeated_source_keys_are_refused(spark):
    src = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(DuplicateKeyError):
        publish.upsert(src, src, ["k"])


def test_sequence_and_soft_delete(spark, rows):
    target = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "k int, v string, s int")
    src = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (2, "gone", 1)], "k int, v string, s int")
    from pyspark.sql import functions as F

    merged = publish.upsert(target, src, ["k"], sequence="s", soft_delete=F.col("v") == "gone")
    assert rows(merged) == [(1, "new", 2, False), (2, "gone", 1, True)]


def test_cluster_keeps_rows_and_sorts(spark):
    df = spark.range(1000).selectExpr(
        "id % 37 as a", "cast(id as string) as b", "if(id % 3 = 0, null, id) as c",
        "timestamp_seconds(id) as t")
    out = cluster.packed(df, ["a", "b", "c", "t"], files=4)
    assert out.drop("z_value").exceptAll(df).isEmpty() and out.count() == 1000
    assert out.rdd.getNumPartitions() == 4
    with pytest.raises(ValueError):
        cluster.with_cells(df, [])


def test_steps_of_even_width(spark, rows):
    df = spark.createDataFrame([(0, 0), (5, 3), (10, 3), (None, 1), (9, None)], "a bigint, b bigint")
    assert rows(cluster.with_steps(df, ["a", "b"], bits=2)) == sorted(
        [(0, 0, 0), (5, 3, 11), (10, 3, 15), (None, 1, 2), (9, None, 4)], key=repr)
    assert {r.z_value for r in cluster.with_steps(df.withColumn("a", df.a * 0), ["a"]).collect()} == {0}


def test_clustered_rows_have_their_z_value(spark):
    import __spark_entry__ as contract

    out = contract.queries()["zorder_cluster"](spark, "/root/testdata/sf0.001")
    assert out.select("z_value").distinct().count() > 1000
    assert "z_value" in contract.oracle_sql()["zorder_cluster"]



def test_cluster_splits_a_shared_value(spark):
    df = spark.range(4000, numPartitions=8).selectExpr("if(id % 3 > 0, 1, id) as a", "1 as b")
    from pyspark.sql import functions as F

    out = cluster.packed(df, ["a"], files=8)
    biggest = out.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert biggest < 1500


def test_snapshots_do_not_pile_up(spark, new_name):
    table = new_name("snapshots")
    for i in range(5):
        publish.merge(_orders(spark, ("O1", "c", float(i), "new")), table, ["order_id"])
    where = table_files.location(spark, table)
    assert where.count("_snapshot_") == 1 and spark.table(table).count() == 1
    import glob

    base = publish._SNAPSHOT.sub("", where).removeprefix("file:")
    assert len(glob.glob(base + "_snapshot_*")) == 2  # the current one and the one before


@pytest.mark.parametrize("partition_by", [(), ("status",)])
def test_optimize_keeps_rows(spark, rows, new_name, partition_by):
    table = new_name("packed")
    data = [(f"O{i}", f"c{i % 7}", float(i), s) for i, s in enumerate("abc" * 20)]
    for part in (data[:20], data[20:40], data[40:]):
        publish.append(spark.createDataFrame(part, ORDER), table, partition_by)
    before = rows(spark.table(table))
    publish.optimize(spark, table, ["customer_id", "amount"], files=2)
    assert rows(spark.table(table)) == before
    assert spark.table(table).select("_metadata.file_path").distinct().count() <= 2 * max(1, 3 * len(partition_by))
    publish.optimize(spark, table)
    assert rows(spark.table(table)) == before


def test_append_clusters_within_partitions(spark, rows, new_name):
    table = new_name("clustered")
    df = spark.range(400).selectExpr("cast(id % 3 as string) as p", "(id * 37) % 400 as a", "id")
    publish.append(df, table, ["p"], zorder_by=["a"])
    publish.append(df, table, zorder_by=["a"])
    assert rows(spark.table(table), "id", "a", "p") == rows(df.unionAll(df), "id", "a", "p")


def test_partitioned_append_writes_few_files(spark, new_name):
    table = new_name("few_files")
    df = spark.range(0, 1000, 1, 8).selectExpr("id", "cast(id % 5 as string) as p")
    publish.append(df, table, ["p"])
    assert spark.table(table).select("_metadata.file_path").distinct().count() <= 8


def test_analyze(spark, new_name):
    from stratiform.operators import advisor

    table = new_name("stats")
    publish.append(spark.range(10), table)
    advisor.analyze(spark, table)
    advisor.analyze(spark, table, ["id"])
    text = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Statistics'").first()
    assert "10 rows" in text.data_type


def test_export_checks(spark):
    df = spark.range(10)
    path = export.export(df, new_folder(spark, "t"), "CSV", files=1)
    assert spark.read.option("header", "true").csv(path).count() == 10
    export.export(df, path, "csv", "append")
    assert spark.read.option("header", "true").csv(path).count() == 20
    for wrong in ({"fmt": "delta"}, {"mode": "error"}, {"files": 0}):
        with pytest.raises(ConfigError):
            export.export(df, "/tmp/x", **wrong)
    with pytest.raises(ConfigError):
        export.export(df, "/mnt/x")


def _files(spark, table):
    return {path.rsplit("/", 1)[-1]: size for path, size in table_files.data_files(spark, table)}


def test_merge_reads_and_replaces_only_files_with_its_keys(spark, rows, new_name, monkeypatch):
    table = new_name("ranged")
    base = spark.range(0, 40_000).selectExpr("id", "id * 7 as v", "cast(sha2(cast(id as string), 256) as string) as pad")
    publish.append(base.repartitionByRange(40, "id").sortWithinPartitions("id"), table)
    before = _files(spark, table)
    assert len(before) == 40
    read = []
    real = table_files.read_files_of
    monkeypatch.setattr(table_files, "read_files_of", lambda s, t, paths: read.append(list(paths)) or real(s, t, paths))
    publish.merge(spark.range(20_000, 20_400).selectExpr("id", "-1 as v", "'new' as pad"), table, ["id"])
    after = _files(spark, table)
    gone = set(before) - set(after)
    # The first call looks at the keys of all files once, to store their ranges.
    assert len(read[0]) == 40 and max(len(r) for r in read[1:]) <= 2
    assert 1 <= len(gone) <= 2 and sum(before[f] for f in gone) < 0.06 * sum(before.values())
    assert spark.table(table).count() == 40_000 and spark.table(table).where("v = -1").count() == 400
    read.clear()
    publish.merge(spark.range(39_990, 40_010).selectExpr("id", "-2 as v", "'end' as pad"), table, ["id"])
    assert max(len(r) for r in read) <= 4  # the files of the merge before, whose ranges are not stored yet
    assert spark.table(table).count() == 40_010 and spark.table(table).where("v = -2").count() == 20
    publish.merge(spark.createDataFrame([(None, 1, "x"), (5, 2, "y")], "id long, v long, pad string"), table, ["id"])
    assert rows(spark.table(table).where("id = 5 or id is null")) == [(5, 2, "y"), (None, 1, "x")]


@pytest.mark.parametrize("partition_by", [(), ("p",)])
@pytest.mark.parametrize("moves", [0, 1, 2])
def test_append_that_fails_while_files_are_moved_is_there_once(spark, rows, new_name, monkeypatch, partition_by, moves):
    table = new_name("moved")
    data = spark.range(100).selectExpr("id", "cast(if(id % 3 = 0, null, concat('a/', id % 3)) as string) as p").repartition(3)
    publish.append(data.where("id < 10"), table, partition_by)
    real, seen = table_files._Folder.move, []

    def lost(self, old, new):
        if "_staged_" in old:
            if len(seen) == moves:
                raise RuntimeError("driver lost")
            seen.append(old)
        real(self, old, new)

    with monkeypatch.context() as patch:
        patch.setattr(table_files._Folder, "move", lost)
        with pytest.raises(RuntimeError):
            publish.append(data, table, partition_by, load="L", again=True)
    for _ in range(2):
        assert publish.append(data, table, partition_by, load="L", again=True) == 100
    spark.catalog.refreshTable(table)
    assert rows(spark.table(table).select("id", "p")) == rows(data.unionAll(data.where("id < 10")))
    assert not [n for n in table_files._Folder(spark, table_files.location(spark, table)).names("_staged_")]


def test_append_that_fails_before_its_plan_changes_nothing(spark, new_name, monkeypatch):
    table = new_name("unplanned")
    publish.append(spark.range(5), table)
    with monkeypatch.context() as patch:
        patch.setattr(table_files._Folder, "write", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            publish.append(spark.range(7), table, load="L", again=True)
    assert spark.table(table).count() == 5
    assert publish.append(spark.range(7), table, load="L", again=True) == 7
    assert spark.table(table).count() == 12


def test_compaction_packs_small_files_of_each_partition(spark, rows, new_name):
    table = new_name("small")
    for i in range(5):
        publish.append(spark.range(i * 10, i * 10 + 10).selectExpr("id", "cast(id % 2 as string) as p").coalesce(1), table, ["p"])
    before, held = rows(spark.table(table)), _files(spark, table)
    assert len(held) == 10
    assert publish.compact(spark, table, least=6) == 0
    assert publish.compact(spark, table, ["id"]) == 10
    assert rows(spark.table(table)) == before and 2 <= len(_files(spark, table)) <= 4
    assert publish.compact(spark, table, target=1) == 0


def test_merge_evaluates_the_merged_rows_once(spark, new_name, monkeypatch):
    table = new_name("once")
    base = spark.range(1000).selectExpr("id", "id % 50 as c")
    publish.append(base, table, zorder_by=["c"])
    calls = []
    real = cluster.cell_bounds
    monkeypatch.setattr(cluster, "cell_bounds", lambda *a: calls.append(a) or real(*a))
    publish.merge(base.where("id < 800").selectExpr("id", "c + 1 as c"), table, ["id"], zorder_by=["c"])
    assert not calls and spark.table(table).count() == 1000
