"""Silver publishing: append, upsert, evolution, clustering, export."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from stratiform.operators import cluster, export, landing, publish, table_files
from stratiform.queries.registry import query, table
from stratiform.session import new_folder

_BASE = "o_orderdate < TIMESTAMP '1999-01-01 00:00:00'"
_DELTA = "o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'"
_CHANGED = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1000 AS o_totalprice,
  o_orderdate, o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'"""
_MERGED = f"""SELECT * FROM (SELECT * FROM orders WHERE {_BASE}) b
WHERE NOT EXISTS (SELECT 1 FROM ({_CHANGED}) d WHERE d.o_orderkey = b.o_orderkey)
UNION ALL BY NAME {_CHANGED}"""


def _base(spark, sf_dir):
    """Orders as they stood at the end of 1998."""
    return table(spark, sf_dir, "orders").filter("o_orderdate < timestamp_ntz'1999-01-01 00:00:00'")


def _delta(spark, sf_dir):
    """Corrected orders from 1998 on: some are known to the base, later ones are new."""
    orders = table(spark, sf_dir, "orders")
    changed = orders.filter("o_orderdate >= timestamp_ntz'1998-01-01 00:00:00'")
    return changed.withColumn("o_totalprice", F.col("o_totalprice") + 1000)


def _new_table(spark, label: str) -> tuple[str, str]:
    name = f"spark_catalog.default.{label}_{uuid.uuid4().hex}"
    return name, new_folder(spark, label)


@query(
    "publish_append",
    f"SELECT * FROM orders WHERE {_BASE} UNION ALL SELECT * FROM orders WHERE NOT ({_BASE})",
)
def publish_append(spark, sf_dir):
    name, path = _new_table(spark, "publish_append")
    orders = table(spark, sf_dir, "orders")
    base = F.expr("o_orderdate < timestamp_ntz'1999-01-01 00:00:00'")
    publish.append(orders.filter(base), name, ["o_orderstatus"], path)
    publish.append(orders.filter(~base), name)
    return spark.table(name)


@query("publish_merge", _MERGED)
def publish_merge(spark, sf_dir):
    return publish.upsert(_base(spark, sf_dir), _delta(spark, sf_dir), ["o_orderkey"])


@query("publish_merge_stored", _MERGED)
def publish_merge_stored(spark, sf_dir):
    """Unpartitioned table: the new snapshot is written beside the old one, then switched."""
    name, path = _new_table(spark, "merge_stored")
    publish.merge(_base(spark, sf_dir), name, ["o_orderkey"], path=path)
    publish.merge(_delta(spark, sf_dir), name, ["o_orderkey"])
    return spark.table(name)


@query(
    "publish_merge_partitions",
    f"SELECT *, CAST(year(o_orderdate) AS INTEGER) AS order_year FROM ({_MERGED})",
)
def publish_merge_partitions(spark, sf_dir):
    """Partitioned table: only the years with a change are rewritten."""
    name, path = _new_table(spark, "merge_partitions")
    year = F.year("o_orderdate").alias("order_year")
    publish.merge(_base(spark, sf_dir).select("*", year), name, ["o_orderkey"], ["order_year"], path)
    publish.merge(_delta(spark, sf_dir).select("*", year), name, ["o_orderkey"])
    return spark.table(name)


_UPDATES = """SELECT l_partkey AS p_partkey, l_extendedprice AS price, l_shipdate AS seq FROM lineitem"""
_PRICES = "SELECT p_partkey, p_retailprice AS price, TIMESTAMP '1990-01-01 00:00:00' AS seq FROM part"


def _prices(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.col("p_retailprice").alias("price"),
        F.to_timestamp_ntz(F.lit("1990-01-01 00:00:00")).alias("seq"),
    )


@query(
    "merge_sequence",
    f"""WITH u AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
  PARTITION BY p_partkey ORDER BY seq DESC, price DESC) AS rn FROM ({_UPDATES})) WHERE rn = 1)
SELECT * FROM ({_PRICES}) p WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.p_partkey = p.p_partkey)
UNION ALL BY NAME SELECT * FROM u""",
)
def merge_sequence(spark, sf_dir):
    updates = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("p_partkey"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_shipdate").alias("seq"),
    )
    return publish.upsert(_prices(spark, sf_dir), updates, ["p_partkey"], sequence="seq")


@query(
    "merge_soft_delete",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  o_orderdate >= TIMESTAMP '1998-01-01 00:00:00' AND o_orderstatus = 'F' AS is_deleted
FROM (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01 00:00:00'
  UNION ALL SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00')""",
)
def merge_soft_delete(spark, sf_dir):
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    target = _base(spark, sf_dir).select(*columns)
    changed = table(spark, sf_dir, "orders").filter("o_orderdate >= timestamp_ntz'1998-01-01 00:00:00'")
    gone = F.col("o_orderstatus") == "F"
    return publish.upsert(target, changed.select(*columns), ["o_orderkey"], soft_delete=gone)


@query(
    "schema_evolution_append",
    """SELECT o_orderkey, o_custkey, o_totalprice, NULL::VARCHAR AS channel, o_orderpriority FROM orders
WHERE o_orderdate < TIMESTAMP '1999-01-01 00:00:00'
UNION ALL SELECT o_orderkey, NULL, o_totalprice, 'web' || o_orderstatus, o_orderpriority FROM orders
WHERE o_orderdate >= TIMESTAMP '1999-01-01 00:00:00'""",
)
def schema_evolution_append(spark, sf_dir):
    """The second load lacks one column and brings another; stored files stay as they are."""
    name, path = _new_table(spark, "evolving")
    orders = table(spark, sf_dir, "orders")
    old = F.expr("o_orderdate < timestamp_ntz'1999-01-01 00:00:00'")
    first = orders.filter(old).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    second = orders.filter(~old).select(
        F.concat(F.lit("web"), "o_orderstatus").alias("channel"),
        "o_totalprice",
        "o_orderkey",
        "o_orderpriority",
    )
    landing.write_table(first, name, path=path, partition_by=["o_orderpriority"])
    landing.write_table(second, name)
    return spark.table(name)


@query(
    "zorder_text",
    """SELECT count(*) AS row_count, TRUE AS cells_follow_the_text, least(64, count(DISTINCT c_name)) AS cells FROM customer""",
)
def zorder_text(spark, sf_dir):
    """Names with a long common beginning still fall into even cells, in their order."""
    cells = cluster.with_cells(table(spark, sf_dir, "customer").select("c_name"), ["c_name"])
    ranges = cells.groupBy("z_value").agg(F.count("*").alias("n"), F.min("c_name").alias("low"), F.max("c_name").alias("high"))
    before = F.max("high").over(Window.orderBy("z_value").rowsBetween(Window.unboundedPreceding, -1))  # 64 rows
    apart = ranges.withColumn("apart", F.coalesce(F.col("low") > before, F.lit(True)))
    return apart.agg(
        F.sum("n").alias("row_count"), F.bool_and("apart").alias("cells_follow_the_text"), F.count("*").alias("cells")
    )


def _scaled(column: str, bits: int) -> str:
    top = (1 << bits) - 1
    return f"CAST(floor(({column} - lo_{column}) * 1.0 / (hi_{column} - lo_{column}) * {top}) AS BIGINT)"


_BITS = 10
_Z = " + ".join(
    f"((({_scaled(c, _BITS)} >> {b}) & 1) << {b * 2 + i})"
    for i, c in enumerate(["l_partkey", "l_suppkey"])
    for b in range(_BITS)
)


@query(
    "zorder_cluster",
    f"""SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, l_linenumber, CAST(l_partkey AS BIGINT) AS l_partkey,
  CAST(l_suppkey AS BIGINT) AS l_suppkey, CAST({_Z} AS BIGINT) AS z_value, TRUE AS partkey_in_cell, TRUE AS suppkey_in_cell FROM
  (SELECT l_orderkey, l_linenumber, CAST(l_partkey AS DOUBLE) AS l_partkey,
    CAST(l_suppkey AS DOUBLE) AS l_suppkey FROM lineitem),
  (SELECT CAST(min(l_partkey) AS DOUBLE) AS lo_l_partkey, CAST(max(l_partkey) AS DOUBLE) AS hi_l_partkey,
    CAST(min(l_suppkey) AS DOUBLE) AS lo_l_suppkey, CAST(max(l_suppkey) AS DOUBLE) AS hi_l_suppkey
   FROM lineitem)""",
)
def zorder_cluster(spark, sf_dir):
    """Clustered rows with their Z-value over steps of even width, and by column whether the values of the row's cell
    of even size lie apart from those of the cells before."""
    columns = ["l_partkey", "l_suppkey"]
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *columns)
    packed = cluster.packed(cluster.with_steps(lines, columns, _BITS).withColumnRenamed("z_value", "steps"), columns)
    bits = cluster.bits_for(columns)
    for at, column in enumerate(columns):
        cell = F.lit(0)
        for bit in range(bits):
            cell = cell + F.shiftleft(F.shiftright("z_value", bit * len(columns) + at).bitwiseAND(F.lit(1)), bit)
        packed = packed.withColumn("cell", cell)
        ranges = packed.groupBy("cell").agg(F.min(column).alias("low"), F.max(column).alias("high"))
        before = F.max("high").over(Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))  # 64 rows
        apart = ranges.select("cell", F.coalesce(F.col("low") > before, F.lit(True)).alias(column.replace("l_", "") + "_in_cell"))
        packed = packed.join(F.broadcast(apart), "cell").drop("cell")
    return packed.drop("z_value").withColumnRenamed("steps", "z_value")


@query(
    "compact_appends",
    """SELECT 'rows' AS what, CAST(count(*) AS BIGINT) AS n FROM orders UNION ALL SELECT 'distinct keys', count(DISTINCT o_orderkey) FROM orders
UNION ALL SELECT 'files beyond the bound', 0 UNION ALL SELECT 'large files renamed', 0 UNION ALL SELECT 'cells changed', 0""",
)
def compact_appends(spark, sf_dir):
    """A large load and ten small ones, clustered, with a packing of small files after each."""
    orders = table(spark, sf_dir, "orders")
    name, path = f"spark_catalog.default.packed_{uuid.uuid4().hex}", new_folder(spark, "packed")
    tenth = F.pmod(F.xxhash64("o_orderkey"), F.lit(100))
    publish.append(orders.where(tenth >= 10).coalesce(2), name, path=path, zorder_by=["o_custkey"])
    cells = table_files.stored_cells(spark, name, ["o_custkey"])
    large = {f for f, _ in table_files.data_files(spark, name)}
    target = 2 * min(size for _, size in table_files.data_files(spark, name))
    for number in range(10):
        publish.append(orders.where(tenth == number).coalesce(1), name, zorder_by=["o_custkey"])
        publish.compact(spark, name, ["o_custkey"], target=target)
    files = {f for f, _ in table_files.data_files(spark, name)}
    stored = spark.table(name)
    counts = [
        ("rows", stored.count()), ("distinct keys", stored.select("o_orderkey").distinct().count()),
        ("files beyond the bound", max(0, len(files) - len(large) - 5)), ("large files renamed", len(large - files)),
        ("cells changed", int(table_files.stored_cells(spark, name, ["o_custkey"]) != cells)),
    ]
    return spark.createDataFrame(counts, "what string, n bigint")


@query(
    "export_roundtrip",
    "SELECT f.fmt, e.* FROM events e, (VALUES ('parquet'), ('csv'), ('json'), ('orc')) f(fmt)",
)
def export_roundtrip(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    report = None
    for fmt in export.FORMATS:
        path = export.export(events, new_folder(spark, f"export-{fmt}"), fmt)
        reader = spark.read.schema(events.schema)
        if fmt == "csv":
            reader = reader.option("header", "true")
        back = reader.format(fmt).load(path).select(F.lit(fmt).alias("fmt"), "*")
        report = back if report is None else report.unionAll(back)
    return report
