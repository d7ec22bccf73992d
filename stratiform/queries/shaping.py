"""Landing columns, mappings and the expression vocabulary of metadata."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratiform.functions.columns import row_hash, short_text
from stratiform.operators import conform, landing, verify
from stratiform.queries.registry import query, table

TS = "2024-02-01 00:00:00"


@query(
    "landing_metadata",
    """SELECT *, 'erp' AS source_system, 'orders' AS source_entity, 'load-1' AS load_id,
  TIMESTAMP '2024-02-01 00:00:00' AS ingest_ts FROM orders""",
)
def landing_metadata(spark, sf_dir):
    return landing.add_metadata(table(spark, sf_dir, "orders"), "erp", "orders", "load-1", TS)


def _rows(*pairs: tuple[str, str], **more) -> list[dict]:
    return [{"transform_expression": e, "conformance_column": c, **more} for e, c in pairs]


@query(
    "conform_mapping",
    """SELECT c_custkey AS customer_id, trim(c_name) AS full_name, upper(c_mktsegment) AS segment,
  CAST(c_nationkey AS BIGINT) AS nation_id, CASE WHEN c_acctbal < 0 THEN 'debt' ELSE 'credit' END AS side
FROM customer""",
)
def conform_mapping(spark, sf_dir):
    mappings = _rows(
        ("c_custkey", "customer_id"),
        ("trim(c_name)", "full_name"),
        ("upper(c_mktsegment)", "segment"),
        ("cast(c_nationkey as bigint)", "nation_id"),
        ("case when c_acctbal < 0 then 'debt' else 'credit' end", "side"),
    ) + [{"transform_expression": "1", "conformance_column": "off", "is_active": "false"}]
    return conform.apply(table(spark, sf_dir, "customer"), mappings)


@query("conform_passthrough", "SELECT * FROM supplier")
def conform_passthrough(spark, sf_dir):
    landed = landing.add_metadata(table(spark, sf_dir, "supplier"), "erp", "supplier", "load-1", TS)
    return conform.apply(landed, [])


@query(
    "conform_typed",
    """SELECT p_partkey AS part_id, coalesce(try_cast(substr(p_brand, 7) AS INTEGER), -1) AS brand_no,
  coalesce(try_cast(p_name AS INTEGER), 0) AS name_no, CAST(p_retailprice AS DECIMAL(12, 2)) AS price
FROM part""",
)
def conform_typed(spark, sf_dir):
    mappings = [
        {"transform_expression": "p_partkey", "conformance_column": "part_id"},
        {"transform_expression": "substr(p_brand, 7)", "conformance_column": "brand_no",
         "target_type_name": "int", "default_value": "-1"},
        {"transform_expression": "p_name", "conformance_column": "name_no",
         "target_type_name": "int", "default_value": "0"},
        {"transform_expression": "p_retailprice", "conformance_column": "price",
         "target_type_name": "decimal(12,2)"},
    ]
    return conform.apply(table(spark, sf_dir, "part"), mappings, typed=True)


@query(
    "scalar_strings",
    """SELECT c_custkey, trim('  ' || c_name || ' ') AS trimmed, upper(c_mktsegment) AS upped,
  length(c_name) AS len, concat(c_mktsegment, '-', c_name) AS joined, contains(c_name, '00') AS has_zeros,
  c_name LIKE '%7' AS ends_in_seven, regexp_matches(c_name, '[13579]$') AS is_odd,
  CAST(c_nationkey AS VARCHAR) AS nation_text FROM customer""",
)
def scalar_strings(spark, sf_dir):
    mappings = _rows(
        ("c_custkey", "c_custkey"),
        ("trim('  ' || c_name || ' ')", "trimmed"),
        ("upper(c_mktsegment)", "upped"),
        ("cast(length(c_name) as bigint)", "len"),
        ("concat(c_mktsegment, '-', c_name)", "joined"),
        ("contains(c_name, '00')", "has_zeros"),
        ("c_name like '%7'", "ends_in_seven"),
        ("c_name rlike '[13579]$'", "is_odd"),
        ("cast(c_nationkey as string)", "nation_text"),
    )
    return conform.apply(table(spark, sf_dir, "customer"), mappings)


@query(
    "scalar_dates",
    """SELECT event_id, CAST(ts AS DATE) AS day, strftime(ts, '%Y%m%d') AS day_text,
  CAST(strptime(strftime(ts, '%d/%m/%Y'), '%d/%m/%Y') AS DATE) AS parsed,
  CAST(floor(epoch(ts)) AS BIGINT) AS seconds, date_trunc('hour', ts) AS hour_start,
  ts - INTERVAL 7 DAY AS week_before, CAST(ts AS DATE) <= DATE '2024-01-15' AS first_half FROM events""",
)
def scalar_dates(spark, sf_dir):
    mappings = _rows(
        ("event_id", "event_id"),
        ("date(ts)", "day"),
        ("date_format(ts, 'yyyyMMdd')", "day_text"),
        ("to_date(date_format(ts, 'dd/MM/yyyy'), 'dd/MM/yyyy')", "parsed"),
        ("unix_timestamp(ts)", "seconds"),
        ("cast(date_trunc('hour', ts) as timestamp_ntz)", "hour_start"),
        ("ts - interval 7 days", "week_before"),
        ("to_date(ts) <= date'2024-01-15'", "first_half"),
    )
    return conform.apply(table(spark, sf_dir, "events"), mappings)


@query(
    "scalar_misc",
    """SELECT o_orderkey, CAST(o_custkey AS DOUBLE) AS cust_number,
  CAST(o_totalprice AS DECIMAL(12, 2)) AS price, CAST(floor(o_totalprice) AS BIGINT) AS whole,
  round(o_totalprice / 1000, 1) AS thousands, CASE WHEN o_totalprice > 300000 THEN 'big' ELSE 'small' END
  AS size_class, coalesce(nullif(o_orderstatus, 'P'), 'pending') AS status,
  nullif(o_orderstatus, 'P') IS NULL AS is_pending, o_orderstatus IN ('O', 'F') AS is_known,
  '{"k":' || o_orderkey || ',"s":"' || o_orderstatus || '"}' AS as_json,
  o_orderkey + 1 AS parsed_json FROM orders""",
)
def scalar_misc(spark, sf_dir):
    mappings = _rows(
        ("o_orderkey", "o_orderkey"),
        ("cast(o_custkey as double)", "cust_number"),
        ("cast(o_totalprice as decimal(12,2))", "price"),
        ("cast(floor(o_totalprice) as bigint)", "whole"),
        ("round(o_totalprice / 1000, 1)", "thousands"),
        ("case when o_totalprice > 300000 then 'big' else 'small' end", "size_class"),
        ("coalesce(nullif(o_orderstatus, 'P'), 'pending')", "status"),
        ("nullif(o_orderstatus, 'P') is null", "is_pending"),
        ("o_orderstatus in ('O', 'F')", "is_known"),
        ("to_json(struct(o_orderkey as k, o_orderstatus as s))", "as_json"),
        ("cast(get_json_object(concat('{\"a\":', o_orderkey + 1, '}'), '$.a') as bigint)", "parsed_json"),
    )
    return conform.apply(table(spark, sf_dir, "orders"), mappings)


_HASHED = ", ',', ".join(
    f"coalesce('{c}:' || length(CAST({c} AS VARCHAR)) || '=' || CAST({c} AS VARCHAR), '{c}:null')"
    for c in ["o_custkey", "o_orderkey", "o_orderpriority", "o_orderstatus"]
)


@query("row_hash", f"SELECT o_orderkey, sha256(concat({_HASHED})) AS row_hash FROM orders")
def hashed_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    columns = ["o_orderpriority", "o_orderkey", "o_orderstatus", "o_custkey"]
    return orders.select("o_orderkey", row_hash(orders, columns).alias("row_hash"))


@query(
    "error_text",
    """SELECT conv_id, turn, substr(trim(replace(text, chr(10), ' ')), 1, 500) AS error_message
FROM conversations""",
)
def error_text(spark, sf_dir):
    """Texts as the audit table stores them: one line, at most 500 characters."""
    turns = table(spark, sf_dir, "conversations")
    return turns.select("conv_id", "turn", short_text(F.col("text")).alias("error_message"))


@query(
    "retention_filter",
    "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 240 HOUR",
)
def retention_filter(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    hours = landing.retention_hours(days=10)
    return landing.retain(events, hours, "2024-01-31 00:00:00", "ts")


@query(
    "seed_sample",
    """SELECT *, 'seed-1' AS _seed_run_id, TIMESTAMP '2024-02-01 00:00:00' AS _seed_ts FROM (
  SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25)""",
)
def seed_sample(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return verify.seed_sample(orders, [F.desc("o_totalprice"), "o_orderkey"], 25, "seed-1", TS)
