"""Row checks, dataset checks and business rules."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.operators import audit, bronze, content, key_history, rules
from stratiform.operators.keyed import distinct_report, measure
from stratiform.queries.registry import query, table
from stratiform.session import new_folder

AS_OF = "2024-02-01 00:00:00"
FLAGS = ["bronze_dq_status", "bronze_dq_failed_check"]

ORDER_CHECKS = {
    "required_columns": ["o_orderkey", "o_custkey", "o_region"],
    "expected_types": {"o_orderkey": "bigint", "o_totalprice": "decimal(12,2)", "o_clerk": "string"},
    "non_nullable_columns": ["o_orderstatus", "no_such_column"],
    "allowed_values": {"o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM"]},
    "regex_patterns": {"o_orderpriority": "^[0-9]-[A-Z]+$"},
    "length_constraints": {"o_orderpriority": {"min": 5, "max": 8}},
    "range_constraints": {"o_totalprice": {"min": 2000, "max": 450000}},
    "logical_checks": ["o_totalprice < 400000 OR o_orderstatus = 'F'"],
    "null_thresholds": {"o_orderstatus": 0.25, "o_custkey": 0.0},
    "uniqueness_constraints": ["o_orderkey", ["o_custkey", "o_orderstatus"]],
    "freshness": {"column": "o_orderdate", "max_age_hours": 24},
    "volume": {"min_rows": 1, "max_rows": 100000000000},
}
_ORDERS = """(SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus, o_totalprice,
  o_orderdate, o_orderpriority FROM orders)"""
_FIRST_FAILURE = """CASE
  WHEN o_orderstatus IS NULL THEN 'non_null:o_orderstatus'
  WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 'allowed_values:o_orderpriority'
  WHEN NOT regexp_matches(o_orderpriority, '^[0-9]-[A-Z]+$') THEN 'regex:o_orderpriority'
  WHEN length(o_orderpriority) < 5 OR length(o_orderpriority) > 8 THEN 'length:o_orderpriority'
  WHEN o_totalprice < 2000 OR o_totalprice > 450000 THEN 'range:o_totalprice'
  WHEN NOT (o_totalprice < 400000 OR o_orderstatus = 'F')
    THEN 'logical:o_totalprice < 400000 OR o_orderstatus = ''F''' END"""
_CHECKED = f"checked AS (SELECT *, {_FIRST_FAILURE} AS failed_check FROM {_ORDERS})"


def _orders(spark, sf_dir) -> DataFrame:
    """Orders whose pending status is taken as missing."""
    df = table(spark, sf_dir, "orders")
    return df.withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P")))


def _flagged(df: DataFrame, cfg: dict, *keys: str) -> DataFrame:
    return bronze.annotate(df, cfg).select(*keys, *FLAGS)


def _flag_sql(keys: str, source: str, label: str, bad: str) -> str:
    return f"""SELECT {keys}, CASE WHEN {bad} THEN 'FAIL' ELSE 'PASS' END AS bronze_dq_status,
  CASE WHEN {bad} THEN '{label}' END AS bronze_dq_failed_check FROM {source}"""


@query("bronze_non_null", _flag_sql("o_orderkey", _ORDERS, "non_null:o_orderstatus", "o_orderstatus IS NULL"))
def bronze_non_null(spark, sf_dir):
    return _flagged(_orders(spark, sf_dir), {"non_nullable_columns": ["o_orderstatus"]}, "o_orderkey")


@query(
    "bronze_allowed_values",
    _flag_sql("o_orderkey", _ORDERS, "allowed_values:o_orderstatus", "o_orderstatus NOT IN ('O')"),
)
def bronze_allowed_values(spark, sf_dir):
    return _flagged(_orders(spark, sf_dir), {"allowed_values": {"o_orderstatus": ["O"]}}, "o_orderkey")


@query(
    "bronze_regex",
    _flag_sql("p_partkey", "part", "regex:p_brand", "NOT regexp_matches(p_brand, '#1[0-9]$')"),
)
def bronze_regex(spark, sf_dir):
    return _flagged(table(spark, sf_dir, "part"), {"regex_patterns": {"p_brand": "#1[0-9]$"}}, "p_partkey")


@query(
    "bronze_length",
    _flag_sql("doc_id", "documents", "length:text", "length(text) < 200 OR length(text) > 2000"),
)
def bronze_length(spark, sf_dir):
    cfg = {"length_constraints": {"text": {"min": 200, "max": 2000}}}
    return _flagged(table(spark, sf_dir, "documents"), cfg, "doc_id")


@query(
    "bronze_range",
    _flag_sql(
        "c_custkey", "customer", "range:c_acctbal", "c_acctbal < 0.0 OR c_acctbal > 9000.5"
    ),
)
def bronze_range(spark, sf_dir):
    cfg = {"range_constraints": {"c_acctbal": {"min": 0, "max": 9000.5}, "c_name": {"min": 1}}}
    return _flagged(table(spark, sf_dir, "customer"), cfg, "c_custkey")


@query(
    "bronze_logical",
    _flag_sql(
        "event_id",
        "(SELECT event_id, event_type, nullif(value, 0.5) AS value FROM events)",
        "logical:value > 10 OR event_type = ''error''",
        "NOT (value > 10 OR event_type = 'error')",
    ),
)
def bronze_logical(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("value", F.nullif("value", F.lit(0.5)))
    return _flagged(events, {"logical_checks": ["value > 10 OR event_type = 'error'"]}, "event_id")


@query(
    "bronze_annotate",
    f"""WITH {_CHECKED} SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
  o_orderpriority, CASE WHEN failed_check IS NULL THEN 'PASS' ELSE 'FAIL' END AS bronze_dq_status,
  failed_check AS bronze_dq_failed_check FROM checked""",
)
def bronze_annotate(spark, sf_dir):
    return bronze.annotate(_orders(spark, sf_dir), ORDER_CHECKS)


@query(
    "bronze_split",
    f"""WITH {_CHECKED} SELECT CASE WHEN failed_check IS NULL THEN 'valid' ELSE 'reject' END AS side,
  failed_check, count(*) AS row_count FROM checked GROUP BY 1, 2""",
)
def bronze_split(spark, sf_dir):
    out = bronze.run(_orders(spark, sf_dir), ORDER_CHECKS, AS_OF)
    sides = out.valid.withColumn("side", F.lit("valid")).unionAll(
        out.rejects.withColumn("side", F.lit("reject"))
    )
    return sides.groupBy("side", F.col("bronze_dq_failed_check").alias("failed_check")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


@query(
    "bronze_bad_config",
    """SELECT 'FAIL' AS bronze_dq_status, 'invalid_bronze_dq_config' AS bronze_dq_failed_check,
  count(*) AS row_count, CAST(0 AS BIGINT) AS valid_rows FROM orders""",
)
def bronze_bad_config(spark, sf_dir):
    out = bronze.run(_orders(spark, sf_dir), {"volume": [1], "no_such_check": 1})
    passed = F.count_if(F.col("bronze_dq_status") == "PASS")
    return out.annotated.groupBy(*FLAGS).agg(
        F.count(F.lit(1)).alias("row_count"), passed.alias("valid_rows")
    )


@query(
    "bronze_summary",
    f"""WITH {_CHECKED}, n AS (SELECT count(*) AS t, count(failed_check) AS f FROM checked)
SELECT 'row_level_summary' AS check_name, CASE WHEN f = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
  t AS total_rows, t - f AS passed_rows, f AS failed_rows FROM n""",
)
def bronze_summary(spark, sf_dir):
    checked = bronze.annotate(_orders(spark, sf_dir), ORDER_CHECKS)
    report = bronze.dataset_checks(checked, {})
    fields = F.from_json("details", "total_rows bigint, passed_rows bigint, failed_rows bigint")
    return report.select("check_name", "status", fields.alias("d")).select("check_name", "status", "d.*")


_AGE = "(epoch(TIMESTAMP '2024-02-01 00:00:00') - floor(epoch(max(o_orderdate)))) / 3600.0"


@query(
    "bronze_full_report",
    f"""WITH {_CHECKED},
n AS (SELECT count(*) AS t, count(failed_check) AS f, count(*) - count(o_orderstatus) AS null_status,
  count(*) - count(o_custkey) AS null_cust, max(o_orderdate) AS latest,
  CAST({_AGE} AS DOUBLE) AS age FROM checked),
u1 AS (SELECT count(*) AS d FROM (SELECT DISTINCT o_orderkey FROM checked)),
u2 AS (SELECT count(*) AS d FROM (SELECT DISTINCT o_custkey, o_orderstatus FROM checked))
SELECT 'required_columns' AS validation_type, 'FAIL' AS validation_status,
  CAST(NULL AS DOUBLE) AS observed FROM n
UNION ALL SELECT 'data_types', 'FAIL', NULL FROM n
UNION ALL SELECT 'row_level_summary', CASE WHEN f = 0 THEN 'PASS' ELSE 'FAIL' END, f FROM n
UNION ALL SELECT 'null_threshold:o_orderstatus',
  CASE WHEN null_status * 1.0 / t <= 0.25 THEN 'PASS' ELSE 'FAIL' END, null_status FROM n
UNION ALL SELECT 'null_threshold:o_custkey', CASE WHEN null_cust = 0 THEN 'PASS' ELSE 'FAIL' END,
  null_cust FROM n
UNION ALL SELECT 'freshness:o_orderdate', CASE WHEN age <= 24 THEN 'PASS' ELSE 'FAIL' END, age FROM n
UNION ALL SELECT 'volume', CASE WHEN t BETWEEN 1 AND 100000000000 THEN 'PASS' ELSE 'FAIL' END, t FROM n
UNION ALL SELECT 'uniqueness:o_orderkey', CASE WHEN t = u1.d THEN 'PASS' ELSE 'FAIL' END, t - u1.d
  FROM n, u1
UNION ALL SELECT 'uniqueness:o_custkey,o_orderstatus', CASE WHEN t = u2.d THEN 'PASS' ELSE 'FAIL' END,
  t - u2.d FROM n, u2""",
)
def bronze_full_report(spark, sf_dir):
    out = bronze.run(_orders(spark, sf_dir), ORDER_CHECKS, AS_OF)
    rows = audit.check_rows(spark, out.results, audit.RunKey("r1", "erp", "orders", AS_OF), out.errors)
    fields = "failed_rows double, null_rows double, age_hours double, row_count double, duplicate_rows double"
    parsed = F.from_json("error_details", fields)
    names = [f.split()[0] for f in fields.split(", ")]
    return rows.select(
        "validation_type",
        "validation_status",
        F.coalesce(*[parsed[n] for n in names]).alias("observed"),
    )


@query(
    "schema_checks",
    """WITH n AS (SELECT count(*) AS t FROM events)
SELECT 'required_columns' AS check_name, 'FAIL' AS status, '{"missing_columns":["country"]}' AS details
UNION ALL SELECT 'expected_columns', 'FAIL',
  '{"extra_columns":["props"],"missing_expected_columns":["country"]}'
UNION ALL SELECT 'data_types', 'FAIL',
  '{"mismatch":{"ts":{"expected":"timestamp","actual":"timestamp_ntz"}},"missing_columns":["country"]}'
UNION ALL SELECT 'volume', CASE WHEN t >= 1000 THEN 'PASS' ELSE 'FAIL' END,
  '{"row_count":' || t || ',"min_rows":1000,"max_rows":null}' FROM n""",
)
def schema_checks(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    cfg = {
        "required_columns": ["event_id", "country"],
        "expected_columns": ["event_id", "ts", "user_id", "event_type", "value", "country"],
        "expected_types": {"event_id": "BIGINT", "ts": "timestamp", "country": "string"},
        "volume": {"min_rows": 1000},
    }
    return bronze.run(events, cfg).results.filter("check_name <> 'row_level_summary'")


@query(
    "null_threshold",
    """WITH n AS (SELECT count(*) AS t, count(nullif(event_type, 'view')) AS a,
  count(nullif(value, 0.5)) AS b FROM events)
SELECT 'null_threshold:event_type' AS check_name,
  CASE WHEN (t - a) * 1.0 / t <= 0.1 THEN 'PASS' ELSE 'FAIL' END AS status, t - a AS null_rows,
  round((t - a) * 1.0 / t, 9) AS ratio, CAST(0.1 AS DOUBLE) AS max_ratio FROM n
UNION ALL SELECT 'null_threshold:value', CASE WHEN (t - b) * 1.0 / t <= 0.5 THEN 'PASS' ELSE 'FAIL' END,
  t - b, round((t - b) * 1.0 / t, 9), 0.5 FROM n""",
)
def null_threshold(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumns(
        {"event_type": F.nullif("event_type", F.lit("view")), "value": F.nullif("value", F.lit(0.5))}
    )
    cfg = {"null_thresholds": {"event_type": 0.1, "value": 0.5}}
    report = bronze.dataset_checks(bronze.annotate(events, cfg), cfg)
    d = F.from_json("details", "null_rows bigint, ratio double, max_ratio double")
    return report.filter("check_name LIKE 'null_threshold:%'").select(
        "check_name",
        "status",
        d["null_rows"].alias("null_rows"),
        F.round(d["ratio"], 9).alias("ratio"),
        d["max_ratio"].alias("max_ratio"),
    )


@query(
    "volume_check",
    """SELECT 'volume' AS check_name, CASE WHEN count(*) BETWEEN 100 AND 5000 THEN 'PASS' ELSE 'FAIL' END
  AS status, '{"row_count":' || count(*) || ',"min_rows":100,"max_rows":5000}' AS details FROM events""",
)
def volume_check(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    cfg = {"volume": {"min_rows": 100, "max_rows": 5000}}
    return bronze.dataset_checks(bronze.annotate(events, cfg), cfg).filter("check_name = 'volume'")


@query(
    "uniqueness_check",
    """WITH n AS (SELECT count(*) AS t FROM lineitem),
a AS (SELECT count(*) AS d FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)),
b AS (SELECT count(*) AS d FROM (SELECT DISTINCT l_shipdate FROM lineitem))
SELECT 'uniqueness:l_orderkey,l_linenumber' AS check_name,
  CASE WHEN t = d THEN 'PASS' ELSE 'FAIL' END AS status, t - d AS duplicate_rows FROM n, a
UNION ALL SELECT 'uniqueness:l_shipdate', CASE WHEN t = d THEN 'PASS' ELSE 'FAIL' END, t - d FROM n, b""",
)
def uniqueness_check(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    cfg = {"uniqueness_constraints": [["l_orderkey", "l_linenumber", "absent"], "l_shipdate"]}
    frames = bronze.uniqueness_results(lines, cfg)
    duplicates = F.get_json_object("details", "$.duplicate_rows").cast("bigint")
    return frames[0].unionAll(frames[1]).select(
        "check_name", "status", duplicates.alias("duplicate_rows")
    )


@query(
    "distinct_keys",
    """SELECT (SELECT count(*) FROM lineitem) AS total_rows,
  (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem)) AS distinct_rows""",
)
def distinct_keys(spark, sf_dir):
    return distinct_report(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_suppkey"])


@query(
    "freshness_check",
    """SELECT 'freshness:ts' AS check_name,
  CASE WHEN age <= 30 THEN 'PASS' ELSE 'FAIL' END AS status, round(age, 6) AS age_hours FROM (
  SELECT (epoch(TIMESTAMP '2024-02-01 00:00:00') - floor(epoch(max(ts)))) / 3600.0 AS age FROM events)""",
)
def freshness_check(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    cfg = {"freshness": {"column": "ts", "max_age_hours": 30}}
    report = bronze.dataset_checks(bronze.annotate(events, cfg), cfg, AS_OF)
    age = F.get_json_object("details", "$.age_hours").cast("double")
    return report.filter("check_name = 'freshness:ts'").select(
        "check_name", "status", F.round(age, 6).alias("age_hours")
    )


LINE_RULES = [
    {"rule_name": "quantity_limit", "rule_expression": "l_quantity <= 45", "severity": "high"},
    {"rule_name": "discount_limit", "rule_expression": "l_discount < 0.09", "severity": "ERROR"},
    {"rule_name": "open_not_returned", "rule_expression": "l_linestatus <> 'O' OR l_returnflag <> 'R'",
     "severity": "low"},
    {"rule_name": "tax_known", "rule_expression": "l_tax > 0", "severity": "WARN"},
    {"rule_name": "never", "rule_expression": "1 = 0", "is_active": "false"},
]
_BAD = {
    "quantity_limit": "NOT (l_quantity <= 45)",
    "discount_limit": "NOT (l_discount < 0.09)",
    "open_not_returned": "NOT (l_linestatus <> 'O' OR l_returnflag <> 'R')",
    "tax_known": "NOT (l_tax > 0)",
}


def _names(*names: str, first: tuple[str, ...] = ()) -> str:
    cases = [*first, *[f"CASE WHEN {_BAD[n]} THEN '{n}' END" for n in names]]
    return f"nullif(concat_ws(',', {', '.join(cases)}), '')"


_KEYS = "l_orderkey, l_linenumber, l_partkey"


@query(
    "rules_error",
    f"""SELECT *, CASE WHEN dq_failed_rule IS NULL THEN 'PASS' ELSE 'FAIL' END AS dq_status FROM (
  SELECT {_KEYS}, {_names('quantity_limit', 'discount_limit')} AS dq_failed_rule FROM lineitem)""",
)
def rules_error(spark, sf_dir):
    out = rules.apply(table(spark, sf_dir, "lineitem"), LINE_RULES[:2])
    return out.select(*_KEYS.split(", "), "dq_status", "dq_failed_rule")


@query(
    "rules_warn",
    f"""SELECT {_KEYS}, 'PASS' AS dq_status, {_names('open_not_returned', 'tax_known')} AS dq_warn_rule
FROM lineitem""",
)
def rules_warn(spark, sf_dir):
    out = rules.apply(table(spark, sf_dir, "lineitem"), LINE_RULES[2:])
    return out.select(*_KEYS.split(", "), "dq_status", "dq_warn_rule")


@query(
    "rules_split",
    f"""SELECT dq_status, count(*) AS row_count, CAST(sum(l_linenumber) AS BIGINT) AS line_sum FROM (
  SELECT l_linenumber, CASE WHEN {_names('quantity_limit', 'discount_limit')} IS NULL THEN 'PASS'
  ELSE 'FAIL' END AS dq_status FROM lineitem) GROUP BY dq_status""",
)
def rules_split(spark, sf_dir):
    valid, bad = rules.split(rules.apply(table(spark, sf_dir, "lineitem"), LINE_RULES))
    return valid.unionAll(bad).groupBy("dq_status").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("l_linenumber").alias("line_sum")
    )


_PK_INPUT = """(SELECT nullif(l_orderkey, 7) AS l_orderkey, l_linenumber, l_partkey, l_quantity,
  l_discount, l_tax, l_linestatus, l_returnflag FROM lineitem)"""
_PK_CASES = (
    "CASE WHEN l_orderkey IS NULL OR l_linenumber IS NULL THEN 'primary_key_not_null' END",
    "CASE WHEN count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 THEN 'primary_key_unique' END",
)


def _lines_with_null_key(spark, sf_dir) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return lines.withColumn("l_orderkey", F.nullif("l_orderkey", F.lit(7).cast("bigint")))


@query(
    "rules_full",
    f"""SELECT *, CASE WHEN dq_failed_rule IS NULL THEN 'PASS' ELSE 'FAIL' END AS dq_status FROM (
  SELECT {_KEYS}, {_names('quantity_limit', 'discount_limit', first=_PK_CASES)} AS dq_failed_rule,
  {_names('open_not_returned', 'tax_known')} AS dq_warn_rule FROM {_PK_INPUT})""",
)
def rules_full(spark, sf_dir):
    out = rules.apply(_lines_with_null_key(spark, sf_dir), LINE_RULES, "l_orderkey, l_linenumber")
    return out.select(*_KEYS.split(", "), "dq_status", "dq_failed_rule", "dq_warn_rule")


@query(
    "pk_not_null",
    f"""SELECT l_partkey, l_linenumber, CASE WHEN l_orderkey IS NULL THEN 'FAIL' ELSE 'PASS' END
  AS key_status FROM {_PK_INPUT}""",
)
def pk_not_null(spark, sf_dir):
    out = rules.apply(_lines_with_null_key(spark, sf_dir), [], "l_orderkey")
    missing = F.contains("dq_failed_rule", F.lit(rules.PK_NOT_NULL))
    return out.select(
        "l_partkey", "l_linenumber", F.when(missing, "FAIL").otherwise("PASS").alias("key_status")
    )


@query(
    "pk_unique",
    f"""SELECT l_orderkey, l_linenumber, l_partkey,
  count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS is_repeated FROM {_PK_INPUT}""",
)
def pk_unique(spark, sf_dir):
    lines = _lines_with_null_key(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey")
    return rules.flag_duplicates(lines, ["l_orderkey", "l_linenumber"], "is_repeated")


@query(
    "pk_failure_counts",
    f"""SELECT count(*) FILTER (l_orderkey IS NULL OR l_linenumber IS NULL) AS primary_key_not_null,
  count(*) FILTER (n > 1) AS primary_key_unique FROM (
  SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM {_PK_INPUT})""",
)
def pk_failure_counts(spark, sf_dir):
    out = rules.apply(_lines_with_null_key(spark, sf_dir), [], "l_orderkey,l_linenumber")
    return rules.key_failures(out)


@query(
    "reconcile_content",
    """WITH ends AS (SELECT min(o_orderkey) AS lost, max(o_orderkey) AS twice FROM orders),
copied AS (SELECT o.* FROM orders o, ends WHERE o_orderkey <> lost UNION ALL SELECT o.* FROM orders o, ends WHERE o_orderkey = twice),
held AS (SELECT *, 1 AS l, 0 AS r FROM orders UNION ALL SELECT *, 0, 1 FROM copied)
SELECT * EXCLUDE (l, r), sum(l)::BIGINT AS left_rows, sum(r)::BIGINT AS right_rows, TRUE AS counts_agree, FALSE AS fingerprints_agree
FROM held GROUP BY ALL HAVING sum(l) <> sum(r)""",
)
def reconcile_content(spark, sf_dir):
    """A copy with one row lost and another doubled: counts agree, fingerprints do not, and the rows are named."""
    orders = table(spark, sf_dir, "orders")
    lost, twice = orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    copied = orders.where(F.col("o_orderkey") != lost).unionByName(orders.where(F.col("o_orderkey") == twice)).repartition(5)
    left, right = content.fingerprint(orders).first(), content.fingerprint(copied).first()
    agree = {"counts_agree": F.lit(left["rows"] == right["rows"]), "fingerprints_agree": F.lit(left == right)}
    return content.differing_rows(orders, copied).withColumns(agree)


@query(
    "pk_unique_across_loads",
    """WITH l AS (SELECT o_custkey, o_orderkey, year(o_orderdate) AS load FROM orders)
SELECT load, o_orderkey, o_custkey, EXISTS (FROM l e WHERE e.o_custkey = l.o_custkey AND e.load < l.load) AS seen_before FROM l""",
)
def pk_unique_across_loads(spark, sf_dir):
    """A load for each year of orders; the keys are customers. The history is packed on the way, the third load comes twice."""
    orders = table(spark, sf_dir, "orders").select(F.year("o_orderdate").cast("bigint").alias("load"), "o_orderkey", "o_custkey")
    delivered = new_folder(spark, "key-loads")  # a folder for each load, so that a load reads no other's rows
    orders.write.partitionBy("load").parquet(delivered)
    orders = spark.read.schema("o_orderkey bigint, o_custkey bigint, load bigint").parquet(delivered).select(*orders.columns)
    history = f"spark_catalog.default.keys_{uuid.uuid4().hex}"
    years = [r[0] for r in orders.select("load").where("load IS NOT NULL").distinct().orderBy("load").collect()]
    parts = {None: orders.where("load IS NULL").withColumn("seen_before", F.lit(False))}
    for year in [*years[:3], *years[2:]]:
        flagged = measure(key_history.flag_seen(orders.where(F.col("load") == year), ["o_custkey"], history, str(year)), "flagged").frame
        key_history.record(flagged.where(~F.col("seen_before")), ["o_custkey"], history, str(year))
        parts[year] = flagged
    return functools.reduce(DataFrame.unionByName, parts.values())
