"""Control metadata as frames: loading, selection, validation and per-source plans.

All checks are set-based: a registry of any size is validated in one pass, errors come as rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform import schemas
from stratiform.errors import ConfigError
from stratiform.functions.columns import any_null

# Accepted values of registry cells.
SOURCE_TYPES = ["FILE", "JDBC", "API", "CUSTOM"]
LOAD_TYPES = ["full", "incremental"]
PUBLISH_MODES = ["append", "merge"]
TABLE_TYPES = ["managed", "external"]
RUNTIME_FIELDS = [
    "source_system", "source_entity", "source_type", "landing_table", "conformance_table",
    "silver_table", "publish_mode",
]
SEVERITY_WORDS = ["error", "critical", "high", "medium", "warn", "warning", "low"]
LEGACY_PATH = r"^(dbfs:)?/mnt/"
ENTITY = ["source_system", "source_entity"]


def load(spark: SparkSession, name: str, folder: str | None = None, table: str | None = None) -> DataFrame:
    """A control table from CSV or the catalog, every cell as text and NULL as empty."""
    if name not in schemas.CONTROL_TABLES:
        raise ConfigError(f"unknown control table {name!r}")
    if table:
        frame = spark.table(table)
    else:
        reader = spark.read.options(header="true", multiLine="true", escape='"')
        frame = reader.csv(f"{folder}/{name}.csv")
    return frame.select(
        *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in frame.columns]
    )


def bootstrap(spark: SparkSession, folder: str, catalog_schema: str, backup: str | None = None) -> None:
    """Create the control tables from CSVs; nothing is written unless all four hold rows."""
    frames = {name: load(spark, name, folder) for name in schemas.CONTROL_TABLES}
    empty = [name for name, frame in frames.items() if frame.isEmpty()]
    if empty:
        raise ConfigError(f"control files without rows: {empty}")
    for name, frame in frames.items():
        frame.write.mode("overwrite").format("parquet").saveAsTable(f"{catalog_schema}.{name}")
        if backup:
            frame.write.mode("overwrite").parquet(f"{backup}/{name}")


def _text(df: DataFrame, name: str) -> Column:
    """Trimmed cell, empty when NULL or when the column is missing."""
    if name not in df.columns:
        return F.lit("")
    return F.trim(F.coalesce(F.col(name).cast("string"), F.lit("")))


def active(df: DataFrame) -> DataFrame:
    """Rows whose is_active is literally true; tables without the flag are active as a whole."""
    if "is_active" not in df.columns:
        return df
    return df.filter(F.lower(_text(df, "is_active")) == "true")


def select_sources(
    registry: DataFrame,
    product_name: str | None = None,
    source_system: str | None = None,
    source_entity: str | None = None,
) -> DataFrame:
    """Active sources that match all given filters; case and outer blanks do not count."""
    chosen = active(registry)
    wanted = {
        "product_name": product_name,
        "source_system": source_system,
        "source_entity": source_entity,
    }
    for name, value in wanted.items():
        if value and value.strip():
            chosen = chosen.filter(F.lower(_text(registry, name)) == value.strip().lower())
    return chosen


def for_entity(
    rows: DataFrame, source_system: str, source_entity: str, product_name: str | None = None
) -> DataFrame:
    return select_sources(rows, product_name, source_system, source_entity)


def row_order() -> Column:
    """Row number of a control file as it was read; control files are single and small."""
    return F.monotonically_increasing_id()


def first_publish_rule(publish: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """First active publish rule per entity, by row number of the control file."""
    rows = active(publish)
    picked = [c for c in rows.columns if c not in (*ENTITY, ordinal)]
    best = rows.groupBy(*ENTITY).agg(
        F.min_by(F.struct(*picked), F.col(ordinal)).alias("rule")
    )
    return best.select(*ENTITY, F.lit(True).alias("rule_found"), *[f"rule.{c}" for c in picked])


def _per_entity(rows: DataFrame, name: str) -> DataFrame:
    return active(rows).groupBy(*ENTITY).agg(F.count(F.lit(1)).alias(name))


def entity_metadata(
    registry: DataFrame, mappings: DataFrame, rules: DataFrame, publish: DataFrame
) -> DataFrame:
    """Per active source: number of mappings and rules, and its first publish rule."""
    zero = F.lit(0).cast("bigint")
    rule = first_publish_rule(publish).select(
        *ENTITY, "rule_found", F.col("publish_mode").alias("rule_mode")
    )
    return (
        active(registry)
        .select("product_name", *ENTITY)
        .join(_per_entity(mappings, "m"), ENTITY, "left")
        .join(_per_entity(rules, "r"), ENTITY, "left")
        .join(rule, ENTITY, "left")
        .select(
            "product_name",
            *ENTITY,
            F.coalesce("m", zero).alias("mapping_count"),
            F.coalesce("r", zero).alias("dq_rule_count"),
            F.coalesce("rule_found", F.lit(False)).alias("publish_rule_found"),
            F.col("rule_mode").alias("publish_rule_mode"),
        )
    )


def missing_headers(df: DataFrame, name: str) -> list[str]:
    return sorted(set(schemas.REQUIRED_HEADERS[name]) - set(df.columns))


def _errors(df: DataFrame, keys: Sequence[str], tests: Sequence[tuple[Column, str]]) -> DataFrame:
    """One (keys, error) row per failed test."""
    found = F.array(*[F.when(bad, F.lit(text)) for bad, text in tests])
    return df.select(*keys, F.explode(found).alias("error")).filter("error is not null")


def _json_kind(cell: Column) -> Column:
    return F.schema_of_variant(F.try_parse_json(cell))


def registry_errors(registry: DataFrame, keys: Sequence[str] = ENTITY) -> DataFrame:
    """Row errors of the source registry."""

    def cell(name: str) -> Column:
        return _text(registry, name)

    def outside(name: str, allowed: list[str], fold) -> tuple[Column, str]:
        return ~fold(cell(name)).isin(allowed), f"{name} must be {'|'.join(allowed)}"

    kind = F.upper(cell("source_type"))
    tests = [
        outside("is_active", ["true", "false"], F.lower),
        outside("source_type", SOURCE_TYPES, F.upper),
        outside("load_type", LOAD_TYPES, F.lower),
        outside("publish_mode", PUBLISH_MODES, F.lower),
    ]
    for layer in ("landing", "conformance", "silver"):
        raw = F.lower(cell(f"{layer}_table_type"))
        table_type = F.when(raw == "", "managed").otherwise(raw)
        path = cell(f"{layer}_table_path")
        external = table_type == "external"
        tests += [
            (~table_type.isin(TABLE_TYPES), f"{layer}_table_type must be managed|external"),
            (external & (path == ""), f"{layer}_table_path is required for external tables"),
            (
                external & F.lower(path).rlike(LEGACY_PATH),
                f"{layer}_table_path must not be a legacy mount path",
            ),
        ]
    for source_type, field in (("FILE", "source_path"), ("JDBC", "jdbc_table"), ("API", "api_endpoint")):
        tests.append(
            ((kind == source_type) & (cell(field) == ""), f"{field} is required for {source_type} sources")
        )
    tests.append(
        (
            (kind == "FILE") & F.lower(cell("source_path")).rlike(LEGACY_PATH),
            "source_path must not be a legacy mount path",
        )
    )
    for name in RUNTIME_FIELDS:
        tests.append((cell(name) == "", f"{name} is missing"))
    options = cell("source_options_json")
    shape = _json_kind(options)
    tests += [
        ((options != "") & shape.isNull(), "invalid source_options_json"),
        (
            (options != "") & shape.isNotNull() & ~shape.startswith("OBJECT"),
            "source_options_json must be a JSON object",
        ),
    ]
    return _errors(registry, keys, tests)


def publish_errors(publish: DataFrame, keys: Sequence[str] = ENTITY) -> DataFrame:
    mode = F.lower(_text(publish, "publish_mode"))
    tests = [
        (~mode.isin(PUBLISH_MODES), "publish_mode must be append|merge"),
        (
            (mode == "merge") & (_text(publish, "merge_key") == ""),
            "merge_key is required when publish_mode=merge",
        ),
    ]
    for name in ("optimize_zorder_json", "partition_columns_json"):
        cell = _text(publish, name)
        shape = _json_kind(cell)
        tests += [
            ((cell != "") & shape.isNull(), f"invalid {name}"),
            (
                (cell != "") & shape.isNotNull() & ~shape.startswith("ARRAY"),
                f"{name} must be a JSON array",
            ),
        ]
    return _errors(publish, keys, tests)


def _repeated(df: DataFrame, scope: Sequence[str], name: str, text: str) -> DataFrame:
    """Errors for values that occur more than once per entity; counted, not windowed."""
    value = _text(df, name)
    many = (
        df.select(*scope, value.alias("__value"))
        .filter(F.col("__value") != "")
        .groupBy(*scope, "__value")
        .agg(F.count(F.lit(1)).alias("__n"))
        .filter("__n > 1")
    )
    return many.select(*scope, F.concat(F.lit(text), F.col("__value")).alias("error"))


def rule_errors(rules: DataFrame, scope: Sequence[str] = ENTITY) -> DataFrame:
    """Errors of active rules: missing fields, unknown severity, repeated names per entity."""
    rows = active(rules)
    severity = F.lower(_text(rules, "severity"))
    tests = [
        (_text(rules, "rule_name") == "", "rule_name is required"),
        (_text(rules, "rule_expression") == "", "rule_expression is required"),
        ((severity != "") & ~severity.isin(SEVERITY_WORDS), "severity must be ERROR|WARN"),
    ]
    repeated = _repeated(rows, scope, "rule_name", "duplicate rule_name: ")
    return _errors(rows, scope, tests).unionAll(repeated)


def mapping_errors(mappings: DataFrame, scope: Sequence[str] = ENTITY) -> DataFrame:
    rows = active(mappings)
    tests = [
        (_text(mappings, name) == "", f"{name} is required")
        for name in ("transform_expression", "conformance_column")
    ]
    repeated = _repeated(rows, scope, "conformance_column", "duplicate conformance_column: ")
    return _errors(rows, scope, tests).unionAll(repeated)


def reference_errors(registry: DataFrame, **tables: DataFrame) -> DataFrame:
    """Entities that a control table names but the registry does not hold.

    All tables and the registry meet in one grouping, so that counts of entities are shuffled, not rows.
    An entity with a NULL part is never held.
    """
    every = registry.select(*ENTITY, F.lit(-1).alias("__table"))
    for at, rows in enumerate(tables.values()):
        every = every.unionAll(rows.select(*ENTITY, F.lit(at).alias("__table")))
    counts = [F.count_if(F.col("__table") == at).alias(f"__n{at}") for at in range(len(tables))]
    grouped = every.groupBy(*ENTITY).agg(F.bool_or(F.col("__table") == -1).alias("__known"), *counts)
    found = F.array(
        *[F.struct(F.lit(name).alias("table_name"), F.col(f"__n{at}").alias("row_count")) for at, name in enumerate(tables)]
    )
    lost = grouped.filter(~F.col("__known") | any_null(ENTITY)).select(*ENTITY, F.explode(found).alias("__found"))
    return lost.select("__found.table_name", *ENTITY, "__found.row_count").filter("row_count > 0")


def _list_cell(column: str) -> Column:
    """Entries of a JSON array cell; a bad cell counts as empty."""
    parsed = F.from_json(F.col(column), "array<string>")
    return F.coalesce(parsed, F.array().cast("array<string>"))


def target_table(registry: DataFrame, publishers: DataFrame) -> DataFrame:
    """Silver target per source: a publisher may override catalog and schema, the source its name.

    ``publishers`` has publisher_name, silver_catalog_name and silver_db_name.
    """
    def filled(name: str) -> Column:
        return F.nullif(F.trim(F.col(name)), F.lit(""))

    part = F.split(F.col("silver_table"), r"\.")
    joined = registry.join(publishers, "publisher_name", "left")
    return joined.select(
        *registry.columns,
        F.concat_ws(
            ".",
            F.coalesce(filled("silver_catalog_name"), F.get(part, 0)),
            F.coalesce(filled("silver_db_name"), F.get(part, 1)),
            F.coalesce(filled("silver_object_name"), filled("silver_file_name"), F.get(part, 2)),
        ).alias("silver_target"),
    )


def publish_plan(registry: DataFrame, publish: DataFrame) -> DataFrame:
    """Mode, merge key, partition and clustering columns per active source."""
    rule = first_publish_rule(publish).select(
        *ENTITY,
        F.col("publish_mode").alias("__mode"),
        F.col("merge_key").alias("__key"),
        _list_cell("partition_columns_json").alias("partition_columns"),
        _list_cell("optimize_zorder_json").alias("zorder_columns"),
    )
    empty = F.array().cast("array<string>")

    def filled(name: str) -> Column:
        return F.nullif(F.trim(F.col(name)), F.lit(""))

    mode = F.lower(F.coalesce(filled("__mode"), filled("publish_mode"), F.lit("append")))
    key = F.when(mode == "merge", F.coalesce(filled("__key"), filled("primary_key")))
    error = (
        F.when(~mode.isin(PUBLISH_MODES), F.concat(F.lit("unsupported publish mode: "), mode))
        .when((mode == "merge") & key.isNull(), "missing merge key")
    )
    return active(registry).join(rule, ENTITY, "left").select(
        *ENTITY,
        mode.alias("publish_mode"),
        key.alias("merge_key"),
        F.coalesce("partition_columns", empty).alias("partition_columns"),
        F.coalesce("zorder_columns", empty).alias("zorder_columns"),
        error.alias("plan_error"),
    )


def dry_run(
    registry: DataFrame, mappings: DataFrame, rules: DataFrame, publish: DataFrame
) -> DataFrame:
    """What a run of each active source would do, without touching its data."""
    counts = entity_metadata(registry, mappings, rules, publish).drop("product_name")
    keys = F.transform(F.split("primary_key", ","), lambda k: F.trim(k))
    pk = F.array_distinct(F.filter(keys, lambda k: k != ""))
    return (
        active(registry)
        .join(counts, ENTITY)
        .select(
            F.concat_ws(".", *ENTITY).alias("source"),
            F.array(
                F.concat(F.lit("ingest via "), "source_type"),
                F.concat(F.lit("write landing "), "landing_table"),
                F.format_string("apply %d mappings", "mapping_count"),
                F.format_string("apply %d dq rules", "dq_rule_count"),
                F.concat(F.lit("publish "), "publish_mode", F.lit(" to "), "silver_table"),
            ).alias("steps"),
            pk.alias("primary_key_columns"),
            (F.size(pk) > 0).alias("primary_key_configured"),
        )
    )
