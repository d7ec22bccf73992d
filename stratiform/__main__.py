"""Run sources from control files: ``python -m stratiform --config-dir conf [--execute]``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from stratiform import schemas
from stratiform.plans import control, flow, spec

#: Columns of a registry row that name a source, in the order of ``flow.last_watermark``.
SOURCE_NAME = ("source_system", "source_entity", "tenant", "product_name")


def _print(frame: DataFrame) -> None:
    """Every row, one after the other as it comes."""
    print(*frame.columns, sep="\t")
    for row in frame.toLocalIterator():
        print(*["" if v is None else v for v in row], sep="\t")


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="stratiform")
    parser.add_argument("--config-dir", required=True, help="folder with the four control CSVs")
    parser.add_argument("--product-name")
    parser.add_argument("--source-system")
    parser.add_argument("--source-entity")
    parser.add_argument("--audit-schema", help="catalog.schema that receives the audit tables")
    parser.add_argument("--checkpoint-root", help="folder for the state of streaming sources")
    parser.add_argument("--publishers", help="CSV of publisher_name, silver_catalog_name, silver_db_name")
    parser.add_argument("--no-optimize", action="store_true", help="leave small files as they are after a publish")
    parser.add_argument("--execute", action="store_true", help="without it only the plan is shown")
    parser.add_argument("--fail-fast", action="store_true")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.getOrCreate()
    frames = {name: control.load(spark, name, args.config_dir) for name in schemas.CONTROL_TABLES}
    registry, mappings, rules, publish = frames.values()
    if not args.execute:
        chosen = control.select_sources(registry, args.product_name, args.source_system, args.source_entity)
        numbered = publish.withColumn("ordinal", control.row_order())
        _print(control.dry_run(chosen, mappings, rules, numbered))
        return 0
    names = flow.AuditTables.__dataclass_fields__ if args.audit_schema else ()
    tables = flow.AuditTables(**{n: f"{args.audit_schema}.{n}" for n in names})
    specs = spec.from_control(
        spark, *frames.values(), product_name=args.product_name,
        source_system=args.source_system, source_entity=args.source_entity,
        checkpoint_root=args.checkpoint_root, optimize=not args.no_optimize,
        start=lambda row: flow.last_watermark(spark, tables, *[row.get(k) or "" for k in SOURCE_NAME]),
        publishers=spark.read.csv(args.publishers, header=True) if args.publishers else None,
    )
    report = flow.run_all(spark, specs, tables, fail_fast=args.fail_fast)
    _print(report)
    return 0 if report.filter("status <> 'SUCCESS'").isEmpty() else 1


if __name__ == "__main__":
    raise SystemExit(main())
