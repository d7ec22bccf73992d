"""Business rules and primary-key checks on conformed data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiform.errors import ConfigError, RuleError
from stratiform.functions.columns import all_labels, any_null
from stratiform.operators.keyed import COPIES, flag_keys, key_counts, measure
from stratiform.operators.metadata import RowShape, cell, is_active

# Names of the key rules, and severities as metadata spells them.
PK_NOT_NULL = "primary_key_not_null"
PK_UNIQUE = "primary_key_unique"
SEVERITIES = {
    "error": "ERROR", "critical": "ERROR", "high": "ERROR", "medium": "ERROR",
    "warn": "WARN", "warning": "WARN", "low": "WARN",
}

RULE_ROWS = RowShape("rule", ("rule_name", "rule_expression"), "rule_name", {"severity": frozenset(SEVERITIES)})


@dataclass(frozen=True)
class Rule:
    name: str
    expression: str
    severity: str


def parse(rows: Sequence[Mapping[str, Any]]) -> list[Rule]:
    errors = RULE_ROWS.problems(rows)
    if errors:
        raise ConfigError(f"invalid rule metadata: {errors}")
    return [
        Rule(cell(row, "rule_name"), cell(row, "rule_expression"), SEVERITIES[cell(row, "severity").lower() or "error"])
        for row in rows
        if is_active(row)
    ]


def key_columns(primary_key: str | Sequence[str] | None) -> list[str]:
    """Columns of a comma-separated key, trimmed, without repeats, in order."""
    if not primary_key:
        return []
    parts = primary_key.split(",") if isinstance(primary_key, str) else primary_key
    return list(dict.fromkeys(p.strip() for p in parts if p.strip()))


def flag_duplicates(df: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """Flag all rows whose key occurs more than once; NULL keys count as equal."""
    repeated = key_counts(df, keys).filter(F.col(COPIES) > 1)
    return flag_keys(df, measure(repeated, "repeated-keys"), keys, flag)


def apply(
    df: DataFrame,
    rules: Sequence[Mapping[str, Any]] = (),
    primary_key: str | Sequence[str] | None = None,
) -> DataFrame:
    """Add dq_status, dq_failed_rule and dq_warn_rule.

    Key checks come first, then rules in metadata order. An expression that is NULL passes.
    """
    parsed = parse(rules)
    keys = key_columns(primary_key)
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ConfigError(f"primary key columns not in the frame: {missing}")

    failing: list[tuple[str, Column]] = []
    checked = df
    if keys:
        checked = flag_duplicates(df, keys, "__repeated")
        failing = [(PK_NOT_NULL, any_null(keys)), (PK_UNIQUE, F.col("__repeated"))]
    failing += [(r.name, ~F.expr(r.expression)) for r in parsed if r.severity == "ERROR"]
    warning = [(r.name, ~F.expr(r.expression)) for r in parsed if r.severity == "WARN"]
    try:
        named = checked.select(
            *df.columns,
            all_labels(failing).alias("dq_failed_rule"),
            all_labels(warning).alias("dq_warn_rule"),
        )
    except Exception as exc:
        raise RuleError(f"a rule expression does not resolve: {exc}") from exc
    status = F.when(F.col("dq_failed_rule").isNull(), "PASS").otherwise("FAIL")
    return named.select(*df.columns, status.alias("dq_status"), "dq_failed_rule", "dq_warn_rule")


def _need_status(df: DataFrame) -> None:
    if "dq_status" not in df.columns:
        raise ConfigError("dq_status is missing: apply the rules first")


def passed(df: DataFrame) -> DataFrame:
    _need_status(df)
    return df.filter(F.col("dq_status") == "PASS")


def failed(df: DataFrame) -> DataFrame:
    _need_status(df)
    return df.filter(F.col("dq_status") == "FAIL")


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return passed(df), failed(df)


def key_failure_columns() -> list[Column]:
    """Aggregates counting the rows that carry each key rule."""
    return [
        F.count_if(F.col("dq_failed_rule").contains(rule)).alias(rule)
        for rule in (PK_NOT_NULL, PK_UNIQUE)
    ]


def key_failures(df: DataFrame) -> DataFrame:
    return df.agg(*key_failure_columns())
