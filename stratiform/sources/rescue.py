"""Schema evolution of JSON lines: what happens to keys the schema does not know."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.errors import ConfigError
from stratiform.sources.options import EVOLUTION_MODES

RESCUED = "_rescued_data"


def _unknown(line: Column, known: list[str]) -> Column:
    pairs = F.from_json(line, "map<string,string>")
    return F.map_filter(pairs, lambda key, _: ~key.isin(known))


def _rescued(line: Column, parsed: Column, record: T.StructType) -> Column:
    """What the record does not hold of a line: unknown keys and values of another type, as JSON; a
    line that is no JSON object as it is."""
    pairs = F.from_json(line, "map<string,string>")
    known = record.fieldNames()
    empty = F.array_compact(F.array(*[F.when(parsed.getField(k).isNull(), F.lit(k)) for k in known]))
    left = F.map_filter(pairs, lambda key, value: ~key.isin(known) | (value.isNotNull() & F.array_contains(empty, key)))
    whole = F.when(F.length(F.trim(line)) > 0, line)
    return F.when(pairs.isNull(), whole).when(F.size(left) > 0, F.to_json(left))


def parse_lines(
    df: DataFrame, line: str, schema: T.StructType | str, mode: str = "none"
) -> DataFrame:
    """Parse JSON lines under a schema.

    *none* drops unknown keys, *failOnNewColumns* stops the query at the first one, *rescue* keeps
    them as JSON in ``_rescued_data``, with values that do not fit their column's type, and keeps there
    what is no JSON object. *addNewColumns* parses like *none*: new columns join the
    schema when a stream starts again (see ``widened_schema``).
    """
    if mode not in EVOLUTION_MODES:
        raise ConfigError(f"schema evolution mode must be one of {EVOLUTION_MODES}, got {mode!r}")
    record = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    others = [c for c in df.columns if c != line]
    text = F.col(line)
    parsed = F.from_json(text, record)
    known = record.fieldNames()
    if mode in ("none", "addNewColumns"):
        return df.select(*others, parsed.alias("__r")).select(*others, "__r.*")
    if mode == "rescue":
        rows = df.select(*others, text.alias("__line"), parsed.alias("__r"))
        kept = _rescued(F.col("__line"), F.col("__r"), record)
        return rows.select(*others, "__r.*", kept.alias(RESCUED))
    extra = _unknown(text, known)
    names = F.array_join(F.map_keys(extra), ",")
    stop = F.raise_error(F.concat(F.lit("unknown columns: "), names))
    checked = F.when(F.coalesce(F.size(extra), F.lit(0)) > 0, stop.cast("string")).otherwise(text)
    return df.select(*others, F.from_json(checked, record).alias("__r")).select(*others, "__r.*")


def widened_schema(
    df: DataFrame, line: str, schema: T.StructType | str, most: int | None = None
) -> T.StructType:
    """The schema plus every top-level key seen in the lines, new keys as text.

    The keys are gathered by a distinct aggregation; only new names reach the driver. ``most`` refuses
    lines whose keys are data rather than columns: more new names than that are an error.
    """
    record = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    keys = df.select(F.explode(F.json_object_keys(line)).alias("key"))
    fresh = keys.filter(~F.col("key").isin(record.fieldNames())).distinct()
    names = sorted(r.key for r in (fresh if most is None else fresh.limit(most + 1)).collect())
    if most is not None and len(names) > most:
        raise ConfigError(f"more than {most} new columns")
    return T.StructType(record.fields + [T.StructField(k, T.StringType()) for k in names])
