"""Comparing two frames by their rows: fingerprints that ignore order, and the rows that differ.

Counts agree when one row is lost and another one doubled; fingerprints do not. Rows are found by descending
in ranges of their hash: only ranges whose fingerprints differ are looked at further, so that two
nearly equal frames of any size shuffle a few thousand range sums and a few rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.operators.keyed import measure

#: Bits of the hash by which a level of the descent cuts ranges, and the number of levels.
LEVEL_BITS, LEVELS = 12, 2


def _parts(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Each column beside whether it is NULL, as a hash skips NULLs; maps by their sorted entries, variants as JSON."""
    found: list[Column] = []
    for name in columns:
        column, kind = F.col(f"`{name}`"), df.schema[name].dataType
        if isinstance(kind, T.MapType):
            column = F.array_sort(F.map_entries(column))
        elif isinstance(kind, T.VariantType):
            column = F.to_json(column)
        found += [column, column.isNull()]
    return found


def row_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    return F.xxhash64(*_parts(df, columns))


def _sums(first: Column, second: Column) -> list[Column]:
    wide = "decimal(38,0)"
    return [
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(first.cast(wide)), F.lit(0).cast(wide)).alias("sum_1"),
        F.coalesce(F.sum(second.cast(wide)), F.lit(0).cast(wide)).alias("sum_2"),
    ]


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: number of rows, and two sums of independent row hashes, which depend on no order."""
    columns = list(columns or df.columns)
    parts = _parts(df, columns)
    return df.agg(*_sums(F.xxhash64(*parts), F.xxhash64(F.lit("second"), *parts)))


def same_content(left: DataFrame, right: DataFrame, columns: Sequence[str] | None = None) -> bool:
    columns = list(columns or left.columns)
    return tuple(fingerprint(left, columns).first()) == tuple(fingerprint(right, columns).first())


def differing_rows(left: DataFrame, right: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows that the two frames do not hold equally often: the columns, left_rows, right_rows."""
    columns = list(columns or left.columns)
    sides = []
    for side, frame in enumerate((left, right)):
        own = frame.select(*[F.col(f"`{c}`") for c in columns])
        parts = _parts(own, columns)
        sides.append(own.withColumns({"__h": F.xxhash64(*parts), "__g": F.xxhash64(F.lit("second"), *parts), "__side": F.lit(side)}))
    scope = [s for s in sides]
    for level in range(1, LEVELS + 1):
        shift = 64 - level * LEVEL_BITS
        place = F.shiftrightunsigned("__h", shift)
        sums = [s.groupBy(place.alias("__range")).agg(*_sums(F.col("__h"), F.col("__g"))) for s in scope]
        names = ["rows", "sum_1", "sum_2"]
        other = sums[1].select("__range", *[F.col(n).alias(f"other_{n}") for n in names])
        equal = F.lit(True)
        for n in names:
            equal = equal & F.col(n).eqNullSafe(F.col(f"other_{n}"))
        ranges = measure(sums[0].join(other, "__range", "full").where(~equal).select("__range"), "differing-ranges")
        side = F.broadcast(ranges.frame) if ranges.fits_broadcast else ranges.frame
        scope = [s.withColumn("__range", place).join(side, "__range", "left_semi").drop("__range") for s in sides]
    both = scope[0].unionByName(scope[1])
    held = [F.count_if(F.col("__side") == n).alias(f"{name}_rows") for n, name in enumerate(("left", "right"))]
    # Rows of one hash pair are equal; any of them stands for all.
    found = both.groupBy("__h", "__g").agg(*[F.first(f"`{c}`").alias(c) for c in columns], *held)
    return found.where("left_rows <> right_rows").drop("__h", "__g")
