"""Clustering of a published table along a Z-order curve."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Z_COLUMN = "z_value"
_TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def _as_number(df: DataFrame, name: str) -> Column:
    """Order-preserving number of a column that is no text."""
    kind = df.schema[name].dataType
    if isinstance(kind, _TIMES):
        return F.unix_timestamp(F.col(name)).cast("double")
    return F.col(name).cast("double")


def _spread() -> Column:
    """Number that splits rows sharing a range key; the same for a row each time a task runs."""
    return F.xxhash64(F.spark_partition_id())


def _ranged(df: DataFrame, keys: Sequence[str], files: int | None) -> DataFrame:
    """Range-partition by the keys, with a last key that splits equal ones over several tasks."""
    spread = df.withColumn("__spread", _spread())
    columns = [F.col(k) for k in (*keys, "__spread")]
    ranged = spread.repartitionByRange(files, *columns) if files else spread.repartitionByRange(*columns)
    return (ranged.sortWithinPartitions(*keys) if keys else ranged).drop("__spread")


#: Values that are looked at to place the cells of a text column; numbers are summed up natively.
SAMPLE_VALUES = 20_000


def cell_bounds(df: DataFrame, columns: Sequence[str], bits: int) -> list[list]:
    """For each column the values that cut its rows into up to ``2 ** bits`` cells of even size.

    Outliers and common prefixes take no cells away, as cells follow the rows, not the range.
    """
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    texts = [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]
    numbers = [c for c in columns if c not in texts]
    found = {}
    if numbers:
        row = df.agg(*[F.percentile_approx(_as_number(df, c), shares, 10_000).alias(f"b{i}") for i, c in enumerate(numbers)]).first()
        found = {c: sorted(set(row[f"b{i}"] or [])) for i, c in enumerate(numbers)}
    if texts:
        total = df.agg(F.count(F.lit(1))).first()[0]
        # Twice what is wanted on average; the limit bounds what comes to the driver.
        some = df.select(*texts).sample(min(1.0, 2 * SAMPLE_VALUES / max(total, 1)), seed=1).limit(4 * SAMPLE_VALUES).collect()
        for c in texts:
            values = sorted(r[c] for r in some if r[c] is not None)
            found[c] = sorted({values[int(share * len(values))] for share in shares}) if values else []
    return [found[c] for c in columns]


def _cell(value: Column, bounds: Sequence) -> Column:
    """How many bounds lie below the value, by a search tree of comparisons; NULL is in cell 0."""

    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low).cast("bigint")
        middle = (low + high) // 2
        return F.when(value > F.lit(bounds[middle]), between(middle + 1, high)).otherwise(between(low, middle))

    return between(0, len(bounds))


def bits_for(columns: Sequence[str], bits: int = 6) -> int:
    if not columns:
        raise ValueError("need at least one column")
    return max(1, min(bits, 62 // len(columns)))


def _step(value: Column, low: float | None, high: float | None, bits: int) -> Column:
    """Number of the step of even width between the lowest and the highest value; NULL is in step 0."""
    if low is None or low == high:
        return F.lit(0).cast("bigint")
    share = (value - F.lit(low)) / F.lit(high - low)
    return F.coalesce(F.floor(share * F.lit(float((1 << bits) - 1))), F.lit(0)).cast("bigint")


def _interleaved(cells: Sequence[Column], bits: int) -> Column:
    z = F.lit(0).cast("bigint")
    for i, cell in enumerate(cells):
        for bit in range(bits):
            one = F.shiftright(cell, bit).bitwiseAND(F.lit(1).cast("bigint"))
            z = z + F.shiftleft(one, bit * len(cells) + i)
    return z


def with_cells(df: DataFrame, columns: Sequence[str], cells: Sequence[Sequence] | None = None, bits: int = 6) -> DataFrame:
    """Add the Z-value over the columns' cells: ``cells`` has the bounds that earlier rows got, else they follow the rows."""
    bits = bits_for(columns, bits)
    found = [
        _cell(F.col(name) if isinstance(df.schema[name].dataType, T.StringType) else _as_number(df, name), bounds)
        for name, bounds in zip(columns, cells or cell_bounds(df, columns, bits))
    ]
    return df.withColumn(Z_COLUMN, _interleaved(found, bits))


def with_steps(df: DataFrame, columns: Sequence[str], bits: int = 10) -> DataFrame:
    """Add the Z-value over steps of even width of number and time columns, which follow from their ranges alone."""
    bits = bits_for(columns, bits)
    numbers = [_as_number(df, name) for name in columns]
    ends = df.agg(*[f(n).alias(f"{label}{i}") for i, n in enumerate(numbers) for label, f in (("low", F.min), ("high", F.max))]).first()
    steps = [_step(n, ends[f"low{i}"], ends[f"high{i}"], bits) for i, n in enumerate(numbers)]
    return df.withColumn(Z_COLUMN, _interleaved(steps, bits))


def packed(
    df: DataFrame, columns: Sequence[str], partitions: Sequence[str] = (), files: int | None = None,
    cells: Sequence[Sequence] | None = None,
) -> DataFrame:
    """Rows in even output partitions: by table partition first, then along the Z-order curve, and
    within a cell by the columns themselves.

    The Z-value stays as a column when there is one.
    """
    if not columns:
        return _ranged(df, list(partitions), files)
    return _ranged(with_cells(df, columns, cells), [*partitions, Z_COLUMN, *columns], files)
