"""Snapshot export."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stratiform.errors import ConfigError

# Export formats, modes, and path prefixes that are refused.
FORMATS = ("parquet", "csv", "json", "orc")
MODES = ("overwrite", "append")
LEGACY_PREFIXES = ("/mnt/", "dbfs:/mnt/")
MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"  # text formats would cut to milliseconds by default


def is_legacy_path(path: str) -> bool:
    return path.strip().lower().startswith(LEGACY_PREFIXES)


def export(
    df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", files: int | None = None
) -> str:
    """Write a snapshot of a frame. ``files`` merges partitions without a shuffle."""
    kind = fmt.strip().lower()
    if kind not in FORMATS:
        raise ConfigError(f"export format must be one of {FORMATS}, got {fmt!r}")
    if mode not in MODES:
        raise ConfigError(f"export mode must be one of {MODES}, got {mode!r}")
    if is_legacy_path(path):
        raise ConfigError(f"legacy mount path is not allowed: {path!r}")
    if files is not None and files <= 0:
        raise ConfigError("files must be positive")
    writer = (df.coalesce(files) if files else df).write.mode(mode).format(kind)
    if kind == "csv":
        writer = writer.option("header", "true")
    if kind in ("csv", "json"):
        writer = writer.options(timestampFormat=MICROS + "XXX", timestampNTZFormat=MICROS)
    writer.save(path)
    return path
