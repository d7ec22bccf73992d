"""Layered loading, quality checks, upsert publishing and run monitoring as Spark plans."""

__version__ = "0.1.0"
