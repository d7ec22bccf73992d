"""Registered queries over the given tables, each with its SQL counterpart where there is one."""

from stratiform.queries.registry import load_all, oracles, queries

__all__ = ["load_all", "oracles", "queries"]
