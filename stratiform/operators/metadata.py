"""Validation of metadata: rows that declare mappings or rules, and nested configurations.

Both are described as data and checked by one walker each, so a new field or key is a new entry.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

# Texts that switch a metadata row off.
INACTIVE = frozenset({"false", "0", "n", "no"})


def cell(row: Mapping[str, Any], name: str) -> str:
    """Trimmed text of a cell; a missing one is empty."""
    value = row.get(name)
    return "" if value is None or value is False else str(value).strip()


def is_active(row: Mapping[str, Any]) -> bool:
    """Whether a metadata row counts; a missing flag does, an explicit no does not."""
    flag = row.get("is_active")
    if flag is None:
        return True
    return flag.strip().lower() not in INACTIVE if isinstance(flag, str) else bool(flag)


@dataclass(frozen=True)
class RowShape:
    """What the active rows of a metadata list must look like."""

    noun: str
    filled: tuple[str, ...]
    named_by: str
    choices: Mapping[str, frozenset[str]] = field(default_factory=dict)

    def problems(self, rows: Sequence[Any]) -> list[str]:
        strange = [f"{self.noun} {n}: not a mapping" for n, row in enumerate(rows, 1) if not isinstance(row, Mapping)]
        active = {n: row for n, row in enumerate(rows, 1) if isinstance(row, Mapping) and is_active(row)}
        blanks = {n: [f for f in self.filled if not cell(row, f)] for n, row in active.items()}
        lacking = [f"{self.noun} {n}: {', '.join(names)} not filled in" for n, names in blanks.items() if names]
        whole = {n: row for n, row in active.items() if not blanks[n]}
        uses = Counter(cell(row, self.named_by) for row in whole.values())
        repeated = [f"{self.named_by} {name!r} is used by {times} {self.noun} rows" for name, times in uses.items() if times > 1]
        unknown = [
            f"{self.noun} {n}: {name} {row[name]!r} is none of {sorted(allowed)}"
            for n, row in whole.items()
            for name, allowed in self.choices.items()
            if cell(row, name) and cell(row, name).lower() not in allowed
        ]
        return strange + lacking + repeated + unknown


@dataclass(frozen=True)
class Value:
    """Shape of one value in a configuration; None is always allowed.

    ``kind``: list, dict, str, int or float. ``low``, ``high``: bounds of a number. ``keys``: shapes of
    the known entries of an object; ``each``: the shape of all its entries.
    """

    kind: type
    low: float | None = None
    high: float | None = None
    keys: Mapping[str, Value] = field(default_factory=dict)
    each: Value | None = None

    def problems(self, where: str, value: Any) -> Iterator[str]:
        if value is None:
            return
        if self.kind in (int, float):
            yield from self._number(where, value)
        elif not isinstance(value, self.kind):
            yield f"{where} must be {_NOUNS[self.kind]}"
        elif self.kind is dict:
            for name, inner in value.items():
                if shape := self.keys.get(name, self.each):
                    yield from shape.problems(f"{where}.{name}", inner)

    def _number(self, where: str, value: Any) -> Iterator[str]:
        try:
            number = self.kind(value)
        except (TypeError, ValueError):
            yield f"{where} must be {_NOUNS[self.kind]}"
            return
        under = self.low is not None and not number >= self.low
        over = self.high is not None and not number <= self.high
        if under or over:
            both = self.low is not None and self.high is not None
            yield f"{where} must be " + (f"between {self.low:g} and {self.high:g}" if both else f">= {self.low:g}" if under else f"<= {self.high:g}")


# How messages name the shapes.
_NOUNS = {list: "a list", dict: "an object", str: "a string", int: "an integer", float: "numeric"}
