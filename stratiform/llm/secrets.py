"""Secret scan: trigram queries choose the texts in which each rule is run.

Every Arrow batch of texts is a shard with a trigram inverted index of its own, so nothing is shuffled
and memory is bounded by the batch. Rules without mandatory trigrams are run over every text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiform.llm.common import with_own
from stratiform.llm.trigrams import TrigramIndex, query_of


@dataclass(frozen=True)
class Rule:
    """Leftmost, non-overlapping matches of ``pattern`` of which ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0

    @cached_property
    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern)

    @cached_property
    def query(self):
        return query_of(self.pattern)

    def spans(self, text: str) -> list[tuple[int, int]]:
        found = []
        for match in self.compiled.finditer(text):
            start, end = match.span(self.group)
            if end - start >= self.least:
                found.append(match.span())
        return found


#: The kinds whose counts and digest are agreed on, in the order in which they are listed.
#: A run of the same class of characters that is too short holds no longer one, so a minimum inside
#: the pattern gives the same matches as dropping short ones, and fails faster.
BASE_RULES = (
    Rule("assign", r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
)

#: Public formats of further credentials. What begins with a run of letters begins where the run does, so that
#: a long run is looked through once.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("signed_token", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("url_login", r"(?<![a-z0-9+.-])[a-z][a-z0-9+.-]*://[^\s:@/]+:[^\s:@/]+@"),
    Rule("cloud_key", r"AIza[0-9A-Za-z_-]{35}"),
)

_FOUND = "array<struct<kind:string,start:bigint,end:bigint>>"


def scan_texts(texts: list[str], rules: tuple[Rule, ...]) -> list[list[tuple[str, int, int]]]:
    """Spans (kind, start, end) of every text, by start, then in the order of ``rules``."""
    wanted = frozenset(gram for rule in rules for clause in rule.query for grams in clause for gram in grams)
    index = TrigramIndex(texts, wanted)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for order, rule in enumerate(rules):
        for row in index.candidates(rule.query).tolist():
            found[row] += [(start, order, end) for start, end in rule.spans(texts[row])]
    return [[(rules[order].kind, start, end) for start, order, end in sorted(own)] for own in found]


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES, block: int = 2000) -> DataFrame:
    """Add ``secrets`` to every row: spans (kind, start, end) in code points, end exclusive.

    They are ordered by start, then by the order of ``rules``; spans of different kinds may overlap.
    Null texts count as empty. Extra columns stay; one named ``secrets`` gives way. Repeated rows get
    equal results, an empty table an empty one.
    """

    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            spans = []
            for low in range(0, len(texts), block):
                spans += scan_texts(texts[low : low + block], rules)
            rows = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in own] for own in spans]
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            column = pa.array(rows, batch.schema.field("secrets").type)
            yield pa.RecordBatch.from_arrays([*kept, column], batch.schema.names)

    own = with_own(docs, secrets=F.array().cast(_FOUND))
    return own.mapInArrow(scan, own.schema)


def joined_spans(column: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(
        F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )

