"""Token counts by a linear longest-match automaton.

A word is cut greedily into the longest vocabulary entries, the first with the word-start mark. The
automaton is the trie of the vocabulary. Each of its nodes has a failure link, the node reached after
the longest entries at its start have been taken off, and the number of entries taken off on the way.
A word's length in pieces is then a sum of such numbers along one pass over its bytes: no byte is read
twice and no piece is built.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.llm.common import with_own

#: Runs of letters, marks and digits, or single other characters that are not blank.
WORDS = re.compile(r"[^\W_]+|[^\s]")


class PieceCounter:
    """Greedy piece counts over ``pieces`` (byte strings, of which single bytes must all be entries).

    Every word is preceded by ``start``, as in vocabularies whose word-initial entries begin with it.
    """

    def __init__(self, pieces: list[bytes], start: bytes = b" "):
        self.start = start
        entries = {p for p in pieces if p}
        if missing := [b for b in range(256) if bytes([b]) not in entries]:
            raise ValueError(f"{len(missing)} single bytes are no entries, so some texts could not be cut")
        #: node * 256 + byte to node; nodes are numbered from the root, 0, in the order they are met.
        self.moves: dict[int, int] = {}
        ends = [False]
        for entry in sorted(entries):
            node = 0
            for byte in entry:
                key = node << 8 | byte
                node = self.moves.get(key, -1)
                if node < 0:
                    node = self.moves[key] = len(ends)
                    ends.append(False)
            ends[node] = True
        self.fail, self.popped = self._links(ends)
        self.known: dict[str, int] = {}

    def _links(self, ends: list[bool]) -> tuple[list[int], list[int]]:
        """Failure node and number of entries popped on the way to it, for every node.

        A node whose string is an entry pops it whole and falls to the root. Any other node does what
        its parent would, then follows its last byte, failing on where that cannot be followed.
        """
        fail, popped = [0] * len(ends), [0] * len(ends)
        children: list[list[tuple[int, int]]] = [[] for _ in ends]
        for key, node in self.moves.items():
            children[key >> 8].append((key & 255, node))
        level = [0]
        while level:
            below = []
            for parent in level:
                for byte, node in children[parent]:
                    below.append(node)
                    if ends[node]:
                        popped[node] = 1
                        continue
                    at, count = fail[parent], popped[parent]
                    while (to := self.moves.get(at << 8 | byte, -1)) < 0:
                        count += popped[at]
                        at = fail[at]
                    fail[node], popped[node] = to, count
            level = below
        return fail, popped

    def pieces(self, word: bytes) -> int:
        """Number of pieces of one word, the start mark included in ``word``."""
        moves, fail, popped = self.moves, self.fail, self.popped
        node = count = 0
        for byte in word:
            while (to := moves.get(node << 8 | byte, -1)) < 0:
                count += popped[node]
                node = fail[node]
            node = to
        while node:
            count += popped[node]
            node = fail[node]
        return count

    def counts(self, words: list[str], limit: int = 400_000) -> np.ndarray:
        """Counts of many words; each distinct word passes through the automaton once."""
        known = self.known
        missing = set(words).difference(known)
        if len(known) > limit:
            known.clear()
            missing = set(words)
        for word in missing:
            known[word] = self.pieces(self.start + word.encode("utf-8", "surrogatepass"))
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))


def vocabulary(name: str) -> list[bytes]:
    import public_tokenizers

    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines]


_COUNTERS: dict[tuple[str, bytes], PieceCounter] = {}


def counter(name: str, start: bytes) -> PieceCounter:
    """One automaton for each worker process, built from the vocabulary's file when first needed."""
    if (name, start) not in _COUNTERS:
        _COUNTERS[name, start] = PieceCounter(vocabulary(name), start)
    return _COUNTERS[name, start]


def token_counts(docs: DataFrame, name: str = "byte_bpe_50k", start: bytes = b" ", words_at_once: int = 200_000) -> DataFrame:
    """Add ``n_words`` and ``n_tokens`` to every row.

    Words are runs of letters and digits, and single other characters; blanks only part them. A word
    counts as many tokens as the greedy longest match over the vocabulary's entries has pieces. Null
    and empty texts have none of either. Extra columns stay; ones named like an own column give way.
    Repeated rows get equal results, an empty table an empty one. Nothing is shuffled.
    """

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        automaton = counter(name, start)
        for batch in batches:
            sizes: list[int] = []
            totals: list[np.ndarray] = []
            waiting: list[str] = []
            lengths: list[int] = []

            def flush() -> None:
                if lengths:
                    sums = np.concatenate([[0], np.cumsum(automaton.counts(waiting))])  # noqa: B023
                    ends = np.cumsum(lengths)  # noqa: B023
                    totals.append(sums[ends] - sums[ends - np.array(lengths)])  # noqa: B023
                    sizes.extend(lengths)  # noqa: B023
                waiting.clear(), lengths.clear()  # noqa: B023

            for text in batch.column("text").to_pylist():
                found = WORDS.findall(text) if text else []
                waiting.extend(found)
                lengths.append(len(found))
                if len(waiting) >= words_at_once:
                    flush()
            flush()
            tokens = np.concatenate(totals) if totals else np.zeros(0, np.int64)
            kept = [batch.column(i) for i in range(batch.num_columns - 2)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64())], batch.schema.names)

    own = with_own(docs, n_words=F.lit(0).cast("long"), n_tokens=F.lit(0).cast("long"))
    return own.mapInArrow(count, own.schema)
