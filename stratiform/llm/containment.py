"""Benchmark decontamination: size-partitioned MinHash containment search.

Short test items are looked for inside documents of any length. Items are partitioned by the size of
their shingle set, to the next power of two. For each partition a document is seen as overlapping
windows of twice that size, so that any passage as long as an item lies within a window and the
Jaccard similarity of the two is not lost in the length of the document. Signatures of windows are
minima over signatures of small blocks, computed once for all partitions. An item and a window that
agree in any minhash are candidates; the exact containment of the item's shingles in the whole
document decides.

At containment ``c`` an item of a partition, which fills more than half of its size, has similarity of at
least ``c / (5 - c)`` with one of the windows, so ``hashes`` functions miss it with probability of at most
``(1 - c / (5 - c)) ** hashes``. In the smallest partition this holds for items of at least ``BASE / 2``
shingles; smaller ones are looked up by their shingles instead, and none is missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.llm.common import WordHashes, minhash_seeds, shingles, with_own, words

BASE = 8  # shingles in the smallest block

_FOUND = "array<struct<item_id:bigint,containment:double,shared:bigint,item_shingles:bigint>>"


@dataclass
class Partition:
    """Items of one size: sorted values (minhashes, or shingles of tiny items), and for each the items that have it."""

    width: int  # blocks of BASE shingles in half a window; 0 for tiny items
    values: np.ndarray
    starts: np.ndarray
    items: np.ndarray
    marks: np.ndarray  # by the upper bits of a value: whether any item can have it

    @classmethod
    def of(cls, width: int, numbers: list[int], values: list[np.ndarray]) -> Partition:
        flat, owner = np.concatenate(values), np.repeat(numbers, [len(own) for own in values])
        order = np.argsort(flat, kind="stable")
        values, starts = np.unique(flat[order], return_index=True)
        bits = min(26, max(10, int(len(values)).bit_length() + 6))
        marks = np.zeros(2**bits, bool)
        marks[values >> np.uint64(64 - bits)] = True
        return cls(width, values, np.append(starts, len(flat)), owner[order], marks)

    def matches(self, signatures: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of ``signatures`` with an item they share a value with."""
        bits = np.uint64(65 - len(self.marks).bit_length())
        row, column = np.nonzero(self.marks[signatures >> bits])
        value = signatures[row, column]
        at = np.minimum(np.searchsorted(self.values, value), len(self.values) - 1)
        hit = self.values[at] == value
        row, at = row[hit], at[hit]
        spans = self.starts[at + 1] - self.starts[at]
        inside = np.arange(spans.sum()) - np.repeat(np.cumsum(spans) - spans, spans)
        return np.repeat(row, spans), self.items[np.repeat(self.starts[at], spans) + inside]


class ItemIndex:
    """A block of test items, ready to be searched for in documents."""

    def __init__(self, items: list[tuple[int, str]], size: int, hashes: int, threshold: float):
        self.size, self.threshold = size, threshold
        self.seeds = minhash_seeds(hashes, 23)
        hashed = WordHashes()
        self.items = [(i, np.unique(shingles(hashed(words(t)), size))) for i, t in items]
        self.items = [(i, own) for i, own in self.items if len(own)]
        by_width: dict[int, list[int]] = {}
        for number, (_, own) in enumerate(self.items):
            width = 1 << max(0, -(-len(own) // BASE) - 1).bit_length() if 2 * len(own) >= BASE else 0
            by_width.setdefault(width, []).append(number)
        tiny = by_width.pop(0, [])
        self.tiny = Partition.of(0, tiny, [self.items[n][1] for n in tiny]) if tiny else None
        self.partitions = [
            Partition.of(width, numbers, [(self.items[n][1][:, None] * self.seeds).min(0) for n in numbers])
            for width, numbers in sorted(by_width.items())
        ]

    def _blocks(self, values: np.ndarray) -> np.ndarray:
        """Signature of every block of BASE values."""
        parts = values.reshape(-1, BASE)
        out = np.empty((len(parts), len(self.seeds)), np.uint64)
        for low in range(0, len(parts), 256):
            out[low : low + 256] = (parts[low : low + 256, :, None] * self.seeds).min(1)
        return out

    def search(self, texts: list[np.ndarray]) -> list[list[tuple]]:
        """For each text, given as its shingles in order, the items it contains."""
        found: list[list[tuple]] = [[] for _ in texts]
        rows = [i for i, own in enumerate(texts) if len(own)]
        if not rows:
            return found
        candidates = set()
        if self.tiny:
            at, item = self.tiny.matches(np.concatenate([texts[i] for i in rows])[:, None])
            owner = np.repeat(np.arange(len(rows)), [len(texts[i]) for i in rows])
            candidates.update(zip(owner[at].tolist(), item.tolist(), strict=True))
        if self.partitions:
            candidates.update(self._by_windows(texts, rows))
        sets: dict[int, np.ndarray] = {}
        for row, item in sorted(candidates):
            if row not in sets:
                sets = {row: np.unique(texts[rows[row]])}
            item_id, own = self.items[item]
            shared = int(np.isin(own, sets[row], assume_unique=True).sum())
            if shared >= self.threshold * len(own) - 1e-9:
                found[rows[row]].append((item_id, shared / len(own), shared, len(own)))
        return [sorted(set(own), key=lambda f: (f[0] is None, f)) for own in found]

    def _by_windows(self, texts: list[np.ndarray], rows: list[int]) -> set[tuple[int, int]]:
        """Places in ``rows`` with an item that agrees with a window of that text in a minhash."""
        counts = np.array([-(-len(texts[i]) // BASE) for i in rows])
        filled = [np.concatenate([texts[i], np.repeat(texts[i][-1:], -len(texts[i]) % BASE)]) for i in rows]
        blocks = self._blocks(np.concatenate(filled))
        firsts = np.cumsum(counts) - counts
        candidates = set()
        for part in self.partitions:
            halves = -(-counts // part.width)
            owner = np.repeat(np.arange(len(rows)), halves)
            inside = np.arange(halves.sum()) - np.repeat(np.cumsum(halves) - halves, halves)
            half = np.minimum.reduceat(blocks, firsts[owner] + inside * part.width, axis=0)
            together = np.flatnonzero(owner[1:] == owner[:-1])
            window = half.copy()
            window[together] = np.minimum(half[together], half[together + 1])
            row, item = part.matches(window)
            candidates.update(zip(owner[row].tolist(), item.tolist(), strict=True))
        return candidates


def contained_items(
    docs: DataFrame, benchmark: DataFrame, size: int = 5, threshold: float = 0.8, hashes: int = 64,
    block_chars: int = 50_000_000, words_at_once: int = 100_000,
) -> DataFrame:
    """Add ``items`` to every document: the benchmark items it contains.

    An item counts as contained if at least ``threshold`` of its distinct ``size``-word shingles occur
    anywhere in the document. ``items`` is an array of (item_id, containment, shared, item_shingles),
    by ``item_id``. Documents are neither shuffled nor dropped. Items are sent to the executors in
    blocks of about ``block_chars`` characters, each of which passes over the documents once.

    Words are runs of letters and digits in lower case. An item with fewer words than ``size`` is one
    shingle of all its words and is found in documents of just these words; items and texts that are
    null or hold no word match nothing. Repeated items with one id and text count once. Extra columns
    stay; one named ``items`` gives way.
    """
    read = benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("long"), "text")
    total = read.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-total // block_chars)
    result = with_own(docs, items=F.array().cast(_FOUND))
    for block in range(blocks):
        part = read.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        result = _searched(result, ItemIndex([tuple(r) for r in part.collect()], size, hashes, threshold), words_at_once)
    return result


def _searched(docs: DataFrame, index: ItemIndex, words_at_once: int) -> DataFrame:
    def search(batches: Iterator) -> Iterator:
        import pyarrow as pa

        hashed = WordHashes()
        names = ("item_id", "containment", "shared", "item_shingles")
        for batch in batches:
            found: list[list[tuple]] = []
            waiting, held = [], 0
            for text in batch.column("text").to_pylist():
                waiting.append(shingles(hashed(words(text)), index.size))
                held += len(waiting[-1])
                if held >= words_at_once:
                    found += index.search(waiting)
                    waiting, held = [], 0
            found += index.search(waiting)
            before = batch.column("items").to_pylist()
            merged = [[*old, *[dict(zip(names, f, strict=True)) for f in new]] for old, new in zip(before, found, strict=True)]
            items = pa.array(merged, batch.schema.field("items").type)
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, items], batch.schema.names)

    return docs.mapInArrow(search, docs.schema)
