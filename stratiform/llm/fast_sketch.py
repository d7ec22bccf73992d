"""Near duplicates by fast similarity sketching, banding and exact verification.

1. A text is the set of its hashed word shingles. Its sketch has ``bands * rows`` coordinates. In each
   round every shingle is thrown into one coordinate with a value that grows with the round; rounds go
   on until every coordinate is filled, and after as many rounds as there are coordinates the i-th next
   round throws all shingles into coordinate i, so that each is filled for certain. Two sketches agree
   in a coordinate with a probability equal to the Jaccard similarity, and their number of agreeing
   coordinates is concentrated as if coordinates were independent, at the cost of one pass over the
   shingles instead of one for each coordinate.
2. Equal sets are one node. Nodes that agree in a band share a bucket.
3. Buckets are settled by exact comparison: at first every node is compared with the first node of one
   of its buckets, which joins most copies at one comparison each. Buckets that still hold several
   components are looked at with the whole sketches: components are plausible partners if some pair of
   their nodes agrees in enough coordinates. Only what is connected by plausible pairs is compared pair by
   pair, in blocks, inside tasks. What leaves a task are spanning links, never the pairs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiform.llm.common import WordHashes, minhash_seeds, mix, shingles, shuffle_partitions, staged
from stratiform.llm.components import connected_components
from stratiform.llm.line_dedup import LOWER, UPPER
from stratiform.llm.ngram_join import shared_counts, smallest_connected

#: What parts words, and the letters that are lower-cased.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
_TO_LOWER = str.maketrans(UPPER, LOWER)


def shingle_set(text: str | None, size: int, hashes: WordHashes) -> np.ndarray:
    return np.unique(shingles(hashes(WORD.findall(text.translate(_TO_LOWER)) if text else []), size))


class Sketcher:
    """Fast similarity sketches of ``count`` coordinates; a value holds its round in the upper half."""

    def __init__(self, count: int, seed: int = 12):
        self.count, self.odd = count, minhash_seeds(2 * count, seed)

    def _thrown(self, values: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Coordinates and values of all ``values`` in the rounds from ``low`` to ``high``."""
        rounds = np.arange(low, high, dtype=np.uint64)
        drawn = mix(values[None, :] * self.odd[low:high, None] + rounds[:, None])
        if high <= self.count:
            at = ((drawn >> np.uint64(32)) * np.uint64(self.count)) >> np.uint64(32)
        else:
            at = np.broadcast_to(rounds[:, None] - np.uint64(self.count), drawn.shape)
        return at.astype(np.int64).ravel(), ((rounds[:, None] << np.uint64(32)) | (drawn & np.uint64(0xFFFFFFFF))).ravel()

    def __call__(self, values: np.ndarray, cells: int = 1 << 20) -> np.ndarray:
        """Sketch of a non-empty set. Values of later rounds are larger, so throwing rounds together changes nothing."""
        empty = np.uint64(2**64 - 1)
        sketch = np.full(self.count, empty)
        wanted = int(self.count * (np.log(self.count) + 3) / len(values)) + 1
        low = 0
        while low < 2 * self.count and (sketch == empty).any():
            high = min(low + max(1, min(wanted, cells // len(values))), self.count if low < self.count else 2 * self.count)
            for start in range(0, len(values), cells):
                at, thrown = self._thrown(values[start : start + cells], low, high)
                np.minimum.at(sketch, at, thrown)
            low = high
        return sketch


def sketched(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """For every row: number of distinct shingles, fingerprint of the set, band hashes, a byte of every coordinate."""

    def sketch(batches: Iterator) -> Iterator:
        import pyarrow as pa

        hashes, sketcher = WordHashes(), Sketcher(bands * rows)
        number = np.arange(1, bands + 1, dtype=np.uint64)
        for batch in batches:
            counts, ones, twos, buckets, signatures = [], [], [], [], []
            for text in batch.column("text").to_pylist():
                own = shingle_set(text, size, hashes)
                counts.append(len(own))
                ones.append(int(mix(own + np.uint64(1)).sum(dtype=np.uint64).view(np.int64)))
                twos.append(int(mix(own ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64)))
                if not len(own):
                    buckets.append(None)
                    signatures.append(None)
                    continue
                values = mix(sketcher(own))
                total = number
                for part in values.reshape(bands, rows).T:
                    total = mix(total * np.uint64(0x9E3779B97F4A7C15) + part)
                buckets.append(total.view(np.int64))
                signatures.append((values & np.uint64(255)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("text_hash"), pa.array(counts, pa.int64()), pa.array(ones, pa.int64()),
                    pa.array(twos, pa.int64()), pa.array(buckets, pa.list_(pa.int64())), pa.array(signatures, pa.binary()),
                ],
                ["doc_id", "text_hash", "n", "set_1", "set_2", "buckets", "signature"],
            )

    read = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash"))
    schema = "doc_id long, text_hash long, n long, set_1 long, set_2 long, buckets array<long>, signature binary"
    return staged(read.mapInArrow(sketch, schema), "sketches")


def groups_of(batches: Iterator, keys: int) -> Iterator:
    """Lists of rows, as tuples, that agree in the first ``keys`` columns and lie next to each other."""
    waiting: list[tuple] = []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if waiting and row[:keys] != waiting[0][:keys]:
                yield waiting
                waiting = []
            waiting.append(row)
    if waiting:
        yield waiting


def alike(percent: int, a: Column, b: Column) -> Column:
    """Set sizes that allow a similarity of ``percent``."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def star_links(proposals: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Those of the pairs (node, head) that are linked, as (a, b). Rows meet the text of their head sorted by it."""

    def verify(batches: Iterator) -> Iterator:
        import pyarrow as pa

        hashes, last, head_set = WordHashes(), None, None
        for batch in batches:
            a, b = [], []
            for node, head, text, head_text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if head != last:
                    last, head_set = head, shingle_set(head_text, size, hashes)
                own = shingle_set(text, size, hashes)
                both = len(np.intersect1d(own, head_set, assume_unique=True))
                if 100 * both >= percent * (len(own) + len(head_set) - both):
                    a.append(node)
                    b.append(head)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    heads = proposals.select("head").distinct().join(texts.select(F.col("node").alias("head"), F.col("text").alias("head_text")), "head")
    pairs = proposals.join(texts.select("node", "text"), "node").join(heads, "head")
    return pairs.select("node", "head", "text", "head_text").mapInArrow(verify, "a long, b long")


def in_blocks(rows: DataFrame, key: str, parts: Column, columns: list[str]) -> DataFrame:
    """Rows of a group dealt to pairs of blocks; all pairs of blocks (low, high) of a group meet, each in one place."""
    spark = rows.sparkSession
    sizes = rows.groupBy(key).agg(F.greatest(F.lit(1), parts).cast("int").alias("parts"))
    dealt = rows.join(sizes, key).withColumn("block", F.expr("int(pmod(xxhash64(node, 7), parts))"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select(key, F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", *columns)
    keys = [key, "low", "high"]
    return dealt.repartition(shuffle_partitions(spark), *keys).sortWithinPartitions(*keys)


def across(rows: list[tuple]) -> np.ndarray:
    """Pairs of rows (key, low, high, block, component, ...) of two components and, between blocks, of two blocks."""
    component = np.array([r[4] for r in rows])
    pairs = component[:, None] != component[None, :]
    if rows[0][1] != rows[0][2]:
        block = np.array([r[3] for r in rows])
        pairs &= block[:, None] != block[None, :]
    return pairs


def plausible_edges(rows: DataFrame, cut: float, percent: int, block_nodes: int) -> DataFrame:
    """Components of a bucket that some pair of nodes with close sketches connects, as spanning edges (a, b)."""

    def find(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for group in groups_of(batches, 3):
            component = np.array([r[4] for r in group])
            sizes = np.array([r[5] for r in group])
            sketch = np.frombuffer(b"".join(r[6] for r in group), np.uint8).reshape(len(group), -1)
            close = across(group)
            close &= 100 * np.minimum(sizes[:, None], sizes[None, :]) >= percent * np.maximum(sizes[:, None], sizes[None, :])
            step = max(1, 8_000_000 // sketch.size)
            for low in range(0, len(group), step):
                equal = (sketch[low : low + step, None, :] == sketch[None, :, :]).sum(2)
                close[low : low + step] &= equal >= cut * sketch.shape[1]
            head = component[smallest_connected(close | (component[:, None] == component[None, :]))]
            keep = component != head
            yield pa.RecordBatch.from_arrays([pa.array(component[keep], pa.int64()), pa.array(head[keep], pa.int64())], ["a", "b"])

    dealt = in_blocks(rows, "bucket", F.ceil(F.count("*") / block_nodes), ["component", "n", "signature"])
    return dealt.mapInArrow(find, "a long, b long").distinct()


def block_links(rows: DataFrame, size: int, percent: int, block_nodes: int, block_shingles: int) -> DataFrame:
    """Exact links between components of a group (root), as spanning edges (a, b) of nodes."""

    def verify(batches: Iterator) -> Iterator:
        import pyarrow as pa

        hashes = WordHashes()
        for group in groups_of(batches, 3):
            if len({r[4] for r in group}) == 1:
                continue
            sets = [shingle_set(r[6], size, hashes) for r in group]
            lengths = np.array([len(s) for s in sets])
            shared = np.rint(shared_counts(sets)).astype(np.int64)
            close = (100 * shared >= percent * (lengths[:, None] + lengths[None, :] - shared)) & across(group)
            node, head = np.array([r[5] for r in group]), smallest_connected(close)
            keep = head != np.arange(len(group))
            yield pa.RecordBatch.from_arrays([pa.array(node[keep], pa.int64()), pa.array(node[head[keep]], pa.int64())], ["a", "b"])

    parts = F.greatest(F.ceil(F.count("*") / block_nodes), F.ceil(F.sum("n") / block_shingles))
    return in_blocks(rows, "root", parts, ["component", "node", "text"]).mapInArrow(verify, "a long, b long")


def near_duplicates(
    docs: DataFrame, size: int = 4, percent: int = 80, bands: int = 32, rows: int = 5, cut: float = 0.62, rounds: int = 2,
    block_nodes: int = 512, block_shingles: int = 2_000_000,
) -> DataFrame:
    """For every row the component of near duplicates that it lies in.

    Words are runs without blanks, A-Z lower-cased. Rows are linked if the sets of their ``size``-word
    shingles (a shorter text is one shingle) have 100 * intersection >= ``percent`` * union. Returns doc_id,
    n_shingles, component_id (smallest ``doc_id`` that links reach), kept (whether that is the row's own).

    A pair at similarity s shares no bucket with probability ``(1 - s**rows) ** bands`` (3e-6 at 0.8), and
    agrees in fewer than ``cut`` of the coordinates, at 0.8, with probability below 1e-7; block sizes bound
    what a task compares at a time and drop nothing.

    Null and empty texts and texts of blanks have no shingles and are linked with nothing. Repeated rows are
    copies of each other; rows that give one ``doc_id`` several texts are each judged by their own. Rows without
    ``doc_id`` are linked with nothing, have a null component and are kept. Extra columns are not read. An
    empty table gives an empty result.
    """
    sketch = sketched(docs, size, bands, rows)
    known = sketch.where("n > 0 AND doc_id IS NOT NULL").groupBy("set_1", "set_2").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("least"), F.max("n").alias("n"), F.first("buckets").alias("buckets"), F.first("signature").alias("signature")
    )
    nodes = staged(known.select("set_1", "set_2", "least.*", "n", "buckets", "signature", F.monotonically_increasing_id().alias("node")), "nodes")
    thrown = nodes.select("node", "n", F.explode("buckets").alias("bucket"))
    crowded = thrown.groupBy("bucket").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first < last").select("bucket")
    members = staged(thrown.join(crowded, "bucket"), "members")
    wanted = nodes.join(members.select("node").distinct(), "node").select("node", F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))
    read = docs.select(F.col("doc_id").cast("long").alias("id"), "text", F.xxhash64("text").alias("hash"))
    texts = staged(wanted.join(read, ["id", "hash"]).select("node", "text").dropDuplicates(["node"]), "texts")

    def unsettled(links: DataFrame | None) -> DataFrame:
        """Members of buckets that hold several components, with the least component and its first node."""
        own = members.withColumn("component", F.col("node"))
        if links is not None:
            own = members.join(connected_components(links), "node", "left").withColumn("component", F.coalesce("root", "node")).drop("root")
        heads = own.groupBy("bucket").agg(F.min(F.struct("component", "node", "n")).alias("head"), F.max("component").alias("last"))
        return own.join(heads.where("head.component < last").select("bucket", "head"), "bucket")

    links = None
    for turn in range(rounds):
        left = unsettled(links).where(F.col("component") != F.col("head.component")).where(alike(percent, F.col("n"), F.col("head.n")))
        order = F.col("head.node") if turn == 0 else F.xxhash64("head.node", F.lit(turn))
        proposals = left.groupBy("node").agg(F.min(F.struct(order.alias("order"), F.col("head.node").alias("head"))).alias("best")).select("node", "best.head")
        found = staged(star_links(staged(proposals, "proposals"), texts, size, percent), "links")
        links = found if links is None else links.unionByName(found)
    left = staged(unsettled(links).select("bucket", "node", "n", "component"), "unsettled")
    seen = left.join(nodes.select("node", "signature"), "node")
    groups = connected_components(plausible_edges(seen, cut, percent, 2 * block_nodes)).select(F.col("node").alias("component"), "root")
    rest = left.select("node", "n", "component").distinct().join(groups, "component").join(texts, "node")
    found = staged(block_links(rest, size, percent, block_nodes, block_shingles), "links")
    links = found if links is None else links.unionByName(found)
    roots = nodes.join(connected_components(links), "node", "left").select("set_1", "set_2", "doc_id", F.coalesce("root", "node").alias("root"))
    least = roots.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    found = roots.join(least, "root").select("set_1", "set_2", "component_id")
    joined = sketch.where("doc_id IS NOT NULL").select("doc_id", "n", "set_1", "set_2").join(found, ["set_1", "set_2"], "left")
    judged = joined.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
    nameless = sketch.where("doc_id IS NULL").select("doc_id", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"))
    return judged.unionByName(nameless).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
