"""N-gram Jaccard join by a MinHash LSH forest with exact verification.

1. Every text becomes a set of hashed word shingles. Texts with equal sets are one class; its smallest
   document represents it. Only representatives go on, with ``trees * depth`` minhashes.
2. Each tree is a prefix trie of the signatures, held as rows in order of (tree, prefix, document) over
   range partitions. Neighbours in that order share the longest prefixes. The prefix that two documents
   must share is shortened from ``depth`` on until a pair at the threshold is found with probability
   ``recall`` in at least one tree. A trie node at that depth is a run of rows, which may span any
   number of partitions: members point to the first of the run, and the runs at partition borders
   (two for each partition) are joined afterwards. No node is gathered into one task.
3. Connected documents are candidates for each other. Each component is verified exactly, all pairs
   within a component of bounded size at once; larger ones are cut into blocks, one task for each pair of
   blocks. Only counts and spanning edges leave a task, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.llm.common import WordHashes, minhash_seeds, minhashes, mix, shingles, shuffle_partitions, staged, words
from stratiform.llm.components import connected_components

_SKETCH = "doc_id long, text_hash long, shingles long, set_1 long, set_2 long, signature binary"


def shortened(depth: int, trees: int, threshold: float, recall: float) -> int:
    """Longest shared prefix, from ``depth`` down, that finds a pair at ``threshold`` often enough."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def shingle_set(text: str | None, size: int, hashes: WordHashes) -> np.ndarray:
    return np.unique(shingles(hashes(words(text)), size))


def sketched(docs: DataFrame, size: int, trees: int, depth: int) -> DataFrame:
    """For every row: number of distinct shingles, fingerprint of the set, signature."""
    seeds = minhash_seeds(trees * depth, 11)

    def sketch(batches: Iterator) -> Iterator:
        import pyarrow as pa

        hashes = WordHashes()
        for batch in batches:
            counts, ones, twos, signatures = [], [], [], []
            for text in batch.column("text").to_pylist():
                own = shingle_set(text, size, hashes)
                counts.append(len(own))
                with np.errstate(over="ignore"):
                    ones.append(mix(own + np.uint64(1)).sum(dtype=np.uint64))
                    twos.append(mix(own ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
                signatures.append(minhashes(own, seeds).astype(">u4").tobytes() if len(own) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("text_hash"), pa.array(counts, pa.int64()), pa.array(np.array(ones, np.uint64).view(np.int64)),
                    pa.array(np.array(twos, np.uint64).view(np.int64)), pa.array(signatures, pa.binary()),
                ],
                ["doc_id", "text_hash", "shingles", "set_1", "set_2", "signature"],
            )

    read = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash"))
    return staged(read.mapInArrow(sketch, _SKETCH), "sketches")


def forest_edges(classes: DataFrame, trees: int, depth: int, shared: int) -> DataFrame:
    """Edges (a, b) from members of a trie node at depth ``shared`` to one member of it, in all trees."""
    spark = classes.sparkSession
    width = 4 * depth
    rows = classes.select("rep", "signature", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")).select(
        "tree", F.expr(f"substring(signature, tree * {width} + 1, {width})").alias("prefix"), "rep"
    )
    ordered = rows.repartitionByRange(shuffle_partitions(spark), "tree", "prefix", "rep").sortWithinPartitions("tree", "prefix", "rep")

    def runs(batches: Iterator) -> Iterator:
        import pyarrow as pa

        name = ["a", "b", "node"]
        key, leader, borders = None, None, []

        def border() -> None:
            if key is not None:
                borders.append((leader, key))

        for batch in batches:
            count = batch.num_rows
            if not count:
                continue
            tree = np.asarray(batch.column(0), np.int32)
            prefix = np.frombuffer(b"".join(batch.column(1).to_pylist()), ">u4").reshape(count, depth)[:, :shared]
            rep = np.asarray(batch.column(2), np.int64)
            node = np.column_stack([tree.astype(">u4"), prefix])
            new = np.ones(count, bool)
            new[1:] = (node[1:] != node[:-1]).any(1)
            first = node[0].astype(">u4").tobytes()
            if key == first:
                new[0] = False
            elif key is None:
                key, leader = first, int(rep[0])
                border()
            at = np.maximum.accumulate(np.where(new, np.arange(count), -1))
            head = np.where(at < 0, leader, rep[at])
            keep = rep != head
            yield pa.RecordBatch.from_arrays([pa.array(rep[keep]), pa.array(head[keep]), pa.nulls(int(keep.sum()), pa.binary())], name)
            key, leader = node[-1].astype(">u4").tobytes(), int(head[-1])
        border()
        own = pa.array([b[0] for b in borders], pa.int64())
        yield pa.RecordBatch.from_arrays([own, own, pa.array([b[1] for b in borders], pa.binary())], name)

    found = staged(ordered.mapInArrow(runs, "a long, b long, node binary"), "forest")
    borders = found.where("node IS NOT NULL")
    heads = borders.groupBy("node").agg(F.min("a").alias("head"))
    joined = borders.select("node", "a").join(heads, "node").select("a", F.col("head").alias("b"))
    return found.where("node IS NULL").select("a", "b").unionByName(joined)


def shared_counts(sets: list[np.ndarray], chunk: int = 2048) -> np.ndarray:
    """Sizes of all intersections. Common shingles by matrix products, rare ones by their few holders."""
    count = len(sets)
    if count == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[len(sets[0]), both], [both, len(sets[1])]])
    holder = np.repeat(np.arange(count), [len(s) for s in sets])
    _, feature, copies = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(feature, kind="stable")
    holder, starts = holder[order], np.cumsum(copies) - copies
    result = np.zeros(count * count)
    common = np.flatnonzero(copies > max(8, count // 16))
    for low in range(0, len(common), chunk):
        some = common[low : low + chunk]
        matrix = np.zeros((count, len(some)), np.float32)
        for column, f in enumerate(some):
            matrix[holder[starts[f] : starts[f] + copies[f]], column] = 1
        result += (matrix @ matrix.T).astype(np.float64).ravel()
    for few in range(1, max(8, count // 16) + 1):
        some = np.flatnonzero(copies == few)
        step = max(1, 1_000_000 // few**2)
        for low in range(0, len(some), step):
            who = holder[starts[some[low : low + step], None] + np.arange(few)]
            pairs = who[:, :, None] * count + who[:, None, :]
            result += np.bincount(pairs.ravel(), minlength=count * count)
    return result.reshape(count, count)


def smallest_connected(linked: np.ndarray) -> np.ndarray:
    """For every row of a symmetric boolean matrix the smallest row that it is connected with."""
    label = np.arange(len(linked))
    while True:
        new = np.minimum(label, np.where(linked, label[None, :], len(label)).min(1))
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def verified(candidates: DataFrame, size: int, threshold: float) -> DataFrame:
    """Exact links inside each group (root, low, high) of ``candidates``.

    Returns doc, links (copies of partners), head (smallest linked document within the group), parts.
    """
    spark = candidates.sparkSession
    keys = ["root", "low", "high"]
    grouped = candidates.repartition(shuffle_partitions(spark), *keys).sortWithinPartitions(*keys, "doc", "text_hash")

    def links(rows: list[tuple], hashes: WordHashes) -> list[tuple]:
        sets = [shingle_set(r[6], size, hashes) for r in rows]
        lengths = np.array([len(s) for s in sets])
        shared = shared_counts(sets)
        close = (shared >= threshold * (lengths[:, None] + lengths[None, :] - shared) - 1e-9) & (shared > 0)
        np.fill_diagonal(close, False)
        if rows[0][1] != rows[0][2]:  # two blocks: pairs inside a block belong to that block's own group
            block = np.array([r[5] for r in rows])
            close &= block[:, None] != block[None, :]
        copies = np.array([r[7] for r in rows])
        heads = smallest_connected(close)
        return [(r[3], int(n), rows[h][3], r[8]) for r, n, h in zip(rows, close @ copies, heads, strict=True)]

    def verify(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def out(found: list[tuple]):
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], ["doc", "links", "head", "parts"])

        waiting, hashes = [], WordHashes()
        for batch in batches:
            found: list[tuple] = []
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if waiting and row[:3] != waiting[0][:3]:
                    found += links(waiting, hashes)
                    waiting = []
                if not waiting or row[3:5] != waiting[-1][3:5]:  # a repeated row is one of its copies
                    waiting.append(row)
            if found:
                yield out(found)
        if waiting:
            yield out(links(waiting, hashes))

    columns = [*keys, "doc", "text_hash", "block", "text", "copies", "parts"]
    return grouped.select(*columns).mapInArrow(verify, "doc long, links long, head long, parts long")


def jaccard_join(
    docs: DataFrame, size: int = 5, threshold: float = 0.8, trees: int = 24, depth: int = 6, recall: float = 0.99999,
    block_docs: int = 512, block_shingles: int = 2_000_000,
) -> DataFrame:
    """For every row its class of near duplicates and its number of links.

    Two documents are linked if the sets of their hashed ``size``-word shingles have a Jaccard
    similarity of at least ``threshold``. Returns doc_id, class_id (smallest ``doc_id`` among all that
    links connect), n_links (linked rows, exact copies included), n_shingles. ``block_docs`` and
    ``block_shingles`` bound what one task compares at a time; they drop nothing.

    Words are runs of letters and digits, in lower case; a text with fewer than ``size`` words is one
    shingle. Null texts and texts without words are alone in their class and have no links. Repeated
    rows are copies of each other; rows that give one ``doc_id`` different texts share its links.
    Rows without ``doc_id`` have a null class and no links. Extra columns are not read.
    """
    sketch = sketched(docs, size, trees, depth)
    classes = staged(
        sketch.where("shingles > 0 AND doc_id IS NOT NULL").groupBy("set_1", "set_2").agg(
            F.min(F.struct("doc_id", "text_hash", "signature")).alias("least"), F.count("*").alias("copies"), F.max("shingles").alias("shingles")
        ).select("set_1", "set_2", F.col("least.doc_id").alias("rep"), F.col("least.text_hash").alias("text_hash"),
            F.col("least.signature").alias("signature"), "copies", "shingles",
        ),
        "classes",
    )
    edges = forest_edges(classes, trees, depth, shortened(depth, trees, threshold, recall))
    candidates = connected_components(edges)
    members = candidates.join(classes.select(F.col("rep").alias("node"), "text_hash", "copies", "shingles"), "node")
    sizes = members.groupBy("root").agg(
        F.greatest(F.ceil(F.count("*") / block_docs), F.ceil(F.sum("shingles") / block_shingles)).cast("long").alias("parts")
    )
    members = members.join(sizes, "root").select(
        "root", F.col("node").alias("doc"), "text_hash", "copies", "parts", F.expr("pmod(xxhash64(node, text_hash), parts)").alias("block")
    )
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("other")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc"), "text", F.xxhash64("text").alias("text_hash"))
    paired = texts.join(members, ["doc", "text_hash"]).select("*", other).withColumns(
        {"low": F.least("block", "other"), "high": F.greatest("block", "other")}
    )
    links = staged(verified(paired, size, threshold), "links")
    heads = links.where("parts = 1").select(F.col("doc").alias("node"), F.col("head").alias("root"))
    split = links.where("parts > 1").select(F.col("doc").alias("a"), F.col("head").alias("b"))
    if not split.isEmpty():
        heads = heads.unionByName(connected_components(split))
    found = links.groupBy("doc").agg(F.sum("links").alias("links")).join(
        heads.groupBy(F.col("node").alias("doc")).agg(F.min("root").alias("root")), "doc", "left"
    )
    by_set = classes.select("set_1", "set_2", "rep", "copies").join(found, F.col("rep") == F.col("doc"), "left")
    joined = sketch.select("doc_id", "shingles", "set_1", "set_2").join(by_set, ["set_1", "set_2"], "left")
    lone = F.col("rep").isNull() | F.col("doc_id").isNull()
    return joined.select(
        "doc_id", F.when(lone, F.col("doc_id")).otherwise(F.coalesce("root", "rep")).alias("class_id"),
        F.when(lone, F.lit(0)).otherwise(F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
        F.col("shingles").alias("n_shingles"),
    )
