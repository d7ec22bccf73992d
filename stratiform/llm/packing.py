"""Packing documents into token sequences by rounded cutting-stock patterns.

1. Every text is turned into ids once, in Arrow batches, and stored. Each task numbers its documents
   within every remainder length while it writes, so ranks need no shuffle of tokens: they are the
   stored number plus an offset that a window over (length, task) counts gives.
2. What a document has beyond whole sequences of ``capacity`` is its remainder. The histogram of
   remainders (at most ``capacity - 1`` rows) goes through column generation; whole multiples of the
   resulting patterns are assigned to ranks by arithmetic.
3. Documents beyond the rounded patterns are laid end to end, by length and rank, and cut where a
   sequence ends. Only the last of these sequences has padding.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratiform.llm.common import staged
from stratiform.llm.cutting_stock import Pattern, rounded

#: Offsets of so many tasks (each of at most ``capacity`` numbers) are sent to all executors; beyond
#: that they meet the stored tokens by a shuffle.
BROADCAST_TASKS = 1000

_STORED = "doc_id long, ids binary, doc_tokens long, task long, rank long, whole_before long"
_ENCODERS: dict[str, object] = {}


def encoder(vocabulary: str):
    """Byte-level BPE of a public vocabulary; ``<|endoftext|>`` in a text is its special id."""
    if vocabulary not in _ENCODERS:
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _ENCODERS[vocabulary] = tiktoken.Encoding(
            vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
            special_tokens={"<|endoftext|>": len(ranks)},
        )
    return _ENCODERS[vocabulary]


def tokenized(docs: DataFrame, capacity: int, vocabulary: str, end_id: int) -> DataFrame:
    """Stored ids (unsigned 32 bit, little-endian) of every document, numbered within each task."""

    def encode(batches: Iterator) -> Iterator:
        import pyarrow as pa

        encoding, task = encoder(vocabulary), TaskContext.get().partitionId()
        rank, whole = np.zeros(capacity, np.int64), 0
        end = np.array([end_id], "<u4").tobytes()
        # Small pieces of a batch at a time: ids take more room than the texts.
        for batch in (whole_batch.slice(low, 1000) for whole_batch in batches for low in range(0, whole_batch.num_rows, 1000)):
            out: dict[str, list] = {name: [] for name in ("ids", "doc_tokens", "rank", "whole_before")}
            for text in batch.column("text").to_pylist():
                ids = np.asarray(encoding.encode_to_numpy(text or "", allowed_special="all"), "<u4").tobytes() + end
                count = len(ids) // 4
                out["ids"].append(ids)
                out["doc_tokens"].append(count)
                out["rank"].append(int(rank[count % capacity]))
                out["whole_before"].append(whole)
                rank[count % capacity] += 1
                whole += count // capacity
            columns = [
                batch.column("doc_id"), pa.array(out["ids"], pa.binary()), pa.array(out["doc_tokens"], pa.int64()),
                pa.array([task] * batch.num_rows, pa.int64()), pa.array(out["rank"], pa.int64()),
                pa.array(out["whole_before"], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "doc_tokens", "task", "rank", "whole_before"])

    return staged(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encode, _STORED), "tokens")


def _assignments(spark: SparkSession, histogram: dict[int, int], patterns: list[Pattern], capacity: int) -> tuple[DataFrame, int]:
    """Which ranks of a length go where; one row for each length of each pattern, so it is small.

    ``each`` documents of that length lie in one sequence from ``at`` on; ``each`` is 0 for the stream
    of documents that are laid end to end, where ``at`` is the place of the first.
    """
    taken, rows, sequence = dict.fromkeys(histogram, 0), [], 0
    for pattern in patterns:
        at = 0
        for length in sorted(set(pattern.lengths), reverse=True):
            each = pattern.lengths.count(length)
            rows.append((length, taken[length], taken[length] + each * pattern.times, each, sequence, at))
            taken[length] += each * pattern.times
            at += each * length
        sequence += pattern.times
    at = 0
    for length in sorted(histogram, reverse=True):
        if (rest := histogram[length] - taken[length]) > 0:
            rows.append((length, taken[length], histogram[length], 0, sequence, at))
            at += rest * length
    schema = "length long, from_rank long, to_rank long, each long, first_sequence long, at long"
    return spark.createDataFrame(rows, schema), sequence + -(-at // capacity)


def _piece(start: Column, length: Column, sequence: Column, offset: Column) -> Column:
    pieces = {"start": start, "length": length, "sequence_id": sequence, "offset": offset}
    return F.struct(*[column.cast("long").alias(name) for name, column in pieces.items()])


def pack(
    docs: DataFrame, capacity: int = 1024, vocabulary: str = "byte_bpe_50k", end_id: int = 0,
    min_fill: float = 0.995, gap: float = 1e-3,
) -> DataFrame:
    """Pieces of documents placed in sequences of at most ``capacity`` tokens.

    Returns doc_id, start, length, sequence_id, offset, doc_tokens and ids (unsigned 32-bit
    little-endian bytes of the piece). Every document ends with ``end_id``. A document fills as many
    whole sequences as it can; its remainder lies in one piece, or in two where the stream of documents
    beyond the rounded patterns is cut. ``min_fill`` is the least share of a sequence that a pattern
    must fill; ``gap`` the proven distance from the optimum at which column generation ends.

    Null or empty texts are a document of one token. Repeated rows are documents of their own, also
    with one ``doc_id``, which may be null. Extra columns are not read. No rows give no pieces.
    """
    spark = docs.sparkSession
    tokens = tokenized(docs, capacity, vocabulary, end_id)
    length = F.col("doc_tokens") % capacity
    counts = tokens.groupBy("task", length.alias("length")).agg(
        F.count("*").alias("n"), F.sum(F.floor(F.col("doc_tokens") / capacity)).alias("whole")
    )
    counts = staged(counts, "packing-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    histogram.pop(0, None)
    assigned, sequences = _assignments(spark, histogram, rounded(histogram, capacity, min_fill, gap), capacity)

    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("start_rank", F.coalesce(F.sum("n").over(before), F.lit(0)))
    tasks = starts.groupBy("task").agg(
        F.map_from_entries(F.collect_list(F.struct("length", "start_rank"))).alias("start_ranks"), F.sum("whole").alias("whole")
    )
    earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # a row for each task
    tasks = tasks.select("task", "start_ranks", F.coalesce(F.sum("whole").over(earlier), F.lit(0)).alias("whole_start"))
    few = counts.select("task").distinct().limit(BROADCAST_TASKS + 1).count() <= BROADCAST_TASKS

    placed = tokens.join(F.broadcast(tasks) if few else tasks, "task").select(
        "doc_id", "ids", "doc_tokens", length.alias("length"),
        (F.col("rank") + F.element_at("start_ranks", length)).alias("rank"),
        (F.col("whole_before") + F.col("whole_start") + sequences).alias("whole_sequence"),
    )
    spot = F.broadcast(assigned.withColumnRenamed("length", "of_length"))
    placed = placed.join(
        spot, (F.col("length") == F.col("of_length")) & (F.col("rank") >= F.col("from_rank")) & (F.col("rank") < F.col("to_rank")), "left"
    )
    return placed.select("doc_id", "doc_tokens", F.explode(_pieces(capacity)).alias("piece")).select(
        "doc_id", F.col("piece.start").alias("start"), F.col("piece.length").alias("length"), F.col("piece.sequence_id").alias("sequence_id"),
        F.col("piece.offset").alias("offset"), "doc_tokens", F.col("piece.ids").alias("ids"),
    )


def _pieces(capacity: int) -> Column:
    """All pieces of the document in this row, with their ids."""
    cap = F.lit(capacity).cast("long")
    full = F.floor(F.col("doc_tokens") / cap)
    whole = F.transform(
        F.when(full > 0, F.sequence(F.lit(0).cast("long"), full - 1)).otherwise(F.array().cast("array<long>")),
        lambda k: _piece(k * cap, cap, F.col("whole_sequence") + k, F.lit(0)),
    )
    start, length, nth = full * cap, F.col("length"), F.col("rank") - F.col("from_rank")
    patterned = F.array(
        _piece(start, length, F.col("first_sequence") + F.floor(nth / F.col("each")), F.col("at") + (nth % F.col("each")) * length)
    )
    place = F.col("at") + nth * length
    room = cap - place % cap
    sequence = F.col("first_sequence") + F.floor(place / cap)
    streamed = F.when(
        length > room,
        F.array(_piece(start, room, sequence, place % cap), _piece(start + room, length - room, sequence + 1, F.lit(0))),
    ).otherwise(F.array(_piece(start, length, sequence, place % cap)))
    rest = F.when(length == 0, F.slice(patterned, 1, 0)).when(F.col("each") > 0, patterned).otherwise(streamed)
    ids = F.col("ids")
    return F.transform(
        F.concat(whole, rest),
        lambda p: F.struct(
            *[p[name].alias(name) for name in ("start", "length", "sequence_id", "offset")],
            F.substring(ids, (p["start"] * 4 + 1).cast("int"), (p["length"] * 4).cast("int")).alias("ids"),
        ),
    )
