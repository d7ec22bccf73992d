"""Phrases mined from a weighted de Bruijn graph of words.

Nodes are pairs of neighbouring words, edges are triples; an edge leads from its first pair to its
second. Only edges are counted in the corpus, together with the one or two words that end a piece and
have no edge of their own. Everything shorter follows from flow: a pair occurs as often as the edges
that leave it weigh, plus its occurrences at the end of a piece; a word as often as the pairs that it
begins, plus its occurrences as a last word.

Edges below the least count are dropped after they have given their weight to nodes. A node with one
edge in and one edge out, and no piece that begins or ends there, is unary: both edges have its weight.
Paths through unary nodes are compacted to one long edge; the pairs inside have the weight of the path
and are no phrases of their own, so that only nodes at junctions are looked at further.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratiform.llm.common import discard, shuffle_partitions, staged
from stratiform.llm.line_dedup import LOWER, UPPER

#: What ends a piece, what parts its words, the missing language.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"
NO_LANG = "und"

#: One pass over the bytes of a text lower-cases A-Z and makes every piece end a line end.
_TABLE = bytes.maketrans(UPPER.encode() + PIECE_ENDS, LOWER.encode() + b"\n" * len(PIECE_ENDS))
_SPREAD = 32
#: Part of the documents in which hot words are looked for.
_LOOKED_AT = 0.05


def pieces(text: str) -> Iterator[list[bytes]]:
    """Words of every piece; what else ``split`` takes for a blank ends a piece before."""
    for piece in text.encode().translate(_TABLE).split(b"\n"):
        words = piece.split()
        if words:
            yield words


def hot_words(docs: DataFrame, partitions: int) -> list[str]:
    """Words with more than about a quarter of an even partition of all occurrences: at most eight per partition.

    They decide how rows are spread and no count, so a part of the documents is enough to find them.
    """

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            seen: Counter = Counter()
            for text in batch.column("text").to_pylist():
                for words in pieces(text or ""):
                    seen.update(words)
            total = sum(seen.values())
            often = [(w.decode(), n) for w, n in seen.items() if n * 4 * partitions >= total]
            words, counts = [w for w, _ in often], [n for _, n in often]
            yield pa.RecordBatch.from_arrays([pa.array([*words, None], pa.string()), pa.array([*counts, total], pa.int64())], ["word", "n"])

    some = docs.select("text").sample(_LOOKED_AT, seed=13)
    reported = staged(some.mapInArrow(count, "word string, n long"), "frequent-words")
    found = reported.groupBy("word").agg(F.sum("n").alias("n"))
    total = found.where("word IS NULL").first()
    hot = found.where(F.col("word").isNotNull() & (F.col("n") * (8 * partitions) > (total["n"] if total else 0)))
    return sorted(row["word"] for row in hot.collect())


class _Numbers(dict):
    """Words numbered from 1 as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self) + 1
        return number


def edge_counts(docs: DataFrame, tokens: int = 1_000_000, types: int = 1_000_000) -> DataFrame:
    """Edges and piece ends with their weights, pre-aggregated for every ``tokens`` words of a task.

    Columns gram and n. A gram is the node (two words, or the last word of a piece; empty: all words), the
    next word (empty at the end of a piece) and the language, on a line each: one short text makes the
    smallest rows to send. Words are numbered within a task, and triples of numbers counted by sorting, which also puts
    the edges of a node next to each other.
    """

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        def flush():
            known = pa.array([b"", *numbers], pa.binary()).cast(pa.string())
            base = len(numbers) + 1
            for lang, own in seen.items():
                own = np.array([*own, 0, 0], np.int64)
                at = np.flatnonzero(own)
                if not len(at):
                    continue
                a, b = own[at], own[at + 1]
                c = np.where(b > 0, own[np.minimum(at + 2, len(own) - 1)], 0)
                # Pairs are numbered first, so that a triple fits 64 bits however many words there are.
                pairs, pair = np.unique(a * base + b, return_inverse=True)
                keys, counts = np.unique(pair * base + c, return_counts=True)
                a, b, c = pairs[keys // base] // base, pairs[keys // base] % base, keys % base
                first, second = known.take(pa.array(a)), known.take(pa.array(b))
                node = pc.if_else(pa.array(b > 0), pc.binary_join_element_wise(first, second, " "), first)
                gram = pc.binary_join_element_wise(node, known.take(pa.array(c)), pa.scalar(lang), "\n")
                total = pa.array([f"\n\n{lang}"], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([gram, total]), pa.array(np.append(counts, len(at)), pa.int64())], ["gram", "n"]
                )

        seen: dict[str, list[int]] = {}
        numbers, size = _Numbers(), 0
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                own = seen.setdefault(lang, [])
                for words in pieces(text or ""):
                    own.extend(map(numbers.__getitem__, words))
                    own.append(0)
                    size += len(words)
                    if size >= tokens or len(numbers) >= types:
                        yield from flush()
                        seen, numbers, size = {lang: []}, _Numbers(), 0
                        own = seen[lang]
        yield from flush()

    read = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"), "text")
    return read.mapInArrow(count, "gram string, n long")


def flow_counts(docs: DataFrame, least: int) -> DataFrame:
    """Occurrences of words, pairs and triples that reach ``least``, and of all words of a language.

    Columns lang, node (null: all words of the language), next (not null: a triple), n. Edges meet by their
    node, so that its flow is summed where they are; edges of nodes made of two hot words are spread.
    """
    partitions = shuffle_partitions(docs.sparkSession)
    hot = hot_words(docs, partitions) or [""]
    node = F.substring_index("gram", "\n", 1)
    first, second = F.substring_index(node, " ", 1), F.substring_index(node, " ", -1)
    spread = (F.instr(node, " ") > 0) & first.isin(hot) & second.isin(hot)
    salt = F.when(spread, F.expr(f"int(pmod(xxhash64(gram), {_SPREAD})) + 1")).otherwise(0)
    dealt = edge_counts(docs).repartition(partitions, node, salt).select("gram", "n", node.alias("node"), salt.alias("salt"))
    known = F.substring_index("gram", "\n", 2)
    grams = dealt.groupBy("node", "salt", "gram").agg(F.sum("n").alias("n"))
    edges = grams.select(
        F.substring(F.col("gram"), F.length(known) + 2, F.length("gram")).alias("lang"), "node", "salt",
        F.nullif(F.substring_index(known, "\n", -1), F.lit("")).alias("next"), "n",
    )
    flow = F.struct(F.lit(None).cast("string").alias("next"), "n")
    given = F.when(F.col("next").isNotNull() & (F.col("n") >= least), F.array(F.struct("next", "n"), flow)).otherwise(F.array(flow))
    first = F.substring_index("node", " ", 1)
    pair = F.instr("node", " ") > 0
    nodes = edges.select("lang", "node", "salt", F.explode(given).alias("e")).groupBy("lang", "node", "salt", "e.next").agg(F.sum("e.n").alias("n"))

    def row(node: Column, following: Column) -> Column:
        return F.struct(node.alias("node"), following.alias("next"))

    nothing = F.lit(None).cast("string")
    whole = (F.col("n") >= least) | (F.col("salt") > 0)
    passed = (
        F.when(F.col("next").isNotNull(), F.array(row(F.col("node"), F.col("next"))))
        .when(pair & whole, F.array(row(F.col("node"), nothing), row(first, nothing)))
        .otherwise(F.array(row(F.nullif(first, F.lit("")), nothing)))
    )
    counted = nodes.select("lang", F.explode(passed).alias("e"), "n").groupBy("lang", "e.node", "e.next").agg(F.sum("n").alias("n"))
    return counted.where((F.col("n") >= least) | F.col("node").isNull())


def followed(pointers: DataFrame) -> DataFrame:
    """(id, up or null) to (id, head, rank): the first of each chain and the steps to it, by pointer doubling."""
    now = staged(pointers.select("id", F.coalesce("up", "id").alias("head"), F.when(F.col("up").isNull(), 0).otherwise(1).cast("long").alias("rank")), "chains")
    while True:
        ahead = now.where("rank > 0").select(F.col("id").alias("head"), F.col("head").alias("further"), F.col("rank").alias("more"))
        joined = now.join(ahead, "head", "left").select(
            "id", F.coalesce("further", "head").alias("head"), (F.col("rank") + F.coalesce("more", F.lit(0))).alias("rank"), F.col("more").isNotNull().alias("moved")
        )
        following = staged(joined, "chains")
        discard(now)
        now = following.select("id", "head", "rank")
        if following.where("moved").isEmpty():
            return now


def unary_paths(edges: DataFrame) -> DataFrame:
    """Edges (id, lang, a, b, c, n, n_in, n_out) compacted: lang, words, n, n_in, n_out of the path.

    ``n_in`` and ``n_out`` are the weights of the edge's nodes. An edge that has the whole weight of its
    second node is followed by one that has the whole weight of the same node as its first. Pieces end, so
    such chains are no cycles. A path is part of a piece, which bounds what is collected of it.
    """
    into = edges.where("n = n_out").select("lang", "b", "c", F.col("id").alias("up"))
    out = edges.where("n = n_in").select("id", "lang", F.col("a").alias("b"), F.col("b").alias("c"))
    pointers = edges.select("id").join(out.join(into, ["lang", "b", "c"]).select("id", "up"), "id", "left")
    ranked = edges.join(followed(pointers), "id")
    paths = ranked.groupBy("lang", "head").agg(
        F.sort_array(F.collect_list(F.struct("rank", "a", "b", "c", "n_in", "n_out"))).alias("steps"), F.first("n").alias("n")
    )
    head, last = F.col("steps")[0], F.element_at("steps", -1)
    words = F.concat(F.array(head["a"], head["b"]), F.transform("steps", lambda s: s["c"]))
    return paths.select("lang", words.alias("words"), "n", head["n_in"].alias("n_in"), last["n_out"].alias("n_out"))


def phrase_graph(docs: DataFrame, least: int = 10) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The compacted graph: words (lang, w, n), pairs (lang, a, b, n), paths, and sizes (lang, n).

    ``docs`` has text and lang. Null texts are empty, a null lang is ``und``.
    """
    counts = staged(flow_counts(docs, least), "flow")
    first, second = F.substring_index("node", " ", 1), F.substring_index("node", " ", -1)
    pair = F.instr("node", " ") > 0
    sizes = counts.where("node IS NULL").select("lang", "n")
    words = counts.where(F.col("node").isNotNull() & ~pair).select("lang", F.col("node").alias("w"), "n")
    pairs = counts.where(pair & F.col("next").isNull()).select("lang", first.alias("a"), second.alias("b"), "n")
    triples = counts.where("next IS NOT NULL").select("lang", first.alias("a"), second.alias("b"), F.col("next").alias("c"), "n")
    from_node = pairs.withColumnRenamed("n", "n_in")
    to_node = pairs.select("lang", F.col("a").alias("b"), F.col("b").alias("c"), F.col("n").alias("n_out"))
    edges = triples.join(from_node, ["lang", "a", "b"]).join(to_node, ["lang", "b", "c"])
    edges = staged(edges.withColumn("id", F.monotonically_increasing_id()), "edges")
    return words, pairs, staged(unary_paths(edges), "paths"), sizes


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)) in decimals of 38 digits."""
    a, left, right = (c.cast("decimal(15,0)") for c in (a, left, right))
    return F.call_function("div", a * a * F.lit(1_000_000).cast("decimal(7,0)"), left * right).cast("long")


def collocations(docs: DataFrame, least: int = 10, share: int = 50, top: int = 2000) -> DataFrame:
    """The ``top`` phrases of two and three words of every language, by the strength of their weakest cut.

    Texts, A-Z lower-cased, are cut into pieces at ``. , ; : ! ?`` and line ends, pieces into words at blanks
    and tabs. A phrase with a >= ``least`` occurrences, cut into parts with l and r occurrences, has the score
    floor(1000000 a² / (l r)) of its lowest cut (ties: the earlier). Pairs that lie in a triple with
    ``share`` percent of their occurrences, or more, are left out. Returns lang, rank, phrase, a, l, r, n
    (words of the language), score.

    Null and empty texts hold no words, a null lang is ``und``, repeated rows count as often as they stand
    there, ties in score and occurrences go by the phrase's bytes. Extra columns are not read. An empty
    table gives an empty result.
    """
    words, pairs, paths, sizes = phrase_graph(docs.select("lang", "text"), least)
    end = F.size("words") - 2
    steps = paths.select("*", F.explode(F.sequence(F.lit(1), end)).alias("at"), end.alias("end"))
    triples = steps.select(
        "lang", F.get("words", F.col("at") - 1).alias("w"), F.get("words", F.col("at")).alias("b"), F.get("words", F.col("at") + 1).alias("z"), "n",
        F.when(F.col("at") == 1, F.col("n_in")).otherwise(F.col("n")).alias("n_in"),
        F.when(F.col("at") == F.col("end"), F.col("n_out")).otherwise(F.col("n")).alias("n_out"),
    )
    inside = steps.where(F.col("at") > 1).select("lang", F.get("words", F.col("at") - 1).alias("a"), F.get("words", F.col("at")).alias("b"))
    # What is left are pairs at junctions: the heaviest edge that touches them decides.
    first = F.struct(F.get("words", F.lit(0)).alias("a"), F.get("words", F.lit(1)).alias("b"))
    last = F.struct(F.element_at("words", -2).alias("a"), F.element_at("words", -1).alias("b"))
    ends = paths.select("lang", "n", F.explode(F.array(first, last)).alias("p"))
    heaviest = ends.groupBy("lang", "p.a", "p.b").agg(F.max("n").alias("edge"))
    junctions = pairs.join(inside, ["lang", "a", "b"], "left_anti").join(heaviest, ["lang", "a", "b"], "left")
    free = junctions.where(F.col("edge").isNull() | (100 * F.col("edge") < share * F.col("n")))
    phrases = free.select("lang", F.col("a").alias("w"), F.lit(None).cast("string").alias("b"), F.col("b").alias("z"), "n").withColumns(
        {"n_in": F.lit(None).cast("long"), "n_out": F.lit(None).cast("long")}
    ).unionByName(triples)
    of_first = words.withColumnRenamed("n", "n_first")
    of_last = words.select("lang", F.col("w").alias("z"), F.col("n").alias("n_last"))
    known = phrases.join(of_first, ["lang", "w"]).join(of_last, ["lang", "z"])
    a, pair = F.col("n"), F.col("b").isNull()
    early = F.struct(score(a, F.col("n_first"), F.coalesce("n_out", "n_last")).alias("score"), F.lit(1).alias("k"), F.col("n_first").alias("l"), F.coalesce("n_out", "n_last").alias("r"))
    late = F.struct(score(a, F.coalesce("n_in", "n_first"), F.col("n_last")).alias("score"), F.lit(2).alias("k"), F.coalesce("n_in", "n_first").alias("l"), F.col("n_last").alias("r"))
    cut = F.when(pair, early).otherwise(F.least(early, late))
    scored = known.select("lang", F.concat_ws(" ", "w", "b", "z").alias("phrase"), a.alias("a"), cut.alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
