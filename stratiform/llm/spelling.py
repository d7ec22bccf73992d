"""Spelling variants by sorted permuterm rotations.

A word is closed by a terminator and rotated in every way. A rotation without its last letter is the
word with one letter left open, so the words that share it, in order of rotations, differ by that one
replaced letter; the word whose whole rotation equals it lacks that letter. A prefix group therefore
holds one word without and at most one word for each letter of the alphabet, which bounds it however
large the vocabulary is. Groups are scanned where the sort has put them; what leaves them is one row
for each word, not for each pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiform.llm.common import discard, mix, shuffle_partitions, staged
from stratiform.llm.line_dedup import LOWER, UPPER

#: The letters of a word after A-Z are lower-cased, and the terminator, which is none of them.
LETTERS = "[a-zÀ-ÿ]+"
END = "$"
#: Prefixes of more letters are held as hashes.
LONG = 64


def damaged(run: Column, doc_id: Column, every: int) -> Column:
    """``run`` without one code point where ``every`` divides the crc32 of ``<doc_id>:<run>``."""
    text = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run)
    check = F.crc32(F.encode(text, "utf-8"))
    at = (check % F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(check % every == 0, cut).otherwise(run)


def vocabulary(docs: DataFrame, every: int = 31, min_chars: int = 7, min_count: int = 2) -> DataFrame:
    """Words of all texts with their number of occurrences: word, n.

    Counted with map-side combining, so that a word with a third of all occurrences is one row per task.
    """
    runs = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(LETTERS), F.lit(0))
    rows = docs.select("doc_id", F.explode(runs).alias("run")).where(F.length("run") >= min_chars)
    words = rows.select(damaged(F.col("run"), F.col("doc_id"), every).alias("word"))
    return words.where(F.length("word") >= min_chars).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def rotations(words: DataFrame, longest: int = LONG) -> DataFrame:
    """Every rotation of every word twice: whole, and as a prefix that leaves its last letter open.

    Columns prefix, letter ('' for a whole rotation), fresh, n. Taking one of two equal neighbouring
    letters out gives the same word, so only the first of such a run of letters is ``fresh``. Prefixes
    of more than ``longest`` letters are left to ``hashed_rotations``.
    """
    size = F.length("word")

    def rest(at: Column, skipped: int) -> Column:
        return F.concat(F.substring(F.col("word"), at + 1 + skipped, size), F.lit(END), F.substring(F.col("word"), F.lit(1), at))

    def letter(at: Column) -> Column:
        return F.substring(F.col("word"), at + 1, F.lit(1))

    def whole(at: Column) -> Column:
        return F.struct(rest(at, 0).alias("prefix"), F.lit("").alias("letter"), F.lit(False).alias("fresh"))

    def open_(at: Column) -> Column:
        fresh = (at == 0) | (letter(at) != F.substring(F.col("word"), at, F.lit(1)))
        return F.struct(rest(at, 1).alias("prefix"), letter(at).alias("letter"), fresh.alias("fresh"))

    places = F.sequence(F.lit(0), size)
    opened = F.transform(F.slice(places, F.lit(1), size), open_)
    both = F.when(size <= longest, F.concat(F.transform(places, whole), opened)).otherwise(opened)
    return words.where(size <= longest + 1).select("n", F.explode(both).alias("at")).select("at.*", "n")


def hashed_rotations(words: DataFrame, longest: int = LONG, chunk: int = 50_000) -> DataFrame:
    """The rotations that ``rotations`` leaves out, each as a hash of 128 bits, its terminator's place and its size.

    A word of L letters has L rotations of L letters; sums of letters times powers give all their hashes in
    one pass, so a run of a million letters costs a million short rows. ``words`` has an ``id`` that stands
    for the word.
    """
    powers = [np.uint64(b) for b in (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)]
    inverses = [np.uint64(pow(int(b), -1, 2**64)) for b in powers]
    name = ["prefix", "letter", "fresh", "n", "id"]

    def turn(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for id_, word, n in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                code = np.frombuffer(word.encode("utf-32-le"), np.uint32)
                size = len(code)
                total, without = [], []
                for power, inverse in zip(powers, inverses, strict=True):
                    terms = mix(code.astype(np.uint64) + power)
                    terms[1:] *= np.cumprod(np.full(size - 1, power))
                    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)])
                    total.append(sums[-1])
                    without.append(sums[:-1] + (sums[-1] - sums[1:]) * inverse)
                fresh = np.concatenate([np.ones(1, bool), code[1:] != code[:-1]])
                for low in range(0, size + 1, chunk):
                    for opened in ([False, True] if size > longest + 1 else [False]):
                        at = np.arange(low, min(low + chunk, size if opened else size + 1), dtype=np.uint64)
                        hashes = [w[low : low + len(at)] if opened else np.full(len(at), t) for w, t in zip(without, total, strict=True)]
                        key = np.column_stack([*hashes, at, np.full(len(at), size - opened, np.uint64)])
                        count = len(at)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([k.tobytes() for k in key], pa.binary()),
                                pa.array([chr(c) for c in code[low : low + count]] if opened else [""] * count, pa.string()),
                                pa.array(fresh[low : low + count] if opened else np.zeros(count, bool)),
                                pa.array(np.full(count, n), pa.int64()), pa.array(np.full(count, id_), pa.int64()),
                            ],
                            name,
                        )

    some = words.where(F.length("word") > longest).select("id", "word", "n")
    return some.mapInArrow(turn, "prefix binary, letter string, fresh boolean, n long, id long")


def scanned(groups: DataFrame) -> DataFrame:
    """One row for each member (less, name, letter, fresh) of each group: name, near (partners there), other (the best)."""
    ranked = F.array_sort(F.transform("members", lambda m: F.struct(m["less"], m["name"])))
    rows = groups.where(F.size("members") > 1).select(
        F.size(F.filter("members", lambda m: m["letter"] != "")).alias("n_open"),
        F.size(F.filter("members", lambda m: m["fresh"])).alias("n_fresh"),
        F.slice(ranked, 1, 2).alias("top"), F.size("members").alias("n_all"), F.explode("members").alias("m"),
    )
    shorter = F.when(F.col("m.fresh"), F.col("n_all") - F.col("n_open")).otherwise(0)
    near = F.when(F.col("m.letter") == "", F.col("n_fresh")).otherwise(F.col("n_open") - 1 + shorter)
    other = F.when(F.col("top")[0]["name"] == F.col("m.name"), F.col("top")[1]).otherwise(F.col("top")[0])
    return rows.select(F.col("m.name").alias("name"), near.cast("long").alias("near"), other.alias("other")).where("near > 0 OR other IS NOT NULL")


def near_words(words: DataFrame, longest: int = LONG) -> DataFrame:
    """Words (word, n) that have near words: word, n_near, best (a struct of -n and word).

    Near words differ by exactly one inserted, deleted or replaced code point. Rotations are sorted over
    range partitions of the prefix, so that a prefix group lies in one of them and needs no second shuffle.
    """
    partitions = shuffle_partitions(words.sparkSession)
    turned = F.concat("prefix", "letter")
    word = F.concat(F.substring_index(turned, END, -1), F.substring_index(turned, END, 1))
    ordered = rotations(words, longest).repartitionByRange(partitions, "prefix")
    members = ordered.select("prefix", F.struct((-F.col("n")).alias("less"), word.alias("name"), "letter", "fresh").alias("m"))
    short = scanned(members.groupBy("prefix").agg(F.collect_list("m").alias("members")))
    # Ids of long words rise in the order of the words, so that they decide ties as the words do.
    long = staged(words.where(F.length("word") > longest).orderBy("word").withColumn("id", F.monotonically_increasing_id()), "long-words")
    ordered = hashed_rotations(long, longest).repartitionByRange(partitions, "prefix")
    members = ordered.select("prefix", F.struct((-F.col("n")).alias("less"), F.col("id").alias("name"), "letter", "fresh").alias("m"))
    rest = scanned(members.groupBy("prefix").agg(F.collect_list("m").alias("members")))
    rest = rest.groupBy("name").agg(F.sum("near").alias("near"), F.min("other").alias("other"))
    rest = rest.join(long.select(F.col("id").alias("name"), "word"), "name")
    other = long.select(F.col("id").alias("other_id"), F.col("word").alias("other_word"))
    rest = rest.join(other, F.col("other.name") == F.col("other_id")).select(
        F.col("word").alias("name"), "near", F.struct(F.col("other.less").alias("less"), F.col("other_word").alias("name")).alias("other")
    )
    return short.unionByName(rest).groupBy(F.col("name").alias("word")).agg(F.sum("near").alias("n_near"), F.min("other").alias("best"))


def followed(forms: DataFrame) -> DataFrame:
    """(word, form) to (word, root): forms are followed to the last by pointer doubling.

    A form has many times the occurrences of its word, so there are no cycles and a chain is as long as
    the logarithm of the largest count; the number of rounds is the logarithm of that.
    """
    now = staged(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = now.join(ahead, "root", "left")
        following = staged(joined.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "forms")
        discard(now)
        now = following.select("word", "root")
        if following.where("moved").isEmpty():
            return now


def spelling_variants(docs: DataFrame, every: int = 31, min_chars: int = 7, min_count: int = 2, ratio: int = 10) -> DataFrame:
    """Every word of ``docs`` with the spelling that it is likely a variant of.

    Words are maximal runs of Latin letters, A-Z lower-cased, of at least ``min_chars`` code points and
    ``min_count`` occurrences; where ``every`` divides the crc32 of ``<doc_id>:<run>``, one letter is taken
    out first. Returns word, form (the near word with the most occurrences, ties to the smaller word, if it
    has ``ratio`` times as many), root (forms followed to the last, the word itself if it has none), n,
    n_near (near words), form_n.

    Null and empty texts hold no words; rows without ``doc_id`` count under the empty id; repeated rows
    count as often as they stand there. Extra columns are not read. An empty table gives an empty result.
    """
    words = staged(vocabulary(docs.select("doc_id", "text"), every, min_chars, min_count), "vocabulary")
    near = words.join(near_words(words), "word", "left")
    chosen = -F.col("best.less") >= ratio * F.col("n")
    judged = staged(
        near.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(chosen, F.col("best.name")).alias("form"), F.when(chosen, -F.col("best.less")).alias("form_n"),
        ),
        "variants",
    )
    roots = followed(judged.where("form IS NOT NULL"))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
