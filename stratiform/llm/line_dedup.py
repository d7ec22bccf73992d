"""Line dedup against levelled sorted runs of line hashes.

Documents arrive in batches of rising ``doc_id``. The hashes of lines seen so far lie in runs, Spark
tables bucketed and sorted by hash. A batch joins its distinct hashes with every run in order of hash;
those that no run holds become a run of level 0. When a level has ``fan_in`` runs they are merged into
one of the next level, so the number of runs stays logarithmic in the number of batches. Everything
is DataFrame work: no Python touches a row.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.llm.common import shuffle_partitions, with_own
from stratiform.session import drop_folder, new_folder

#: What is stripped at both ends of a line, and the letters that are lower-cased.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """A row for each line that counts: document, fingerprint of its text, position, 128-bit hash."""
    lines = docs.where(F.col("doc_id").isNotNull()).select(
        "doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(split_lines(F.col("text"))).alias("pos", "line")
    )
    keyed = lines.select("doc_id", "text_hash", "pos", line_key(F.col("line")).alias("key"))
    return keyed.where(F.length("key") >= min_chars).select(
        "doc_id", "text_hash", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), F.col("key")).alias("h2")
    )


class LineRuns:
    """The runs: which line hashes have been seen, and the smallest document that holds each."""

    def __init__(self, spark: SparkSession, fan_in: int = 3, buckets: int | None = None):
        self.spark, self.fan_in = spark, fan_in
        self.buckets = buckets or shuffle_partitions(spark)
        self.levels: list[list[str]] = []
        self.paths: dict[str, str] = {}

    def _store(self, frame: DataFrame, *parts: str) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        self.paths[name] = new_folder(self.spark, "line-run")
        writer = frame.write.format("parquet").option("path", self.paths[name]).bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2")
        (writer.partitionBy(*parts) if parts else writer).saveAsTable(name)
        return name

    def _run(self, name: str) -> DataFrame:
        return self.spark.table(name).where("fresh").select("h1", "h2", "owner")

    def add(self, lines: DataFrame) -> DataFrame:
        """Hashes of this batch that a smaller document holds for at least one of its holders.

        Columns h1, h2, owner. The hashes that no run holds are added as a new run.
        """
        found = lines.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        known = F.lit(None).cast("long")
        for at, name in enumerate(name for level in self.levels for name in level):
            run = self._run(name).withColumnRenamed("owner", f"owner_{at}")
            found = found.join(run, ["h1", "h2"], "left")
            known = F.coalesce(known, F.col(f"owner_{at}"))
        name = self._store(
            found.select("h1", "h2", F.coalesce(known, "first").alias("owner"), "last", known.isNull().alias("fresh")),
            "fresh",
        )
        self._push(name, 0)
        # Read by its path it is no bucketed table: lines and this side are both shuffled, and adaptive
        # execution can then split a line that very many documents hold over several tasks.
        stored = self.spark.read.schema(self.spark.table(name).schema).parquet(self.paths[name])
        return stored.where("owner < last").select("h1", "h2", "owner")

    def _push(self, name: str, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) == self.fan_in:
            merged = self._run(self.levels[level][0])
            for other in self.levels[level][1:]:
                merged = merged.unionByName(self._run(other))
            merged = merged.repartition(self.buckets, "h1", "h2").withColumn("fresh", F.lit(True))
            old, self.levels[level] = self.levels[level], []
            self._push(self._store(merged), level + 1)
            # Level 0 also holds what its batch has to drop; that stays until the caller is done.
            for gone in old if level else []:
                self.spark.sql(f"DROP TABLE {gone}")
                drop_folder(self.spark, self.paths.pop(gone))


def dedup_batch(docs: DataFrame, runs: LineRuns, min_chars: int = 10) -> DataFrame:
    """``docs`` without the lines that an earlier batch, or a smaller document of this one, holds."""
    repeated = runs.add(line_hashes(docs, min_chars))
    drops = (
        line_hashes(docs, min_chars)
        .join(repeated, ["h1", "h2"])
        .where("doc_id > owner")
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set("pos").alias("dropped"))
        .select(F.col("doc_id").alias("drop_id"), F.col("text_hash").alias("drop_hash"), "dropped")
    )
    packed = docs.select(F.struct("*").alias("row"))
    joined = packed.join(
        drops, (F.col("row.doc_id") == F.col("drop_id")) & (F.xxhash64("row.text") == F.col("drop_hash")), "left"
    )
    return _cleaned(joined.select("row", F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped")))


def _cleaned(joined: DataFrame) -> DataFrame:
    lines = split_lines(F.col("row.text"))
    counted = joined.select("row", "dropped", lines.alias("lines"), F.size(lines).alias("n"))
    kept = F.array_except(F.sequence(F.lit(0), F.col("n") - 1), "dropped")
    text = F.when(
        F.size("dropped") > 0, F.array_join(F.transform(kept, lambda at: F.get("lines", at)), "\n")
    ).otherwise(F.coalesce("row.text", F.lit("")))
    row = counted.select(
        "row.*", F.struct(text.alias("t"), F.col("n").cast("long").alias("n"), F.size("dropped").cast("long").alias("d")).alias("__own")
    )
    own = {"text": F.col("__own.t"), "n_lines": F.col("__own.n"), "n_dropped": F.col("__own.d")}
    return with_own(row, **own).drop("__own")


def line_dedup(docs: DataFrame, batches: int = 4, fan_in: int = 3, min_chars: int = 10) -> DataFrame:
    """Keep each repeated line in the smallest document that holds it.

    A line's key is the line stripped of blanks and with A-Z lower-cased. Keys of ``min_chars`` code
    points or more that are found in two documents lose all their lines but those of the smallest
    ``doc_id``; several such lines inside that document stay. Returns the input's columns with ``text``
    replaced, and ``n_lines`` (before dropping) and ``n_dropped``.

    Null or empty text is one empty line and comes back empty. Rows that repeat a ``doc_id`` are one
    document. Rows without a ``doc_id`` neither hold nor lose lines. Extra columns stay; ones that are
    named like an own column give way to it. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    shares = [i / batches for i in range(1, batches)]
    cuts = docs.agg(F.percentile_approx("doc_id", F.array(*[F.lit(s) for s in shares]), 10_000)).first()[0] if shares else []
    cuts = sorted(set(cuts or []))
    runs = LineRuns(spark, fan_in)
    doc_id = F.col("doc_id")
    parts = []
    for low, high in zip([None, *cuts], [*cuts, None], strict=True):
        inside = doc_id.isNotNull()
        inside = inside & (doc_id >= low) if low is not None else inside
        inside = inside & (doc_id < high) if high is not None else inside
        parts.append(dedup_batch(docs.where(inside), runs, min_chars))
    nameless = docs.where(doc_id.isNull()).select(F.struct("*").alias("row"), F.array().cast("array<int>").alias("dropped"))
    result = _cleaned(nameless)
    for part in parts:
        result = result.unionByName(part)
    return result
