"""Surrogate generation over a corpus: detection, collision checks between all entities, replacement."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.llm.common import discard, staged, with_own
from stratiform.llm.pii_entities import Surrogates, find_entities

#: Originals with another attempt than the first are sent to all executors up to this number; beyond it
#: they reach their documents by joins.
BROADCAST_ENTITIES = 100_000

_FOUND = "array<struct<kind:string,start:bigint,end:bigint,surrogate:string>>"


def _mentions(docs: DataFrame) -> DataFrame:
    """Distinct entities of every text: doc_id, text_hash, kind, canonical, gender."""

    def find(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            rows = []
            for doc_id, text_hash, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                own = dict.fromkeys((e.kind, e.canonical, e.gender) for e in find_entities(text))
                rows += [(doc_id, text_hash, *e) for e in own]
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "text_hash", "kind", "canonical", "gender"]
            )

    read = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text")
    return read.mapInArrow(find, "doc_id long, text_hash long, kind string, canonical string, gender string")


def _with_surrogates(entities: DataFrame, key: bytes) -> DataFrame:
    """Add ``surrogate`` to rows of kind, canonical, attempt."""

    def add(batches: Iterator) -> Iterator:
        import pyarrow as pa

        maker = Surrogates(key)
        for batch in batches:
            kind, text, attempt = (batch.column(i).to_pylist() for i in range(3))
            made = [maker.of(k, t, attempt=a) for k, t, a in zip(kind, text, attempt, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], [*batch.schema.names, "surrogate"])

    return entities.select("kind", "canonical", "attempt").mapInArrow(add, "kind string, canonical string, attempt int, surrogate string")


def surrogate_table(mentions: DataFrame, key: bytes) -> DataFrame:
    """kind, canonical, attempt, surrogate of every entity; no two share a surrogate, none is an original.

    Of originals that share a surrogate the smallest keeps it; all others, and those whose surrogate is
    an original of the corpus, try again until there are none. Every attempt has a larger space to draw
    from (``Surrogates.of``), so a few rounds do, however many originals a format has.
    """
    now = staged(_with_surrogates(mentions.select("kind", "canonical").distinct().withColumn("attempt", F.lit(0)), key), "surrogates")
    originals = now.select("kind", F.col("canonical").alias("surrogate"))
    while True:
        keeper = now.groupBy("kind", "surrogate").agg(F.min("canonical").alias("keeper"), F.count("*").alias("n")).where("n > 1")
        twice = now.join(keeper, ["kind", "surrogate"]).where("canonical <> keeper").select("kind", "canonical")
        real = now.join(originals, ["kind", "surrogate"]).select("kind", "canonical")
        bad = staged(twice.unionByName(real).distinct(), "surrogate-collisions")
        if bad.isEmpty():
            return now
        again = now.join(bad, ["kind", "canonical"]).select("kind", "canonical", (F.col("attempt") + 1).alias("attempt"))
        rest = now.join(bad, ["kind", "canonical"], "left_anti")
        tried, now = now, staged(rest.unionByName(_with_surrogates(again, key).select(*rest.columns)), "surrogates")
        originals = now.select("kind", F.col("canonical").alias("surrogate"))
        discard(bad)
        discard(tried)


def replace_personal_data(docs: DataFrame, key: bytes = b"stratiform") -> DataFrame:
    """Replace e-mail and IP addresses, IBANs, card, phone and nine-digit numbers, and names.

    Returns the input's columns with ``text`` replaced, and ``replaced``: (kind, start, end, surrogate)
    of each entity in order, positions in code points of the original text, end exclusive. The same
    original gets the same surrogate in every document, in the case and with the separators of the
    mention; different originals get different ones. ``key`` decides which; keep it secret.

    Texts without entities come back unchanged, null texts null. Repeated rows get equal results. Rows
    without ``doc_id`` are treated alike. Extra columns stay; one named ``replaced`` gives way. An empty
    table gives an empty result.
    """
    mentions = staged(_mentions(docs), "mentions")
    table = surrogate_table(mentions, key)
    retried = table.where("attempt > 0").select("kind", "canonical", "attempt")
    many = retried.limit(BROADCAST_ENTITIES + 1).count()
    own = with_own(docs, replaced=F.array().cast(_FOUND))
    if not many:
        return _replaced(own, key)
    tried = mentions.join(F.broadcast(retried) if many <= BROADCAST_ENTITIES else retried, ["kind", "canonical"])
    per_text = tried.groupBy("doc_id", "text_hash").agg(
        F.map_from_entries(F.collect_set(F.struct(F.concat_ws(":", "kind", "canonical").alias("k"), "attempt"))).alias("__attempts")
    )
    # Only texts that hold a retried original; whether that is few enough to send out is Spark's choice.
    keyed = own.withColumns({"__id": F.col("doc_id").cast("long"), "__hash": F.xxhash64("text")})
    per_text = per_text.select(F.col("doc_id").alias("__of"), F.col("text_hash").alias("__text"), "__attempts")
    joined = keyed.join(per_text, F.col("__id").eqNullSafe(F.col("__of")) & (F.col("__hash") == F.col("__text")), "left")
    return _replaced(joined.select(*[F.col(f"`{c}`") for c in own.columns], "__attempts"), key).select(*[F.col(f"`{c}`") for c in own.columns])


def _replaced(docs: DataFrame, key: bytes) -> DataFrame:
    names = docs.columns

    def replace(batches: Iterator) -> Iterator:
        import pyarrow as pa

        maker = Surrogates(key)
        at_text, at_found = names.index("text"), names.index("replaced")
        for batch in batches:
            texts, found = [], []
            attempts = batch.column(names.index("__attempts")).to_pylist() if "__attempts" in names else [None] * batch.num_rows
            for text, own in zip(batch.column(at_text).to_pylist(), attempts, strict=True):
                tried, rows, parts, end = dict(own or []), [], [], 0
                for e in find_entities(text):
                    new = maker.written(e, text[e.start : e.end], tried.get(f"{e.kind}:{e.canonical}", 0))
                    parts += [text[end : e.start], new]
                    end = e.end
                    rows.append({"kind": e.kind, "start": e.start, "end": e.end, "surrogate": new})
                texts.append("".join([*parts, text[end:]]) if rows else text)
                found.append(rows)
            columns = list(batch.columns)
            columns[at_text] = pa.array(texts, pa.string())
            columns[at_found] = pa.array(found, batch.schema.field("replaced").type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(replace, docs.schema)
