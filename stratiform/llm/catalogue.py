"""Registered queries of this package: one for each operator, and the pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.llm import toxicity
from stratiform.llm.collocations import collocations
from stratiform.llm.common import held_out
from stratiform.llm.containment import contained_items
from stratiform.llm.fast_sketch import near_duplicates
from stratiform.llm.hnsw import search_embeddings
from stratiform.llm.language_crf import identify
from stratiform.llm.line_dedup import line_dedup
from stratiform.llm.ngram_join import jaccard_join
from stratiform.llm.packing import pack
from stratiform.llm.pii_surrogates import replace_personal_data
from stratiform.llm.secrets import BASE_RULES, find_secrets, joined_spans
from stratiform.llm.spelling import spelling_variants
from stratiform.llm.token_counts import token_counts

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


LINES_SQL = r"""
lines AS (
  SELECT doc_id, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos,
         unnest(string_split(coalesce(text, ''), chr(10))) AS line
  FROM {docs}),
keyed AS (
  SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
owners AS (
  SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) > 1),
marked AS (
  SELECT k.doc_id, pos, line, owner IS NOT NULL AND owner <> k.doc_id AS gone
  FROM keyed k LEFT JOIN owners o ON k.key = o.key AND length(k.key) >= 10),
cleaned AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS kept
  FROM marked GROUP BY doc_id)
"""

OP4_SQL = (
    "WITH " + LINES_SQL.format(docs="documents")
    + "SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM cleaned"
)


SHINGLES_SQL = r"""
words AS (
  SELECT {id}, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS w FROM {table}),
shingled AS (
  SELECT DISTINCT {id}, unnest(list_transform(range(1, greatest(len(w) - 3, 2)),
         lambda i: array_to_string(w[i:i + 4], ' '))) AS s
  FROM words WHERE len(w) > 0)
"""

OP1_SQL = "WITH RECURSIVE " + SHINGLES_SQL.format(id="doc_id", table="documents") + """,
sizes AS (SELECT doc_id, count(*) AS n FROM shingled GROUP BY doc_id),
both_have AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingled a JOIN shingled b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY ALL),
links AS (
  SELECT a, b FROM both_have h JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE h.n >= 0.8 * (x.n + y.n - h.n)),
reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
classes AS (SELECT a AS doc_id, min(b) AS class_id FROM reached GROUP BY a),
degrees AS (SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY a)
SELECT doc_id, class_id, coalesce(n_links, 0) AS n_links, coalesce(n, 0) AS n_shingles
FROM classes LEFT JOIN degrees USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""


@_query("op1_ngram_join", OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(_table(spark, sf_dir, "documents"))


@_query("op4_line_dedup", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "utf-8"), 256).alias("kept_sha256"))


@_query("op8_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(_table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@_query("op9_language_crf")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return identify(docs.select("doc_id", "text", "lang")).select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


OP10_SQL = "WITH " + SHINGLES_SQL.format(id="doc_id", table="documents") + """,
item_words AS (
  SELECT item_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM benchmark),
item_shingles AS (
  SELECT DISTINCT item_id, unnest(list_transform(range(1, greatest(len(w) - 3, 2)),
         lambda i: array_to_string(w[i:i + 4], ' '))) AS s
  FROM item_words WHERE len(w) > 0),
item_sizes AS (SELECT item_id, count(*) AS item_shingles FROM item_shingles GROUP BY item_id)
SELECT doc_id, item_id, count(*) / any_value(item_shingles) AS containment, count(*) AS shared,
       any_value(item_shingles) AS item_shingles
FROM shingled JOIN item_shingles USING (s) JOIN item_sizes USING (item_id)
GROUP BY doc_id, item_id HAVING count(*) >= 0.8 * any_value(item_shingles)
"""


@_query("op10_containment", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contained_items(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("items").alias("item")).select("doc_id", "item.*")


@_query("op3_secret_scan")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = [rule.kind for rule in BASE_RULES]
    base = F.filter("secrets", lambda s: s["kind"].isin(kinds))
    found_kinds = F.transform("secrets", lambda s: s["kind"])
    counts = [(F.size("secrets") - F.size(F.array_remove(found_kinds, k))).cast("long").alias(f"n_{k}") for k in kinds]
    return found.select("doc_id", *counts, F.sha2(joined_spans(base), 256).alias("base_sha256"), joined_spans(F.col("secrets")).alias("spans"))


@_query("op6_token_counts")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_words", "n_tokens")


@_query("op7_toxicity")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model).select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", "predicted", "worst_sentence",
        F.size("offending").cast("long").alias("n_offending"),
    )


@_query("op2_hnsw")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_embeddings(_table(spark, sf_dir, "embeddings"))


@_query("op5_pii_surrogates")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = replace_personal_data(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return clean.select(
        "doc_id", "text", F.size("replaced").cast("long").alias("n_replaced"), joined_spans(F.col("replaced")).alias("spans")
    )


# crc32 by half bytes: a table of 16 remainders, folded over the digits of the text's hexadecimal form.
OP11_SQL = r"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[a-z\x{00C0}-\x{00FF}]+')) AS run
  FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY doc_id, run),
nibbles AS (
  SELECT *, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS h,
         list_transform(range(0, 16), lambda i: list_reduce([i, 0, 0, 0, 0],
           lambda c, x: xor(c >> 1, 3988292384 * (c & 1)))) AS t
  FROM counted),
checked AS (
  SELECT doc_id, run, n, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(0, length(h)),
      lambda i: instr('123456789ABCDEF', substr(h, (i + 1 + 1 - 2 * (i % 2))::BIGINT, 1))::BIGINT)),
    lambda c, x: xor(c >> 4, t[(xor(c, x) & 15) + 1]))) AS crc
  FROM nibbles),
spelled AS (
  SELECT CASE WHEN crc % 31 = 0 THEN run[:(crc % length(run))::BIGINT] || run[(crc % length(run) + 2)::BIGINT:] ELSE run END AS word, n FROM checked),
words AS (SELECT word, sum(n)::BIGINT AS n FROM spelled WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cuts AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS pos FROM words),
without AS (SELECT word, n, pos, word[:pos - 1] || word[pos + 1:] AS rest FROM cuts),
pairs AS (
  SELECT a.word AS a, a.n AS a_n, b.word AS b, b.n AS b_n FROM without a JOIN without b ON a.rest = b.rest AND a.pos = b.pos AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM words a JOIN without b ON a.word = b.rest
  UNION SELECT b.word, b.n, a.word, a.n FROM words a JOIN without b ON a.word = b.rest),
best AS (SELECT a AS word, count(*) AS n_near, arg_min(b, (-b_n, b)) AS form, max(b_n) AS form_n FROM pairs GROUP BY a),
judged AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * n THEN form END AS form,
         CASE WHEN form_n >= 10 * n THEN form_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
chains AS (
  SELECT word, word AS root, form AS ahead FROM judged
  UNION ALL SELECT c.word, c.ahead, j.form FROM chains c JOIN judged j ON j.word = c.ahead)
SELECT j.word, j.form, c.root, j.n, j.n_near, j.form_n FROM judged j JOIN chains c ON c.word = j.word AND c.ahead IS NULL
"""


@_query("op11_spelling", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(_table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w FROM documents),
shingled AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 2, 2)), lambda i: array_to_string(w[i:i + 3], ' '))) AS s
  FROM worded WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingled GROUP BY doc_id),
both_have AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingled a JOIN shingled b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY ALL),
links AS (
  SELECT a, b FROM both_have h JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * h.n >= 80 * (x.n + y.n - h.n)),
reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
components AS (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM components LEFT JOIN sizes USING (doc_id)
"""


@_query("op12_fast_sketch", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
placed AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded),
ones AS (SELECT lang, w[i] AS x, count(*) AS n FROM placed GROUP BY ALL),
twos AS (SELECT lang, w[i] AS x, w[i + 1] AS y, count(*) AS n FROM placed WHERE i < len(w) GROUP BY ALL HAVING count(*) >= 10),
threes AS (SELECT lang, w[i] AS x, w[i + 1] AS y, w[i + 2] AS z, count(*) AS n FROM placed WHERE i + 1 < len(w) GROUP BY ALL HAVING count(*) >= 10),
sizes AS (SELECT lang, sum(n)::BIGINT AS n FROM ones GROUP BY lang),
cuts AS (
  SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z AS phrase, t.n AS a, 1 AS k, o.n AS l, p.n AS r
  FROM threes t JOIN ones o ON o.lang = t.lang AND o.x = t.x JOIN twos p ON p.lang = t.lang AND p.x = t.y AND p.y = t.z
  UNION ALL
  SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z, t.n, 2, p.n, o.n
  FROM threes t JOIN ones o ON o.lang = t.lang AND o.x = t.z JOIN twos p ON p.lang = t.lang AND p.x = t.x AND p.y = t.y
  UNION ALL
  SELECT t.lang, t.x || ' ' || t.y, t.n, 1, o.n, p.n
  FROM twos t JOIN ones o ON o.lang = t.lang AND o.x = t.x JOIN ones p ON p.lang = t.lang AND p.x = t.y
  WHERE NOT EXISTS (FROM threes h WHERE h.lang = t.lang AND 100 * h.n >= 50 * t.n AND h.x = t.x AND h.y = t.y)
    AND NOT EXISTS (FROM threes h WHERE h.lang = t.lang AND 100 * h.n >= 50 * t.n AND h.y = t.x AND h.z = t.y)),
scored AS (SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM cuts),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM lowest)
SELECT lang, rank, phrase, a, l, r, s.n, score FROM ranked JOIN sizes s USING (lang) WHERE rank <= 2000
"""


@_query("op13_collocations", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents"))
