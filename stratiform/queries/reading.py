"""Scans: formats, increments, payloads, rescue, listings, streams."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from stratiform.operators.export import export
from stratiform.operators.keyed import measure
from stratiform.queries.inputs import ctes, derive
from stratiform.queries.registry import query, table
from stratiform.session import new_folder
from stratiform.sources import files, jdbc, payload, rescue, stores
from stratiform.streaming import files as streams
from stratiform.streaming import windows

FORMATS = ["json", "csv", "parquet", "orc"]


@query(
    "scan_batch_formats",
    """SELECT f.fmt, c.* FROM customer c, (VALUES ('json'), ('csv'), ('parquet'), ('orc')) f(fmt)""",
)
def scan_batch_formats(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    report = None
    for fmt in FORMATS:
        path = export(customer, new_folder(spark, f"scan-{fmt}"), fmt)
        options = {"header": True} if fmt == "csv" else None
        back = files.read_files(spark, path, fmt, options, "full", schema=customer.schema)
        part = back.select(F.lit(fmt).alias("fmt"), *customer.columns)
        report = part if report is None else report.unionAll(part)
    return report


@query("scan_text_lines", f"{ctes('json_lines')} SELECT line AS value FROM json_lines")
def scan_text_lines(spark, sf_dir):
    path = new_folder(spark, "scan-text")
    derive(spark, sf_dir, "json_lines").write.text(path)
    return files.read_files(spark, path, "text", load_type="full")


@query("scan_incremental_files", "SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01 00:00:00'")
def scan_incremental_files(spark, sf_dir):
    """Two deliveries into one folder; only files newer than the first are read."""
    path = new_folder(spark, "deliveries")
    orders = table(spark, sf_dir, "orders")
    old = F.expr("o_orderdate < timestamp_ntz'1999-01-01 00:00:00'")
    orders.filter(old).write.json(path)
    seen = files.listing(spark, path).agg(F.max("modificationTime").cast("string")).first()[0]
    orders.filter(~old).write.mode("append").json(path)
    return files.read_files(spark, path, "json", since=seen, schema=orders.schema)


@query(
    "watermark_increment",
    "SELECT event_id, ts, value FROM events WHERE ts > TIMESTAMP '2024-01-15 12:00:00'",
)
def watermark_increment(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    return jdbc.beyond(events, "ts", "2024-01-15 12:00:00")


@query(
    "watermark_next",
    """SELECT CAST(max(o_orderdate) AS VARCHAR) AS watermark FROM orders
WHERE o_orderdate > TIMESTAMP '1996-01-01 00:00:00'""",
)
def watermark_next(spark, sf_dir):
    increment = jdbc.beyond(table(spark, sf_dir, "orders"), "o_orderdate", "1996-01-01 00:00:00")
    return jdbc.next_watermark(increment, "o_orderdate")


def _page_files(spark, sf_dir):
    """The pages as a file listing: where each would lie, its size, and a moment to each."""
    page = F.col("page_id")
    kind = page % 4
    name = (
        F.when(kind == 0, F.concat(F.lit("/_delta_log/"), page, F.lit(".json")))
        .when(kind == 1, F.concat(F.lit("/"), page, F.lit(".snappy.parquet")))
        .when(kind == 2, F.concat(F.lit("/"), page, F.lit(".parquet")))
        .otherwise(F.concat(F.lit("/"), page, F.lit(".csv")))
    )
    return table(spark, sf_dir, "pages").select(
        F.concat(F.lit("/lake/t"), page % 7, name).alias("path"),
        (F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")) + F.make_dt_interval(secs=page)).alias("modificationTime"),
        F.octet_length("html").cast("bigint").alias("length"),
    )


@query(
    "file_profile",
    """SELECT count(*) AS file_count, TIMESTAMP '2024-01-01' + to_seconds(min(page_id)) AS first_modified,
  TIMESTAMP '2024-01-01' + to_seconds(max(page_id)) AS last_modified,
  CAST(sum(strlen(html)) AS BIGINT) AS total_bytes FROM pages""",
)
def file_profile(spark, sf_dir):
    return files.file_profile(_page_files(spark, sf_dir))


@query(
    "file_layout",
    """SELECT '/lake/t' || (page_id % 7) AS folder, count(*) AS files,
  count(*) FILTER (page_id % 4 IN (1, 2)) AS parquet_files,
  count(*) FILTER (page_id % 4 = 1) AS snappy_parquet_files,
  count(*) FILTER (page_id % 4 = 0) AS log_entries FROM pages GROUP BY page_id % 7""",
)
def file_layout(spark, sf_dir):
    return files.layout(_page_files(spark, sf_dir))


@query(
    "stream_metadata",
    """SELECT count(*) AS row_count, 'web.events' AS _source_id, 'parquet' AS _source_format,
  'parquet' AS _autoloader_format, 'clicks' AS _metadata_source_name, TRUE AS file_known FROM events""",
)
def stream_metadata(spark, sf_dir):
    """Columns that a file stream adds to its rows."""
    name = f"stream_metadata_{uuid.uuid4().hex}"
    given = {"metadata_source_name": "clicks"}
    frame = streams.read_stream(
        spark, f"{sf_dir}/events.parque[t]", "parquet", "web", "events", given, table(spark, sf_dir, "events").schema
    )
    path = new_folder(spark, "stream-metadata")
    streams.land_stream(frame, name, new_folder(spark, "stream-state"), "web", "events", "load-1", path=path)
    known = F.col("_source_file").endswith(".parquet") & F.col("_ingestion_ts").isNotNull()
    return spark.table(name).groupBy("_source_id", "_source_format", "_autoloader_format", "_metadata_source_name").agg(
        F.count("*").alias("row_count"), F.bool_and(known).alias("file_known")
    )


@query(
    "stream_evolution",
    """SELECT event_id, event_type, CASE WHEN event_id % 2 = 1 THEN json_extract_string(props, '$.k') END AS k FROM events""",
)
def stream_evolution(spark, sf_dir):
    """Two starts of one stream; the files of the second have a key that the table then learns."""
    lines = derive(spark, sf_dir, "json_lines").withColumn("id", F.get_json_object("line", "$.event_id").cast("bigint"))
    old = F.to_json(F.struct("id", F.get_json_object("line", "$.event_type").alias("event_type")))
    path, state, known = (new_folder(spark, n) for n in ("evolving", "stream-state", "stream-schema"))
    name, place = f"stream_evolution_{uuid.uuid4().hex}", new_folder(spark, "stream-evolution")
    deliveries = (
        lines.where("id % 2 = 0").select(F.regexp_replace(old, '"id"', '"event_id"').alias("value")),
        lines.where("id % 2 = 1").select(F.col("line").alias("value")),
    )
    for rows in deliveries:
        rows.write.mode("append").text(path)
        frame = streams.read_stream(
            spark, path, "json", "web", "events", {"add_metadata_columns": False}, "event_id bigint, event_type string", known
        )
        streams.land_stream(frame, name, state, "web", "events", "load-1", path=place)
    return spark.table(name).select("event_id", "event_type", "k")


@query("attachment_refs", "SELECT DISTINCT url AS ref FROM pages WHERE trim(url) <> ''")
def attachment_refs(spark, sf_dir):
    return files.attachment_refs(table(spark, sf_dir, "pages"), "url")


_RECORDS = f"""{ctes('bodies')}
SELECT event_id, 0 AS pos, event_id AS id, 'a' AS v, CAST(NULL AS BIGINT) AS item,
  CAST(NULL AS VARCHAR) AS payload_error FROM bodies WHERE event_type = 'click'
UNION ALL SELECT event_id, 1, user_id, 'b', NULL, NULL FROM bodies WHERE event_type = 'click'
UNION ALL SELECT event_id, 0, user_id, 'c', NULL, NULL FROM bodies WHERE event_type = 'view'
UNION ALL SELECT event_id, 0, event_id, 'solo', NULL, NULL FROM bodies WHERE event_type = 'purchase'
UNION ALL SELECT event_id, 0, NULL, NULL, event_id, NULL FROM bodies WHERE event_type = 'signup'
UNION ALL SELECT event_id, 1, NULL, NULL, user_id, NULL FROM bodies WHERE event_type = 'signup'
UNION ALL SELECT event_id, NULL, NULL, NULL, NULL, 'body is not JSON' FROM bodies
  WHERE event_type = 'error'"""


@query("payload_explode", _RECORDS)
def payload_explode(spark, sf_dir):
    bodies = derive(spark, sf_dir, "bodies").select("event_id", "body")
    records = payload.explode_records(bodies, "body")

    def at(path: str, kind: str):
        return F.try_variant_get(F.col("record"), path, kind)

    return records.select(
        "event_id", "pos", at("$.id", "bigint").alias("id"), at("$.v", "string").alias("v"),
        at("$.value", "bigint").alias("item"), "payload_error",
    )


@query(
    "page_continuity",
    f"""{ctes('api_pages')}, starts AS (SELECT source_id, page_offset AS at, count(*) AS pages,
  CAST(sum(page_records) AS BIGINT) AS records FROM api_pages GROUP BY source_id, page_offset),
ends AS (SELECT DISTINCT source_id, page_offset + page_records AS at FROM api_pages WHERE page_records > 0),
g AS (SELECT s.source_id, CAST(sum(pages) AS BIGINT) AS pages, CAST(sum(records) AS BIGINT) AS records,
  count(*) FILTER (e.at IS NULL) - 1 AS gaps FROM starts s
  LEFT JOIN ends e ON e.source_id = s.source_id AND e.at = s.at GROUP BY s.source_id)
SELECT g.*, (SELECT min(page_offset) FROM api_pages p WHERE p.source_id = g.source_id
    AND page_records = 0) AS stop_offset,
  (SELECT count(*) FROM (SELECT next_token FROM api_pages p WHERE p.source_id = g.source_id
    GROUP BY next_token HAVING count(*) > 1)) AS repeated_tokens FROM g""",
)
def page_continuity(spark, sf_dir):
    pages = derive(spark, sf_dir, "api_pages")
    return payload.check_pages(pages, "source_id", "page_offset", "page_records", "next_token")


@query(
    "json_rescue",
    """SELECT event_id, event_type, '{"k":"' || json_extract_string(props, '$.k') || '"}' AS _rescued_data
FROM events""",
)
def json_rescue(spark, sf_dir):
    lines = derive(spark, sf_dir, "json_lines")
    return rescue.parse_lines(lines, "line", "event_id bigint, event_type string", "rescue")


@query("json_widened", "SELECT event_id, event_type, json_extract_string(props, '$.k') AS k FROM events")
def json_widened(spark, sf_dir):
    """addNewColumns: the schema is widened from the keys of all lines, then all are parsed."""
    lines = derive(spark, sf_dir, "json_lines")
    schema = rescue.widened_schema(lines, "line", "event_id bigint, event_type string")
    return rescue.parse_lines(lines, "line", schema, "addNewColumns")


@query(
    "mixed_json",
    f"""{ctes('json_files')} SELECT c_nationkey, c_custkey AS id, c_name AS name FROM json_files
UNION ALL SELECT c_nationkey, -1, NULL FROM json_files WHERE c_acctbal < 3000
UNION ALL SELECT c_nationkey, -2, c_mktsegment FROM json_files WHERE c_acctbal >= 6000""",
)
def mixed_json(spark, sf_dir):
    """Whole file bodies: JSON arrays, single objects over several lines, and JSON lines."""
    bodies = derive(spark, sf_dir, "json_files").select("c_nationkey", "body")
    return files.mixed_records(bodies, "body", "id bigint, name string")


_SHAPES_SQL = """
WITH c AS (SELECT *, c_custkey % 7 AS shape FROM customer)
SELECT c_custkey AS id, CASE WHEN shape IN (0, 1) THEN c_name WHEN shape = 5 THEN c_mktsegment END AS name, NULL AS bad
FROM c WHERE shape NOT IN (3, 4)
UNION ALL SELECT -1, NULL, NULL FROM c WHERE shape = 0
UNION ALL SELECT -2, c_name, NULL FROM c WHERE shape = 2
UNION ALL SELECT -3, NULL, NULL FROM c WHERE shape = 6
UNION ALL SELECT -4, 'a', NULL FROM c WHERE shape = 6
UNION ALL SELECT NULL, NULL, CAST(c_custkey AS VARCHAR) FROM c WHERE shape = 3
UNION ALL SELECT NULL, NULL, '{"id":' || c_custkey || ',"name":"' || c_name FROM c WHERE shape = 4
"""


def _shape_files(spark, sf_dir):
    """Files that mix arrays, objects over lines, several on a line, bare numbers and lines that end too early."""
    path = new_folder(spark, "json-shapes")
    derive(spark, sf_dir, "json_shapes").orderBy("c_custkey").select("body").write.text(path)
    return path


@query("mixed_json_files", _SHAPES_SQL)
def mixed_json_files(spark, sf_dir):
    return files.read_mixed_json(spark, _shape_files(spark, sf_dir), "id bigint, name string", bad="bad")


@query("stream_mixed_json", _SHAPES_SQL)
def stream_mixed_json(spark, sf_dir):
    """The same files as a stream of file names, whose batches are read split by split."""
    path, out, state = _shape_files(spark, sf_dir), new_folder(spark, "mixed-out"), new_folder(spark, "stream-state")
    wanted = {"schema_ddl": "id bigint, name string", "cloudFiles.maxFilesPerTrigger": 3, "add_metadata_columns": False}
    stream = streams.stream_of_files(spark, path, wanted)

    def batch(found, number):
        records = streams.mixed_batch(found, path, "crm", "customers", wanted)
        records.write.mode("overwrite").parquet(f"{out}/batch={number}")

    stream.writeStream.foreachBatch(batch).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).select("id", "name", F.col(files.CORRUPT).alias("bad"))


@query(
    "stream_output_modes",
    """SELECT m AS mode, event_type, user_band, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id
FROM (SELECT *, CASE WHEN user_id % 10 > 0 THEN user_id % 10 END AS user_band FROM events), (VALUES ('complete'), ('update')) v(m)
GROUP BY ALL""",
)
def stream_output_modes(spark, sf_dir):
    """A grouped stream in three micro-batches, landed whole each time and by its changed groups."""
    events = table(spark, sf_dir, "events")
    report = None
    for mode in ("complete", "update"):
        path, state, out = new_folder(spark, "modes-in"), new_folder(spark, "stream-state"), new_folder(spark, f"modes-{mode}")
        name = f"spark_catalog.default.{mode}_{uuid.uuid4().hex}"
        for part in range(3):
            events.where(F.col("event_id") % 3 == part).coalesce(1).write.mode("append").parquet(path)
            frame = streams.read_stream(spark, path, "parquet", "web", "events", {"add_metadata_columns": False}, events.schema)
            band = F.when(F.col("user_id") % 10 > 0, F.col("user_id") % 10).alias("user_band")
            groups = frame.groupBy("event_type", band).agg(
                F.count("*").alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id")
            )
            keys = ["event_type", "user_band"]
            streams.land_stream(groups, name, state, "web", "events", "load-1", {"outputMode": mode}, path=out, keys=keys)
        part = spark.table(name).select(F.lit(mode).alias("mode"), *keys, "n", "first_id", "last_id")
        report = part if report is None else report.unionByName(part)
    return report


@query(
    "stream_landing",
    """SELECT *, 'web' AS source_system, 'events' AS source_entity, 'load-1' AS load_id FROM events""",
)
def stream_landing(spark, sf_dir):
    """The events table as a stream, landed by available-now runs; the second finds nothing new."""
    events = table(spark, sf_dir, "events")
    name = f"stream_landing_{uuid.uuid4().hex}"
    checkpoint = new_folder(spark, "stream-state")
    path = new_folder(spark, "stream-landing")
    # A pattern, as the table may be one file or a folder of files.
    where = f"{sf_dir}/events.parque[t]"
    for _ in range(2):
        frame = streams.read_stream(spark, where, "parquet", "web", "events", schema=events.schema)
        streams.land_stream(frame, name, checkpoint, "web", "events", "load-1", path=path)
    landed = spark.table(name)
    return landed.select(*events.columns, "source_system", "source_entity", "load_id")


_LATE = "event_id % 10 = 3 AND ts < TIMESTAMP '2024-01-10 00:00:00'"


@query(
    "stream_windowed_checks",
    f"""WITH e AS (SELECT *, coalesce({_LATE}, FALSE) AS delivered_late FROM events),
first_part AS (SELECT max(ts) AS seen FROM e WHERE NOT delivered_late)
SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, CASE WHEN value >= 50 OR value IS NULL THEN 'PASS' ELSE 'FAIL' END AS status,
  delivered_late AND time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' <= seen - INTERVAL '2 hours' AS is_late, count(*) AS n
FROM e, first_part GROUP BY ALL""",
)
def stream_windowed_checks(spark, sf_dir):
    """Range checks by the hour. A tenth of the old events is delivered in a second start, after their windows closed."""
    events = table(spark, sf_dir, "events")
    path, state, out = new_folder(spark, "windows-in"), new_folder(spark, "stream-state"), new_folder(spark, "windows-out")
    name = f"spark_catalog.default.windows_{uuid.uuid4().hex}"
    late = F.coalesce(F.expr(_LATE.replace("TIMESTAMP ", "timestamp_ntz")), F.lit(False))
    for part in (~late, late):
        events.where(part).coalesce(2).write.mode("append").parquet(path)
        frame = streams.read_stream(spark, path, "parquet", "web", "events", {"add_metadata_columns": False}, events.schema)
        checks = {"range_constraints": {"value": {"min": 50}}}
        windows.stream_window_counts(frame, name, state, checks, "ts", "1 hour", "2 hours", path=out)
    found = windows.window_counts(spark, name)
    return found.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "status", "is_late", "n")


_QUOTED = "concat('a;', o_orderpriority, chr(39), chr(10), o_orderstatus)"


def _delimited(spark, sf_dir):
    """Orders as files with their own separator and quotes, values over two lines, and a file that no pattern matches."""
    path = new_folder(spark, "delimited")
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_totalprice", f"{_QUOTED} AS note")
    writer = orders.write.options(header="true", sep=";", quote="'", escape="#", encoding="UTF-8")
    writer.mode("append").csv(path)
    orders.limit(1).write.mode("append").json(path)
    return path, {"header": True, "sep": ";", "quote": "'", "escape": "#", "encoding": "UTF-8", "multiLine": True, "pathGlobFilter": "*.csv"}


_DELIMITED_SQL = "SELECT o_orderkey, o_totalprice, 'a;' || o_orderpriority || chr(39) || chr(10) || o_orderstatus AS note FROM orders"
_DELIMITED_DDL = "o_orderkey bigint, o_totalprice double, note string"


@query("reader_options", _DELIMITED_SQL)
def reader_options(spark, sf_dir):
    path, options = _delimited(spark, sf_dir)
    return files.read_files(spark, path, "csv", options, load_type="full", schema=_DELIMITED_DDL)


@query("stream_reader_options", _DELIMITED_SQL)
def stream_reader_options(spark, sf_dir):
    """The same files as a stream, a file for each batch; a hint gives a column its type."""
    path, options = _delimited(spark, sf_dir)
    given = options | {
        "schema_ddl": "o_orderkey bigint, o_totalprice string, note string", "cloudFiles.schemaHints": "o_totalprice double",
        "cloudFiles.maxFilesPerTrigger": 1, "add_metadata_columns": False,
    }
    name = f"stream_options_{uuid.uuid4().hex}"
    frame = streams.read_stream(spark, path, "csv", "erp", "orders", given)
    out, state = new_folder(spark, "stream-options"), new_folder(spark, "stream-state")
    streams.land_stream(frame, name, state, "erp", "orders", "load-1", {k: v for k, v in given.items() if k.startswith("cloud")}, path=out)
    return spark.table(name).select("o_orderkey", "o_totalprice", "note")


#: Files in a folder, and for a task that writes them.
_FOLDER_FILES, _TASK_FILES = 1_000, 20_000


def _file_each(texts, path):
    """A text file for each value. A task that runs again writes the same files, as it has its values in order."""
    spark = texts.sparkSession
    system, inner = stores.opened(path)
    system.create_dir(inner)

    def write(batches):
        system, root = stores.opened(path)
        task, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            for value in batch.column(0).to_pylist():
                folder = f"{root}/{task}-{n // _FOLDER_FILES}"
                if n % _FOLDER_FILES == 0:
                    system.create_dir(folder)
                with system.open_output_stream(f"{folder}/{n % _FOLDER_FILES}.txt") as out:
                    out.write(f"{value or ''}\n".encode())
                n += 1
        yield pa.RecordBatch.from_pydict({"files": [n]})

    tasks = max(4, spark.sparkContext.defaultParallelism, -(-texts.count() // _TASK_FILES))
    texts.repartition(tasks).sortWithinPartitions("value").mapInArrow(write, "files bigint").agg(F.sum("files")).collect()


@query(
    "attachment_copy",
    "SELECT 'page ' || page_id AS content, TRUE AS copied FROM pages UNION ALL SELECT NULL, FALSE FROM pages WHERE page_id % 10 = 0",
)
def attachment_copy(spark, sf_dir):
    """A file for each page, copied by reference; every tenth page names a second file, which is not there."""
    pages, path = table(spark, sf_dir, "pages").select("page_id"), new_folder(spark, "attachments")
    _file_each(pages.select(F.concat(F.lit("page "), "page_id").alias("value")), path)
    held = stores.listing(spark, path)
    plain = F.regexp_replace("path", "^file:/+", "/")
    missing = pages.where("page_id % 10 = 0").select(F.concat(F.lit("/no/such/file/"), "page_id").alias("ref"))
    refs = held.select(plain.alias("ref")).unionByName(missing)
    out = new_folder(spark, "attachments-copied")
    report = measure(files.copy_attachments(refs, held, out if "://" in out else f"file://{out.removeprefix('file:')}"), "copied").frame
    copies = stores.with_contents(report, "new_path")
    return copies.select(F.rtrim(F.col("content").cast("string"), F.lit("\n")).alias("content"), F.col("new_path").isNotNull().alias("copied"))
