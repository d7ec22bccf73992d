"""Records and page order of landed API pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Keys that may wrap the record list, in the order in which they are tried.
ENVELOPE_KEYS = ["data", "items", "results", "records", "value", "content"]


def _list_at(value: Column, path: str = "$") -> Column:
    """The list at a path, NULL when there is none or something else is there."""
    return F.try_variant_get(value, path, "array<variant>")


def _is_object(value: Column) -> Column:
    return F.try_variant_get(value, "$", "map<string,variant>").isNotNull()


def explode_records(df: DataFrame, body: str, envelope: str | None = None) -> DataFrame:
    """One row per record of each page body, as variant ``record`` at position ``pos``.

    A list yields its items, wrapped as ``{"value": item}`` when one of them is not an object. An
    object yields the list under ``envelope`` (dotted path), or under the first of the usual keys
    that holds a list, or else itself. ``payload_error`` tells of bodies without records: not
    JSON, or lacking the configured envelope.
    """
    page = F.col("__page")
    parsed = df.withColumn("__page", F.try_parse_json(F.col(body)))
    error = F.when(page.isNull(), "body is not JSON")
    if envelope:
        nested = F.try_variant_get(page, f"$.{envelope}", "variant")
        single = F.when(nested.isNotNull() & ~F.is_variant_null(nested), F.array(nested))
        listed = F.coalesce(_list_at(page), _list_at(page, f"$.{envelope}"), single)
        error = error.when(F.col("__list").isNull(), f"envelope {envelope!r} not found")
    else:
        usual = [_list_at(page, f"$.{key}") for key in ENVELOPE_KEYS]
        listed = F.coalesce(_list_at(page), *usual, F.when(_is_object(page), F.array(page)))
    found = parsed.withColumn("__list", listed).select(
        *df.columns, error.alias("payload_error"), "__list"
    )
    rows = found.select(
        *df.columns,
        "payload_error",
        F.forall(F.col("__list"), _is_object).alias("__plain"),
        F.posexplode_outer("__list").alias("pos", "__item"),
    )
    item = F.col("__item")
    text = F.coalesce(F.to_json(item), F.lit("null"))
    wrapped = F.parse_json(F.concat(F.lit('{"value":'), text, F.lit("}")))
    record = F.when(F.col("pos").isNull(), F.lit(None)).when(F.col("__plain"), item).otherwise(wrapped)
    kept = rows.filter(F.col("pos").isNotNull() | F.col("payload_error").isNotNull())
    return kept.select(*df.columns, "pos", record.alias("record"), "payload_error")


def check_pages(
    pages: DataFrame, source: str, offset: str, records: str, token: str | None = None
) -> DataFrame:
    """Per source: pages, records, offset gaps, repeated cursor tokens and the stop offset.

    Pages are first grouped by (source, position) with map-side combining, so a source with very
    many pages is spread over all tasks. A gap is a page start, other than the first, at which no
    page ends. The stop offset is that of the first empty page.
    """
    at, n = F.col(offset), F.col(records)
    marks = F.array(
        F.struct(at.alias("at"), F.lit(1).alias("starts"), n.alias("n")),
        F.when(n > 0, F.struct((at + n).alias("at"), F.lit(0).alias("starts"), n.alias("n"))),
    )
    points = (
        pages.select(source, F.explode(marks).alias("mark"))
        .filter("mark is not null")
        .select(source, "mark.*")
        .groupBy(source, "at")
        .agg(
            F.sum("starts").alias("starts"),
            F.count_if(F.col("starts") == 0).alias("ends"),
            F.sum(F.when(F.col("starts") == 1, F.col("n")).otherwise(0)).alias("n"),
            F.min(F.when((F.col("starts") == 1) & (F.col("n") == 0), F.col("at"))).alias("empty_at"),
        )
    )
    open_starts = F.count_if((F.col("starts") > 0) & (F.col("ends") == 0))
    report = points.groupBy(source).agg(
        F.sum("starts").alias("pages"),
        F.sum("n").alias("records"),
        (open_starts - 1).alias("gaps"),
        F.min("empty_at").alias("stop_offset"),
    )
    if token is None:
        return report
    repeated = (
        pages.filter(F.col(token).isNotNull())
        .groupBy(source, token)
        .agg(F.count(F.lit(1)).alias("__uses"))
        .groupBy(source)
        .agg(F.count_if(F.col("__uses") > 1).alias("repeated_tokens"))
    )
    joined = report.join(repeated, source, "left")
    return joined.select(
        *report.columns, F.coalesce("repeated_tokens", F.lit(0).cast("bigint")).alias("repeated_tokens")
    )
