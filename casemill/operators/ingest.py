"""From paged API responses to keyed messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from casemill.functions import nested, values

_PAGE = {"results": "array<string>"}


def explode_pages(
    pages: DataFrame,
    *,
    body: str = "value",
    page: str = "page",
    page_size: int = 100,
    cycle: str | None = None,
    stop_at_empty: bool = False,
) -> DataFrame:
    """One row per record of every page, with the record's original text.

    ``page`` holds 0-based page numbers. Adds ``position`` (place on the page)
    and ``record_offset`` (``page * page_size + position``) and replaces the body
    by ``record``. A page without ``results`` gives no rows.

    A fetcher that reads page by page ends its cycle at the first empty page.
    ``stop_at_empty`` drops what lies behind one, per ``cycle`` column. A missing page
    (null or blank) counts as empty; a broken one does not, and ``broken_pages`` has it.
    """
    parsed = nested.parse_once(pages, body, _PAGE, "_page")
    results = F.col("_page.results")
    if stop_at_empty:
        empty = (F.coalesce(F.size(results), F.lit(0)) < 1) & ~_broken()
        end = F.min(F.when(empty, F.col(page))).alias("_end")
        if cycle is None:
            stop = parsed.agg(end).scalar()
            parsed = parsed.filter(stop.isNull() | (F.col(page) < stop))
        else:
            # One row per cycle, minimised map-side; a cycle holding most pages is
            # split by the adaptive skew join. Pages without a cycle are one, too.
            ends = parsed.groupBy(F.col(cycle).alias("_cycle")).agg(end)
            parsed = parsed.join(ends, F.col(cycle).eqNullSafe(F.col("_cycle")))
            parsed = parsed.filter(F.col("_end").isNull() | (F.col(page) < F.col("_end")))
    kept = [name for name in pages.columns if name != body]
    return parsed.select(*kept, F.posexplode("_page.results").alias("position", "record")).withColumn(
        "record_offset", F.col(page) * page_size + F.col("position")
    )


def _broken() -> Column:
    return F.coalesce(F.col("_page").getField(nested.CORRUPT).isNotNull(), F.lit(False))


def broken_pages(pages: DataFrame, *, body: str = "value") -> DataFrame:
    """The pages whose body does not parse, whole, with an ``error_reason``.

    With ``explode_pages`` of the same frame this loses no page: each has its records
    there, or stands here, or holds none.
    """
    parsed = nested.parse_once(pages, body, _PAGE, "_page").filter(_broken())
    return parsed.select(*pages.columns, F.lit("bad_page").alias("error_reason"))


def envelopes(
    records: DataFrame,
    *,
    source: str,
    endpoint: str | Column,
    fetched_at: Column,
    batch: str = "batch_number",
    record: str = "record",
    offset: str = "record_offset",
    id_path: str = "safetyreportid",
) -> DataFrame:
    """Wrap records as keyed messages: ``key`` (text) and the envelope columns.

    The fallback key counts records from 1, as a fetch loop does.
    """
    given = F.get_json_object(F.col(record), f"$.{id_path}")
    return records.select(
        values.message_key(given, F.col(batch), F.col(offset) + 1).alias("key"),
        F.lit(source).alias("source_api"),
        values.utc_iso(fetched_at).alias("ingestion_timestamp"),
        F.col(batch).cast("int").alias("batch_number"),
        (F.lit(endpoint) if isinstance(endpoint, str) else endpoint).alias("api_endpoint"),
        F.col(record).alias("raw_data"),
    )


def to_messages(wrapped: DataFrame, *, key: str = "key") -> DataFrame:
    """Keyed envelope rows as (key, value) bytes, ready for a topic."""
    body = [name for name in wrapped.columns if name != key]
    return wrapped.select(
        values.key_bytes(F.col(key)).alias("key"),
        F.to_json(F.struct(*body)).cast("binary").alias("value"),
    )


def from_messages(messages: DataFrame) -> DataFrame:
    """Message bytes as a text column ``value``."""
    return messages.select(F.col("value").cast("string").alias("value"))
