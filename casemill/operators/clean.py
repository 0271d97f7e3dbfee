"""Messages to typed rows: parse, route, normalise, label, deduplicate."""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from casemill.functions import nested, values
from casemill.operators.dedup import keep_one
from casemill.spec import COMPAT_REASON, CleanSpec

BAD_ENVELOPE = "bad_envelope"
EMPTY_RECORD = "empty_record"
BAD_RECORD = "bad_record"
# Partition value of raw rows whose envelope gave no batch number.
NO_BATCH = -1


@dataclass(frozen=True)
class CleanResult:
    raw: DataFrame
    clean: DataFrame
    bad: DataFrame


def moment(now: Column | datetime.datetime | str | None) -> Column:
    """A given processing time, or the query's own clock."""
    if now is None:
        return F.current_timestamp()
    return now if isinstance(now, Column) else F.lit(now).cast("timestamp")


def open_envelopes(messages: DataFrame, spec: CleanSpec = CleanSpec()) -> DataFrame:
    """Parse the envelope of each message's ``value`` text.

    Gives the envelope columns and ``_broken``. In strict mode ``raw_data`` of a
    broken envelope is the whole message, so that nothing is lost.
    """
    opened = nested.parse_once(messages.select("value"), "value", spec.envelope, "_envelope")
    broken = nested.misfit(F.col("_envelope"))

    def field(name: str) -> Column:
        inner = F.col(f"_envelope.{name}")
        if spec.strict and name == "raw_data":
            return F.when(broken, F.col("value")).otherwise(inner)
        return inner

    return opened.select(broken.alias("_broken"), *(field(name).alias(name) for name in spec.envelope))


def parse_records(opened: DataFrame, spec: CleanSpec = CleanSpec()) -> DataFrame:
    """Add the parsed ``record`` struct and ``error_reason``, null for rows to keep."""
    parsed = nested.parse_once(opened, "raw_data", spec.record, "record")
    record = F.col("record")
    if spec.strict:
        reason = (
            F.when(F.col("_broken"), BAD_ENVELOPE)
            .when(record.isNull(), EMPTY_RECORD)
            .when(record.getField(nested.CORRUPT).isNotNull(), BAD_RECORD)
        )
    else:
        reason = F.when(record.isNull(), COMPAT_REASON)
    return parsed.select(*spec.envelope, "record", reason.alias("error_reason"))


def parse(messages: DataFrame, spec: CleanSpec = CleanSpec()) -> DataFrame:
    """Envelopes opened and records parsed.

    Clean and bad rows derive from this frame; persist it when both are written.
    """
    return parse_records(open_envelopes(messages, spec), spec)


def raw_rows(opened: DataFrame, spec: CleanSpec = CleanSpec(), now=None) -> DataFrame:
    """Every message, as it arrived. Opened envelopes will do; records need no parsing."""
    rows = opened.select(*spec.envelope, moment(now).alias("created_at"))
    if not spec.strict:
        return rows
    return rows.withColumn("batch_number", F.coalesce("batch_number", F.lit(NO_BATCH)))


def bad_rows(parsed: DataFrame, spec: CleanSpec = CleanSpec(), now=None) -> DataFrame:
    """Messages to set aside, with the reason."""
    return parsed.filter(F.col("error_reason").isNotNull()).select(
        *spec.envelope, "error_reason", moment(now).alias("created_at")
    )


def typed_rows(parsed: DataFrame, spec: CleanSpec = CleanSpec(), now=None) -> DataFrame:
    """Usable records as typed rows, before deduplication."""
    record = F.col("record")

    def category(name: str, path: str) -> Column:
        text = values.category(nested.at(record, path), blank_as_null=spec.blank_as_null)
        return values.decode(text, spec.code_names.get(name, {}))

    flags = {name: values.truthy(nested.at(record, path)) for name, path in spec.flags.items()}
    columns = {
        "report_id": values.record_id(
            nested.at(record, spec.id_path),
            F.col("raw_data"),
            blank_is_missing=spec.blank_id_is_missing,
        ),
        "source_api": F.col("source_api"),
        "ingestion_timestamp": values.iso_timestamp(F.col("ingestion_timestamp")),
        "batch_number": F.col("batch_number"),
        "api_endpoint": F.col("api_endpoint"),
        "raw_record": F.col("raw_data"),
        "created_at": moment(now),
        **{
            name: values.first_date(
                [nested.at(record, path) for path in paths], parse_first=spec.parse_then_coalesce
            )
            for name, paths in spec.dates.items()
        },
        **{
            name: values.non_negative(values.number(nested.at(record, path)))
            for name, path in spec.numbers.items()
        },
        **{name: category(name, path) for name, path in spec.categories.items()},
        **flags,
        spec.label: values.any_flag(*flags.values()),
    }
    kept = parsed.filter(F.col("error_reason").isNull())
    return kept.select(*(columns[name].alias(name) for name in spec.output))


def survivor_order() -> list[Column]:
    """Which duplicate stays: the latest fetched, then the highest batch, then by content.

    A 64-bit hash stands for the content, so that a query which does not ask for
    the text need not shuffle it.
    """
    return [
        F.desc_nulls_last("ingestion_timestamp"),
        F.desc_nulls_last("batch_number"),
        F.desc(F.xxhash64("raw_record")),
        F.asc_nulls_last("source_api"),
        F.asc_nulls_last("api_endpoint"),
    ]


def survivor_key() -> Column:
    """``survivor_order`` as one value, least for the row that stays; for aggregates over a stream."""
    ts, batch = F.col("ingestion_timestamp"), F.col("batch_number")
    down = [F.isnull(ts), -F.unix_micros(ts), F.isnull(batch), -batch, F.bitwise_not(F.xxhash64("raw_record"))]
    up = [c for name in ("source_api", "api_endpoint") for c in (F.isnull(name), F.col(name))]
    return F.struct(*(c.alias(f"k{i}") for i, c in enumerate(down + up)))


def clean_rows(parsed: DataFrame, spec: CleanSpec = CleanSpec(), now=None) -> DataFrame:
    """Typed rows, one per report."""
    return keep_one(typed_rows(parsed, spec, now), ["report_id"], survivor_order())


def clean(messages: DataFrame, spec: CleanSpec = CleanSpec(), now=None) -> CleanResult:
    """Clean a frame of messages. Lazy: nothing runs until a part is used."""
    opened = open_envelopes(messages, spec)
    parsed = parse_records(opened, spec)
    return CleanResult(
        raw=raw_rows(opened, spec, now),
        clean=clean_rows(parsed, spec, now),
        bad=bad_rows(parsed, spec, now),
    )
