"""Scalars: text, flags, numbers, dates, ids."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from casemill.spec import TRUTHY, UNKNOWN

COMPACT_DATE = "yyyyMMdd"


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def category(text: Column, *, unknown: str = UNKNOWN, blank_as_null: bool = False) -> Column:
    """Lower-cased, space-trimmed text; missing becomes ``unknown``.

    Only spaces are trimmed, and an empty text stays empty unless
    ``blank_as_null``.
    """
    present = blank_to_null(text) if blank_as_null else text
    return F.lower(F.trim(F.coalesce(present, F.lit(unknown))))


def decode(text: Column, names: Mapping[str, str]) -> Column:
    """Replace known codes by their names and keep everything else."""
    if not names:
        return text
    table = F.create_map(*(F.lit(x) for pair in names.items() for x in pair))
    return F.coalesce(F.try_element_at(table, text), text)


def truthy(text: Column, tokens: Sequence[str] = TRUTHY) -> Column:
    """True for a known token in any case. Null and padded text are false."""
    return F.coalesce(F.lower(text).isin(*tokens), F.lit(False))


def any_flag(*flags: Column) -> Column:
    """1 when at least one flag is true, else 0."""
    hit = F.lit(False)
    for flag in flags:
        hit = hit | F.coalesce(flag, F.lit(False))
    return hit.cast("int")


def number(text: Column) -> Column:
    """Text as double; null where it is not a number."""
    return text.try_cast("double")


def non_negative(value: Column) -> Column:
    """Negative values become null. NaN is kept."""
    return F.when(~(value < 0), value)


def compact_date(text: Column) -> Column:
    """``yyyyMMdd`` text as a date; null for anything else."""
    return F.try_to_date(text, COMPACT_DATE)


def first_date(texts: Sequence[Column], *, parse_first: bool = False) -> Column:
    """A date from the first text present, or (``parse_first``) the first that parses."""
    if parse_first:
        return F.coalesce(*(compact_date(text) for text in texts))
    return compact_date(F.coalesce(*texts))


def iso_timestamp(text: Column) -> Column:
    """ISO-8601 text as an instant, honouring its offset; null when malformed."""
    return F.try_to_timestamp(text)


def _utc_text(moment: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` in UTC, from the epoch; never by way of the session's zone and its gaps."""
    seconds = F.unix_micros(moment).cast("decimal(20,0)") / 1_000_000
    passed = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))
    return F.substring((F.expr("timestamp_ntz'1970-01-01'") + passed).cast("string"), 1, 19)


def utc_iso(moment: Column) -> Column:
    """An instant as ISO-8601 text with microseconds, in UTC."""
    micros = F.lpad(F.pmod(F.unix_micros(moment), F.lit(1_000_000)).cast("string"), 6, "0")
    return F.concat(F.translate(_utc_text(moment), " ", "T"), F.lit("."), micros, F.lit("+00:00"))


def version_stamp(moment: Column) -> Column:
    """An instant as ``yyyyMMddHHmmss`` in UTC."""
    return F.translate(_utc_text(moment), "-: ", "")


def content_id(text: Column) -> Column:
    """The first 16 hex digits of the text's md5."""
    return F.substring(F.md5(text), 1, 16)


def record_id(given: Column, text: Column, *, blank_is_missing: bool = True) -> Column:
    """The given id, or a content id where it is missing."""
    if blank_is_missing:
        given = F.when(F.trim(given) != "", given)
    return F.coalesce(given, content_id(text))


def message_key(given: Column, batch: Column, position: Column) -> Column:
    """The record id, or ``batch-<batch>-<position>`` where it is missing or empty."""
    fallback = F.concat(F.lit("batch-"), batch.cast("string"), F.lit("-"), position.cast("string"))
    return F.coalesce(F.nullif(given, F.lit("")), fallback)


def key_bytes(key: Column) -> Column:
    """A message key as bytes; an empty key is no key."""
    return F.nullif(key, F.lit("")).cast("binary")


def display(*columns: str) -> Column:
    """Columns rendered as one text, like ``{45.0, null, x, true}``."""
    return F.struct(*columns).cast("string")


def hash_percent(key: Column) -> Column:
    """A stable bucket 0..99 from the key alone, whatever the partitioning."""
    return (F.conv(F.substring(F.md5(key.cast("string")), 1, 4), 16, 10).cast("int") % 100).cast("int")


def hash_fold(key: Column, folds: int) -> Column:
    """A stable fold 0..folds-1 from the key alone, by other digits than ``hash_percent``."""
    return (F.conv(F.substring(F.md5(key.cast("string")), 5, 4), 16, 10).cast("int") % folds).cast("int")
