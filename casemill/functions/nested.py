"""Nested JSON: reading fields by path and parsing with a declared schema."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from casemill.schemas import ddl

CORRUPT = "_corrupt"
_STEP = re.compile(r"(\w+)|\[(\d+)\]")


def at(record: Column, path: str) -> Column:
    """The value at a path like ``patient.drug[0].medicinalproduct``.

    An index past the end of an array gives null, also in ANSI mode.
    """
    for name, index in _STEP.findall(path):
        record = record.getField(name) if name else F.get(record, int(index))
    return record


def json_struct(text: Column, contract: Mapping[str, str]) -> Column:
    """Parse text with a declared schema and remember what did not fit.

    The struct gains a ``_corrupt`` field holding the text when it is broken or
    has the wrong shape. Null or blank text gives a null struct.
    """
    schema = f"{ddl(contract)}, `{CORRUPT}` string"
    return F.from_json(text, schema, {"columnNameOfCorruptRecord": CORRUPT})


def parse_once(df: DataFrame, text: str, contract: Mapping[str, str], into: str) -> DataFrame:
    """Add the parsed struct as a column, parsing each row exactly once.

    A plain projection would not do: Catalyst copies its expression into every
    filter above it, so routing rows on the result would parse them two or three
    times. Passing the struct through a one-element ``explode`` stops that.
    """
    return df.select("*", F.explode(F.array(json_struct(F.col(text), contract))).alias(into))


def misfit(struct: Column) -> Column:
    """True where the text was missing, blank, broken or of the wrong shape."""
    return struct.isNull() | struct.getField(CORRUPT).isNotNull()
