import datetime

import pytest
from pyspark.sql import functions as F

from casemill import schemas
from casemill.functions import nested, values


def column(spark, expression, rows, kind="string"):
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [r.y for r in frame.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def test_category(spark):
    assert column(spark, values.category, [" A b ", None, "", "\tX"]) == ["a b", "unknown", "", "\tx"]
    strict = lambda x: values.category(x, blank_as_null=True)
    assert column(spark, strict, ["", "   ", "Q"]) == ["unknown", "unknown", "q"]


def test_truthy(spark):
    texts = ["1", "TRUE", "Yes", " 1", "2", "", None, "y"]
    assert column(spark, values.truthy, texts) == [True, True, True, False, False, False, False, False]


def test_number_is_safe(spark):
    got = column(spark, values.number, [" 4 ", "1e3", "abc", "", None, "-2.5"])
    assert got == [4.0, 1000.0, None, None, None, -2.5]


def test_non_negative(spark):
    got = column(spark, values.non_negative, [-1.0, 0.0, None, float("nan")], "double")
    assert got[:3] == [None, 0.0, None]
    assert got[3] != got[3]


def test_compact_date(spark):
    texts = ["20240115", "2024011", "202401155", "20240230", "2024-01-15", "", None]
    assert column(spark, values.compact_date, texts) == [datetime.date(2024, 1, 15)] + [None] * 6


def test_iso_timestamp(spark):
    got = column(
        spark,
        lambda x: F.unix_micros(values.iso_timestamp(x)),
        ["1970-01-01T00:00:01.000002+00:00", "1970-01-01T02:00:00+02:00", "soon", None],
    )
    assert got == [1_000_002, 0, None, None]


@pytest.mark.parametrize("zone", ["UTC", "Africa/Cairo", "America/New_York"])
def test_utc_texts_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        moment = F.timestamp_micros(F.lit(1_700_000_000_123_456))
        row = spark.range(1).select(values.utc_iso(moment).alias("iso"), values.version_stamp(moment).alias("v")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert (row.iso, row.v) == ("2023-11-14T22:13:20.123456+00:00", "20231114221320")


@pytest.mark.parametrize("zone", ["Europe/Berlin", "Africa/Cairo", "America/New_York"])
def test_utc_texts_in_gaps_and_overlaps(spark, zone):
    """Every quarter of an hour around the changes of 2024, an instant before the epoch, and null."""
    starts = [1711843200, 1714075200, 1710028800, 1729980000, 1730390400, 1730595600]
    micros = [1_000_000 * (s + 900 * i) + i for s in starts for i in range(64)] + [-1, 0, None]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        moment = F.timestamp_micros("m")
        frame = spark.createDataFrame([(m,) for m in micros], "m long")
        rows = frame.select("m", values.utc_iso(moment).alias("iso"), values.version_stamp(moment).alias("v")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    for m, iso, stamp in rows:
        if m is None:
            assert (iso, stamp) == (None, None)
            continue
        want = datetime.datetime(1970, 1, 1) + datetime.timedelta(microseconds=m)
        assert iso == f"{want:%Y-%m-%dT%H:%M:%S}.{want.microsecond:06d}+00:00"
        assert stamp == f"{want:%Y%m%d%H%M%S}"


def test_message_key(spark):
    key = lambda x: values.message_key(x, F.lit(3), F.lit(101))
    assert column(spark, key, ["r1", "", None, " "]) == ["r1", "batch-3-101", "batch-3-101", " "]


def test_key_bytes(spark):
    got = column(spark, values.key_bytes, ["a", "", None])
    assert [g and bytes(g) for g in got] == [b"a", None, None]


def test_path_reads_safely(spark):
    record = F.from_json(F.col("x"), "a struct<b: array<struct<c: string>>>")
    got = column(
        spark,
        lambda _: nested.at(record, "a.b[0].c"),
        ['{"a":{"b":[{"c":"1"}]}}', '{"a":{"b":[]}}', '{"a":{"b":[null]}}', '{"a":null}', "{}"],
    )
    assert got == ["1", None, None, None, None]


def test_misfit(spark):
    flag = lambda x: nested.misfit(nested.json_struct(x, {"p": "struct<a: string>"}))
    texts = ['{"p":{"a":1}}', '{"p":"oops"}', "x", "", None, "{}"]
    assert column(spark, flag, texts) == [False, True, True, True, True, False]


def test_hash_percent_does_not_depend_on_partitioning(spark):
    ids = spark.range(500).select(F.col("id").cast("string").alias("id"))
    pick = lambda df: sorted(r.id for r in df.filter(values.hash_percent(F.col("id")) < 80).collect())
    assert pick(ids) == pick(ids.repartition(7))
    assert 340 < len(pick(ids)) < 460


def test_conform(spark):
    frame = spark.createDataFrame([("1", "x", 2)], "a string, b string, c int")
    got = schemas.conform(frame, {"c": "bigint", "a": "int", "b": "int"})
    assert got.dtypes == [("c", "bigint"), ("a", "int"), ("b", "int")]
    assert got.first() == (2, 1, None)
    with pytest.raises(ValueError):
        schemas.conform(frame, {"missing": "int"})
    assert schemas.conform(frame, {"missing": "int"}, fill_missing=True).first().missing is None
