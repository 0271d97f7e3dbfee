import json

from pyspark.sql import functions as F

from casemill import schemas
from casemill.functions import nested
from casemill.operators import ingest
from casemill.sources import read_pages

PAGES = [(0, '{"results":[{"id":"a"},{"id":"b"}]}'), (1, '{"meta":1}'), (2, '{"results":[]}'), (3, "broken")]


def pages(spark, rows=PAGES):
    return spark.createDataFrame(rows, "page int, value string")


def test_explode_pages(spark):
    got = ingest.explode_pages(pages(spark), page_size=2).orderBy("record_offset").collect()
    assert [tuple(r) for r in got] == [(0, 0, '{"id":"a"}', 0), (0, 1, '{"id":"b"}', 1)]


def test_broken_pages_are_kept_aside(spark):
    got = [tuple(r) for r in ingest.broken_pages(pages(spark)).collect()]
    assert got == [(3, "broken", "bad_page")]
    rows = [(0, '{"results":[{"id":"a"}]}'), (1, '{"results":[{"id"'), (2, '{"results":[{"id":"c"}]}'), (3, None)]
    for stop in (False, True):
        records = ingest.explode_pages(pages(spark, rows), stop_at_empty=stop).collect()
        assert sorted(r.page for r in records) == [0, 2]
    assert [r.page for r in ingest.broken_pages(pages(spark, rows)).collect()] == [1]


def test_stop_at_the_first_empty_page(spark):
    rows = [(0, '{"results":[{"id":"a"},{"id":"b"}]}'), (1, "broken"), (2, '{"results":[{"id":"c"}]}')]
    rows += [(3, '{"meta":1}'), (5, '{"results":[{"id":"late"}]}')]
    everything = ingest.explode_pages(pages(spark, rows)).count()
    assert everything == 4
    assert ingest.explode_pages(pages(spark, rows), stop_at_empty=True).count() == 3
    cycles = pages(spark, rows).withColumn("cycle", (F.col("page") > 3).cast("int"))
    assert ingest.explode_pages(cycles, cycle="cycle", stop_at_empty=True).count() == 4
    unnamed = cycles.withColumn("cycle", F.when(F.col("cycle") == 0, 0))
    assert ingest.explode_pages(unnamed, cycle="cycle", stop_at_empty=True).count() == 4


def test_envelopes_and_messages(spark):
    rows = [(4, 100, '{"safetyreportid":"r1","n":1}'), (4, 101, '{"safetyreportid":""}'), (4, 102, "{}")]
    records = spark.createDataFrame(rows, "batch_number int, record_offset int, record string")
    wrapped = ingest.envelopes(
        records, source="s", endpoint="u", fetched_at=F.lit("2024-01-01 00:00:00").cast("timestamp")
    )
    sent = ingest.to_messages(wrapped).orderBy(F.col("key").cast("string").desc()).collect()
    assert [bytes(m.key).decode() for m in sent] == ["r1", "batch-4-103", "batch-4-102"]
    assert json.loads(bytes(sent[0].value)) == {
        "source_api": "s",
        "ingestion_timestamp": "2024-01-01T00:00:00.000000+00:00",
        "batch_number": 4,
        "api_endpoint": "u",
        "raw_data": '{"safetyreportid":"r1","n":1}',
    }
    received = ingest.from_messages(ingest.to_messages(wrapped))
    body = received.select(nested.json_struct(F.col("value"), schemas.ENVELOPE).alias("e"))
    assert body.filter(nested.misfit(F.col("e"))).isEmpty()


def test_page_files(spark, tmp_path):
    for number, body in PAGES[:3]:
        (tmp_path / f"page-{number}.json").write_text(body)
    landed = read_pages(spark, str(tmp_path)).withColumn(
        "page", F.regexp_extract("file", r"page-(\d+)", 1).cast("int")
    )
    got = ingest.explode_pages(landed.select("page", "value"))
    assert sorted(r.record for r in got.collect()) == ['{"id":"a"}', '{"id":"b"}']
