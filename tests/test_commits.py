"""Attempts, the log that says which count, compaction and the index of keys."""

import os
import re

import pytest
from pyspark.sql import functions as F

from casemill import commits, schemas
from casemill.commits import Entry
from casemill.files import children, sizes
from casemill.operators import clean, keyindex
from casemill.plans import jobs
from casemill.streaming import clean_stream, write_batch

from cases import NOW, RECORDS, envelope, messages, record

ROWS = {"id": "bigint", "batch_number": "int"}


def numbered(spark, n, first=0):
    return spark.range(first, first + n, numPartitions=3).select("id", (F.col("id") % 3).cast("int").alias("batch_number"))


def stage(spark, zones, n, batch_id=0, first=0, partition="batch_number"):
    rows = numbered(spark, n, first)
    return commits.stage(rows, zones, "bronze", commits.new_attempt(), "r", batch_id, partition=partition)


def ids(spark, zones, **options):
    rows = commits.read_zone(spark, zones, "bronze", ROWS, **options)
    return None if rows is None else sorted(r.id for r in rows.collect())


def test_only_committed_attempts_are_read(spark, zones):
    assert ids(spark, zones) is None
    one = stage(spark, zones, 4)
    commits.commit(spark, zones, [one])
    stage(spark, zones, 9)  # never committed
    assert ids(spark, zones) == [0, 1, 2, 3]
    commits.commit(spark, zones, [stage(spark, zones, 2), stage(spark, zones, 3, batch_id=1, first=100)])
    assert ids(spark, zones) == [0, 1, 100, 101, 102]


def test_only_their_folders_are_opened(spark, zones):
    """An attempt that is half written, or is removed while others are read, disturbs nobody."""
    commits.commit(spark, zones, [stage(spark, zones, 4)])
    folder = f"{zones.bronze}/attempt=broken/batch_number=0"
    os.makedirs(folder)
    with open(f"{folder}/part-0.parquet", "w") as file:
        file.write("half")
    assert ids(spark, zones) == [0, 1, 2, 3]


def test_readers_keep_the_rows_they_began_with(spark, zones):
    commits.commit(spark, zones, [stage(spark, zones, 4)])
    before = commits.read_zone(spark, zones, "bronze", ROWS)
    commits.commit(spark, zones, [stage(spark, zones, 1)])
    assert before.count() == 4
    assert ids(spark, zones) == [0]


def test_a_clock_that_is_behind_does_not_matter(spark, zones, monkeypatch):
    commits.commit(spark, zones, [stage(spark, zones, 4)])
    monkeypatch.setattr(commits.time, "time_ns", lambda: 5)
    commits.commit(spark, zones, [stage(spark, zones, 1)])
    assert ids(spark, zones) == [0]


def test_latest_entries():
    log = [Entry("z", "r", 0, "a", 5), Entry("z", "r", 0, "b", 7), Entry("z", "r", 0, "c", 5, 1), Entry("y", "r", 0, "d", 1)]
    assert {s: e.attempt for s, e in commits.latest(log).items()} == {("z", "r", 0): "b", ("y", "r", 0): "d"}
    assert list(commits.latest(log[:1] + log[2:], "z").values()) == [log[2]]
    assert [e.attempt for e in commits.missing(log, "x", "z")] == ["b"]
    assert commits.missing([*log, Entry("x", "r", 0, "e", 7)], "x", "z") == []
    assert [e.attempt for e in commits.missing([*log, Entry("x", "r", 0, "e", 6)], "x", "z")] == ["b"]


def test_a_batch_without_rows_leaves_no_folder(spark, zones):
    rows = spark.createDataFrame([("s", "t", 1, "e", "x", "why", None)], schemas.ddl(schemas.BAD))
    some = commits.stage_if_any(rows, zones, "quarantine", "a1", "r", 0)
    commits.commit(spark, zones, [some])
    assert commits.read(spark, zones, "quarantine").count() == 1
    none = commits.stage_if_any(rows.limit(0), zones, "quarantine", "a2", "r", 0)
    assert none.attempt == commits.NOTHING and os.listdir(zones.quarantine) == ["attempt=a1"]
    commits.commit(spark, zones, [none])
    assert commits.read_zone(spark, zones, "quarantine", schemas.BAD) is None


def test_snapshots_change_together(spark, zones):
    rows = spark.range(3).select("id")
    commits.publish({"predictions": rows, "predictions_slim": rows}, zones)
    with pytest.raises(Exception, match="divide|DIVIDE"):
        broken = rows.select((F.lit(1) / (F.col("id") - 1)).alias("id"))
        commits.publish({"predictions": rows.limit(1), "predictions_slim": broken}, zones)
    read = lambda zone: commits.read_zone(spark, zones, zone, {"id": "bigint"}).count()
    assert (read("predictions"), read("predictions_slim")) == (3, 3)


def live_files(spark, zones, zone="bronze"):
    live = {e.attempt for e in commits.latest(commits.read_log(spark, zones), zone).values()}
    return sizes(spark, *(f"{getattr(zones, zone)}/attempt={a}" for a in live))


@pytest.mark.parametrize("partition", ["batch_number", None])
def test_compaction(spark, zones, partition):
    for n in range(6):
        rows = numbered(spark, 10, first=10 * n)
        commits.commit(spark, zones, [commits.stage(rows, zones, "bronze", f"a{n}", "r", n, partition=partition)])
    many = len(live_files(spark, zones))
    before = ids(spark, zones)
    assert commits.compact(spark, zones, "bronze", ROWS, partition=partition) == 6
    assert ids(spark, zones) == before == list(range(60))
    assert len(live_files(spark, zones)) <= 3 < many
    assert commits.compact(spark, zones, "bronze", ROWS, partition=partition) == 0
    # A batch written again replaces its rows, also those that were moved, and also once the log is gathered.
    commits.commit(spark, zones, [stage(spark, zones, 2, batch_id=3, first=500, partition=partition)])
    want = [i for i in range(60) if not 30 <= i < 40] + [500, 501]
    assert ids(spark, zones) == want
    commits.compact_log(spark, zones)
    assert ids(spark, zones) == want
    assert len(children(spark, zones.commits)) == 1
    assert commits.compact(spark, zones, "bronze", ROWS, partition=partition) == 2
    assert ids(spark, zones) == want


def test_large_files_stay(spark, zones):
    for n in range(3):
        commits.commit(spark, zones, [stage(spark, zones, 10, batch_id=n, first=10 * n)])
    assert commits.compact(spark, zones, "bronze", ROWS, partition="batch_number", small_bytes=1) == 0


def test_a_batch_replayed_during_compaction_stays_replaced(spark, zones, monkeypatch):
    for n in range(2):
        commits.commit(spark, zones, [stage(spark, zones, 10, batch_id=n, first=10 * n)])
    real = commits._append

    def later(*args):
        monkeypatch.setattr(commits, "_append", real)
        commits.commit(spark, zones, [stage(spark, zones, 1, batch_id=0, first=900)])
        real(*args)

    monkeypatch.setattr(commits, "_append", later)
    commits.compact(spark, zones, "bronze", ROWS, partition="batch_number")
    assert ids(spark, zones) == [*range(10, 20), 900]


def test_vacuum(spark, zones):
    for n in (4, 5, 6):
        commits.commit(spark, zones, [stage(spark, zones, n)])
    stage(spark, zones, 9)
    assert commits.vacuum(spark, zones, "bronze") == 0
    assert commits.vacuum(spark, zones, "bronze", older_than=-5) == 3
    assert ids(spark, zones) == list(range(6))
    assert len(os.listdir(zones.bronze)) == 1


def test_zone_written_without_a_log(spark, zones):
    numbered(spark, 5).write.parquet(f"{zones.bronze}/run_id=r/batch_id=0")
    assert ids(spark, zones) == list(range(5))


# ---- the index of keys ----


def send(spark, zones, batch_id, keys, **options):
    rows = [(envelope(record(safetyreportid=k), i % 60, batch_id),) for i, k in enumerate(keys)]
    write_batch(spark.createDataFrame(rows, "value string"), zones, "run-a", batch_id, dedup="indexed", now=NOW, **options)


def silver(spark, zones):
    return sorted((r.report_id, r.batch_number) for r in jobs.read_silver(spark, zones).collect())


def test_index_follows_the_batches(spark, zones):
    send(spark, zones, 0, ["a", "b"])
    send(spark, zones, 1, ["b", "c"])
    send(spark, zones, 2, ["c", "d", "a"])
    assert silver(spark, zones) == [("a", 0), ("b", 0), ("c", 1), ("d", 2)]
    # Written again without "c": the next batch that has it stores it.
    send(spark, zones, 1, ["b", "e"])
    send(spark, zones, 3, ["c", "e"])
    assert silver(spark, zones) == [("a", 0), ("b", 0), ("c", 3), ("d", 2), ("e", 1)]
    index = commits.read_zone(spark, zones, "keys", keyindex.CONTRACT)
    assert sorted(r.report_id for r in index.collect()) == list("abcde")


def test_batches_stored_without_an_index_are_indexed_first(spark, zones):
    write_batch(messages(spark), zones, "run-a", 0, now=NOW)
    send(spark, zones, 1, ["r1", "new"])
    assert [k for k, n in silver(spark, zones) if n == 1 and k in ("r1", "new")] == ["new", "r1"]
    assert silver(spark, zones).count(("r1", 1)) == 1
    assert commits.missing(commits.read_log(spark, zones), "keys", "silver") == []


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_index_is_neither_exchanged_nor_read_whole(spark, zones):
    stored = spark.range(20_000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("report_id"))
    staged = commits.stage(keyindex.entries(stored, 256), zones, "keys", "a", "r", 0, partition="bucket", gather=True)
    commits.commit(spark, zones, [staged])
    index = commits.read_zone(spark, zones, "keys", keyindex.CONTRACT)
    keys = spark.createDataFrame([("k1",), ("k19999",), ("other",)], "report_id string").persist()
    found = keyindex.known(keys, index, 256)
    assert sorted(r.report_id for r in found.collect()) == ["k1", "k19999"]
    plan = physical(found).split("Initial Plan")[0]
    touched = re.search(r"PartitionFilters: \[bucket#\d+ IN \(([\d,]+)\)\]", plan)
    assert touched and len(touched[1].split(",")) == 3
    # Between the join that asks the index and its scan nothing is exchanged; the keys are broadcast.
    scan = plan.index("FileScan parquet")
    semi = plan.rindex("BroadcastHashJoin", 0, scan)
    assert "LeftSemi" in plan[semi:scan] and "Exchange" not in plan[semi:scan]
    read = index.where(F.col("bucket").isin([int(b) for b in touched[1].split(",")]))
    assert read.count() < 20_000 / 20


def test_runs_of_buckets():
    assert keyindex.runs([(3, 5), (1, 5), (2, 5)], 10) == [[1, 2], [3]]
    assert keyindex.runs([(1, 50)], 10) == [[1]] and keyindex.runs([], 10) == []


@pytest.mark.parametrize("limit", [1 << 20, 300, 1])
def test_every_way_to_ask_the_index_agrees(spark, limit):
    name = F.concat(F.lit("k"), F.col("id").cast("string")).alias("report_id")
    index = keyindex.entries(spark.range(500).select(name), 7).persist()
    keys = spark.range(490, 520).select(name).persist()
    found = keyindex.known(keys, index, 7, broadcast_bytes=limit)
    assert sorted(r.report_id for r in found.collect()) == [f"k{i}" for i in range(490, 500)]
    none = keyindex.known(keys.limit(0), index, 7, broadcast_bytes=limit)
    assert none.collect() == []


def test_compacted_stream_zones(spark, zones):
    for n in range(4):
        send(spark, zones, n, [f"k{n}", "k0", "k1"])
    before = silver(spark, zones)
    assert before == [("k0", 0), ("k1", 0), ("k2", 2), ("k3", 3)]
    done = clean_stream.compact_zones(spark, zones)
    assert done["silver"] == done["keys"] == 3 and done["bronze"] == 4
    assert silver(spark, zones) == before
    send(spark, zones, 4, ["k3", "k9"])
    assert silver(spark, zones) == [*before, ("k9", 4)]


# ---- late rows ----


def timed(spark, zones, batch_id, rows, **options):
    texts = []
    for key, time in rows:
        text = envelope(record(safetyreportid=key), 0, batch_id)
        texts.append((text.replace("2024-01-01T00:00:00.000000", time),))
    options = {"dedup": "indexed", "delay": "1 day", "now": NOW, **options}
    write_batch(spark.createDataFrame(texts, "value string"), zones, "run-a", batch_id, **options)


def late(spark, zones):
    rows = commits.read_zone(spark, zones, "late", clean_stream.LATE)
    return sorted((r.report_id, r.batch_number, str(r.watermark)) for r in rows.collect())


@pytest.mark.parametrize("dedup", ["indexed", "per_batch"])
def test_late_rows_are_kept_aside(spark, zones, dedup):
    timed(spark, zones, 0, [("a", "2024-01-05T00:00:00"), ("b", "2024-01-01T00:00:00")], dedup=dedup)
    timed(spark, zones, 1, [("c", "2024-01-04T00:00:00"), ("d", "2024-01-03T23:59:59"), ("e", "no time"), ("a", "2024-01-01T00:00:00")], dedup=dedup)
    assert silver(spark, zones) == [("a", 0), ("b", 0), ("c", 1), ("e", 1)]
    mark = "2024-01-04 00:00:00"
    assert late(spark, zones) == [("a", 1, mark), ("d", 1, mark)]
    # An older batch does not set the clock back, and the batch written again sees the same clock.
    timed(spark, zones, 1, [("c", "2024-01-04T00:00:00"), ("d", "2024-01-03T23:59:59")], dedup=dedup)
    timed(spark, zones, 2, [("f", "2024-01-03T00:00:00"), ("g", "2024-01-20T00:00:00")], dedup=dedup)
    assert late(spark, zones) == [("d", 1, mark), ("f", 2, mark)]
    assert silver(spark, zones) == [("a", 0), ("b", 0), ("c", 1), ("g", 2)]


def test_late_rows_need_a_mode_without_state(spark, zones):
    from casemill import StreamSpec

    with pytest.raises(ValueError, match="late"):
        clean_stream.run_clean_stream(spark, StreamSpec(kind="files", path="x"), zones, dedup="state", late=True)


# ---- sums of batches ----


def test_sums_follow_the_batches(spark, zones):
    def send(batch_id, keys):
        rows = [(envelope(record(safetyreportid=k, serious="1", patient={"patientsex": k[0]}), 0, batch_id),) for k in keys]
        write_batch(spark.createDataFrame(rows, "value string"), zones, "run-a", batch_id, dedup="per_batch", now=NOW)

    def told():
        rows = jobs.run_incremental_report(spark, zones, as_of="2024-06-01").collect()
        return {r.dimension_value: r.total_records for r in rows if r.dimension_type != "medicinal_product"}

    send(0, ["f1", "m1", "m2"])
    send(1, ["f2"])
    assert told() == {"all_records": 4, "f": 2, "m": 2}
    assert jobs.refresh_sums(spark, zones) == 0
    send(0, ["f1"])
    send(2, ["x1", "x2"])
    assert jobs.refresh_sums(spark, zones) == 2
    assert told() == {"all_records": 4, "f": 2, "x": 2}
    send(1, [])
    assert told() == {"all_records": 3, "f": 1, "x": 2}


# ---- rejects ----


def test_sift(spark):
    rows = spark.createDataFrame([("1", "2.5", "x"), ("q", "r", "y"), (None, None, None), ("7", "s", "z")], "a string, b string, c string")
    fitting, rejected = schemas.sift(rows, {"a": "int", "b": "double", "c": "string"})
    assert [tuple(r) for r in fitting.collect()] == [(1, 2.5, "x"), (None, None, None)]
    lost = sorted((r.column_name, r.value, r.row) for r in rejected.collect())
    assert [x[:2] for x in lost] == [("a", "q"), ("b", "r"), ("b", "s")]
    assert lost[0][2] == '{"a":"q","b":"r","c":"y"}'
    same, none = schemas.sift(rows, {"a": "string"})
    assert same.count() == 4 and none.count() == 0 and set(none.columns) == set(rejected.columns)
