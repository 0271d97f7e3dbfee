import json

import pytest
from pyspark.sql import functions as F

from casemill import CleanSpec, StreamSpec, commits, schemas
from casemill.files import children
from casemill.operators import clean
from casemill.plans import jobs
from casemill.sources import read_table
from casemill.streaming import run_clean_stream, write_batch
from casemill.streaming import clean_stream

from cases import NOW, RECORDS, REASONS, envelope, messages, record


def land(spark, path, cases, batch=1):
    rows = [(envelope(raw, i, batch),) for i, raw in enumerate(cases)]
    frame = spark.createDataFrame(rows, "value string").select(F.col("value").cast("binary"))
    frame.coalesce(1).write.mode("append").parquet(path)


def run(spark, path, zones, **options):
    source = StreamSpec(kind="files", path=path, max_per_trigger=1)
    for query in run_clean_stream(spark, source, zones, now=NOW, **options):
        query.awaitTermination()


def counted(spark, zones, zone):
    return commits.read(spark, zones, zone).count()


def silver(spark, zones):
    return sorted(r.report_id for r in jobs.read_silver(spark, zones).collect())


KEYS = [record(safetyreportid=k) for k in "aab"]


@pytest.mark.parametrize(
    "dedup, want",
    [
        ("per_batch", list("aabb")),
        ("global", list("ab")),
        ("indexed", list("ab")),
        ("state", list("ab")),
        ("watermark", list("ab")),
    ],
)
def test_duplicates_across_batches(spark, tmp_path, zones, dedup, want):
    inbox = str(tmp_path / "inbox")
    land(spark, inbox, KEYS, 1)
    land(spark, inbox, KEYS, 2)
    run(spark, inbox, zones, dedup=dedup)
    assert silver(spark, zones) == want
    assert read_table(spark, zones.bronze).count() == 6


@pytest.mark.parametrize("dedup", ["per_batch", "state", "watermark"])
def test_a_batch_is_not_held_in_memory(spark, tmp_path, zones, monkeypatch, dedup):
    """Zones are written from files that hold the parsed rows, never from Spark's cache, and the files go."""
    inbox, plans, real = str(tmp_path / "inbox"), {}, commits.stage

    def stage(rows, zones, zone, *args, **kwargs):
        plans[zone] = rows._jdf.queryExecution().executedPlan().toString()
        return real(rows, zones, zone, *args, **kwargs)

    land(spark, inbox, RECORDS.values())
    monkeypatch.setattr(commits, "stage", stage)
    run(spark, inbox, zones, dedup=dedup)
    assert set(plans) == {"bronze", "silver", "quarantine"}
    assert not any("InMemoryTableScan" in plan for plan in plans.values())
    assert "from_json" not in plans["bronze"] + plans["quarantine"]
    assert counted(spark, zones, "bronze") == len(RECORDS)
    assert children(spark, zones.parsed) == []


@pytest.mark.parametrize("dedup", ["state", "watermark"])
def test_a_stream_with_state_writes_few_files(spark, tmp_path, zones, dedup):
    """Such a stream runs without adaptive execution; each task must not write a file for every batch number."""
    inbox = str(tmp_path / "inbox")
    for batch in (1, 2, 3):
        land(spark, f"{inbox}/{batch}", [record(safetyreportid=f"{batch}-{n}") for n in range(40)], batch)
    spark.read.parquet(*(f"{inbox}/{b}" for b in (1, 2, 3))).coalesce(1).write.parquet(f"{inbox}/all")
    run(spark, f"{inbox}/all", zones, dedup=dedup)
    stored = jobs.read_silver(spark, zones)
    assert stored.count() == 120
    assert len(stored.inputFiles()) == 3


@pytest.mark.parametrize("chosen", [None, "HDFSBackedStateStoreProvider"])
def test_ids_are_kept_on_disk(spark, tmp_path, zones, chosen):
    """Whatever the session, a stream with state keeps it in RocksDB, unless the caller chose a store."""
    session, name = spark.newSession(), "spark.sql.streaming.stateStore.providerClass"
    session.conf.set("spark.sql.shuffle.partitions", "3")
    if chosen:
        session.conf.set(name, f"org.apache.spark.sql.execution.streaming.state.{chosen}")
    before, inbox = session.conf.get(name), str(tmp_path / "inbox")
    land(session, inbox, KEYS)
    run(session, inbox, zones, dedup="watermark")
    log = spark.read.text(f"{zones.checkpoints}/clean_stream_silver/offsets/0").where("value LIKE '%conf%'").first().value
    conf = json.loads(log)["conf"]
    assert conf[name].rsplit(".", 1)[-1] == (chosen or "RocksDBStateStoreProvider")
    assert conf["spark.sql.shuffle.partitions"] == "3"
    assert session.conf.get(name) == before
    assert silver(session, zones) == ["a", "b"]


def test_state_holds_ids_and_the_best_row_of_the_first_batch_stays(spark, tmp_path, zones):
    """The rows themselves do not lie in the state, and no better copy of a later batch takes their place."""
    inbox, text = str(tmp_path / "inbox"), lambda key, n: record(safetyreportid=key, receiptdate=f"2024010{n}")
    land(spark, inbox, [text("a", 1), text("a", 2), text("b", 3)], 1)
    run(spark, inbox, zones, dedup="state")
    land(spark, inbox, [text("c", 4), text("b", 5), text("a", 6), text("c", 7), text("a", 8)], 2)
    run(spark, inbox, zones, dedup="state")
    rows = sorted((r.report_id, r.receipt_date.day, r.batch_number) for r in jobs.read_silver(spark, zones).collect())
    assert rows == [("a", 2, 1), ("b", 3, 1), ("c", 7, 2)]
    state = spark.read.format("statestore").load(f"{zones.checkpoints}/clean_stream_silver")
    assert sorted(r.key[0] for r in state.select("key").collect()) == list("abc")
    assert {f.dataType.simpleString() for f in state.schema["value"].dataType} == {"timestamp"}


def test_a_broken_time_does_not_move_the_watermark(spark, tmp_path, zones):
    """Old rows in three files, one with an unreadable time: none is taken for late."""
    inbox = str(tmp_path / "inbox")
    for batch, keys in enumerate(("ab", "cxx", "de"), 1):
        rows = []
        for i, key in enumerate(keys):
            message = json.loads(envelope(record(safetyreportid=key), i, batch))
            if key == "x":
                message["ingestion_timestamp"] = "not a time"
            rows.append((json.dumps(message),))
        frame = spark.createDataFrame(rows, "value string").select(F.col("value").cast("binary"))
        frame.coalesce(1).write.mode("append").parquet(inbox)
    run(spark, inbox, zones, dedup="watermark")
    assert silver(spark, zones) == list("abcdex")


def test_stream_equals_batch(spark, tmp_path, zones):
    inbox = str(tmp_path / "inbox")
    land(spark, inbox, RECORDS.values())
    run(spark, inbox, zones)
    batch = clean.clean(messages(spark), now=NOW)
    shown = lambda df, contract: sorted(map(str, df.select(*contract).collect()))
    stored = jobs.read_silver(spark, zones)
    assert shown(stored, schemas.CLEAN) == shown(batch.clean, schemas.CLEAN)
    assert shown(read_table(spark, zones.bronze, contract=schemas.RAW), schemas.RAW) == shown(batch.raw, schemas.RAW)
    assert shown(read_table(spark, zones.quarantine, contract=schemas.BAD), schemas.BAD) == shown(batch.bad, schemas.BAD)
    assert read_table(spark, zones.quarantine).count() == len(REASONS)


def test_text_files(spark, tmp_path, zones):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "a.txt").write_text("\n".join([envelope(KEYS[0], 0), envelope(KEYS[2], 1), "garbage"]))
    source = StreamSpec(kind="files", path=str(inbox), file_format="text")
    for query in run_clean_stream(spark, source, zones, now=NOW):
        query.awaitTermination()
    assert silver(spark, zones) == ["a", "b"]
    assert read_table(spark, zones.quarantine).first().error_reason == "bad_envelope"


def test_restart_reads_only_what_is_new(spark, tmp_path, zones):
    inbox = str(tmp_path / "inbox")
    land(spark, inbox, KEYS[:1])
    run(spark, inbox, zones)
    land(spark, inbox, KEYS[2:])
    run(spark, inbox, zones)
    run(spark, inbox, zones)
    assert silver(spark, zones) == ["a", "b"]
    assert read_table(spark, zones.bronze).count() == 2
    runs = read_table(spark, zones.bronze).select("run_id", "batch_id").distinct().collect()
    assert len({r.run_id for r in runs}) == 1 and sorted(r.batch_id for r in runs) == [0, 1]


def test_new_checkpoint_keeps_history(spark, tmp_path, zones):
    inbox = str(tmp_path / "inbox")
    land(spark, inbox, KEYS)
    run(spark, inbox, zones, dedup="per_batch")
    run(spark, inbox, zones, dedup="per_batch", name="second")
    assert silver(spark, zones) == list("aabb")


def test_crash_between_zones_is_repaired(spark, tmp_path, zones, monkeypatch):
    inbox = str(tmp_path / "inbox")
    land(spark, inbox, RECORDS.values())
    real = clean_stream.stage_silver

    def fails(*args, **kwargs):
        real(*args, **kwargs)
        raise RuntimeError("executor lost")

    monkeypatch.setattr(clean_stream, "stage_silver", fails)
    with pytest.raises(Exception, match="executor lost"):
        run(spark, inbox, zones)
    # All zones were written, and none of them counts.
    assert read_table(spark, zones.bronze).count() == len(RECORDS)
    assert commits.read_log(spark, zones) == []
    monkeypatch.setattr(clean_stream, "stage_silver", real)
    run(spark, inbox, zones)
    assert silver(spark, zones) == sorted(r.report_id for r in clean.clean(messages(spark), now=NOW).clean.collect())
    assert counted(spark, zones, "bronze") == len(RECORDS)
    assert counted(spark, zones, "quarantine") == len(REASONS)


def test_replayed_batch_changes_nothing(spark, zones):
    for batch_id in (0, 1, 0):
        write_batch(messages(spark), zones, "run-a", batch_id, now=NOW)
    want = sorted(r.report_id for r in clean.clean(messages(spark), now=NOW).clean.collect())
    assert silver(spark, zones) == want
    assert counted(spark, zones, "bronze") == 2 * len(RECORDS)


def test_a_replay_reads_only_other_batches(spark, zones):
    """A batch written again need not open what its earlier attempt stored, also once that is compacted."""
    ids = lambda run: clean_stream._others(
        spark, zones, "silver", {"report_id": "string"}, run, 0, commits.read_log(spark, zones)
    )
    write_batch(messages(spark, dict(enumerate(KEYS))), zones, "run-1", 0, now=NOW)
    assert ids("run-1") is None
    write_batch(messages(spark, dict(c=record(safetyreportid="c"))), zones, "run-2", 0, now=NOW)
    assert [r.report_id for r in ids("run-1").collect()] == ["c"]
    opened, silver_now = ids("run-2").inputFiles(), commits.latest(commits.read_log(spark, zones), "silver")
    attempt = silver_now["silver", "run-1", 0].attempt
    assert opened and all(f"attempt={attempt}/" in file for file in opened)
    clean_stream.compact_zones(spark, zones)
    assert sorted(r.report_id for r in ids("run-2").collect()) == ["a", "b"]
    assert [r.report_id for r in ids("run-1").collect()] == ["c"]
    write_batch(messages(spark, dict(enumerate(KEYS))), zones, "run-1", 0, now=NOW)
    assert silver(spark, zones) == ["a", "b", "c"]


def test_unheld_batch_gives_the_same_rows(spark, tmp_path, zones):
    write_batch(messages(spark), zones, "run-a", 0, now=NOW, keep=False)
    want = sorted(r.report_id for r in clean.clean(messages(spark), now=NOW).clean.collect())
    assert silver(spark, zones) == want


def test_unheld_stream_gives_the_same_rows(spark, tmp_path, zones):
    inbox = str(tmp_path / "inbox")
    land(spark, inbox, RECORDS.values())
    run(spark, inbox, zones, keep=False)
    want = sorted(r.report_id for r in clean.clean(messages(spark), now=NOW).clean.collect())
    assert silver(spark, zones) == want
    assert read_table(spark, zones.bronze).count() == len(RECORDS)


def test_clean_batch_leaves_no_quarantine(spark, zones):
    rows = spark.createDataFrame([(envelope(KEYS[0], 0),)], "value string")
    write_batch(rows, zones, "run-a", 0, now=NOW)
    assert commits.read_zone(spark, zones, "quarantine", schemas.BAD) is None


@pytest.mark.parametrize("broadcast_bytes", [0, 1_000_000])
@pytest.mark.parametrize("dedup", ["global", "indexed"])
def test_both_ways_to_find_new_keys_agree(spark, zones, dedup, broadcast_bytes):
    write_batch(messages(spark, dict(a=KEYS[0])), zones, "run-a", 0, now=NOW)
    typed = clean.typed_rows(clean.parse(messages(spark, dict(enumerate(KEYS)))), now=NOW)
    staged = clean_stream.stage_silver(typed, zones, "run-a", 1, dedup=dedup, broadcast_bytes=broadcast_bytes)
    assert silver(spark, zones) == ["a"]
    commits.commit(spark, zones, staged)
    assert silver(spark, zones) == ["a", "b"]


def test_lenient_stream(spark, tmp_path, zones):
    inbox = str(tmp_path / "inbox")
    land(spark, inbox, RECORDS.values())
    run(spark, inbox, zones, spec=CleanSpec.compat())
    want = clean.clean(messages(spark), CleanSpec.compat(), NOW).clean
    assert silver(spark, zones) == sorted(r.report_id for r in want.collect())
