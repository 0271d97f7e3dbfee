"""Clean a message stream into the bronze, silver and quarantine zones."""

from __future__ import annotations

import threading
from collections.abc import Callable, Mapping

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from casemill import commits, schemas
from casemill.files import delete
from casemill.layout import Zones
from casemill.operators import clean as ops, keyindex
from casemill.operators.dedup import BROADCAST_BYTES, keep_one, new_keys_only
from casemill.sources import read_table, spread, stream_source
from casemill.spec import CleanSpec, DedupMode, StreamSpec

#: Of each batch, the latest time rows were fetched at so far, in microseconds; lateness goes by it.
CLOCK = {"fetched": "bigint"}
LATE = {**schemas.CLEAN, "watermark": "timestamp"}
_STORE = "spark.sql.streaming.stateStore"
#: How ids that were seen are kept, unless the caller's session says otherwise: on the executors'
#: disks, with one bound on the memory that all partitions of an executor take for them. Small write
#: buffers, as every partition has its own and keeps it between batches.
STATE = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}.rocksdb.boundedMemoryUsage": "true",
    f"{_STORE}.rocksdb.maxMemoryUsageMB": "128",
    f"{_STORE}.rocksdb.writeBufferSizeMB": "2",
    f"{_STORE}.rocksdb.allowFAllocate": "false",
    f"{_STORE}.rocksdb.changelogCheckpointing.enabled": "true",
}


def _others(spark: SparkSession, zones: Zones, zone: str, contract, run_id: str, batch_id: int, log) -> DataFrame | None:
    """A zone's committed rows, without those an earlier attempt at this batch wrote.

    The log tells which attempts hold rows of other batches; if none does, there is nothing to read.
    """
    held = commits.latest(log, zone)
    if held:
        others = [e for e in held.values() if e.slot[1:] != (run_id, batch_id)]
        return commits.read_zone(spark, zones, zone, contract, slots=True, log=log, only=others)
    stored = commits.read_zone(spark, zones, zone, contract, slots=True, log=log)
    if stored is None:
        return None
    # Rows that were stored before there was a log may have no slot.
    return stored.where(~(F.col("run_id").eqNullSafe(run_id) & F.col("batch_id").eqNullSafe(batch_id)))


def index_keys(spark: SparkSession, zones: Zones) -> bool:
    """Index the keys of batches that were stored without; False if there are none."""
    log = commits.read_log(spark, zones)
    slots = commits.missing(log, "keys", "silver")
    if slots:
        silver = commits.read_zone(spark, zones, "silver", {"report_id": "string"}, slots=True, log=log)
        commits.adopt(keyindex.entries(silver, zones.key_buckets, *commits.SLOT), zones, "keys", slots, partition="bucket")
    return bool(slots)


def stage_silver(
    typed: DataFrame,
    zones: Zones,
    run_id: str,
    batch_id: int,
    attempt: str | None = None,
    *,
    dedup: DedupMode = "global",
    delay: str | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> list[commits.Entry]:
    """Deduplicate one batch of typed rows and stage it; the entries are what ``commit`` takes.

    Within a batch the first by ``survivor_order`` stays. ``global`` and ``indexed`` also
    drop ids that other batches have stored, so across batches the first stored row stays.
    With a ``delay``, rows fetched earlier than that before the latest row of all committed
    batches go to the late zone as they are, whatever their id.
    """
    spark, attempt = typed.sparkSession, attempt or commits.new_attempt()
    if dedup == "indexed":
        index_keys(spark, zones)
    log = commits.read_log(spark, zones)
    staged: list[commits.Entry] = []

    def stage(rows: DataFrame, zone: str, partition: str | None = None) -> None:
        staged.append(
            commits.stage(rows, zones, zone, attempt, run_id, batch_id, partition=partition, gather=bool(partition))
        )

    if delay:
        clock = _others(spark, zones, "clock", CLOCK, run_id, batch_id, log)
        latest = F.lit(clock.agg(F.max("fetched")).first()[0] if clock is not None else None).cast("bigint")
        mark = F.timestamp_micros(latest) - F.expr(f"INTERVAL {delay}")
        behind = F.coalesce(F.col("ingestion_timestamp") < mark, F.lit(False))
        stage(typed.where(behind).withColumn("watermark", mark), "late", "batch_number")
        fetched = F.greatest(F.unix_micros(F.max("ingestion_timestamp")), latest)
        stage(typed.agg(fetched.alias("fetched")), "clock")
        typed = typed.where(~behind)
    once = keep_one(typed, ["report_id"], ops.survivor_order())
    if dedup not in ("global", "indexed"):
        stage(once, "silver", "batch_number")
        return staged
    zone, contract = ("silver", {"report_id": "string"}) if dedup == "global" else ("keys", keyindex.CONTRACT)
    stored = _others(spark, zones, zone, contract, run_id, batch_id, log)
    if stored is None:  # the rows are used once
        stage(once.select(*typed.columns), "silver", "batch_number")
    else:
        once = once.persist(StorageLevel.DISK_ONLY)
        try:
            if dedup == "global":
                fresh = new_keys_only(once, stored, "report_id", broadcast_bytes=broadcast_bytes)
            else:
                ids = once.select("report_id")
                hits = keyindex.known(ids, stored, zones.key_buckets, broadcast_bytes=broadcast_bytes)
                fresh = once.join(hits, "report_id", "left_anti")
            stage(fresh.select(*typed.columns), "silver", "batch_number")
        finally:
            once.unpersist()
    if dedup == "indexed":
        kept = commits.read_staged(spark, zones, staged[-1], schemas.CLEAN)
        stage(keyindex.entries(kept, zones.key_buckets), "keys", "bucket")
    return staged


def _held(rows: DataFrame, path: str) -> DataFrame:
    """Rows written to files and read again, a stretch at a time, however many there are.

    Spark's cache would not do: a partition of it that went to disk comes back as a whole.
    """
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def stage_batch(
    messages: DataFrame,
    zones: Zones,
    run_id: str,
    batch_id: int,
    spec: CleanSpec = CleanSpec(),
    *,
    dedup: DedupMode = "global",
    delay: str | None = None,
    now=None,
    keep: bool = True,
    silver: bool = True,
) -> list[commits.Entry]:
    """Write one bounded frame of messages to all zones, where nobody sees it yet.

    ``keep`` holds the parsed rows in files while the zones are written from them; turn it
    off for a frame too large to hold. That one is parsed once per zone, and its raw rows
    are written from where they are read instead of being shuffled into fewer files.
    """
    attempt = commits.new_attempt()
    opened = ops.open_envelopes(messages, spec)
    parsed = ops.parse_records(opened, spec)
    held = f"{zones.parsed}/attempt={attempt}"
    try:
        if keep:
            opened = parsed = _held(parsed, held)
        raw = ops.raw_rows(opened, spec, now)
        staged = [commits.stage(raw, zones, "bronze", attempt, run_id, batch_id, partition="batch_number", gather=keep)]
        bad = ops.bad_rows(parsed, spec, now)
        staged.append(commits.stage_if_any(bad, zones, "quarantine", attempt, run_id, batch_id))
        if silver:
            typed = ops.typed_rows(parsed, spec, now)
            staged += stage_silver(typed, zones, run_id, batch_id, attempt, dedup=dedup, delay=delay)
    finally:
        if keep:
            delete(messages.sparkSession, held)
    return staged


def write_batch(messages: DataFrame, zones: Zones, run_id: str, batch_id: int, *args, **options) -> None:
    """``stage_batch``, and the one record that makes all of it count.

    Writing the same (run, batch) again replaces its rows in every zone, so a retried batch
    changes nothing. Until the record is there, readers see nothing of the batch, or what
    an earlier attempt at it has committed.
    """
    staged = stage_batch(messages, zones, run_id, batch_id, *args, **options)
    commits.commit(messages.sparkSession, zones, staged)


def start_stream(
    stream: DataFrame,
    checkpoint: str,
    trigger: Mapping[str, object],
    write: Callable[[DataFrame, str, int], None],
    mode: str = "append",
) -> StreamingQuery:
    """Start a per-batch sink whose run id is the query's own, kept in its checkpoint.

    A restarted query keeps its id and so replaces a half-written batch; a query
    on a new checkpoint counts batches from 0 again but gets a new id, so it
    cannot overwrite history.
    """
    started = threading.Event()
    holder: list[StreamingQuery] = []

    def sink(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        write(batch, f"run-{holder[0].id}", batch_id)

    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .foreachBatch(sink)
        .start()
    )
    holder.append(query)
    started.set()
    return query


def state_session(spark: SparkSession) -> SparkSession:
    """A session for a stream with state: the caller's settings over those of ``STATE``."""
    session = spark.newSession()
    for name, value in {**STATE, **spark.conf.getAll}.items():
        if session.conf.get(name, None) != value:
            try:
                session.conf.set(name, value)
            except AnalysisException:  # a setting of the application, which all sessions share
                pass
    return session


def compact_zones(spark: SparkSession, zones: Zones, small_bytes: int = 32 << 20) -> dict[str, int]:
    """Gather the small files of all zones a stream writes; gives the attempts rewritten per zone."""
    layout = {
        "bronze": (schemas.RAW, "batch_number"),
        "silver": (schemas.CLEAN, "batch_number"),
        "quarantine": (schemas.BAD, None),
        "late": (LATE, "batch_number"),
        "keys": (keyindex.CONTRACT, "bucket"),
        "clock": (CLOCK, None),
    }
    done = {
        zone: commits.compact(spark, zones, zone, contract, partition=partition, small_bytes=small_bytes)
        for zone, (contract, partition) in layout.items()
    }
    commits.compact_log(spark, zones)
    return done


def run_clean_stream(
    spark: SparkSession,
    source: StreamSpec,
    zones: Zones,
    spec: CleanSpec = CleanSpec(),
    *,
    dedup: DedupMode = "global",
    delay: str = "1 day",
    late: bool = False,
    compact_every: int | None = None,
    trigger: Mapping[str, object] | None = None,
    now=None,
    keep: bool = True,
    name: str = "clean_stream",
) -> list[StreamingQuery]:
    """Start cleaning and return the running queries.

    ``dedup`` says how far duplicates are looked for:

    * ``per_batch``: within a micro-batch only.
    * ``global``: also against everything stored. Each batch scans the stored
      id column, so let batches be large (``max_per_trigger``).
    * ``indexed``: as ``global``, but the ids are looked up in an index of hash
      buckets, of which a batch reads those its own ids fall in.
    * ``state``: against every id seen so far, kept in the state store with the
      times it was seen, so a batch costs what it holds. Of the copies in the first
      batch that has the id the first by ``survivor_order`` stays.
    * ``watermark``: ids are forgotten ``delay`` after they were fetched, and rows
      arriving later than that are not cleaned (they stay in bronze). Which copy of
      one batch stays is not defined. Rows whose time cannot be read are cleaned, and deduplicated within
      their batch only.

    ``late`` sets rows aside that were fetched more than ``delay`` before the latest
    row of the batches committed so far: they go to the late zone, whole, and every other
    row to silver. It goes with the modes that keep no state. ``compact_every`` gathers the
    small files of the zones, and the log, after every so many batches.

    The two stateful modes need a second query, as state can only drop rows for
    silver and must not drop them for bronze. It runs in a session of its own, by the
    caller's settings and, where those say nothing, ``STATE``, so that ids lie on disk.
    ``keep`` is that of ``write_batch``: turn it off for batches without a bound. ``trigger`` defaults to working
    through what is there and stopping; a service passes ``processingTime``.
    """
    trigger = dict(trigger or {"availableNow": True})
    stateful = dedup in ("state", "watermark")
    if late and stateful:
        raise ValueError(f"{dedup} drops late rows itself; late rows are kept by the modes without state")
    messages = stream_source(spark, source)

    def zone_batch(batch: DataFrame, run_id: str, batch_id: int) -> None:
        write_batch(
            spread(batch),
            zones,
            run_id,
            batch_id,
            spec,
            dedup=dedup,
            delay=delay if late else None,
            now=now,
            keep=keep,
            silver=not stateful,
        )
        if compact_every and batch_id % compact_every == compact_every - 1:
            compact_zones(spark, zones)

    queries = [start_stream(messages, f"{zones.checkpoints}/{name}", trigger, zone_batch)]
    if stateful:
        typed = ops.typed_rows(ops.parse(stream_source(state_session(spark), source), spec), spec, now)
        if dedup == "watermark":
            # A row without a readable time passes by the watermark, which it must not move.
            timeless = typed.where("ingestion_timestamp IS NULL")
            typed = (
                typed.where("ingestion_timestamp IS NOT NULL")
                .withWatermark("ingestion_timestamp", delay)
                .dropDuplicatesWithinWatermark(["report_id"])
                .unionByName(timeless)
            )
        else:
            # Within one batch the time is one value, so an id is new if it was first and last seen at once.
            # State holds ids and times alone; the rows go by it, and meet the new ids in the batch.
            columns = typed.columns
            seen = typed.select("report_id", F.current_timestamp().alias("_seen")).groupBy("report_id")
            times = seen.agg(F.min("_seen").alias("_first"), F.max("_seen").alias("_last"))
            new = times.where("_first = _last").select("report_id", F.lit(True).alias("_new"))
            typed = typed.unionByName(new, allowMissingColumns=True)

        def silver_batch(batch: DataFrame, run_id: str, batch_id: int) -> None:
            if dedup == "watermark":
                batch = keep_one(batch, ["report_id"], ops.survivor_order())
            else:
                key = F.when(F.col("_new").isNull(), ops.survivor_key())
                best = F.min_by(F.struct(*columns), key).alias("_row")
                batch = batch.groupBy("report_id").agg(best, F.bool_or("_new").alias("_new"))
                batch = batch.where("_new").select("_row.*")
            attempt = commits.new_attempt()
            staged = commits.stage(
                batch, zones, "silver", attempt, run_id, batch_id, partition="batch_number", gather=True
            )
            commits.commit(spark, zones, [staged])

        mode = "append" if dedup == "watermark" else "update"
        queries.append(start_stream(typed, f"{zones.checkpoints}/{name}_silver", trigger, silver_batch, mode))
    return queries
