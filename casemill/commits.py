"""Which rows of a zone count: attempts at a batch, and a log of those that were committed.

Every write goes to a folder of its own, ``attempt=<id>``, and nothing is overwritten. The
rows carry the slot they fill: a stream's batch, or the one slot of a snapshot. When all
zones of a batch are written, one file is added to the log, which names the attempt that
fills each slot from then on. Readers take the attempts the log names, so they see a batch
in all its zones or in none, and the old rows of a slot until the new ones are complete.

The log is a small Parquet table of one row per slot and attempt; the latest row of a slot
counts. Compaction writes rows of many slots to one attempt, and logs them with the
sequence they had, so that a batch replayed meanwhile still replaces its rows.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from casemill import schemas
from casemill.files import children, delete, sizes
from casemill.layout import Zones
from casemill.sinks import gathered
from casemill.sources.tables import read_if_present, read_table

#: What every stored row says of itself, beside its contract.
SLOT = {"run_id": "string", "batch_id": "bigint"}
LOG = {"zone": "string", **SLOT, "attempt": "string", "sequence": "bigint", "generation": "int"}
SNAPSHOT = ("snapshot", 0)  # the slot of a table that is replaced as a whole
NOTHING = ""  # stands for an attempt without rows


@dataclass(frozen=True)
class Entry:
    """One row of the log: an attempt fills a slot of a zone."""

    zone: str
    run_id: str
    batch_id: int
    attempt: str
    sequence: int = 0
    generation: int = 0

    @property
    def slot(self) -> tuple[str, str, int]:
        return self.zone, self.run_id, self.batch_id


def new_attempt() -> str:
    return uuid.uuid4().hex


def read_log(spark: SparkSession, zones: Zones) -> list[Entry]:
    """All of the log. Its length is the number of batches, not of rows."""
    stored = read_if_present(spark, zones.commits, LOG)
    return [] if stored is None else [Entry(*row) for row in stored.select(*LOG).collect()]


def latest(log: Iterable[Entry], zone: str | None = None) -> dict[tuple[str, str, int], Entry]:
    """The entry that counts for each slot."""
    out: dict[tuple[str, str, int], Entry] = {}
    for entry in log:
        held = out.get(entry.slot)
        if zone in (None, entry.zone) and (
            held is None or (entry.sequence, entry.generation) > (held.sequence, held.generation)
        ):
            out[entry.slot] = entry
    return out


def _append(spark: SparkSession, zones: Zones, entries: Iterable[Entry]) -> None:
    """Add rows to the log in one file, so that all of them count from one moment on.

    Each record has its own folder, as queries that run side by side commit side by side.
    """
    rows = [(e.zone, e.run_id, e.batch_id, e.attempt, e.sequence, e.generation) for e in entries]
    record = spark.createDataFrame(rows, schemas.ddl(LOG)).coalesce(1)
    record.write.parquet(f"{zones.commits}/record={uuid.uuid4().hex}")


def stage(
    rows: DataFrame,
    zones: Zones,
    zone: str,
    attempt: str,
    run_id: str = SNAPSHOT[0],
    batch_id: int = SNAPSHOT[1],
    *,
    partition: str | None = None,
    gather: bool = False,
) -> Entry:
    """Write rows that do not count yet; the entry is what ``commit`` takes."""
    if gather and partition:
        rows = gathered(rows, [partition])
    marked = rows.withColumns({"run_id": F.lit(run_id), "batch_id": F.lit(batch_id).cast("bigint")})
    writer = marked.write.partitionBy(partition) if partition else marked.write
    writer.parquet(f"{getattr(zones, zone)}/attempt={attempt}")
    return Entry(zone, run_id, batch_id, attempt)


def stage_if_any(rows: DataFrame, zones: Zones, zone: str, attempt: str, run_id: str, batch_id: int) -> Entry:
    """Like ``stage``, but no rows leave no folder. What was written tells, so ``rows`` run once."""
    entry = stage(rows, zones, zone, attempt, run_id, batch_id)
    if not read_staged(rows.sparkSession, zones, entry, dict(rows.dtypes)).isEmpty():
        return entry
    delete(rows.sparkSession, f"{getattr(zones, zone)}/attempt={attempt}")
    return replace(entry, attempt=NOTHING)


def read_staged(spark: SparkSession, zones: Zones, entry: Entry, contract: Mapping[str, str]) -> DataFrame:
    """What was staged, for the writer that goes on from it."""
    return read_table(spark, f"{getattr(zones, entry.zone)}/attempt={entry.attempt}", contract=contract).select(*contract)


def commit(spark: SparkSession, zones: Zones, entries: Iterable[Entry]) -> None:
    """From now on these attempts fill their slots, all of them at once.

    The sequence goes on from the slots' last one, so a driver whose clock is behind that
    of the one before it still replaces its rows.
    """
    entries = list(entries)
    held = latest(read_log(spark, zones))
    last = max((held[e.slot].sequence for e in entries if e.slot in held), default=0)
    sequence = max(time.time_ns(), last + 1)
    _append(spark, zones, [Entry(*e.slot, e.attempt, sequence) for e in entries])


def read_zone(
    spark: SparkSession,
    zones: Zones,
    zone: str,
    contract: Mapping[str, str],
    *,
    slots: bool = False,
    log: list[Entry] | None = None,
    only: Iterable[Entry] | None = None,
) -> DataFrame | None:
    """The rows of a zone that count, or None before there are any.

    Only the folders of attempts that the log names are read. Where an attempt holds
    rows of a slot that has been filled anew since, a join with the log leaves them out. A
    zone the log does not know, written without it, counts as it lies. ``slots`` adds the
    columns of ``SLOT``; ``log`` is the log, if it has been read; ``only`` names the slots
    that are wanted.
    """
    names = [*contract, *SLOT] if slots else list(contract)
    log = [e for e in (read_log(spark, zones) if log is None else log) if e.zone == zone]
    path = getattr(zones, zone)
    if not log:
        stored = read_if_present(spark, path, {**contract, **SLOT})
        return None if stored is None else stored.select(*names)
    live = list(latest(log).values() if only is None else only)
    attempts = {e.attempt for e in live} - {NOTHING}
    if not attempts:
        return None
    folders = [f"{path}/attempt={attempt}" for attempt in sorted(attempts)]
    stored = read_table(spark, *folders, contract={**contract, **SLOT, "attempt": "string"}, base=path)
    counting = {(e.slot, e.attempt) for e in live}
    if any(e.attempt in attempts and (e.slot, e.attempt) not in counting for e in log):
        rows = [(e.run_id, e.batch_id, e.attempt) for e in live]
        keys = spark.createDataFrame(rows, schemas.ddl({**SLOT, "attempt": "string"}))
        stored = stored.join(F.broadcast(keys), [*SLOT, "attempt"], "left_semi")
    return stored.select(*names)


def read(spark: SparkSession, zones: Zones, zone: str) -> DataFrame:
    """The rows of a zone that count; an error before there are any."""
    rows = read_zone(spark, zones, zone, schemas.ZONES[zone])
    if rows is None:
        raise LookupError(f"nothing was committed to {getattr(zones, zone)}")
    return rows


def missing(log: Iterable[Entry], zone: str, like: str) -> list[Entry]:
    """The slots of ``like`` that ``zone`` has not, or only as they were before."""
    log = list(log)
    held = latest(log, zone)
    return [
        e
        for e in latest(log, like).values()
        if (zone, e.run_id, e.batch_id) not in held or held[zone, e.run_id, e.batch_id].sequence < e.sequence
    ]


def adopt(rows: DataFrame, zones: Zones, zone: str, slots: Iterable[Entry], *, partition: str | None = None) -> None:
    """Fill slots of a zone with rows made from another zone's; ``rows`` carry ``SLOT``.

    The slots keep their sequence, so a batch written again meanwhile still replaces its rows.
    """
    spark, attempt, slots = rows.sparkSession, new_attempt(), list(slots)
    keys = spark.createDataFrame([(e.run_id, e.batch_id) for e in slots], schemas.ddl(SLOT))
    rows = rows.join(F.broadcast(keys), list(SLOT), "left_semi")
    rows = gathered(rows, [partition]) if partition else rows
    writer = rows.write.partitionBy(partition) if partition else rows.write
    writer.parquet(f"{getattr(zones, zone)}/attempt={attempt}")
    _append(spark, zones, [Entry(zone, e.run_id, e.batch_id, attempt, e.sequence) for e in slots])


def publish(
    frames: Mapping[str, DataFrame], zones: Zones, *, partitions: Mapping[str, str] | None = None
) -> None:
    """Replace whole tables, all of them at one moment: staged, then committed."""
    spark, attempt = next(iter(frames.values())).sparkSession, new_attempt()
    entries = [stage(rows, zones, zone, attempt, partition=(partitions or {}).get(zone)) for zone, rows in frames.items()]
    commit(spark, zones, entries)


def compact(
    spark: SparkSession,
    zones: Zones,
    zone: str,
    contract: Mapping[str, str],
    *,
    partition: str | None = None,
    small_bytes: int = 32 << 20,
    target_bytes: int = 128 << 20,
) -> int:
    """Rewrite attempts whose files are small into one attempt; gives how many were rewritten.

    Files are chosen by size: those of attempts whose files are smaller than ``small_bytes``
    on average. The scan packs them into tasks by bytes, about ``target_bytes`` each, that
    write one file; rows of a partitioned zone are gathered by partition value, large values
    split by bytes. The new attempt takes the old ones' slots with the sequences they had.
    """
    live = list(latest(read_log(spark, zones), zone).values())
    path = getattr(zones, zone)
    taken: dict[str, list[int]] = {}
    folders = {f"{path}/attempt={e.attempt}" for e in live if e.attempt != NOTHING}
    for file, size in sizes(spark, *sorted(folders)):
        taken.setdefault(file.split("/attempt=", 1)[1].split("/", 1)[0], []).append(size)
    small = sorted(a for a in taken if sum(taken[a]) < small_bytes * len(taken[a]))
    files = sum(len(taken[a]) for a in small)
    if files < 2 or (partition and len(small) < 2):
        return 0
    rows = read_zone(spark, zones, zone, {**contract, "attempt": "string"}, slots=True)
    rows = rows.where(F.col("attempt").isin(small)).select(*contract, *SLOT)
    if partition:
        rows = gathered(rows, [partition])
    else:
        rows = rows.coalesce(max(1, round(sum(sum(taken[a]) for a in small) / target_bytes)))
    attempt = new_attempt()
    writer = rows.write.partitionBy(partition) if partition else rows.write
    writer.parquet(f"{path}/attempt={attempt}")
    moved = [Entry(*e.slot, attempt, e.sequence, e.generation + 1) for e in live if e.attempt in small]
    _append(spark, zones, moved)
    return len(small)


def compact_log(spark: SparkSession, zones: Zones) -> None:
    """Gather the log into one file, without the entries of attempts that no longer count.

    The gathered rows are added before the files they come from go; a reader that sees
    both sees each entry twice, which changes nothing.
    """
    old, log = children(spark, zones.commits), read_log(spark, zones)
    live = {(e.zone, e.attempt) for e in latest(log).values()}
    # Of an attempt that counts, the slots it has lost stay on record, as it still holds their rows.
    _append(spark, zones, [e for e in dict.fromkeys(log) if (e.zone, e.attempt) in live])
    for file in old:
        delete(spark, file)


def vacuum(spark: SparkSession, zones: Zones, zone: str, *, older_than: float = 7 * 86_400) -> int:
    """Remove attempts that do not count and were made more than so many seconds ago.

    Give it longer than any reader or writer takes: a reader may still scan what has been
    replaced, and a writer's attempt does not count before it is committed.
    """
    live = {e.attempt for e in latest(read_log(spark, zones), zone).values()}
    gone = 0
    for folder in children(spark, getattr(zones, zone), before=time.time() - older_than):
        name = folder.rstrip("/").rsplit("/", 1)[-1]
        if name.startswith("attempt=") and name.removeprefix("attempt=") not in live:
            delete(spark, folder)
            gone += 1
    return gone
