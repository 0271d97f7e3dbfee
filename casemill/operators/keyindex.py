"""An index of stored keys, laid out by hash bucket, that a batch asks without moving it.

The index is a zone of its own: ``bucket=<hash of the key>`` folders of keys, committed
with the batch that stored them. A batch's keys name the buckets to read, and meet them in
a broadcast join, so the index is neither shuffled nor read as a whole, and a batch costs
what its own buckets hold.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from casemill.operators.dedup import BROADCAST_BYTES, KEY_BYTES

CONTRACT = {"report_id": "string", "bucket": "int"}
#: A batch whose keys need more broadcasts than this meets the index in a shuffle of keys.
MOST_RUNS = 16


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def entries(rows: DataFrame, buckets: int, *more: str) -> DataFrame:
    """What the index holds of stored rows, and ``more`` of their columns."""
    return rows.select("report_id", bucket_of(F.col("report_id"), buckets).alias("bucket"), *more)


def runs(sizes: Iterable[tuple[int, int]], limit: int) -> list[list[int]]:
    """Buckets and the bytes a batch has in them, in runs of up to ``limit`` bytes."""
    out: list[list[int]] = []
    room = 0
    for bucket, size in sorted(sizes):
        if not out or size > room:
            out.append([])
            room = limit
        out[-1].append(bucket)
        room -= size
    return out


def known(
    keys: DataFrame, index: DataFrame, buckets: int, *, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Those of a (persisted) batch's ``keys``, one row each, that the index holds.

    Only the batch's bytes per bucket come to the driver, one row per bucket at most. They
    say which buckets are read and how the keys are dealt to broadcasts of bounded size.
    """
    keys = entries(keys, buckets)
    size = F.sum(F.octet_length("report_id") + KEY_BYTES)
    sizes = [tuple(row) for row in keys.groupBy("bucket").agg(size).collect()]
    parts = runs(sizes, broadcast_bytes)
    if len(parts) > MOST_RUNS or any(size > broadcast_bytes for _, size in sizes):
        return keys.join(index, "report_id", "left_semi").select("report_id")

    def hits(part: list[int]) -> DataFrame:
        inside = F.col("bucket").isin(part)
        asked = F.broadcast(keys.where(inside).select("report_id"))
        return index.where(inside).select("report_id").join(asked, "report_id", "left_semi")

    return reduce(DataFrame.unionByName, map(hits, parts or [[]])).distinct()
