"""Duplicate elimination with a stated survivor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# Key lists of at most this size are broadcast.
BROADCAST_BYTES = 64 << 20
KEY_BYTES = 64  # what a key takes beside its own characters, about


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key group under ``order``.

    Catalyst turns ``row_number() = 1`` into a group limit on both sides of the
    shuffle: each task sends at most one row per key, so a key holding a third
    of all rows costs its reducer one row per map task and no more.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def keep_any(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One arbitrary row per key."""
    return df.dropDuplicates(list(keys))


def new_keys_only(
    batch: DataFrame, stored: DataFrame, key: str, *, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Rows of a (small, persisted) batch whose key is not stored yet.

    The stored side is the large one, so it must not be shuffled for every
    batch: when the batch's keys take little enough room they are broadcast to a
    semi join that scans only the stored key column, and the few hits are then
    subtracted. The keys of a larger batch meet the stored ones in a shuffle of
    the key columns alone, whose join is left to the planner.
    """
    stored = stored.select(key)
    keys = batch.select(key)
    size = F.sum(F.octet_length(F.col(key).cast("string")) + KEY_BYTES)
    if (keys.agg(size).first()[0] or 0) <= broadcast_bytes:
        keys = F.broadcast(keys)
    hits = stored.join(keys, key, "left_semi").distinct()
    return batch.join(hits, key, "left_anti")
