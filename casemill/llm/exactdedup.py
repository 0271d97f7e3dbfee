"""Exact duplicates in a stream of documents.

A streaming query groups the rows of a growing folder by the digest of their text. Its
state, kept on disk in RocksDB and never expired, holds per digest how many rows had it,
and of the row that stays the identifier and the place of its content: file and row. Rows
of one digest meet in each task before the shuffle, without their text, so a digest that
a third of all rows share costs a row per task.

A digest seen twice is a hit, and a hit is only believed once its bytes were compared: the
least and the greatest text of its rows must be the same. Texts, too, meet in each task
first. Where hits are few they are sent to the scan, so that no other text moves. Of a
digest whose texts differ, the texts themselves are the groups.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.layout import scratch_folder
from casemill.llm.text import stored

BATCH_BYTES = 1 << 40  # of files in one micro-batch, about
BROADCAST_BYTES = 64 << 20  # hits are sent to all tasks up to this size
HIT_BYTES = 64  # what a hit takes there

Digest = Callable[[Column], Column]
_STATE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_HITS = "digest binary, members long, keep struct<doc_id: long, file: string, row: long>"


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def located(frame: DataFrame, text: str = "text", key: str = "doc_id", digest: Digest = sha256) -> DataFrame:
    """doc_id, the place of its content (file, row), text and digest of rows read from Parquet files."""
    return frame.select(
        F.col(key).cast("long").alias("doc_id"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).withColumn("digest", digest(F.col("text")))


def _stream_session(spark: SparkSession) -> SparkSession:
    """A session of its own for the state's settings, so that the caller's stay as they are."""
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    session.conf.set("spark.sql.streaming.stateStore.providerClass", _STATE)
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "true")
    # Else each partition's store takes megabytes of disk before it holds a row.
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return session


def _pattern(path: str) -> str:
    """A pattern that matches the path alone: a stream takes a single file only by pattern."""
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]"


def write_hits(changed: DataFrame, home: str, batch_id: int) -> None:
    found = changed.where("members > 1").select("digest", "members", "keep")
    found.write.mode("overwrite").parquet(f"{home}/hits/batch={batch_id}")


def observe(
    spark: SparkSession,
    path: str,
    home: str,
    text: str = "text",
    key: str = "doc_id",
    digest: Digest = sha256,
    batch_bytes: int = BATCH_BYTES,
) -> None:
    """Take in what has arrived under ``path`` since the last call with this ``home``, and stop.

    ``home`` holds the query's checkpoint, and with it the state, and the hits of each
    micro-batch. A micro-batch that is done again replaces its hits.
    """
    session = _stream_session(spark)
    schema = spark.read.parquet(path).schema
    arriving = session.readStream.schema(schema).option("maxBytesPerTrigger", str(batch_bytes)).parquet(_pattern(path))
    seen = (
        located(arriving, text, key, digest)
        .select("digest", F.struct("doc_id", "file", "row").alias("keep"))
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("members"), F.max("keep").alias("keep"))
    )

    query = (
        seen.writeStream.outputMode("update")
        .option("checkpointLocation", f"{home}/checkpoint")
        .trigger(availableNow=True)
        .foreachBatch(lambda changed, batch_id: write_hits(changed, home, batch_id))
        .start()
    )
    query.awaitTermination()


def hits(spark: SparkSession, home: str) -> DataFrame:
    """(digest, members, keep) of every digest seen more than once, as of the last micro-batch.

    Counts only grow, and so does the row that stays, so the greatest are the latest.
    """
    told = spark.read.schema(_HITS).parquet(f"{home}/hits")
    latest = told.groupBy("digest").agg(F.max("members").alias("members"), F.max("keep").alias("keep"))
    return stored(latest, "hits")


def torn(rows: DataFrame, found: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The digests among the hits whose rows do not all hold the same bytes."""
    if found.count() * HIT_BYTES <= broadcast_bytes:
        rows = rows.join(F.broadcast(found.select("digest")), "digest", "left_semi")
    compared = rows.groupBy("digest").agg(F.min("text").alias("least"), F.max("text").alias("greatest"))
    return compared.where("least <> greatest").select("digest")


def groups(rows: DataFrame, found: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``rows`` (of ``located``) with group_size and keep, and without text; a row alone has none to keep.

    The join by digest is the planner's: it sends few hits to all tasks, and splits the
    rows of a digest that many share.
    """
    differing = stored(torn(rows, found, broadcast_bytes), "torn")
    if differing.isEmpty():
        return rows.drop("text").join(found.withColumnRenamed("members", "group_size"), "digest", "left")
    apart = rows.join(differing, "digest", "left_semi")
    by_text = apart.groupBy("digest", "text").agg(
        F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "file", "row")).alias("keep")
    )
    whole = rows.drop("text").join(differing, "digest", "left_anti")
    return (
        whole.join(found.withColumnRenamed("members", "group_size"), "digest", "left")
        .unionByName(apart.join(by_text, ["digest", "text"]).drop("text"))
    )


def verdicts(
    spark: SparkSession,
    path: str,
    home: str,
    text: str = "text",
    key: str = "doc_id",
    digest: Digest = sha256,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row under ``path``, after ``observe``.

    Null texts are empty ones, and empty texts are equal like others. Of equal texts the row
    with the largest id stays; null ids come last, and of rows with one id the one that lies
    last by file and row stays. Other columns are not read, whatever their names.
    """
    rows = located(spark.read.parquet(path), text, key, digest).withColumn("text_sha256", F.sha2("text", 256))
    marked = groups(rows, hits(spark, home), broadcast_bytes)
    alone = F.col("keep").isNull()
    stays = (F.col("keep.file") == F.col("file")) & (F.col("keep.row") == F.col("row"))
    return marked.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        (alone | stays).alias("kept"),
        "text_sha256",
    )


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, home = f"{sf_dir}/documents.parquet", scratch_folder(spark, "exact")
    observe(spark, path, home)
    return verdicts(spark, path, home)


ORACLE = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
