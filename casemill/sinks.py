"""Tables out: Parquet, CSV, JDBC, message topics."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, DataFrameWriter, functions as F

from casemill import schemas
from casemill.files import delete
from casemill.operators.ingest import to_messages
from casemill.sources.tables import read_table
from casemill.spec import JdbcSpec


SHARES = 16  # without adaptive execution a partition value goes to this part of the tasks


def gathered(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows arranged so that a partitioned write makes few, evenly sized files.

    Without it every task writes a file into every partition it has rows for.
    The rebalance splits a partition value that holds most of the rows over many
    tasks, which a plain repartition by that value would not. It needs adaptive
    execution, which a stream with state runs without: there every value is dealt
    out in as many shares as a sixteenth of the shuffle has partitions.
    """
    conf = df.sparkSession.conf
    if conf.get("spark.sql.adaptive.enabled") == "true":
        return df.hint("rebalance", *columns)
    width = int(conf.get("spark.sql.shuffle.partitions"))
    content = [name for name, kind in df.dtypes if "map<" not in kind]
    return df.repartition(width, *columns, F.pmod(F.xxhash64(*content), F.lit(max(1, width // SHARES))))


def append_partitioned(df: DataFrame, path: str, partition: str = "batch_number") -> None:
    """Append to a Parquet table partitioned by a column."""
    gathered(df, [partition]).write.mode("append").partitionBy(partition).parquet(path)


def append_if_nonempty(df: DataFrame, path: str) -> bool:
    """Append; if there was nothing to append, a table that was not there is not made.

    ``df`` runs once: the rows are staged beside the table, which tells whether there are any.
    """
    spark, staged = df.sparkSession, f"{path.rstrip('/')}-staged-{uuid.uuid4().hex}"
    df.write.parquet(staged)
    rows = read_table(spark, staged, contract=dict(df.dtypes))
    try:
        if rows.isEmpty():
            return False
        rows.write.mode("append").parquet(path)
        return True
    finally:
        delete(spark, staged)


def overwrite_snapshot(df: DataFrame, path: str) -> None:
    """Replace a whole Parquet table."""
    df.write.mode("overwrite").parquet(path)


def overwrite_partitions(df: DataFrame, path: str, *partitions: str) -> None:
    """Replace only the partitions that occur in ``df``."""
    (
        gathered(df, partitions).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def export_csv(df: DataFrame, path: str) -> None:
    """Replace a CSV folder, with a header line in every file."""
    df.write.mode("overwrite").option("header", True).csv(path)


def jdbc_options(spec: JdbcSpec, table: str, extra: Mapping[str, str] | None = None) -> dict[str, str]:
    """Writer options for one warehouse table."""
    return {
        "url": spec.url,
        "dbtable": table,
        "user": spec.user,
        "password": spec.password,
        "driver": spec.driver,
        "batchsize": str(spec.batch_rows),
        "numPartitions": str(spec.max_connections),
        **(extra or {}),
    }


def jdbc_writer(
    df: DataFrame,
    spec: JdbcSpec,
    table: str,
    mode: str = "append",
    extra: Mapping[str, str] | None = None,
) -> DataFrameWriter:
    """A writer for a warehouse table, shaped to the table's contract if it has one.

    ``overwrite`` empties the table and keeps its definition, indexes and grants.
    """
    options = dict(extra or {})
    if mode == "overwrite":
        options.setdefault("truncate", "true")
    if table in schemas.WAREHOUSE:
        df = schemas.conform(df, schemas.WAREHOUSE[table])
    return df.write.format("jdbc").options(**jdbc_options(spec, table, options)).mode(mode)


def jdbc_write(df: DataFrame, spec: JdbcSpec, table: str, mode: str = "append", extra=None) -> None:
    jdbc_writer(df, spec, table, mode, extra).save()


def kafka_options(servers: str, topic: str, extra: Mapping[str, str] | None = None) -> dict[str, str]:
    """Publisher options: every replica acknowledges, compressed, small delay to batch."""
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        # The settings that publishers of this topic share.
        "kafka.acks": "all",
        "kafka.retries": "5",
        "kafka.linger.ms": "50",
        "kafka.compression.type": "gzip",
        **(extra or {}),
    }


def publish(wrapped: DataFrame, servers: str, topic: str, extra: Mapping[str, str] | None = None) -> None:
    """Send keyed envelope rows to a topic, from all executors at once."""
    to_messages(wrapped).write.format("kafka").options(**kafka_options(servers, topic, extra)).save()


def land_messages(wrapped: DataFrame, path: str, files: int | None = None) -> None:
    """Write messages as Parquet files a ``files`` stream can watch."""
    messages = to_messages(wrapped)
    if files:
        messages = messages.repartition(files)
    messages.write.mode("append").parquet(path)
