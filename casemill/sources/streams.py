"""Streaming readers. Every kind yields one text column, ``value``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from casemill.operators.ingest import from_messages
from casemill.spec import StreamSpec


def kafka_options(spec: StreamSpec) -> dict[str, str]:
    """Reader options of a Kafka source."""
    if not (spec.servers and spec.topic):
        raise ValueError("a kafka source needs servers and topic")
    options = {
        "kafka.bootstrap.servers": spec.servers,
        "subscribe": spec.topic,
        "startingOffsets": spec.starting_offsets,
    }
    return {**options, "maxOffsetsPerTrigger": str(spec.bound), **spec.options}


def _file_options(spec: StreamSpec) -> dict[str, str]:
    if not spec.path:
        raise ValueError("a files source needs a path")
    return {"maxFilesPerTrigger": str(spec.bound), **spec.options}


def stream_source(spark: SparkSession, spec: StreamSpec) -> DataFrame:
    """The message stream a spec describes."""
    if spec.kind == "kafka":
        raw = spark.readStream.format("kafka").options(**kafka_options(spec)).load()
        return from_messages(raw)
    reader = spark.readStream.options(**_file_options(spec))
    if spec.file_format == "text":
        return reader.text(spec.path)
    return from_messages(reader.schema("value binary").parquet(spec.path))
