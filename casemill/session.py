"""Session for stand-alone use. Library code never changes a caller's session."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession


def build(app_name: str, conf: Mapping[str, str] | None = None) -> SparkSession:
    """UTC, adaptive execution and dynamic partition overwrite; ``conf`` wins.

    The shuffle width is left to adaptive execution: fixing it to a handful
    would put terabytes into each task.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.streaming.schemaInference": "false",
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        # Recording the call site of every column expression takes about a fifth of
        # the time to build a plan, which a stream pays once per batch.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **(conf or {}),
    }
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
