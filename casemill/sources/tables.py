"""Batch readers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from casemill import schemas


def read_table(
    spark: SparkSession, *places: str | None, contract: Mapping[str, str] | None = None, base: str | None = None
) -> DataFrame:
    """A Parquet table that lies in one place or several; places without a name are passed over.

    With a contract, no file is opened to infer the schema. ``base`` is the folder below
    which folder names give column values.
    """
    named = list(filter(None, places))
    if not named:
        raise ValueError("a table needs a place")
    reader = spark.read.schema(schemas.ddl(contract)) if contract else spark.read
    return (reader.option("basePath", base) if base else reader).parquet(*named)


def read_if_present(
    spark: SparkSession, path: str, contract: Mapping[str, str] | None = None
) -> DataFrame | None:
    """The table, or None before anything was written to it."""
    try:
        return read_table(spark, path, contract=contract)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def rows_table(spark: SparkSession, rows: Sequence[tuple], contract: Mapping[str, str]) -> DataFrame:
    """A handful of literal rows as a table with declared types."""
    return spark.createDataFrame(list(rows), schemas.ddl(contract))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed page responses, one file each: ``value`` and the file's path."""
    return spark.read.text(path, wholetext=True).selectExpr("value", "_metadata.file_path AS file")


def spread(df: DataFrame) -> DataFrame:
    """A frame of fewer splits than the session has cores, dealt out over all cores.

    For input that arrives in a few unsplittable pieces (one topic partition, one
    row group) ahead of expensive parsing. A frame that is wide enough already,
    as any large one is, passes through without a shuffle. Meant for plain scans:
    asking a frame that already shuffles for its width would run that shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
