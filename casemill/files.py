"""What a job asks of the file system, through Spark's own Hadoop client."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def children(spark: SparkSession, path: str, before: float | None = None) -> list[str]:
    """What lies directly in a folder, without hidden names; ``before``: last changed before that time."""
    system, place = _at(spark, path)
    if not system.exists(place):
        return []
    found = [f for f in system.listStatus(place) if f.getPath().getName()[0] not in "._"]
    return [f.getPath().toString() for f in found if before is None or f.getModificationTime() < 1000 * before]


def delete(spark: SparkSession, path: str) -> bool:
    """Remove a file or a folder; False if there was none."""
    system, place = _at(spark, path)
    return system.delete(place, True)


def sizes(spark: SparkSession, *paths: str) -> list[tuple[str, int]]:
    """Every Parquet file below some folders with its bytes; a large listing runs as a Spark job."""
    if not paths:
        return []
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return [(row.path, row.length) for row in reader.load(list(paths)).select("path", "length").collect()]
