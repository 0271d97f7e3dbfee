"""A dictionary of a column's values by frequency, made and used without passing the driver.

Index 0 is the most frequent value, ties go by value, as ``StringIndexer`` has them. The
values are ranked in ranges: each range counts its own, and the ranges' sizes, one number
each, are summed up to where a range begins. As the index tells how frequent a value is,
looking it up needs no guess at hot keys: the first values go to every task, and the rows
of all others meet the rest of the dictionary in a shuffle that none of them dominates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from casemill.layout import scratch_folder

HOT = 4096  # values that go to every task


def frequency_index(rows: DataFrame, column: str, folder: str | None = None) -> DataFrame:
    """(value, index) of the values of a column that are not null, stored in ``folder``."""
    spark = rows.sparkSession
    folder = folder or scratch_folder(spark, "dictionary")
    counts = rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    # Stored, because a range drawn a second time may begin elsewhere.
    order = [F.desc("n"), F.asc("value")]
    counts.repartitionByRange(*order).withColumn("part", F.spark_partition_id()).write.parquet(f"{folder}/ranges")
    ranges = spark.read.schema("value string, n bigint, part int").parquet(f"{folder}/ranges")
    sizes = ranges.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1
    indexed = ranges.withColumn("place", place).join(F.broadcast(starts), "part")
    indexed.select("value", (F.col("start") + F.col("place")).alias("index")).write.parquet(f"{folder}/index")
    return spark.read.schema("value string, index bigint").parquet(f"{folder}/index")


def with_index(rows: DataFrame, column: str, dictionary: DataFrame, output: str, hot: int = HOT) -> DataFrame:
    """``rows`` with the index of a column's value; null and unknown values share the one behind the last."""
    names = rows.columns
    unknown = dictionary.count()

    def found(part: DataFrame, values: DataFrame) -> DataFrame:
        known = values.select(F.col("value").alias("_value"), F.col("index").alias("_index"))
        return part.join(known, F.col(f"`{column}`") == F.col("_value"), "left").drop("_value")

    first = found(rows, F.broadcast(dictionary.where(F.col("index") < hot)))
    if unknown > hot:
        rest = found(
            first.where(F.col("_index").isNull() & F.col(f"`{column}`").isNotNull()).drop("_index"),
            dictionary.where(F.col("index") >= hot),
        )
        first = first.where(F.col("_index").isNotNull() | F.col(f"`{column}`").isNull()).unionByName(rest)
    index: Column = F.coalesce("_index", F.lit(unknown)).cast("double")
    return first.select(*(F.col(f"`{n}`") for n in names), index.alias(output))
