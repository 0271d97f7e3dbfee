"""Dictionaries of many values, and counts from sketches."""

import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from casemill.operators import dictionary, profile


def as_rows(frame, *columns):
    return sorted(map(str, frame.select(*columns).collect()))


@pytest.mark.parametrize("hot", [0, 5, 4096])
def test_indexes_are_those_of_the_indexer(spark, hot):
    """Ties, a value that a third of the rows share, nulls, values not learned, a clashing column."""
    value = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 > 0, F.concat(F.lit("v"), (F.col("id") % 97).cast("string")))
    rows = spark.range(3000).select("id", value.alias("a.b"), F.lit("x").alias("value"), F.lit(1).alias("n"))
    learned = rows.where("id < 2000 AND id % 97 <> 5").withColumnRenamed("a.b", "c")
    asked = rows.withColumnRenamed("a.b", "c")
    want = StringIndexer(inputCol="c", outputCol="index", handleInvalid="keep").fit(learned).transform(asked)
    index = dictionary.frequency_index(learned, "c")
    got = dictionary.with_index(asked, "c", index, "index", hot=hot)
    assert got.columns == ["id", "c", "value", "n", "index"]
    assert as_rows(got, "id", "index") == as_rows(want, "id", "index")


def test_a_million_values(spark):
    """Every value its own place, dealt over ranges; the driver gets none of them."""
    rows = spark.range(1_200_000, numPartitions=16).select(F.concat(F.lit("k"), (F.col("id") % 1_000_000).cast("string")).alias("v"))
    index = dictionary.frequency_index(rows, "v")
    told = index.agg(F.count("*"), F.count_distinct("index"), F.min("index"), F.max("index")).first()
    assert tuple(told) == (1_000_000, 1_000_000, 0, 999_999)
    # The 200,000 values that occur twice come first.
    twice = index.where(F.substring("value", 2, 9).cast("int") < 200_000).agg(F.max("index")).first()[0]
    assert twice == 199_999
    plan = dictionary.with_index(rows, "v", index, "i", hot=100)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_empty_dictionary(spark):
    rows = spark.createDataFrame([(1, None)], "id int, v string")
    index = dictionary.frequency_index(rows, "v")
    assert index.count() == 0
    assert [tuple(r) for r in dictionary.with_index(rows, "v", index, "i").collect()] == [(1, None, 0.0)]


def test_sketches_of_parts_unite(spark):
    rows = spark.range(60_000).select((F.col("id") % 7).alias("part"), (F.col("id") % 20_000).alias("many"), (F.col("id") % 3).alias("few"))
    made = profile.sketches(rows, ["many", "few"], ["part"])
    assert made.count() == 14
    told = {r.column_name: r.estimate for r in profile.distinct_estimates(made).collect()}
    assert abs(told["many"] - 20_000) <= profile.SKETCH_ERROR * 20_000 and told["few"] == 3
    none = profile.sketches(rows.limit(0), ["few"], ["part"])
    assert profile.distinct_estimates(none).collect() == []
