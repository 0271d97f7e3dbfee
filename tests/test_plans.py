"""Plans, not results: what is scanned, shuffled and run outside the JVM."""

import re

import pytest
from pyspark.sql import functions as F

from casemill.operators import clean, dedup, reports, summary
from casemill.plans.catalog import QUERIES
from casemill.plans.samples import scored_events, table

from cases import NOW, SF_DIR, messages


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_long_summary_scans_once_and_reads_what_it_needs(spark, tmp_path):
    path = str(tmp_path / "scored")
    scored_events(spark, SF_DIR).write.parquet(path)
    scored = spark.read.parquet(path)
    one = physical(summary.long_summary(scored, ["event_type", "user_id"], "2024-01-01"))
    many = physical(summary.union_summary(scored, ["event_type", "user_id"], "2024-01-01"))
    assert one.count("FileScan") == 1
    assert many.count("FileScan") == 3
    (read,) = re.findall(r"ReadSchema: struct<([^>]*)>", one)
    assert {f.split(":")[0] for f in read.split(",")} == {
        "event_type", "user_id", "risk_label", "prediction_probability",
    }


def test_dedup_limits_every_key_before_the_shuffle(spark):
    plan = physical(clean.clean(messages(spark), now=NOW).clean)
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")


def shuffled_rows(df):
    """Rows written to each shuffle of an executed frame."""
    leaves = df._jdf.queryExecution().executedPlan().finalPhysicalPlan().collectLeaves()
    stages = [leaves.apply(i) for i in range(leaves.size())]
    return [s.plan().metrics().apply("shuffleRecordsWritten").value() for s in stages if "Shuffle" in s.nodeName()]


def test_hot_key_sends_one_row_per_task(spark):
    """A key holding nearly all rows reaches its reducer as one row per map task."""
    key = F.when(F.col("id") % 1000 > 0, "hot").otherwise(F.col("id").cast("string"))
    rows = spark.range(20_000, numPartitions=8).select(key.alias("k"), "id")
    kept = dedup.keep_one(rows, ["k"], [F.desc("id")])
    assert {r.k: r.id for r in kept.collect()}["hot"] == 19_999
    assert shuffled_rows(kept) == [8 + 20]


def test_hot_group_is_summed_before_the_shuffle(spark):
    rows = spark.range(20_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), (F.col("id") % 5).cast("string"))).alias("a"),
        F.lit(1).alias("risk_label"),
        F.rand(1).alias("prediction_probability"),
    )
    long = summary.long_summary(rows, ["a"], "2024-01-01")
    assert len(long.collect()) == 7
    assert shuffled_rows(long) == [8 * 7]


def test_filters_reach_the_scan(spark):
    plan = physical(table(spark, SF_DIR, "events").filter("event_type = 'error'").select("event_id"))
    assert "EqualTo(event_type,error)" in plan


def test_top_k_does_not_sort_everything(spark):
    lines = table(spark, SF_DIR, "lineitem")
    plan = physical(reports.top_k(lines, "l_partkey", F.sum("l_quantity"), 5))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_known_keys_are_looked_up_without_shuffling_the_store(spark):
    batch = spark.range(10).select(F.col("id").cast("string").alias("k"))
    stored = spark.range(100_000, numPartitions=8).select(F.col("id").cast("string").alias("k"))
    frame = dedup.new_keys_only(batch, stored, "k")
    plan = physical(frame)
    semi = plan.index("BroadcastHashJoin [k", plan.index("LeftAnti") if "LeftAnti" in plan else 0)
    assert "LeftSemi" in plan[semi:]
    assert frame.isEmpty()


SLOW = ("stream_", "run_", "model_", "sink_", "partition_", "quarantine_sink", "snapshot_", "csv_", "read_many")


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(SLOW)))
def test_nothing_leaves_the_jvm_and_nothing_is_crossed(spark, name):
    plan = physical(QUERIES[name](spark, SF_DIR))
    for banned in ("Python", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert banned not in plan, banned
