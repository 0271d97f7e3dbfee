import os

import pytest
from pyspark.sql import functions as F

from casemill import JdbcSpec, StreamSpec, Zones, schemas, sinks
from casemill.layout import scratch_folder
from casemill.sources import kafka_options, read_if_present, read_table, rows_table, spread

JDBC = JdbcSpec(url="jdbc:postgresql://db/w", user="u", password="p")


def numbered(spark, n, parts=4):
    return spark.range(n, numPartitions=parts).select("id", (F.col("id") % 3).cast("int").alias("batch_number"))


def test_append_partitioned(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        sinks.append_partitioned(numbered(spark, 10), path)
    back = read_table(spark, path)
    assert back.count() == 20
    assert back.dtypes[-1] == ("batch_number", "int")
    assert sorted(d for d in os.listdir(path) if "=" in d) == [f"batch_number={i}" for i in range(3)]


def test_gathered_write_makes_few_files(spark, tmp_path):
    frame = numbered(spark, 3000, parts=40)
    frame.write.partitionBy("batch_number").parquet(str(tmp_path / "plain"))
    sinks.append_partitioned(frame, str(tmp_path / "gathered"))
    files = lambda name: len(list((tmp_path / name).glob("*/*.parquet")))
    assert files("plain") == 120
    assert files("gathered") <= 12


def test_hot_partition_value_is_split_over_tasks(spark, tmp_path):
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256KB")
    try:
        rows = spark.range(400_000, numPartitions=16).select(
            F.xxhash64("id").alias("x"), F.when(F.col("id") < 10, 1).otherwise(0).alias("batch_number")
        )
        sinks.append_partitioned(rows, str(tmp_path / "t"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    hot = list((tmp_path / "t" / "batch_number=0").glob("*.parquet"))
    assert len(hot) > 4
    assert max(f.stat().st_size for f in hot) < 4 * sum(f.stat().st_size for f in hot) / len(hot)


def test_append_if_nonempty(spark, tmp_path):
    path = str(tmp_path / "q")
    assert not sinks.append_if_nonempty(numbered(spark, 0), path)
    assert read_if_present(spark, path) is None
    assert sinks.append_if_nonempty(numbered(spark, 2), path)
    assert not sinks.append_if_nonempty(numbered(spark, 0), path)
    assert read_if_present(spark, path).count() == 2
    assert os.listdir(tmp_path) == ["q"]


def test_a_probe_runs_the_frame_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = numbered(spark, 50).mapInArrow(counted, "id long, batch_number int")
    assert sinks.append_if_nonempty(rows, str(tmp_path / "q"))
    assert seen.value == 50


def test_snapshot_replaces_everything(spark, tmp_path):
    path = str(tmp_path / "s")
    sinks.overwrite_snapshot(numbered(spark, 9), path)
    sinks.overwrite_snapshot(numbered(spark, 2), path)
    assert read_table(spark, path).count() == 2


def test_only_touched_partitions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "p")
    sinks.overwrite_partitions(numbered(spark, 9), path, "batch_number")
    sinks.overwrite_partitions(numbered(spark, 1), path, "batch_number")
    got = {r.batch_number: r["count"] for r in read_table(spark, path).groupBy("batch_number").count().collect()}
    assert got == {0: 1, 1: 3, 2: 3}


def test_overwritten_partitions_have_few_files(spark, tmp_path):
    path = str(tmp_path / "days")
    rows = spark.range(8_000, numPartitions=16).select("id", (F.col("id") % 10).alias("day"))
    sinks.overwrite_partitions(rows, path, "day")
    files = [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    assert read_table(spark, path).count() == 8_000
    assert len(files) == 10


def test_csv(spark, tmp_path):
    path = str(tmp_path / "csv")
    sinks.export_csv(rows_table(spark, [("m", "v", "f1", 0.5, "test")], schemas.METRICS), path)
    back = spark.read.option("header", True).schema(schemas.ddl(schemas.METRICS)).csv(path)
    assert [tuple(r) for r in back.collect()] == [("m", "v", "f1", 0.5, "test")]


def test_jdbc_options():
    options = sinks.jdbc_options(JDBC, "risk_summary", {"truncate": "true"})
    assert options["dbtable"] == "risk_summary"
    assert (options["url"], options["user"], options["password"]) == (JDBC.url, "u", "p")
    assert options["driver"] == "org.postgresql.Driver"
    assert options["truncate"] == "true"
    assert int(options["numPartitions"]) == JDBC.max_connections


def test_jdbc_needs_a_password():
    with pytest.raises(TypeError):
        JdbcSpec(url="jdbc:x", user="u")


def test_warehouse_contracts():
    assert set(schemas.WAREHOUSE) == {"cleaned_patients", "patient_predictions", "model_evaluation", "risk_summary"}
    assert "created_at" not in schemas.WAREHOUSE["cleaned_patients"]
    assert len(schemas.WAREHOUSE["cleaned_patients"]) == 16


def test_kafka_options():
    spec = StreamSpec(servers="h:9092", topic="t", max_per_trigger=500, options={"minPartitions": "64"})
    assert kafka_options(spec) == {
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "t",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "500",
        "minPartitions": "64",
    }
    with pytest.raises(ValueError):
        kafka_options(StreamSpec(servers="h:9092"))
    out = sinks.kafka_options("h:9092", "t", {"kafka.client.id": "c"})
    assert (out["kafka.acks"], out["kafka.compression.type"], out["kafka.linger.ms"]) == ("all", "gzip", "50")
    assert out["topic"] == "t" and out["kafka.client.id"] == "c"


def test_many_paths(spark, tmp_path):
    paths = [str(tmp_path / n) for n in "ab"]
    for path in paths:
        sinks.overwrite_snapshot(numbered(spark, 3), path)
    assert read_table(spark, None, paths[0], "", paths[1]).count() == 6
    with pytest.raises(ValueError):
        read_table(spark, None, "")


def test_spread(spark):
    cores = spark.sparkContext.defaultParallelism
    narrow, wide = spark.range(100, numPartitions=1), spark.range(100, numPartitions=cores + 1)
    assert spread(narrow).rdd.getNumPartitions() == cores
    assert spread(wide) is wide


def test_scratch_folder_follows_the_session(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_folder(spark, "x"), scratch_folder(spark, "x")
    assert one.startswith(shared) and one != two


def test_zones():
    zones = Zones("hdfs://n/lake/")
    assert zones.silver == "hdfs://n/lake/processed/cleaned_parquet"
    assert zones.quarantine == "hdfs://n/lake/processed/bad_records"
    assert zones.summary == "hdfs://n/lake/reporting/risk_summary"
