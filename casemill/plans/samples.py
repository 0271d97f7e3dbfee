"""Frames the catalogue derives from the sample tables.

``events`` stands in for a feed of reports. Spark turns every event into a nested
report, wraps it in an envelope and damages some texts, depending on the event's
own type and ``k`` property, so that all routes are taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from casemill import schemas
from casemill.functions import values
from casemill.operators import score
from casemill.sources import spread

SOURCE = "events feed"
NOW = "2024-06-01T00:00:00+00:00"
AS_OF = "2024-06-01"
VERSION = "20240601000000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _kind(*names: str) -> Column:
    return F.col("event_type").isin(*names)


def iso_text(moment: str) -> Column:
    """A zoneless timestamp column written out as UTC."""
    return F.concat(F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def reports(events: DataFrame) -> DataFrame:
    """One nested report per event, as JSON text, some of it damaged."""
    k, day = F.col("k"), F.date_format("ts", "yyyyMMdd")
    name = F.concat(F.lit(" Product "), F.col("user_id").cast("string"), F.lit(" "))
    drugs = F.array(
        F.struct(name.alias("medicinalproduct")), F.struct(F.lit("Other").alias("medicinalproduct"))
    )
    amount = F.col("value").cast("string")
    patient = F.struct(
        F.when(k < 45, "2").when(k < 80, "1").when(k < 90, "0").alias("patientsex"),
        F.when(_kind("click") & (k < 10), F.concat(F.lit("-"), amount))
        .when(_kind("click") & (k < 20), "n/a")
        .otherwise(amount)
        .alias("patientage"),
        F.when(~_kind("signup"), (k + 40).cast("string")).alias("patientweight"),
        F.array(F.struct(F.upper("event_type").alias("reactionmeddrapt"))).alias("reaction"),
        F.when(_kind("view") & (k > 90), F.filter(drugs, lambda _: F.lit(False))).otherwise(drugs).alias("drug"),
    )
    report = F.to_json(
        F.struct(
            F.when(
                ~(_kind("signup") & (k < 20)),
                F.concat(F.lit("r-"), F.col("user_id").cast("string"), F.lit("-"), k.cast("string")),
            ).alias("safetyreportid"),
            day.alias("receivedate"),
            F.when(_kind("click") & (k >= 90), F.date_format("ts", "yyyy-MM-dd"))
            .when(~_kind("view"), day)
            .alias("receiptdate"),
            F.when(F.col("value") > 60, "1").otherwise("2").alias("serious"),
            F.when(_kind("error") & (F.col("value") > 30), "YES").alias("seriousnessdeath"),
            F.when(_kind("purchase") & (k < 50), True).alias("seriousnesshospitalization"),
            patient.alias("patient"),
        )
    )
    damaged = (
        F.when(_kind("error") & (k == 99), F.substring(report, 1, 20))
        .when(_kind("error") & (k == 98), "not json")
        .when(_kind("error") & (k == 97), "")
        .when(_kind("error") & (k == 96), F.lit(None))
        .when(_kind("error") & (k == 95), '{"safetyreportid":"x","patient":"oops"}')
        .otherwise(report)
    )
    keyed = events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    return keyed.select("event_id", "event_type", "ts", "k", damaged.alias("record"))


def wrapped_reports(
    spark: SparkSession, sf_dir: str, batch_shift: int = 0, where: Column | str | None = None
) -> DataFrame:
    """Envelope columns and message key, one row per event.

    ``batch_shift`` re-sends the same reports as a later cycle would; ``where`` says of
    which events, by event_id, event_type, ts, k and record.
    """
    batch = F.dayofmonth("ts") + batch_shift
    given = F.get_json_object("record", "$.safetyreportid")
    # The sample is one row group; real feeds arrive in many splits.
    sent = reports(spread(table(spark, sf_dir, "events")))
    return (sent if where is None else sent.where(where)).select(
        "event_type",
        "k",
        values.message_key(given, batch, F.col("event_id") + 1).alias("key"),
        F.lit(SOURCE).alias("source_api"),
        iso_text("ts").alias("ingestion_timestamp"),
        batch.alias("batch_number"),
        F.concat(F.lit("feed/"), "event_type").alias("api_endpoint"),
        F.col("record").alias("raw_data"),
    )


def messages(
    spark: SparkSession, sf_dir: str, batch_shift: int = 0, where: Column | str | None = None
) -> DataFrame:
    """Message texts; some envelopes are damaged too."""
    body = F.to_json(F.struct(*schemas.ENVELOPE))
    text = F.when(_kind("view") & (F.col("k") == 0), "garbage").otherwise(body)
    return wrapped_reports(spark, sf_dir, batch_shift, where).select(text.alias("value"))


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a risk label and the rule's probability."""
    label = values.any_flag(F.col("value") > 20, values.truthy(F.col("event_type"), ("error", "purchase")))
    labelled = table(spark, sf_dir, "events").withColumn("risk_label", label)
    return labelled.withColumn("prediction_probability", score.rule_probability(F.col("risk_label")))
