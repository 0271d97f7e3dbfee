"""Analyst reports over predictions, metrics and batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from casemill.operators.summary import measures


def distribution(predictions: DataFrame, label: str = "risk_label") -> DataFrame:
    """Rows per label and their share of the total."""
    counts = predictions.groupBy(label).agg(F.count(F.lit(1)).alias("records"))
    # The window sees one row per label, not the data.
    total = F.sum("records").over(Window.partitionBy())
    return counts.withColumn("share", F.col("records") / total)


def rates(predictions: DataFrame, dimension: str, label: str = "risk_label", **columns: str) -> DataFrame:
    """Summary measures per value of a dimension, with the high-risk rate."""
    return predictions.groupBy(dimension).agg(
        *measures(label, **columns), F.avg(label).alias("high_risk_rate")
    )


def top_k(
    df: DataFrame, dimension: str, measure: Column, k: int = 20, name: str = "high_risk_records"
) -> DataFrame:
    """The k groups with the largest aggregate; ties go to the smaller key."""
    grouped = df.groupBy(dimension).agg(measure.alias(name))
    return grouped.orderBy(F.desc_nulls_last(name), F.asc(dimension)).limit(k)


def extremes(
    predictions: DataFrame,
    dimension: str,
    k: int = 5,
    min_records: int = 1,
    label: str = "risk_label",
    **columns: str,
) -> DataFrame:
    """The k highest and k lowest groups by high-risk rate.

    Groups with fewer than ``min_records`` rows are left out, as a rate over a
    handful of rows says little. Both ends read one shared aggregate.
    """
    eligible = rates(predictions, dimension, label, **columns).filter(F.col("total_records") >= min_records)
    ends = [
        eligible.orderBy(order, F.asc(dimension)).limit(k).withColumn("side", F.lit(side))
        for side, order in (("highest", F.desc("high_risk_rate")), ("lowest", F.asc("high_risk_rate")))
    ]
    return ends[0].unionByName(ends[1])


def over_time(
    predictions: DataFrame,
    moment: str = "receipt_date",
    unit: str = "month",
    label: str = "risk_label",
    **columns: str,
) -> DataFrame:
    """Summary measures per period; rows without a date form their own group."""
    period = F.date_trunc(unit, F.col(moment)).cast("date")
    return predictions.groupBy(period.alias("period")).agg(*measures(label, **columns))


def batch_volume(rows: DataFrame, batch: str = "batch_number") -> DataFrame:
    """Rows per ingest batch."""
    return rows.groupBy(batch).agg(F.count(F.lit(1)).alias("records"))


def latest_metrics(metrics: DataFrame, version: str = "model_version") -> DataFrame:
    """Every model's metrics as of its newest version."""
    keys = ["model_name", "metric_name", "split_name"]
    return metrics.groupBy(*keys).agg(
        F.max(version).alias(version), F.max_by("metric_value", version).alias("metric_value")
    )
