"""Classification quality, computed from the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from casemill import schemas


def confusion(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per (label, prediction) pair. Its size is set by the classes, not the data."""
    return df.groupBy(*by, label, prediction).agg(F.count(F.lit(1)).alias("records"))


def metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """accuracy and support-weighted precision, recall and f1_score, as rows.

    One scan builds the confusion counts; the rest works on those. A class that
    is never predicted has precision 0, and f1 0 where both parts are 0. Rows without a
    label or without a prediction are no classes and count nowhere.
    """
    by = list(by)
    known = df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    cells = confusion(known, label, prediction, by)
    # Each cell counts towards the class it holds and the class it was taken for.
    sides = F.inline(
        F.array(
            F.struct(F.col(label).alias("_class"), F.lit(True).alias("_actual")),
            F.struct(F.col(prediction).alias("_class"), F.lit(False).alias("_actual")),
        )
    )
    hit = F.col(label) == F.col(prediction)
    classes = (
        cells.select(*by, "records", hit.alias("_hit"), sides)
        .groupBy(*by, "_class")
        .agg(
            F.sum(F.when(F.col("_actual"), F.col("records")).otherwise(0)).alias("support"),
            F.sum(F.when(~F.col("_actual"), F.col("records")).otherwise(0)).alias("predicted"),
            F.sum(F.when(F.col("_actual") & F.col("_hit"), F.col("records")).otherwise(0)).alias("correct"),
        )
    )

    def ratio(top, bottom):
        return F.when(bottom > 0, top / bottom).otherwise(0.0)

    correct, support, predicted = (F.col(c).cast("double") for c in ("correct", "support", "predicted"))
    precision, recall = ratio(correct, predicted), ratio(correct, support)
    f1 = ratio(2 * precision * recall, precision + recall)
    total = F.sum(support)
    wide = classes.groupBy(*by).agg(
        (F.sum(correct) / total).alias("accuracy"),
        (F.sum(support * precision) / total).alias("precision"),
        (F.sum(support * recall) / total).alias("recall"),
        (F.sum(support * f1) / total).alias("f1_score"),
    )
    names = ["accuracy", "precision", "recall", "f1_score"]
    return wide.unpivot(by, names, "metric_name", "metric_value").filter(
        F.col("metric_value").isNotNull()
    )


def metric_rows(
    predictions: DataFrame,
    split_name: str,
    label: str = "risk_label",
    prediction: str = "prediction",
) -> DataFrame:
    """The metrics table for a predictions frame, per model and version."""
    found = metrics(predictions, label, prediction, by=["model_name", "model_version"])
    return found.withColumn("split_name", F.lit(split_name)).select(*schemas.METRICS)
