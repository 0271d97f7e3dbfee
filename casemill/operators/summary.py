"""Risk summaries over any set of dimensions."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from casemill import schemas

# Fixed values of the summary's first row.
OVERALL = ("overall", "all_records")
DIMENSIONS = ("patient_sex", "medicinal_product")


def measures(label: str = "risk_label", probability: str = "prediction_probability") -> list[Column]:
    """Counts and mean probability of a group. All of them combine map-side."""
    total, high = F.count(F.lit(1)), F.sum(label)
    return [
        total.alias("total_records"),
        high.alias("high_risk_records"),
        (total - high).alias("low_risk_records"),
        F.avg(probability).alias("average_probability"),
    ]


def _as_date(as_of: datetime.date | str | None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of).cast("date")


def summary(
    predictions: DataFrame,
    dimension: str | None = None,
    as_of: datetime.date | str | None = None,
    **columns: str,
) -> DataFrame:
    """The summary over everything, or by one dimension.

    Grouping by the date, which is constant, gives no row for an empty input.
    """
    dated = predictions.withColumn("summary_date", _as_date(as_of))
    keys = ["summary_date"] + ([dimension] if dimension else [])
    grouped = dated.groupBy(*keys).agg(*measures(**columns))
    kind, value = (dimension, F.col(dimension).cast("string")) if dimension else (OVERALL[0], F.lit(OVERALL[1]))
    return grouped.withColumns({"dimension_type": F.lit(kind), "dimension_value": value}).select(
        *schemas.SUMMARY
    )


def long_summary(
    predictions: DataFrame,
    dimensions: Sequence[str] = DIMENSIONS,
    as_of: datetime.date | str | None = None,
    **columns: str,
) -> DataFrame:
    """The overall summary and one per dimension, in long form, from one scan.

    Grouping sets aggregate all of them together: the input is read once and
    each task sends one row per group it met. Whether a row belongs to a
    dimension is told by ``grouping``, so a null dimension value keeps its type.
    """
    if not dimensions:
        return summary(predictions, None, as_of, **columns)
    grouped = predictions.groupingSets([[], *([d] for d in dimensions)], *dimensions).agg(
        *measures(**columns), *(F.grouping(d).alias(f"_not_{i}") for i, d in enumerate(dimensions))
    )
    kind, value = F.lit(OVERALL[0]), F.lit(OVERALL[1])
    for i, d in enumerate(dimensions):
        mine = F.col(f"_not_{i}") == 0
        kind = F.when(mine, d).otherwise(kind)
        value = F.when(mine, F.col(d).cast("string")).otherwise(value)
    return grouped.select(
        _as_date(as_of).alias("summary_date"),
        kind.alias("dimension_type"),
        value.alias("dimension_value"),
        *list(schemas.SUMMARY)[3:],
    )


def parts(
    scored: DataFrame,
    dimensions: Sequence[str] = DIMENSIONS,
    keys: Sequence[str] = (),
    label: str = "risk_label",
    probability: str = "prediction_probability",
) -> DataFrame:
    """Sums per dimension value, and per value of ``keys``, that add up to any summary.

    One scan, as in ``long_summary``; the keys stand in front of the summed columns.
    """
    sets = [[*keys, *([d] if d else [])] for d in (None, *dimensions)]
    grouped = scored.groupingSets(sets, *keys, *dimensions).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.sum(label).alias("high_risk_records"),
        F.sum(probability).alias("probability_sum"),
        *(F.grouping(d).alias(f"_not_{i}") for i, d in enumerate(dimensions)),
    )
    kind, value = F.lit(OVERALL[0]), F.lit(OVERALL[1])
    for i, d in enumerate(dimensions):
        mine = F.col(f"_not_{i}") == 0
        kind, value = F.when(mine, d).otherwise(kind), F.when(mine, F.col(d).cast("string")).otherwise(value)
    named = {"dimension_type": kind, "dimension_value": value}
    return grouped.select(*keys, *(named.get(c, F.col(c)).alias(c) for c in schemas.SUMMARY_PARTS))


def from_parts(sums: DataFrame, as_of: datetime.date | str | None = None) -> DataFrame:
    """The summary that sums of any number of batches add up to."""
    total, high = F.sum("total_records"), F.sum("high_risk_records")
    return (
        sums.groupBy("dimension_type", "dimension_value")
        .agg(
            total.alias("total_records"),
            high.alias("high_risk_records"),
            (total - high).alias("low_risk_records"),
            (F.sum("probability_sum") / total).alias("average_probability"),
        )
        .withColumn("summary_date", _as_date(as_of))
        .select(*schemas.SUMMARY)
    )


def union_summary(
    predictions: DataFrame,
    dimensions: Sequence[str] = DIMENSIONS,
    as_of: datetime.date | str | None = None,
    **columns: str,
) -> DataFrame:
    """The same rows as ``long_summary`` by union: one scan per dimension.

    Kept for frames whose dimensions live in different sources, and as the
    yardstick ``bench.py`` measures ``long_summary`` against.
    """
    result = summary(predictions, None, as_of, **columns)
    for dimension in dimensions:
        result = result.unionByName(summary(predictions, dimension, as_of, **columns))
    return result
