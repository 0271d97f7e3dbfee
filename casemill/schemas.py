"""Table contracts, and a projection that makes a frame obey one.

A contract is an ordered ``name -> Spark SQL type`` mapping, so the same object
serves as a reader schema (``ddl``), a cast list (``conform``) and a test
expectation. Names and types are fixed values of the data model.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

# Message body wrapped around every record.
ENVELOPE = {
    "source_api": "string",
    "ingestion_timestamp": "string",
    "batch_number": "int",
    "api_endpoint": "string",
    "raw_data": "string",
}

# The nested report inside raw_data. Leaves stay text; typing happens in clean.
RECORD = {
    "safetyreportid": "string",
    "receivedate": "string",
    "receiptdate": "string",
    "serious": "string",
    "seriousnessdeath": "string",
    "seriousnesshospitalization": "string",
    "patient": (
        "struct<patientsex: string, patientage: string, patientweight: string,"
        " reaction: array<struct<reactionmeddrapt: string, reactionoutcome: string>>,"
        " drug: array<struct<medicinalproduct: string, drugindication: string,"
        " drugcharacterization: string, drugadministrationroute: string>>>"
    ),
}

RAW = {**ENVELOPE, "created_at": "timestamp"}

CLEAN = {
    "report_id": "string",
    "source_api": "string",
    "ingestion_timestamp": "timestamp",
    "batch_number": "int",
    "api_endpoint": "string",
    "receipt_date": "date",
    "patient_age": "double",
    "patient_weight": "double",
    "patient_sex": "string",
    "medicinal_product": "string",
    "reaction": "string",
    "serious": "boolean",
    "seriousness_death": "boolean",
    "seriousness_hospitalization": "boolean",
    "risk_label": "int",
    "raw_record": "string",
    "created_at": "timestamp",
}

BAD = {**ENVELOPE, "error_reason": "string", "created_at": "timestamp"}

PREDICTIONS = {
    "report_id": "string",
    "source_api": "string",
    "receipt_date": "date",
    "patient_sex": "string",
    "medicinal_product": "string",
    "model_name": "string",
    "model_version": "string",
    "risk_label": "int",
    "prediction": "int",
    "prediction_probability": "double",
    "scoring_timestamp": "timestamp",
    "features": "string",
    "created_at": "timestamp",
}

PREDICTIONS_SLIM = {
    name: PREDICTIONS[name]
    for name in ("report_id", "source_api", "risk_label", "prediction", "prediction_probability")
}

METRICS = {
    "model_name": "string",
    "model_version": "string",
    "metric_name": "string",
    "metric_value": "double",
    "split_name": "string",
}

SUMMARY = {
    "summary_date": "date",
    "dimension_type": "string",
    "dimension_value": "string",
    "total_records": "bigint",
    "high_risk_records": "bigint",
    "low_risk_records": "bigint",
    "average_probability": "double",
}

# Of one batch: what a summary is added up from.
SUMMARY_PARTS = {
    "dimension_type": "string",
    "dimension_value": "string",
    "total_records": "bigint",
    "high_risk_records": "bigint",
    "probability_sum": "double",
}

# Of one batch: what distinct counts are united from.
SKETCHES = {"column_name": "string", "sketch": "binary"}

# A value that did not fit the column it was meant for.
REJECTS = {"table_name": "string", "row_id": "string", "column_name": "string", "value": "string", "row": "string"}

# What lies in each zone.
ZONES = {
    "bronze": RAW,
    "silver": CLEAN,
    "quarantine": BAD,
    "predictions": PREDICTIONS,
    "predictions_slim": PREDICTIONS_SLIM,
    "test_predictions": PREDICTIONS,
    "metrics": METRICS,
    "summary": SUMMARY,
    "rejects": REJECTS,
}

# Warehouse tables: the contract each JDBC target expects. Serial ids and the
# load time are left to the database's own defaults.
WAREHOUSE = {
    "cleaned_patients": {k: v for k, v in CLEAN.items() if k != "created_at"},
    "patient_predictions": PREDICTIONS,
    "model_evaluation": METRICS,
    "risk_summary": SUMMARY,
}


def ddl(contract: Mapping[str, str]) -> str:
    """The contract as a DDL schema string for readers and ``from_json``."""
    return ", ".join(f"`{name}` {kind}" for name, kind in contract.items())


def conform(df: DataFrame, contract: Mapping[str, str], *, fill_missing: bool = False) -> DataFrame:
    """Project ``df`` onto a contract: its columns, order and types.

    Text that does not fit the target type becomes null (``try_cast``), so one
    odd value cannot stop a load; ``misfits`` counts them. A missing column is an error unless
    ``fill_missing`` asks for nulls.
    """
    have = dict(df.dtypes)
    missing = [name for name in contract if name not in have]
    if missing and not fill_missing:
        raise ValueError(f"columns missing from frame: {missing}")
    return df.select(
        *(
            (
                F.lit(None).cast(kind)
                if name in missing
                else F.col(f"`{name}`") if have[name] == kind else F.col(f"`{name}`").try_cast(kind)
            ).alias(name)
            for name, kind in contract.items()
        )
    )


def misfits(df: DataFrame, contract: Mapping[str, str]) -> DataFrame:
    """(column_name, misfits): values that ``conform`` would turn to null, in one pass."""
    shared = [name for name in contract if name in df.columns]
    lost = (F.col(f"`{n}`").isNotNull() & F.col(f"`{n}`").try_cast(contract[n]).isNull() for n in shared)
    wide = df.agg(*(F.count_if(test).alias(name) for name, test in zip(shared, lost, strict=True)))
    return wide.unpivot([], shared, "column_name", "misfits")


def sift(df: DataFrame, contract: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """The rows that fit a contract, conformed, and the values that keep the others from it.

    A row is rejected whole if ``conform`` would turn one of its values to null. Each such
    value is a row of the second frame: an id of the rejected row, made from its content,
    the column, the value as text, and the rejected row as JSON. A frame whose types are
    the contract's already cannot lose a value, and is not looked at.
    """
    have = dict(df.dtypes)
    lossy = [n for n in contract if n in have and have[n] != contract[n]]
    row = F.to_json(F.struct(*(F.col(f"`{n}`") for n in contract if n in have)), {"ignoreNullFields": "false"})
    lost = {n: F.col(f"`{n}`").isNotNull() & F.col(f"`{n}`").try_cast(contract[n]).isNull() for n in lossy}
    shown = [
        F.when(test, F.struct(F.lit(n).alias("column_name"), F.col(f"`{n}`").cast("string").alias("value")))
        for n, test in lost.items()
    ]
    if not lossy:
        none = df.limit(0).select(F.lit("").alias("row_id"), F.lit("").alias("column_name"), F.lit("").alias("value"))
        return conform(df, contract), none.withColumn("row", F.lit(""))
    bad = F.expr("false")
    for test in lost.values():
        bad = bad | test
    rejected = (
        df.where(bad)
        .select(row.alias("row"), F.array_compact(F.array(*shown)).alias("_lost"))
        .select(F.md5("row").alias("row_id"), F.explode("_lost").alias("_one"), "row")
        .select("row_id", "_one.column_name", "_one.value", "row")
    )
    return conform(df.where(~bad), contract), rejected
