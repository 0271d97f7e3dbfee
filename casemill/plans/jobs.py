"""Batch jobs: score the silver zone, report on the scores, train models."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from casemill import commits, schemas, sinks
from casemill.layout import Zones
from casemill.operators import evaluate, model, profile, score, summary
from casemill.spec import CleanSpec, JdbcSpec, RuleSpec, StreamSpec
from casemill.streaming.clean_stream import compact_zones, run_clean_stream


def new_version() -> str:
    """A version stamp for a run starting now, in UTC."""
    return f"{datetime.datetime.now(datetime.timezone.utc):%Y%m%d%H%M%S}"


def read_silver(spark: SparkSession, zones: Zones) -> DataFrame:
    return commits.read(spark, zones, "silver")


def run_score(
    spark: SparkSession,
    zones: Zones,
    rule: RuleSpec = RuleSpec(),
    *,
    version: str | None = None,
    now=None,
    jdbc: JdbcSpec | None = None,
) -> str:
    """Score silver with the rule; gives the run's version.

    Silver is scored once; every further output reads the staged predictions. All outputs
    count from one moment on, and a version scored again replaces its metrics. The warehouse
    tables are loaded with what the lake holds, and so replaced; rows with a value that
    does not fit its column are not loaded but go to the rejects.
    """
    version, attempt = version or new_version(), commits.new_attempt()
    silver = read_silver(spark, zones)
    staged = [commits.stage(score.score(silver, version, rule, now), zones, "predictions", attempt)]
    predictions = commits.read_staged(spark, zones, staged[0], schemas.PREDICTIONS)
    staged.append(commits.stage(score.slim(predictions), zones, "predictions_slim", attempt))
    metrics = evaluate.metric_rows(predictions, rule.split_name, rule.label).coalesce(1)
    staged.append(commits.stage(metrics, zones, "metrics", attempt, f"{version}/{rule.split_name}"))
    commits.commit(spark, zones, staged)
    if jdbc:
        load_warehouse(
            zones,
            jdbc,
            {
                "cleaned_patients": score.base_frame(silver, rule),
                "patient_predictions": predictions,
                "model_evaluation": commits.read(spark, zones, "metrics"),
            },
        )
    return version


def load_warehouse(zones: Zones, jdbc: JdbcSpec, tables: Mapping[str, DataFrame]) -> None:
    """Replace warehouse tables; rows that do not fit go to the rejects zone, by table."""
    spark = next(iter(tables.values())).sparkSession
    attempt, staged = commits.new_attempt(), []
    for table, rows in tables.items():
        fitting, rejected = schemas.sift(rows, schemas.WAREHOUSE[table])
        sinks.jdbc_write(fitting, jdbc, table, "overwrite")
        told = rejected.withColumn("table_name", F.lit(table)).select(*schemas.REJECTS)
        staged.append(commits.stage_if_any(told, zones, "rejects", f"{attempt}-{table}", table, 0))
    commits.commit(spark, zones, staged)


def run_report(
    spark: SparkSession,
    zones: Zones,
    *,
    dimensions: tuple[str, ...] = summary.DIMENSIONS,
    as_of: datetime.date | str | None = None,
    jdbc: JdbcSpec | None = None,
) -> DataFrame:
    """Summarise the stored predictions; gives the day's summary.

    Each day's summary has its own slot, so earlier days stay.
    """
    as_of = str(as_of or datetime.datetime.now(datetime.timezone.utc).date())
    rows = summary.long_summary(commits.read(spark, zones, "predictions"), dimensions, as_of)
    return _store_summary(spark, zones, rows, as_of, jdbc)


def _store_summary(spark: SparkSession, zones: Zones, rows: DataFrame, as_of: str, jdbc: JdbcSpec | None) -> DataFrame:
    staged = commits.stage(rows.coalesce(1), zones, "summary", commits.new_attempt(), as_of)
    commits.commit(spark, zones, [staged])
    if jdbc:
        load_warehouse(zones, jdbc, {"risk_summary": commits.read(spark, zones, "summary")})
    return commits.read_staged(spark, zones, staged, schemas.SUMMARY)


def run_incremental_report(
    spark: SparkSession,
    zones: Zones,
    rule: RuleSpec = RuleSpec(),
    *,
    dimensions: tuple[str, ...] = summary.DIMENSIONS,
    as_of: datetime.date | str | None = None,
    jdbc: JdbcSpec | None = None,
) -> DataFrame:
    """The day's summary of silver under the rule, reading only batches not summed before.

    A batch's sums fill its slot in a zone of their own. When the batch is written again,
    its slot is summed anew, and the old sums no longer count.
    """
    as_of = str(as_of or datetime.datetime.now(datetime.timezone.utc).date())
    refresh_sums(spark, zones, rule, dimensions)
    sums = commits.read_zone(spark, zones, "summary_parts", schemas.SUMMARY_PARTS)
    if sums is None:
        raise LookupError("there is no committed batch to sum")
    return _store_summary(spark, zones, summary.from_parts(sums, as_of), as_of, jdbc)


def _refresh(spark: SparkSession, zones: Zones, zone: str, derive: Callable[[DataFrame], DataFrame]) -> int:
    """Fill the slots that silver has and ``zone`` has not, or as they were; gives how many."""
    log = commits.read_log(spark, zones)
    slots = commits.missing(log, zone, "silver")
    if slots:
        fresh = commits.read_zone(spark, zones, "silver", schemas.CLEAN, slots=True, log=log, only=slots)
        if fresh is not None:
            commits.adopt(derive(fresh), zones, zone, slots)
    return len(slots)


def refresh_sums(
    spark: SparkSession, zones: Zones, rule: RuleSpec = RuleSpec(), dimensions: tuple[str, ...] = summary.DIMENSIONS
) -> int:
    """Sum up the batches of silver that have no sums yet, or have changed; gives how many."""

    def derive(rows: DataFrame) -> DataFrame:
        probability = score.rule_probability(F.col(rule.label), rule)
        scored = score.base_frame(rows, rule).withColumn("prediction_probability", probability)
        return summary.parts(scored, dimensions, tuple(commits.SLOT))

    return _refresh(spark, zones, "summary_parts", derive)


def distinct_counts(
    spark: SparkSession, zones: Zones, columns: tuple[str, ...] = ("report_id", *summary.DIMENSIONS)
) -> DataFrame:
    """(column_name, estimate) over silver, sketching only batches not sketched before.

    Estimates are within ``profile.SKETCH_ERROR`` of the exact count, whatever the number
    of batches, and small counts are exact. A batch written again is sketched anew.
    """
    _refresh(spark, zones, "sketches", lambda rows: profile.sketches(rows, columns, tuple(commits.SLOT)))
    held = commits.read_zone(spark, zones, "sketches", schemas.SKETCHES)
    if held is None:
        raise LookupError("there is no committed batch to sketch")
    return profile.distinct_estimates(held)


def run_training(
    spark: SparkSession,
    zones: Zones,
    spec: model.ModelSpec = model.ModelSpec(),
    *,
    version: str | None = None,
    grids=None,
    now=None,
) -> str:
    """Train on silver, keep the best model and its predictions; gives its name.

    Model, metrics and predictions, and the slim copy that goes with them, count from one
    moment on.
    """
    version, attempt = version or new_version(), commits.new_attempt()
    silver = read_silver(spark, zones)
    train, test = model.split(silver, spec)
    models = model.train(train, spec, grids)
    metrics = model.evaluate_all(models, test, version, spec).coalesce(1)
    staged = [commits.stage(metrics, zones, "metrics", attempt, f"{version}/trained")]
    best = model.select_best(commits.read_staged(spark, zones, staged[0], schemas.METRICS))
    model.save(models[best], f"{zones.best_model}/attempt={attempt}")
    staged.append(commits.Entry("best_model", *commits.SNAPSHOT, attempt))
    for rows, zone in ((test, "test_predictions"), (silver, "predictions")):
        found = model.predict(models[best], rows, best, version, spec, now)
        staged.append(commits.stage(found.select(*schemas.PREDICTIONS), zones, zone, attempt))
    kept = commits.read_staged(spark, zones, staged[-1], schemas.PREDICTIONS)
    staged.append(commits.stage(score.slim(kept), zones, "predictions_slim", attempt))
    commits.commit(spark, zones, staged)
    return best


def load_best(spark: SparkSession, zones: Zones):
    """The model ``run_training`` kept last."""
    (entry,) = commits.latest(commits.read_log(spark, zones), "best_model").values()
    return model.load(f"{zones.best_model}/attempt={entry.attempt}")


def tidy(spark: SparkSession, zones: Zones, *, older_than: float = 7 * 86_400) -> dict[str, int]:
    """Gather small files and the log, and remove what no longer counts; gives folders removed per zone."""
    compact_zones(spark, zones)
    held = {entry.zone for entry in commits.read_log(spark, zones)}
    return {zone: commits.vacuum(spark, zones, zone, older_than=older_than) for zone in sorted(held)}


def run_all(
    spark: SparkSession,
    source: StreamSpec,
    zones: Zones,
    spec: CleanSpec = CleanSpec(),
    rule: RuleSpec = RuleSpec(),
    *,
    version: str | None = None,
    as_of: datetime.date | str | None = None,
    now=None,
    jdbc: JdbcSpec | None = None,
) -> DataFrame:
    """Clean what has arrived, score it, report on it.

    Each step starts when the one before has finished, not after a fixed wait.
    """
    for query in run_clean_stream(spark, source, zones, spec, now=now):
        query.awaitTermination()
    run_score(spark, zones, rule, version=version, now=now, jdbc=jdbc)
    return run_report(spark, zones, as_of=as_of, jdbc=jdbc)
