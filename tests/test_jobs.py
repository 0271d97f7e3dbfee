import pytest
from pyspark.sql import functions as F

from casemill import JdbcSpec, StreamSpec, commits, schemas, sinks
from casemill.functions import values
from casemill.operators import evaluate, model
from casemill.plans import jobs
from casemill.streaming import write_batch

from cases import NOW, messages, record
from test_stream import land


def test_run_all(spark, tmp_path, zones):
    inbox = str(tmp_path / "inbox")
    land(spark, inbox, [record(safetyreportid=str(i), serious=str(i % 2)) for i in range(10)])
    source = StreamSpec(kind="files", path=inbox)
    rows = jobs.run_all(spark, source, zones, version="v1", as_of="2024-06-01", now=NOW)
    overall = rows.filter("dimension_type = 'overall'").first()
    assert (overall.total_records, overall.high_risk_records) == (10, 5)
    assert rows.columns == list(schemas.SUMMARY)
    slim, full = commits.read(spark, zones, "predictions_slim"), commits.read(spark, zones, "predictions")
    assert slim.exceptAll(full.select(*schemas.PREDICTIONS_SLIM)).isEmpty() and slim.count() == 10
    metrics = commits.read(spark, zones, "metrics").collect()
    assert {(m.metric_name, m.metric_value) for m in metrics} == {
        ("accuracy", 1.0), ("precision", 1.0), ("recall", 1.0), ("f1_score", 1.0),
    }


def test_reruns_replace_and_history_stays(spark, zones):
    write_batch(messages(spark), zones, "run-a", 0, now=NOW)
    for version in ("v1", "v2", "v2"):
        jobs.run_score(spark, zones, version=version, now=NOW)
    assert commits.read(spark, zones, "metrics").count() == 8
    assert {r.model_version for r in commits.read(spark, zones, "predictions").collect()} == {"v2"}
    for day in ("2024-06-01", "2024-06-02", "2024-06-02"):
        last = jobs.run_report(spark, zones, as_of=day)
    assert {str(r.summary_date) for r in last.collect()} == {"2024-06-02"}
    assert commits.read(spark, zones, "summary").count() == 2 * last.count()


def test_warehouse_loads(spark, zones, monkeypatch):
    """Every table is loaded with what the lake holds of it; no connection is made here."""
    loads = []

    def recorded(df, spec, table, mode="append", extra=None):
        shaped = schemas.conform(df, schemas.WAREHOUSE[table])
        loads.append((table, mode, shaped.count(), dict(shaped.dtypes) == schemas.WAREHOUSE[table]))

    monkeypatch.setattr(sinks, "jdbc_write", recorded)
    write_batch(messages(spark), zones, "run-a", 0, now=NOW)
    warehouse = JdbcSpec("jdbc:postgresql://db/w", "u", "p")
    jobs.run_score(spark, zones, version="v1", now=NOW, jdbc=warehouse)
    jobs.run_report(spark, zones, as_of="2024-06-01", jdbc=warehouse)
    silver = jobs.read_silver(spark, zones).count()
    summary_rows = commits.read(spark, zones, "summary").count()
    assert loads == [
        ("cleaned_patients", "overwrite", silver, True),
        ("patient_predictions", "overwrite", silver, True),
        ("model_evaluation", "overwrite", 4, True),
        ("risk_summary", "overwrite", summary_rows, True),
    ]


def test_rows_that_do_not_fit_are_not_loaded(spark, zones, monkeypatch):
    """Loaded and rejected rows are all rows; a load without misfits clears the table's rejects."""
    loaded = []
    monkeypatch.setattr(sinks, "jdbc_write", lambda df, *_: loaded.append(df.count()))
    warehouse = JdbcSpec("jdbc:postgresql://db/w", "u", "p")
    rows = spark.createDataFrame(
        [("2024-06-01", "a", "x", str(n), 1, 1, 0.5) for n in (1, 2, "many")],
        "summary_date string, dimension_type string, dimension_value string, total_records string,"
        " high_risk_records long, low_risk_records long, average_probability double",
    )
    jobs.load_warehouse(zones, warehouse, {"risk_summary": rows})
    (kept,) = commits.read(spark, zones, "rejects").collect()
    assert (kept.table_name, kept.column_name, kept.value) == ("risk_summary", "total_records", "many")
    assert loaded == [2] and '"total_records":"many"' in kept.row
    jobs.load_warehouse(zones, warehouse, {"risk_summary": rows.where("total_records <> 'many'")})
    assert commits.read_zone(spark, zones, "rejects", schemas.REJECTS) is None and loaded == [2, 2]


def training_rows(spark, n=400):
    """The product decides the label, but for a few rows; one numeric column is empty."""
    i = F.col("id")
    return spark.range(n).select(
        i.cast("string").alias("report_id"),
        F.lit("s").alias("source_api"),
        F.lit("2024-01-01").cast("date").alias("receipt_date"),
        F.when(i % 5 > 0, i % 90).cast("double").alias("patient_age"),
        F.lit(None).cast("double").alias("patient_weight"),
        (i % 4).cast("int").alias("batch_number"),
        F.when(i % 7 > 0, (i % 3).cast("string")).alias("patient_sex"),
        F.concat(F.lit("p"), (i % 8).cast("string")).alias("medicinal_product"),
        F.lit("nausea").alias("reaction"),
        F.when(i % 41 == 0, 0).otherwise((i % 8 < 4).cast("int")).alias("risk_label"),
    )


SMALL = dict(trees=5, depth=3, hash_width=256)


@pytest.mark.parametrize("hashed", [(), ("medicinal_product", "receipt_date")])
def test_training(spark, tmp_path, hashed):
    listed = tuple(c for c in model.ModelSpec.categorical if c not in hashed)
    spec = model.ModelSpec(categorical=listed, hashed=hashed, **SMALL)
    train, test = model.split(training_rows(spark), spec)
    assert train.count() + test.count() == 400 and 60 < test.count() < 110
    models = model.train(train, spec)
    metrics = model.evaluate_all(models, test, "v1", spec)
    scores = {(m.model_name, m.metric_name): m.metric_value for m in metrics.collect()}
    assert set(name for name, _ in scores) == {"logistic_regression", "random_forest"}
    # A few small trees rarely draw the one hashed column that matters.
    sure = scores if not hashed else [k for k in scores if k[0] == "logistic_regression"]
    assert all(scores[k] > 0.9 for k in sure)
    best = model.select_best(metrics)
    assert scores[best, "f1_score"] == max(v for (_, name), v in scores.items() if name == "f1_score")
    path = str(tmp_path / "best")
    model.save(models[best], path)
    rows = model.predict(model.load(path), test, best, "v1", spec, NOW)
    assert dict(rows.dtypes) == schemas.PREDICTIONS
    probabilities = [r.prediction_probability for r in rows.collect()]
    assert all(0 <= p <= 1 for p in probabilities) and len(set(probabilities)) > 1


def test_values_unseen_in_training_are_scored(spark):
    spec = model.ModelSpec(**SMALL)
    models = model.train(training_rows(spark), spec)
    strange = training_rows(spark, 3).withColumns(
        {"medicinal_product": F.lit("never seen"), "patient_sex": F.lit(None).cast("string")}
    )
    for name, fitted in models.items():
        assert model.predict(fitted, strange, name, "v1", spec).count() == 3


def test_folds_and_choice(spark):
    """Every candidate meets every fold; the same rows are held out each time; ties go by text."""
    spec = model.ModelSpec(**SMALL)
    features = model.train(training_rows(spark), spec)["logistic_regression"]
    fold = values.hash_fold(F.col("report_id"), spec.folds).alias("fold")
    vectors = model.PipelineModel(stages=features.stages[:-1]).transform(model.prepare(training_rows(spark), spec))
    vectors = vectors.select("risk_label", "feature_vector", fold).persist()
    grid = {"regParam": [0.01, 5.0], "maxIter": [5]}
    tried = model.cross_validate(vectors, model.learners(spec)["logistic_regression"], grid, spec)
    f1 = {(r.parameters, r.fold): r.metric_value for r in tried.where("metric_name = 'f1_score'").collect()}
    texts = sorted(model.candidates(grid))
    assert texts == ['{"maxIter": 5, "regParam": 0.01}', '{"maxIter": 5, "regParam": 5.0}']
    assert sorted(f1) == [(t, n) for t in texts for n in range(spec.folds)]
    assert model.choose(tried) == max(texts, key=lambda t: sum(f1[t, n] for n in range(spec.folds)))
    even = tried.withColumn("metric_value", F.lit(0.1) + F.lit(0.2))
    assert model.choose(even) == texts[0]


def test_slope_at_the_optimum(spark):
    """Flat in every coefficient after many steps, and not after one."""
    rows = training_rows(spark).where("medicinal_product <> 'p9'")
    slopes = {}
    for steps in (1, 300):
        spec = model.ModelSpec(**SMALL, max_iter=steps, tolerance=1e-12, reg_param=0.05)
        found = model.optimum(model.train(rows, spec)["logistic_regression"], rows, spec).collect()
        assert [r.coefficient for r in found] == list(range(len(found)))
        slopes[steps] = max(abs(r.gradient) for r in found)
    assert slopes[300] < 1e-6 < 1e-3 < slopes[1]


def test_grid_search(spark):
    spec = model.ModelSpec(**SMALL)
    grids = {"logistic_regression": {"regParam": [0.01, 0.1], "elasticNetParam": [0.0, 0.7]}}
    models = model.train(training_rows(spark), spec, grids)
    chosen = models["logistic_regression"].stages[-1]
    assert chosen.getOrDefault("regParam") in (0.01, 0.1)


def test_run_training(spark, zones):
    rows = training_rows(spark).withColumns(
        {c: F.lit(None).cast(t) for c, t in schemas.CLEAN.items() if c not in training_rows(spark).columns}
    )
    rows.select(*schemas.CLEAN).write.parquet(f"{zones.silver}/run_id=r/batch_id=0")
    best = jobs.run_training(spark, zones, model.ModelSpec(**SMALL), version="v1", now=NOW)
    assert best in ("logistic_regression", "random_forest")
    full, test = commits.read(spark, zones, "predictions"), commits.read(spark, zones, "test_predictions")
    assert full.count() == 400 > test.count() > 0
    slim = commits.read(spark, zones, "predictions_slim")
    assert slim.exceptAll(full.select(*slim.columns)).isEmpty() and slim.count() == 400
    stored = commits.read(spark, zones, "metrics")
    assert stored.count() == 8
    assert jobs.load_best(spark, zones).transform(model.prepare(rows, model.ModelSpec(**SMALL))).count() == 400
    again = {r.metric_name: r.metric_value for r in evaluate.metric_rows(test, "test").collect()}
    kept = {r.metric_name: r.metric_value for r in stored.collect() if r.model_name == best}
    assert again == pytest.approx(kept)


def test_split_puts_rows_without_a_key_on_the_test_side(spark):
    rows = spark.createDataFrame([("a",), ("b",), (None,)], "report_id string")
    train, test = model.split(rows)
    assert train.count() + test.count() == 3
    assert test.where("report_id IS NULL").count() == 1
