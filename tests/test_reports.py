import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from casemill import RuleSpec, schemas
from casemill.operators import clean, evaluate, profile, reports, score, summary

from cases import NOW, messages

# Published totals: group -> (records, high risk, mean probability).
OVERALL = (7573, 3708, 0.491)
SEXES = {
    "2": (4480, 1915, 0.435),
    "1": (2326, 1192, 0.511),
    "0": (720, 574, 0.767),
    "unknown": (47, 27, 0.567),
}
PRODUCTS = {
    "lipitor": (507, 495, 0.929),
    "pradaxa": (68, 52, 0.738),
    "gilenya": (54, 51, 0.900),
    "warfarin": (15, 12, 0.770),
    "revlimid": (58, 58, 0.950),
    "jakafi": (616, 74, 0.158),
    "letairis": (1444, 98, 0.111),
    "claritin chewable": (360, 0, 0.050),
    "oxytrol for women": (53, 0, 0.050),
}


def labelled(spark, groups, column):
    """One row per published record."""
    rows = spark.createDataFrame([(k, n, h) for k, (n, h, _) in groups.items()], f"{column} string, n int, h int")
    rows = rows.select(column, F.explode(F.expr("sequence(1, n)")).alias("i"), "h")
    label = (F.col("i") <= F.col("h")).cast("int")
    return rows.select(
        column, label.alias("risk_label"), score.rule_probability(label).alias("prediction_probability")
    )


def test_published_totals(spark):
    by_sex = {
        (r.dimension_type, r.dimension_value): r
        for r in summary.long_summary(labelled(spark, SEXES, "patient_sex"), ["patient_sex"], "2024-01-01").collect()
    }
    want = {("patient_sex", k): v for k, v in SEXES.items()} | {("overall", "all_records"): OVERALL}
    assert set(by_sex) == set(want)
    for key, (total, high, mean) in want.items():
        row = by_sex[key]
        assert (row.total_records, row.high_risk_records, row.low_risk_records) == (total, high, total - high)
        assert row.average_probability == pytest.approx(mean, abs=6e-4)
        assert row.average_probability == pytest.approx(0.05 + 0.9 * high / total)


def test_published_products(spark):
    rows = reports.rates(labelled(spark, PRODUCTS, "medicinal_product"), "medicinal_product").collect()
    for row in rows:
        total, high, mean = PRODUCTS[row.medicinal_product]
        assert (row.total_records, row.high_risk_records) == (total, high)
        assert row.average_probability == pytest.approx(mean, abs=6e-4)
        assert row.high_risk_rate == pytest.approx(high / total)
    ends = reports.extremes(labelled(spark, PRODUCTS, "medicinal_product"), "medicinal_product", 2, 50)
    assert [(r.side, r.medicinal_product) for r in ends.collect()] == [
        ("highest", "revlimid"), ("highest", "lipitor"),
        ("lowest", "claritin chewable"), ("lowest", "oxytrol for women"),
    ]


def frame(spark, rows):
    return spark.createDataFrame(rows, "a string, b string, risk_label int, prediction_probability double")


ROWS = [("x", None, 1, 0.95), ("x", "p", 0, 0.05), (None, "p", 1, 0.95), ("y", "q", 0, 0.05), (None, None, 0, 0.05)]


def test_one_scan_equals_union(spark):
    one = summary.long_summary(frame(spark, ROWS), ["a", "b"], "2024-01-01")
    many = summary.union_summary(frame(spark, ROWS), ["a", "b"], "2024-01-01")
    assert one.columns == many.columns == list(schemas.SUMMARY)
    assert dict(one.dtypes) == schemas.SUMMARY
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))


def test_null_value_keeps_its_dimension(spark):
    rows = summary.long_summary(frame(spark, ROWS), ["a", "b"], "2024-01-01").collect()
    nulls = sorted((r.dimension_type, r.total_records) for r in rows if r.dimension_value is None)
    assert nulls == [("a", 2), ("b", 2)]


def test_parts_add_up(spark):
    rows = summary.long_summary(frame(spark, ROWS), ["a", "b"], "2024-01-01").collect()
    for measure in ("total_records", "high_risk_records", "low_risk_records"):
        totals = {}
        for r in rows:
            totals[r.dimension_type] = totals.get(r.dimension_type, 0) + r[measure]
        assert len(set(totals.values())) == 1


@pytest.mark.parametrize("dimensions", [[], ["a"], ["a", "b"]])
def test_empty_input_gives_no_rows(spark, dimensions):
    assert summary.long_summary(frame(spark, ROWS).limit(0), dimensions).isEmpty()


def test_top_k_breaks_ties_by_key(spark):
    top = reports.top_k(frame(spark, ROWS).na.drop(), "a", F.sum(F.lit(1)), 1).collect()
    assert [tuple(r) for r in top] == [("x", 1)]


def test_over_time_keeps_undated_rows(spark):
    rows = spark.createDataFrame(
        [("2024-01-31", 1, 0.95), ("2024-01-01", 0, 0.05), (None, 0, 0.05)],
        "receipt_date string, risk_label int, prediction_probability double",
    ).withColumn("receipt_date", F.col("receipt_date").cast("date"))
    got = {str(r.period): r.total_records for r in reports.over_time(rows).collect()}
    assert got == {"2024-01-01": 2, "None": 1}


def test_scores(spark):
    cleaned = clean.clean(messages(spark), now=NOW).clean
    scored = score.score(cleaned, "v1", now=NOW)
    assert dict(scored.dtypes) == schemas.PREDICTIONS
    for row in scored.collect():
        assert row.prediction == row.risk_label
        assert row.prediction_probability == (0.95 if row.risk_label else 0.05)
        assert (row.model_name, row.model_version) == (RuleSpec().model_name, "v1")
    r2 = scored.filter("report_id = 'r2'").first()
    assert r2.features == "{null, null, unknown, unknown, unknown, false, true, false}"
    assert score.slim(scored).columns == list(schemas.PREDICTIONS_SLIM)
    assert {r.metric_value for r in evaluate.metric_rows(scored, "rule_based").collect()} == {1.0}


def test_metrics_equal_the_evaluator(spark):
    rows = [(float(i % 3), float((i * 7 // 5) % 4)) for i in range(200)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    got = {r.metric_name: r.metric_value for r in evaluate.metrics(df, "label", "prediction").collect()}
    names = {"accuracy": "accuracy", "precision": "weightedPrecision", "recall": "weightedRecall", "f1_score": "f1"}
    for ours, theirs in names.items():
        want = MulticlassClassificationEvaluator(labelCol="label", metricName=theirs).evaluate(df)
        assert got[ours] == pytest.approx(want, abs=1e-12)


def test_metrics_of_nothing(spark):
    empty = spark.createDataFrame([], "label int, prediction int")
    assert evaluate.metrics(empty, "label", "prediction").isEmpty()


def test_latest_metrics(spark):
    rows = [("m", "1", "accuracy", 0.5, "t"), ("m", "2", "accuracy", 0.7, "t"), ("n", "1", "accuracy", 0.1, "t")]
    metrics = spark.createDataFrame(rows, schemas.ddl(schemas.METRICS))
    got = {(r.model_name, r.model_version): r.metric_value for r in reports.latest_metrics(metrics).collect()}
    assert got == {("m", "2"): 0.7, ("n", "1"): 0.1}


def test_column_selection(spark):
    df = spark.createDataFrame([], "a int, b double, c string, d date, e boolean, f decimal(5,2), g array<int>")
    assert profile.columns_of(df, "number", but=["a"]) == ["b", "f"]
    assert profile.columns_of(df, "category") == ["c", "d", "e"]
    assert profile.with_values(df, []) == []
    assert profile.with_values(df, ["a", "c"]) == []


@pytest.mark.parametrize("bins", [1 << 12, 8])
@pytest.mark.parametrize(
    "values",
    [
        [1.0],
        [1.0, 2.0],
        [5.0] * 1000 + [float(i) for i in range(100)],
        [float(i % 7) for i in range(501)],
        [float((i * 7919) % 10007) / 3 for i in range(5000)],
        [-3.0] * 400 + [8.0] * 400,
        [-1.7e308, -1.6e308, 1.6e308, 1.7e308],
        [5e-324 * i for i in range(6)] + [-1e-300],
        [float("-inf")] * 3 + [2.5, 2.5000000001] + [float("inf")] * 3,
        [-0.0, 0.0, 0.0],
    ],
)
def test_exact_median(spark, monkeypatch, values, bins):
    monkeypatch.setattr(profile, "_BINS", bins)
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double")
    want = sorted(values)
    middle = want[(len(want) - 1) // 2] / 2 + want[len(want) // 2] / 2 if len(want) % 2 == 0 else want[len(want) // 2]
    assert profile.exact_medians(df, ["v"]) == {"v": middle}


def test_distinct(spark):
    df = spark.range(3000).select((F.col("id") % 500).alias("k"))
    assert profile.distinct(df, "k").first()[0] == 500
    assert profile.distinct(df, "k", approximate=True).first()[0] == pytest.approx(500, rel=0.1)


def test_quality(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", None), (None, 4)], "k string, v int")
    got = {r.measure: r.rate for r in profile.quality(df, ["k", "v"], F.col("k"), F.col("v") > 3).collect()}
    assert got == {
        "null_rate_k": 0.25, "null_rate_v": 0.5, "duplicate_key_rate": pytest.approx(1 / 3), "bad_record_rate": 0.25,
    }


def test_medians_share_their_passes(spark, monkeypatch):
    passes = []
    real = profile._narrowed
    monkeypatch.setattr(profile, "_narrowed", lambda *a: passes.append(1) or real(*a))
    df = spark.range(20_001).select(*(((F.col("id") * k) % 20_001).cast("double").alias(f"v{k}") for k in (1, 2, 5)))
    assert profile.exact_medians(df, df.columns) == dict.fromkeys(df.columns, 10_000.0)
    assert len(passes) <= 3


def test_misfits(spark):
    df = spark.createDataFrame([("1", "x"), ("y", None), (None, "2")], "a string, b string")
    got = {r.column_name: r.misfits for r in schemas.misfits(df, {"a": "int", "b": "double", "c": "int"}).collect()}
    assert got == {"a": 1, "b": 1}


def test_median_of_nothing(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0)], "a double, b double")
    assert profile.exact_medians(df, ["a", "b"]) == {"a": None, "b": 2.0}
    assert profile.fill_median(df, ["a"]).first().a is None


def test_quality_of_nothing(spark):
    for rows in ([], [(None, 1)]):
        frame = spark.createDataFrame(rows, "key string, n int")
        rates = {r.measure: r.rate for r in profile.quality(frame, ["n"], key=F.col("key")).collect()}
        assert rates["duplicate_key_rate"] is None


def test_metrics_pass_over_nulls(spark):
    sound = [(1, 1), (0, 1), (0, 0), (1, 1)]
    found = []
    for rows in (sound, [*sound, (None, 1), (0, None), (None, None)]):
        frame = spark.createDataFrame(rows, "label int, prediction int")
        found.append(sorted(map(tuple, evaluate.metrics(frame, "label", "prediction").collect())))
    assert found[0] == found[1]
