"""Trained models next to the rule scorer: features, learners, choice, scoring."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass
from itertools import product

import numpy as np
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import FeatureHasher, Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from casemill import schemas
from casemill.functions import values
from casemill.operators import evaluate, profile
from casemill.operators.clean import moment
from casemill.spec import UNKNOWN


@dataclass(frozen=True)
class ModelSpec:
    """What to learn from. The label's own flags must never be among the features."""

    key: str = "report_id"
    label: str = "risk_label"
    numeric: tuple[str, ...] = ("patient_age", "patient_weight", "batch_number")
    categorical: tuple[str, ...] = ("patient_sex", "medicinal_product", "reaction", "receipt_date")
    train_percent: int = 80
    folds: int = 3
    seed: int = 42
    max_iter: int = 20
    tolerance: float = 1e-6
    reg_param: float = 0.0
    elastic_net: float = 0.0
    trees: int = 100
    depth: int = 8
    # Categories that are hashed instead of indexed. Columns of many values belong
    # here: an index of its values passes all of them through the driver.
    hashed: tuple[str, ...] = ()
    hash_width: int = 1 << 16


# Parameter values to search; they include the published best ones.
GRIDS = {
    "logistic_regression": {"regParam": [0.0, 0.01, 0.1], "elasticNetParam": [0.0, 0.7]},
    "random_forest": {"numTrees": [50, 100], "maxDepth": [5, 8]},
}


def split(df: DataFrame, spec: ModelSpec = ModelSpec()) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the key.

    Unlike a seeded random split, the same row always lands on the same side,
    however the data is partitioned. Rows without a key are test rows.
    """
    train = F.coalesce(values.hash_percent(F.col(spec.key)) < spec.train_percent, F.lit(False))
    return df.filter(train), df.filter(~train)


def prepare(df: DataFrame, spec: ModelSpec = ModelSpec()) -> DataFrame:
    """Feature columns with the types the stages expect."""
    return df.withColumns(
        {
            **{c: F.col(c).cast("double") for c in spec.numeric},
            **{c: F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)) for c in (*spec.categorical, *spec.hashed)},
            spec.label: F.col(spec.label).cast("double"),
        }
    )


def feature_stages(train: DataFrame, spec: ModelSpec = ModelSpec()) -> list[Estimator | Transformer]:
    """Median imputation, indexing, one-hot encoding, hashing and assembly.

    Empty numeric columns are left out, as they have no median.
    """
    numeric = profile.with_values(train, spec.numeric)
    listed, hashed = list(spec.categorical), list(spec.hashed)
    stages: list[Estimator | Transformer] = []
    parts: list[str] = []
    if numeric:
        filled = [f"{c}_filled" for c in numeric]
        stages.append(Imputer(strategy="median", inputCols=numeric, outputCols=filled))
        parts += filled
    if listed:
        index, hot = [f"{c}_index" for c in listed], [f"{c}_hot" for c in listed]
        stages.append(StringIndexer(inputCols=listed, outputCols=index, handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=index, outputCols=hot))
        parts += hot
    if hashed:
        stages.append(FeatureHasher(inputCols=hashed, outputCol="hashed", numFeatures=spec.hash_width))
        parts.append("hashed")
    stages.append(VectorAssembler(inputCols=parts, outputCol="feature_vector"))
    return stages


def learners(spec: ModelSpec = ModelSpec()) -> dict[str, Estimator]:
    """The two learners, by model name."""
    common = {"featuresCol": "feature_vector", "labelCol": spec.label}
    return {
        "logistic_regression": LogisticRegression(
            maxIter=spec.max_iter, tol=spec.tolerance, regParam=spec.reg_param, elasticNetParam=spec.elastic_net, **common
        ),
        "random_forest": RandomForestClassifier(
            numTrees=spec.trees, maxDepth=spec.depth, seed=spec.seed, **common
        ),
    }


def candidates(grid: Mapping[str, list]) -> dict[str, dict]:
    """Every combination of a grid's values, by a text that names it."""
    combined = ({name: value for name, value in zip(grid, values_, strict=True)} for values_ in product(*grid.values()))
    return {json.dumps(c, sort_keys=True): c for c in combined}


def cross_validate(vectors: DataFrame, learner: Estimator, grid: Mapping[str, list], spec: ModelSpec = ModelSpec()) -> DataFrame:
    """(parameters, fold, metric_name, metric_value): every candidate, learned without each fold and tried on it.

    ``vectors`` hold the label, ``feature_vector`` and ``fold``. Folds go by a hash of the
    key, so the same rows are held out for all candidates, in every run.
    """
    tried = None
    for text, values_ in candidates(grid).items():
        chosen = learner.copy({learner.getParam(name): value for name, value in values_.items()})
        for fold in range(spec.folds):
            fitted = chosen.fit(vectors.where(F.col("fold") != fold))
            told = fitted.transform(vectors.where(F.col("fold") == fold)).select(
                F.lit(text).alias("parameters"), "fold", spec.label, "prediction"
            )
            tried = told if tried is None else tried.unionByName(told)
    return evaluate.metrics(tried, spec.label, "prediction", by=["parameters", "fold"])


def choose(tried: DataFrame, metric: str = "f1_score") -> str:
    """The parameters with the best mean over the folds; of equal ones the first by text.

    Means are compared to nine digits, so that the order in which they were added up
    does not settle a tie.
    """
    means = (
        tried.where(F.col("metric_name") == metric)
        .groupBy("parameters")
        .agg(F.round(F.avg("metric_value"), 9).alias("mean"))
    )
    return means.orderBy(F.desc("mean"), "parameters").first()["parameters"]


def train(
    rows: DataFrame,
    spec: ModelSpec = ModelSpec(),
    grids: Mapping[str, Mapping[str, list]] | None = None,
) -> dict[str, PipelineModel]:
    """Fit both learners on one shared set of features.

    The feature stages are fitted once and their output kept while the learners
    iterate over it. ``grids`` (model name -> parameter -> values) searches
    parameters by cross-validation over the training rows.
    """
    prepared = prepare(rows, spec)
    features = Pipeline(stages=feature_stages(prepared, spec)).fit(prepared)
    fold = values.hash_fold(F.coalesce(F.col(spec.key).cast("string"), F.lit("")), spec.folds).alias("fold")
    vectors = features.transform(prepared).select(spec.label, "feature_vector", fold).persist()
    try:
        fitted = {}
        for name, learner in learners(spec).items():
            if grids and name in grids:
                best = candidates(grids[name])[choose(cross_validate(vectors, learner, grids[name], spec))]
                learner = learner.copy({learner.getParam(k): v for k, v in best.items()})
            fitted[name] = PipelineModel(stages=[*features.stages, learner.fit(vectors)])
        return fitted
    finally:
        vectors.unpersist()


def optimum(model: PipelineModel, rows: DataFrame, spec: ModelSpec = ModelSpec()) -> DataFrame:
    """(coefficient, gradient): the loss's slope in each coefficient of a fitted logistic regression, the intercept last.

    Where it is zero in all of them, the fit is the optimum, as the loss is convex. The
    slope is that of the mean log loss plus the squared penalty on standardised
    coefficients; a penalty on absolute values has none. Two sums over the rows give it.
    """
    last = model.stages[-1]
    if last.getOrDefault("elasticNetParam") != 0.0:
        raise ValueError("a penalty on absolute values has no slope at zero")
    scored = model.transform(prepare(rows, spec))
    label, taken = F.col(spec.label), F.get(vector_to_array("probability"), F.lit(1))
    # By how much each row's probability is off; sums of weights want no negative ones.
    off = F.abs(taken - label)
    sums = Summarizer.metrics("mean")
    sides = scored.groupBy(spec.label).agg(
        sums.summary(F.col("feature_vector"), off).alias("off"), F.sum(off).alias("weight"), F.count(F.lit(1)).alias("n")
    ).collect()
    spread = scored.agg(Summarizer.std(F.col("feature_vector")).alias("std")).first()["std"].toArray()
    total = sum(side["n"] for side in sides)
    slope, intercept = np.zeros(len(spread)), 0.0
    for side in sides:
        sign = -1 if side[spec.label] == 1 else 1
        slope += sign * side["weight"] * side["off"]["mean"].toArray() / total
        intercept += sign * side["weight"] / total
    slope += last.getOrDefault("regParam") * spread**2 * last.coefficients.toArray()
    rows_ = [(i, float(g)) for i, g in enumerate([*slope, intercept])]
    return scored.sparkSession.createDataFrame(rows_, "coefficient int, gradient double")


def predict(
    model: PipelineModel, rows: DataFrame, name: str, version: str, spec: ModelSpec = ModelSpec(), now=None
) -> DataFrame:
    """Predictions with the model's probability of the high-risk class."""
    kept = [spec.key, *(c for c in ("source_api", "receipt_date", "patient_sex", "medicinal_product") if c in rows.columns)]
    original = F.struct(*kept).alias("_row")
    scored = model.transform(prepare(rows.withColumn("_row", original), spec))
    return scored.select(
        *(F.col(f"_row.{c}").alias(c) for c in kept),
        F.lit(name).alias("model_name"),
        F.lit(version).alias("model_version"),
        F.col(spec.label).cast("int").alias("risk_label"),
        F.col("prediction").cast("int").alias("prediction"),
        # A model trained on low-risk rows alone knows no other class.
        F.coalesce(F.get(vector_to_array("probability"), F.lit(1)), F.lit(0.0)).alias("prediction_probability"),
        moment(now).alias("scoring_timestamp"),
        values.display(*spec.numeric, *spec.categorical, *spec.hashed).alias("features"),
        moment(now).alias("created_at"),
    )


def evaluate_all(
    models: Mapping[str, PipelineModel], test: DataFrame, version: str, spec: ModelSpec = ModelSpec()
) -> DataFrame:
    """Metric rows of every model on the test rows."""
    result = None
    for name, model in models.items():
        rows = evaluate.metric_rows(predict(model, test, name, version, spec), "test")
        result = rows if result is None else result.unionByName(rows)
    return result.select(*schemas.METRICS)


def select_best(metrics: DataFrame, metric: str = "f1_score") -> str:
    """The name of the model with the highest metric; ties go to the smaller name."""
    ranked = metrics.filter(F.col("metric_name") == metric).orderBy(F.desc("metric_value"), "model_name")
    return ranked.first()["model_name"]


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
