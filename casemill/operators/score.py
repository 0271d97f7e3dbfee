"""The rule scorer."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from casemill import schemas
from casemill.functions import values
from casemill.operators.clean import moment
from casemill.spec import UNKNOWN, RuleSpec


def base_frame(cleaned: DataFrame, rule: RuleSpec = RuleSpec()) -> DataFrame:
    """Cleaned rows with the types scoring relies on and no missing category."""
    return cleaned.withColumns(
        {
            rule.label: F.col(rule.label).cast("int"),
            **{name: F.col(name).cast("double") for name in rule.numeric},
        }
    ).fillna(UNKNOWN, subset=list(rule.categorical))


def rule_probability(label, rule: RuleSpec = RuleSpec()):
    """The fixed probability of a label column."""
    return F.when(label == 1, rule.high).otherwise(rule.low)


def score(cleaned: DataFrame, version: str, rule: RuleSpec = RuleSpec(), now=None) -> DataFrame:
    """One prediction row per cleaned row. A projection: no shuffle."""
    label = F.col(rule.label)
    scored = base_frame(cleaned, rule).withColumns(
        {
            "model_name": F.lit(rule.model_name),
            "model_version": F.lit(version),
            "prediction": label,
            "prediction_probability": rule_probability(label, rule),
            "features": values.display(*rule.features),
            "scoring_timestamp": moment(now),
            "created_at": moment(now),
        }
    )
    return scored.select(*schemas.PREDICTIONS)


def slim(predictions: DataFrame) -> DataFrame:
    """The narrow copy of a predictions frame."""
    return predictions.select(*schemas.PREDICTIONS_SLIM)
