"""Settings as plain values. Nothing here reads the environment."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Literal

from casemill import schemas

# Fixed values of the data model.
TRUTHY = ("1", "true", "yes")
UNKNOWN = "unknown"
RULE_MODEL_NAME = "rule_based_risk_scorer"
COMPAT_REASON = "failed_json_parse"

# What a micro-batch takes in at most, if not said otherwise: Kafka records, or files.
BATCH_BOUND = {"kafka": 50_000_000, "files": 10_000}

DedupMode = Literal["per_batch", "watermark", "state", "global", "indexed"]


@dataclass(frozen=True)
class CleanSpec:
    """How a nested record becomes one typed row.

    The defaults describe a safety report; point the paths elsewhere to clean
    another document shape with the same operators. The row must still end up
    with the columns of ``output``.
    """

    envelope: Mapping[str, str] = field(default_factory=lambda: schemas.ENVELOPE)
    record: Mapping[str, str] = field(default_factory=lambda: schemas.RECORD)
    output: Mapping[str, str] = field(default_factory=lambda: schemas.CLEAN)
    id_path: str = "safetyreportid"
    dates: Mapping[str, tuple[str, ...]] = field(
        default_factory=lambda: {"receipt_date": ("receiptdate", "receivedate")}
    )
    numbers: Mapping[str, str] = field(
        default_factory=lambda: {
            "patient_age": "patient.patientage",
            "patient_weight": "patient.patientweight",
        }
    )
    categories: Mapping[str, str] = field(
        default_factory=lambda: {
            "patient_sex": "patient.patientsex",
            "medicinal_product": "patient.drug[0].medicinalproduct",
            "reaction": "patient.reaction[0].reactionmeddrapt",
        }
    )
    flags: Mapping[str, str] = field(
        default_factory=lambda: {
            "serious": "serious",
            "seriousness_death": "seriousnessdeath",
            "seriousness_hospitalization": "seriousnesshospitalization",
        }
    )
    label: str = "risk_label"
    # Optional code -> name maps per category column, e.g. {"patient_sex": {"1": "male"}}.
    code_names: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    # strict: any record that does not fit the schema is quarantined. Off: only
    # records whose parse gives nothing at all (null or blank text).
    strict: bool = True
    # A blank id counts as missing and gets a content id.
    blank_id_is_missing: bool = True
    # A blank category counts as missing and becomes "unknown".
    blank_as_null: bool = False
    # Try each date path in turn until one parses, instead of taking the first
    # one that is present.
    parse_then_coalesce: bool = False

    @classmethod
    def compat(cls, **changes) -> CleanSpec:
        """The lenient rules: keep misshapen records, keep blank ids."""
        return cls(**{"strict": False, "blank_id_is_missing": False, **changes})


@dataclass(frozen=True)
class RuleSpec:
    """The rule scorer: the label is the prediction, with a fixed probability."""

    model_name: str = RULE_MODEL_NAME
    split_name: str = "rule_based"
    label: str = "risk_label"
    high: float = 0.95
    low: float = 0.05
    numeric: tuple[str, ...] = ("patient_age", "patient_weight")
    categorical: tuple[str, ...] = ("patient_sex", "medicinal_product", "reaction")
    features: tuple[str, ...] = (
        "patient_age",
        "patient_weight",
        "patient_sex",
        "medicinal_product",
        "reaction",
        "serious",
        "seriousness_death",
        "seriousness_hospitalization",
    )


@dataclass(frozen=True)
class StreamSpec:
    """Where messages come from.

    ``kafka`` needs the Kafka connector on the cluster. ``files`` watches a
    folder of files holding a ``value`` column (parquet) or one message per line
    (text).
    """

    kind: Literal["kafka", "files"] = "kafka"
    servers: str | None = None
    topic: str | None = None
    starting_offsets: str = "earliest"
    path: str | None = None
    file_format: Literal["parquet", "text"] = "parquet"
    # Upper bound on one micro-batch, so that the first one does not take all there is:
    # Kafka records, or files. None: that of ``BATCH_BOUND``.
    max_per_trigger: int | None = None
    options: Mapping[str, str] = field(default_factory=dict)

    @property
    def bound(self) -> int:
        return self.max_per_trigger or BATCH_BOUND[self.kind]


@dataclass(frozen=True)
class JdbcSpec:
    """A JDBC warehouse. There is no default password."""

    url: str
    user: str
    password: str
    driver: str = "org.postgresql.Driver"
    # At most this many connections write at a time, whatever the frame's width.
    max_connections: int = 16
    batch_rows: int = 10_000
