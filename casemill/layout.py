"""Folder layout of the data zones, and scratch folders for jobs."""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Zones:
    """Paths under one root; any Hadoop-compatible file system works.

    The folder names are fixed values: readers of the zones expect them. ``key_buckets``
    is how many folders the index of stored keys has, some million keys for each; it
    stays as it was when the index was made, and so is part of the index's place.
    """

    root: str
    key_buckets: int = 64

    def _at(self, tail: str) -> str:
        return f"{self.root.rstrip('/')}/{tail}"

    @property
    def bronze(self) -> str:
        return self._at("raw/events")

    @property
    def silver(self) -> str:
        return self._at("processed/cleaned_parquet")

    @property
    def quarantine(self) -> str:
        return self._at("processed/bad_records")

    @property
    def late(self) -> str:
        return self._at("processed/late_rows")

    @property
    def keys(self) -> str:
        return self._at(f"processed/keys_{self.key_buckets}")

    @property
    def clock(self) -> str:
        return self._at("processed/clock")

    @property
    def parsed(self) -> str:
        """Parsed rows of the batches that are being written; each removes its own when it is done."""
        return self._at("processed/parsed_rows")

    @property
    def commits(self) -> str:
        return self._at("commits")

    @property
    def checkpoints(self) -> str:
        return self._at("checkpoints")

    @property
    def predictions(self) -> str:
        return self._at("models/predictions/latest")

    @property
    def predictions_slim(self) -> str:
        return self._at("models/predictions/full_latest")

    @property
    def test_predictions(self) -> str:
        return self._at("models/predictions/test_latest")

    @property
    def metrics(self) -> str:
        return self._at("models/evaluation")

    @property
    def best_model(self) -> str:
        return self._at("models/best_model")

    @property
    def rejects(self) -> str:
        return self._at("models/rejects")

    @property
    def summary(self) -> str:
        return self._at("reporting/risk_summary")

    @property
    def windows(self) -> str:
        return self._at("reporting/windows")

    @property
    def sketches(self) -> str:
        return self._at("reporting/sketches")

    @property
    def summary_parts(self) -> str:
        return self._at("reporting/risk_summary_parts")


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach.

    It lies under ``spark.checkpoint.dir``. Only a local-mode session, where
    driver and executors share one disk, may fall back to a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
