import os

import pytest

from casemill import app, commits, session
from casemill.sources import read_table
from casemill import schemas

from cases import record
from test_stream import land


@pytest.fixture
def own_session(spark, monkeypatch):
    """The session the command line would build, minus its settings on the shared one."""
    built = {}
    monkeypatch.setattr(session, "build", lambda name, conf=None: built.setdefault(name, spark))
    return built


def test_jobs_in_order(spark, tmp_path, zones, own_session):
    inbox = str(tmp_path / "inbox")
    land(spark, inbox, [record(safetyreportid=str(i), serious=str(i % 2)) for i in range(4)])
    app.main(["clean", "--root", zones.root, "--inbox", inbox])
    app.main(["score", "--root", zones.root, "--version", "v1"])
    app.main(["report", "--root", zones.root, "--as-of", "2024-06-01"])
    stored = read_table(spark, zones.summary, contract=schemas.SUMMARY).filter("dimension_type = 'overall'").first()
    assert (stored.total_records, stored.high_risk_records) == (4, 2)
    assert set(own_session) == {"casemill-clean", "casemill-score", "casemill-report"}


def test_upkeep_and_incremental_report(spark, tmp_path, zones, own_session):
    inbox = str(tmp_path / "inbox")
    for n in range(2):
        land(spark, inbox, [record(safetyreportid=str(i), serious="1") for i in range(n, n + 3)])
        app.main(["clean", "--root", zones.root, "--inbox", inbox, "--dedup", "indexed", "--late", "--key-buckets", "4"])
    app.main(["report", "--root", zones.root, "--incremental", "--as-of", "2024-06-01"])
    app.main(["tidy", "--root", zones.root, "--keep-days", "-1", "--key-buckets", "4"])
    stored = commits.read(spark, zones, "summary").filter("dimension_type = 'overall'").first()
    assert (stored.total_records, stored.high_risk_records) == (4, 4)
    assert sorted(r.report_id for r in commits.read(spark, zones, "silver").collect()) == list("0123")
    assert len(os.listdir(zones.silver)) == 1


def test_a_topic_needs_servers(spark, zones, own_session):
    with pytest.raises(ValueError):
        app.main(["clean", "--root", zones.root])


def test_session_settings(monkeypatch):
    seen = {}

    class Builder:
        def appName(self, name):
            seen["name"] = name
            return self

        def config(self, key, value):
            seen[key] = value
            return self

        def getOrCreate(self):
            return self

    monkeypatch.setattr(session.SparkSession, "builder", Builder())
    session.build("x", {"spark.sql.session.timeZone": "Africa/Cairo", "spark.extra": "1"})
    assert seen["name"] == "x"
    assert seen["spark.sql.session.timeZone"] == "Africa/Cairo"
    assert seen["spark.extra"] == "1"
    assert seen["spark.sql.sources.partitionOverwriteMode"] == "dynamic"
    assert seen["spark.sql.streaming.schemaInference"] == "false"
