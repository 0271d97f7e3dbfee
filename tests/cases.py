"""Edge records and messages, with the results written by hand."""

import json
import os

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
NOW = "2024-06-01 00:00:00"


def envelope(raw, n, batch=1):
    return json.dumps(
        {
            "source_api": "reports",
            "ingestion_timestamp": f"2024-01-01T00:00:{n:02d}.000000+00:00",
            "batch_number": batch,
            "api_endpoint": "https://reports.example/api",
            "raw_data": raw,
        }
    )


def record(**fields):
    return json.dumps(fields)


RECORDS = {
    "E01": record(
        safetyreportid="r1", receiptdate="20240115", serious="1",
        patient={
            "patientsex": "2", "patientage": "45", "patientweight": "70.5",
            "reaction": [{"reactionmeddrapt": " Nausea "}],
            "drug": [{"medicinalproduct": "LIPITOR"}, {"medicinalproduct": "X"}],
        },
    ),
    "E02": record(
        safetyreportid="r2", receivedate="20240101", serious="2", seriousnessdeath="YES",
        patient={"patientage": "-1", "patientweight": "-3", "reaction": [], "drug": []},
    ),
    "E03": record(
        receiptdate="2024-01-15", receivedate="20240101", serious=" 1",
        patient={"patientsex": "  ", "patientage": "abc", "patientweight": "NaN"},
    ),
    "E04": record(safetyreportid="", seriousnesshospitalization=True, patient=None),
    "E05": record(safetyreportid="r1", receiptdate="20240116", serious="2", patient={"patientsex": "1"}),
    "E06": "not json",
    "E07": "",
    "E08": None,
    "E09": '{"safetyreportid":"r9"',
    "E10": '{"safetyreportid":"r10","patient":"oops"}',
    "E11": "[1,2]",
    "E12": "null",
    "E13": "{}",
    "E14": record(safetyreportid=77, serious=1, patient={"patientage": 30, "patientsex": "\tF "}),
    "E15": "   ",
    "E16": record(safetyreportid="r16", receiptdate="20240230", patient={"reaction": [None], "drug": [{}]}),
}

# case -> (age, weight, sex, product, reaction, receipt date, label)
TYPED = {
    "E01": (45.0, 70.5, "2", "lipitor", "nausea", "2024-01-15", 1),
    "E02": (None, None, "unknown", "unknown", "unknown", "2024-01-01", 1),
    "E03": (None, "nan", "", "unknown", "unknown", None, 0),
    "E04": (None, None, "unknown", "unknown", "unknown", None, 1),
    "E05": (None, None, "1", "unknown", "unknown", "2024-01-16", 0),
    "E13": (None, None, "unknown", "unknown", "unknown", None, 0),
    "E14": (30.0, None, "\tf", "unknown", "unknown", None, 1),
    "E16": (None, None, "unknown", "unknown", "unknown", None, 0),
}

REASONS = {
    "E06": "bad_record", "E07": "empty_record", "E08": "empty_record", "E09": "bad_record",
    "E10": "bad_record", "E11": "bad_record", "E12": "bad_record", "E15": "empty_record",
}

LENIENT_BAD = {"E07", "E08", "E15"}

MESSAGES = {
    "V01": ("garbage", "bad_envelope"),
    "V02": ('{"batch_number":"x","raw_data":"{}"}', "bad_envelope"),
    "V03": (None, "bad_envelope"),
    "V04": ('{"source_api":"a"}', "empty_record"),
    "V05": ("", "bad_envelope"),
}


def messages(spark, cases=RECORDS):
    rows = [(envelope(raw, i),) for i, raw in enumerate(cases.values())]
    return spark.createDataFrame(rows, "value string")
