import re

import pytest
from pyspark.sql import functions as F

from casemill.llm import licenses
from helpers import AWKWARD, IDS, SMALL, as_query, table, texts_of

CITED = [
    "This work is licensed under the GNU General Public License, version 3.",
    "Licensed under CC BY-NC 4.0. All rights reserved. cc by cc by",
    "Released under the MIT License.\nLicensed under the Apache License, Version 2.0.",
    "SPDX-License-Identifier: LGPL-2.1-or-later; Creative Commons Attribution ShareAlike 4.0 International License",
    "Copyright (c) 2020 2021, all rights reserved. Permission is hereby granted, free of charge, to any person obtaining a copy",
    "an accident by occ by ccby CC\nBY General  Public\tLICENSE",
    "GPL v2 or later. gnu gpl 3 only. BSD 3-clause license",
    "license " * 3000 + "all rights reserved " * 500,
    "Ümlaut cc by é general public license ñ",
    "sufficient rights but no citation",
    "two-clause BSD",
    "CC0",
]


def brute(doc, text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    places, own = [], set()
    for phrase, label in licenses.BASE.items():
        parts = phrase.split()
        for i in range(len(words) - len(parts) + 1):
            if words[i : i + len(parts)] == parts:
                places.append(i)
                own.add(label)
    norm = " " + " ".join(words) + " "
    starts = {}
    at = 1
    for i, w in enumerate(words):
        starts[at] = i
        at += len(w) + 1
    spans = []
    for s in licenses.signatures():
        for m in re.finditer(f"(?<= )(?:{s.pattern})(?= )", norm):
            first = starts[m.start()]
            spans.append((first, first + len(m[0].split(" ")), s))
    spans.sort(key=lambda d: (d[0], -d[1], -d[2].priority, d[2].id))
    outer, reach = [], 0
    for d in spans:
        if d[1] > reach:
            outer.append(d)
        reach = max(reach, d[1])
    left = []
    for i, d in enumerate(outer):
        a = outer[i - 1] if i else None
        b = outer[i + 1] if i + 1 < len(outer) else None
        if a and a[1] > d[0] and a[2].priority > d[2].priority:
            continue
        if b and b[0] < d[1] and b[2].priority > d[2].priority:
            continue
        left.append(d[2])
    top = max([s.confidence for s in left], default=0.0)
    labels = ",".join(sorted(own | {s.label for s in left}))
    return (
        doc, len(words), len(places), min(places, default=None), max(places, default=None),
        ",".join(sorted(own)), labels, max(top, 0.5 if places else 0.0),
    )


@pytest.mark.parametrize("texts", [AWKWARD, CITED])
def test_awkward(spark, tmp_path, texts):
    ids = IDS if texts is AWKWARD else list(range(len(texts)))
    rows = as_query(spark, table(spark, texts, ids), licenses.op10_license_scans, tmp_path)
    want = sorted((brute(i, t) for i, t in zip(ids, texts, strict=True)), key=str)
    assert sorted(map(tuple, rows), key=str) == want


def test_labels(spark):
    rows = {r["doc_id"]: r["labels"] for r in licenses.license_labels(table(spark, CITED)).collect()}
    assert rows[0] == "gpl,gpl-3.0"
    assert rows[1] == "cc-by,cc-by-nc-4.0,reserved"
    assert rows[2] == "apache-2.0,mit"
    assert rows[3] == "cc-by-sa-4.0,lgpl-2.1"
    assert (rows[9], rows[10], rows[11]) == ("", "bsd-2-clause", "cc0")


def test_table(spark):
    rows = licenses.op10_license_scans(spark, SMALL).collect()
    assert sorted(map(tuple, rows), key=str) == sorted((brute(*r) for r in texts_of()), key=str)


def test_every_rule_is_behind_a_gate():
    rules = licenses.signatures()
    assert len(rules) > 200
    for s in rules:
        assert s.keyword in s.pattern
        assert s.pattern.startswith("cc ") or any(g in s.pattern for g in licenses.GATES)


def test_empty_table(spark, tmp_path):
    assert as_query(spark, table(spark, []), licenses.op10_license_scans, tmp_path) == []


def test_plan_has_no_python(spark):
    frame = spark.read.parquet(f"{SMALL}/documents.parquet")
    plan = licenses.gated(frame, "text", "doc_id").withColumn("row", F.lit(1))
    for part in (plan, licenses.detections(plan)):
        assert not re.search("Python|Pandas|Arrow", part._jdf.queryExecution().toString())


def test_identifiers_with_suffixes(spark):
    texts = [f"SPDX-License-Identifier: {x}" for x in ("BSD-3-Clause", "BSD-2-Clause-Patent", "BSD-4-Clause", "MIT-0", "CC0-1.0", "BSD")]
    rows = {r["doc_id"]: r["labels"] for r in licenses.license_labels(table(spark, texts)).collect()}
    assert [rows[i] for i in range(6)] == ["bsd-3-clause", "bsd-2-clause", "bsd-4-clause", "mit", "cc0", "bsd"]
