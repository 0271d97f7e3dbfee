import hashlib
import os

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from casemill.llm import infill
from casemill.llm.infill import op12_fill_in_middle
from helpers import AWKWARD, IDS, as_query, table

MARKED = ["<P>", "a<S>b", "<M", "M>", "<", "<P<S>", "<M>x" * 3, "<P", "S>", "日<本>語<S", "ab<Q>cd"]


def by_hand(doc, text):
    text = text or ""
    n, digest = len(text), hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = text[:low], text[low:high], text[high:]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc, n, "plain", None, None, text, text
    if h[3] % 100 < 20:
        return doc, n, "spm", low, high - low, f"<S>{suffix}<P>{prefix}<M>{middle}", text
    return doc, n, "psm", low, high - low, f"<P>{prefix}<S>{suffix}<M>{middle}", text


def order(rows):
    return sorted(map(str, rows))


@pytest.fixture(params=[1 << 20, 7])
def step(request, monkeypatch):
    """Shifts held for few bytes at a time give the same."""
    monkeypatch.setattr(infill, "STEP", request.param)


def test_awkward_rows(spark):
    texts, ids = AWKWARD + MARKED * 8, IDS + list(range(100, 100 + 8 * len(MARKED)))
    made = infill.restored(infill.fill_in_middle(table(spark, texts, ids)))
    assert made.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"]
    want = [by_hand(i, t) for i, t in zip(ids, texts, strict=True)]
    assert order(map(tuple, made.collect())) == order(want)
    assert {w[2] for w in want} == {"plain", "psm", "spm"}


def test_arrays_of_every_form(step):
    """Many ids over a few texts, as arrays without Spark, in steps of few bytes too."""
    rows = [(i, t) for i in range(60) for t in ("", "é", "ab", "日本語 😀 x", "<S>", "x<", ">y", "z" * 40)]
    draws = np.array([[int(hashlib.sha256(f"1:{i}".encode()).hexdigest()[8 * k : 8 * k + 8], 16) for k in range(4)] for i, _ in rows])
    n, forms, low, size, output = infill._transform(pa.array([t for _, t in rows]), list(draws.T))
    back = infill._restore(output, forms)
    got = zip((i for i, _ in rows), *(c.to_pylist() for c in (n, forms, low, size, output, back)), strict=True)
    assert list(got) == [by_hand(i, t) for i, t in rows]


def test_slices_of_arrays():
    """An array that begins inside its buffers is read from where it begins."""
    texts = pa.array(["skipped", "日本語", "", "abc"])[1:]
    data, offsets = infill._bytes_of(texts)
    assert bytes(data).decode() == "日本語abc" and offsets.tolist() == [0, 9, 9, 12]


def test_query(spark, tmp_path):
    rows = as_query(spark, table(spark, AWKWARD, IDS), op12_fill_in_middle, tmp_path)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = [(*w[:5], sha(w[5]), sha(w[6])) for w in (by_hand(i, t) for i, t in zip(IDS, AWKWARD, strict=True))]
    assert order(map(tuple, rows)) == order(want)


def test_empty_table(spark):
    made = infill.restored(infill.fill_in_middle(table(spark, ["x"]).limit(0)))
    assert made.collect() == []


def test_sql(spark):
    folder = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet')")
    want = duck.execute(infill.ORACLE)
    names = [c[0] for c in want.description]
    got = op12_fill_in_middle(spark, folder).select(*names)
    assert order(map(tuple, got.collect())) == order(want.fetchall())
