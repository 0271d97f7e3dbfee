import random
import zlib

import duckdb
import pytest

from casemill.llm import toxicity
from helpers import AWKWARD, IDS, as_query, table

LARGE = "/root/testdata/sf0.1"


def label_table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string, source int")


def test_held_out_accuracy(spark):
    rows = {r["doc_id"]: r for r in toxicity.op7_toxicity(spark, LARGE).collect()}
    labels = duckdb.sql(f"select doc_id, toxic from '{LARGE}/labels.parquet'").fetchall()
    assert len(rows) == 10_000
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows.values())
    held = [(rows[i]["predicted"], toxic) for i, toxic in labels if rows[i]["held_out"]]
    assert len(held) > 500
    assert sum(p == t for p, t in held) >= 0.98 * len(held)
    found = sum(p for p, t in held if t)
    assert found >= 0.9 * sum(t for _, t in held)


def test_held_out_labels_are_not_read(spark, tmp_path):
    docs = table(spark, [f"plain words {i} " + ("awful" if i % 2 else "fine") for i in range(300)])
    toxic = lambda i, flip: (i % 2) ^ (flip and zlib.crc32(str(i).encode()) % 5 == 0)
    found = []
    for flip in (False, True):
        rows = toxicity.toxicity(docs, label_table(spark, [(i, 1, int(toxic(i, flip)), "x", 1) for i in range(300)]))
        found.append(sorted(map(tuple, rows.collect())))
    assert found[0] == found[1]
    assert all(p == i % 2 for i, _, _, p in found[0])


@pytest.mark.parametrize(
    ("text", "folded"),
    [
        ("1diot CL0WN tr@sh l0$er", " idiot clown trash loser "),
        ("тrаsh ѕсuм", " trash scum "),
        ("ｔｒａｓｈ mo​ron", " trash moron "),
        ("trash### 152 A1", " trash a "),
        (None, " "),
        ("", " "),
    ],
)
def test_folding(text, folded):
    assert toxicity.fold(text) == folded


def test_exception_phrases(spark):
    rng = random.Random(1)
    texts, labels = [], []
    for i in range(600):
        words = [f"w{rng.randrange(400)}" for _ in range(20)]
        if i % 3 == 0:
            words[5] = "rotten"
        if i % 12 == 1:
            words[5:7] = ["rotten", "apples"]
        texts.append(" ".join(words))
        labels.append((i, 1, int(i % 3 == 0), "x", 1))
    rows = toxicity.toxicity(table(spark, texts), label_table(spark, labels)).collect()
    assert sum(r["predicted"] == (r["doc_id"] % 3 == 0) for r in rows) >= 590


def test_awkward(spark, tmp_path):
    label_table(spark, [(i, 1, i % 2, "x", 1) for i in IDS if i is not None] + [(None, 1, 1, "x", 1), (3, 1, None, "x", 1)]).write.parquet(
        str(tmp_path / "labels.parquet")
    )
    rows = as_query(spark, table(spark, AWKWARD, IDS), toxicity.op7_toxicity, tmp_path)
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(map(str, IDS))
    assert all(0 <= r["score"] <= 1 for r in rows)


@pytest.mark.parametrize("texts", [[], AWKWARD])
def test_no_labels(spark, tmp_path, texts):
    label_table(spark, []).write.parquet(str(tmp_path / "labels.parquet"))
    rows = as_query(spark, table(spark, texts), toxicity.op7_toxicity, tmp_path)
    assert [r["predicted"] for r in rows] == [0] * len(texts)
