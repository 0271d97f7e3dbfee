import math
import random

import duckdb
import numpy as np
import pytest

from casemill.llm import topk
from helpers import SMALL

KIND = "vec_id long, embedding array<float>, label int, v string, dim string"


def brute(rows, k=5):
    held = [
        (i, [math.floor(256 * x) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for at, (q, a) in enumerate(held):
        if q % 50 == 0:
            others = [(i, b) for other, (i, b) in enumerate(held) if other != at and len(a) == len(b)]
            scores = [(-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in others]
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def run(spark, rows, tmp_path):
    frame = spark.createDataFrame([(i, v, 0, "x", "y") for i, v in rows], KIND)
    frame.write.parquet(str(tmp_path / "embeddings.parquet"))
    return sorted(map(tuple, topk.op4_exact_top_k(spark, str(tmp_path)).collect()))


@pytest.mark.parametrize("seed", range(2))
def test_ties_and_awkward_rows(spark, tmp_path, seed):
    rng = random.Random(seed)
    hot = [0.5, -0.25, 1.0]
    rows = [(i, hot if i % 3 else [rng.choice([-1.0, 0.0, 0.5, 1.0]) for _ in range(3)]) for i in range(300)]
    rows += [(None, hot), (50, hot), (50, hot), (400, None), (450, [1.0, None, 1.0]), (500, [1.0, float("nan"), 1.0])]
    rows += [(550, [float("inf"), 0.0, 0.0]), (600, [1.0, 2.0]), (601, [2.0, 2.0]), (650, []), (651, []), (-50, [-3.0, -2.5, 0.1])]
    assert run(spark, rows, tmp_path) == brute(rows)


def test_rows_of_one_id(spark, tmp_path):
    """Rows that share an id differ, score with each other, and are asked each for itself."""
    rows = [(50, [1.0, 0.0]), (50, [0.0, 1.0]), (50, [1.0, 0.0]), (7, [2.0, 2.0]), (7, [2.0, 2.0]), (0, [0.5, 0.5])]
    got = run(spark, rows, tmp_path)
    assert got == brute(rows)
    assert got.count((50, 1, 7, 131072)) == 3 and (50, 3, 50, 65536) in got


def test_large_components(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-1, 1) * 2.0 ** rng.randrange(22) for _ in range(4)]) for i in range(60)]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    assert run(spark, rows, tmp_path) == brute(rows)


def test_many_blocks(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(topk, "ROWS", 7)
    monkeypatch.setattr(topk, "QUERIES", 2)
    monkeypatch.setattr(topk, "BITS", 3)
    rng = random.Random(9)
    rows = [(i, [rng.choice([0.1, 0.2, -0.3]) for _ in range(5)]) for i in range(260)]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    assert run(spark, rows, tmp_path) == brute(rows)


def test_blocks_are_never_broadcast(spark, monkeypatch, tmp_path):
    """The planner takes the sets of queries for small, as it counts none of their copies."""
    monkeypatch.setattr(topk, "ROWS", 7)
    paired, each = [], topk._each
    monkeypatch.setattr(topk, "_each", lambda frame, *rest: paired.append(frame) or each(frame, *rest))
    rows = [(i, [float(i % 7), 1.0]) for i in range(200)]
    assert run(spark, rows, tmp_path) == brute(rows)
    assert paired
    for frame in paired:
        frame.collect()
        final = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        joins = [line for line in final.splitlines() if "Join" in line]
        assert "SortMergeJoin [dim" in joins[0]


def test_few_and_none(spark, tmp_path):
    assert run(spark, [(0, [1.0]), (3, [2.0])], tmp_path / "a") == [(0, 1, 3, 131072)]
    assert run(spark, [], tmp_path / "b") == []


def test_table(spark):
    rows = duckdb.sql(f"select vec_id, embedding from '{SMALL}/embeddings.parquet'").fetchall()
    assert sorted(map(tuple, topk.op4_exact_top_k(spark, SMALL).collect())) == brute(rows)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SMALL}/embeddings.parquet')")
    assert sorted(duck.execute(topk.ORACLE).fetchall()) == brute(rows)
