import os
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from casemill.llm import collocations as C
from helpers import AWKWARD, IDS, as_query, table

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def pieces(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
        if words := re.findall(r"[^\x20\x09]+", piece):
            yield words


def by_hand(rows, least=100, top=2000, longest=5):
    n, f = Counter(), Counter()
    for lang, text in rows:
        for words in pieces(text):
            n[lang or "und"] += len(words)
            f.update(
                (lang or "und", tuple(words[i : i + k]))
                for i in range(len(words))
                for k in range(1, longest + 1)
                if i + k <= len(words)
            )
    f = {key: count for key, count in f.items() if count >= least}
    inside = {}
    for (lang, p), count in f.items():
        for i in range(len(p)):
            for k in range(2, len(p)):
                if i + k <= len(p):
                    key = lang, p[i : i + k]
                    inside[key] = max(inside.get(key, 0), count)
    out = {}
    for (lang, p), a in f.items():
        if len(p) < 2 or 100 * inside.get((lang, p), -1) >= 100 * a:
            continue
        cuts = [(f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))]
        score, _, (left, right) = min((1000 * a * n[lang] // (x * y), k, (x, y)) for k, (x, y) in enumerate(cuts))
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    return [
        (lang, rank, p.decode(), -a, left, right, n[lang], -score)
        for lang, found in out.items()
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1)
    ]


def prose(seed=1, texts=120):
    """Few words, so that phrases repeat; long runs without marks; copies."""
    dice = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + ["É", "Straße", "日本", "ab\x00c", "X-Y", "(z)"]
    out = []
    for _ in range(texts):
        run = [dice.choice(words[: dice.choice([3, 18])]) for _ in range(dice.choice([0, 1, 5, 60, 300]))]
        out.append("".join(w + dice.choice([" ", "  ", "\t", " ", " ", ". ", "\r\n", "\x0b!"]) for w in run))
    return out + out[:30] + ["w1 w2 w3 w4 w5 w6 " * 400] * 2


def order(rows):
    return sorted(map(str, map(tuple, rows)))


def docs_of(spark, rows):
    frame = table(spark, [t for _, t in rows])
    langs = spark.createDataFrame([(i, lang) for i, (lang, _) in enumerate(rows)], "doc_id long, l string")
    return frame.drop("lang").join(langs, "doc_id").withColumnRenamed("l", "lang")


@pytest.mark.parametrize("least, longest", [(2, 5), (9, 5), (3, 3)])
def test_against_brute_force(spark, least, longest):
    texts = AWKWARD + prose()
    rows = [(("en", None, "und", "fr")[i % 4], t) for i, t in enumerate(texts)]
    got = C.collocations(docs_of(spark, rows), least=least, longest=longest, top=40)
    want = by_hand(rows, least, 40, longest)
    assert order(got.collect()) == order(want)
    assert {w[0] for w in want} == {"en", "und", "fr"} and max(w[1] for w in want) == 40


def test_a_full_filter_changes_nothing(spark):
    """With a filter of 2 ** 15 bits for many more phrases, all the rest is counted exactly."""
    rows = [("en", t) for t in prose(2)]
    docs = docs_of(spark, rows)
    assert order(C.collocations(docs, least=2, bits=15).collect()) == order(by_hand(rows, 2))


@pytest.mark.parametrize("trigger, size", [(1, 50), (2, 400), (10**9, 1 << 20)])
def test_each_occurrence_is_counted_once(monkeypatch, trigger, size):
    """Whatever begins a chunk, and however the text is dealt to arrays."""
    monkeypatch.setattr(C, "TRIGGER", trigger)
    texts = [t or "" for t in AWKWARD + prose(3, 40)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * len(texts)), pa.array(texts)], ["lang", "text"])
    chunks = pa.Table.from_batches(C._chunked(5, size)([batch]))
    for words in range(1, 6):
        found = Counter()
        for part in C._counted(words, None)(chunks.to_batches()):
            for phrase, f in zip(part.column("phrase").to_pylist(), part.column("f").to_pylist(), strict=True):
                found[phrase] += f
        want = Counter(" ".join(w[i : i + words]) for t in texts for w in pieces(t) for i in range(len(w) - words + 1))
        assert found == want


def test_a_phrase_hashes_alike_wherever_it_stands():
    data = np.frombuffer("xx日本 b日本 b".encode(), np.uint8)
    whole, alone = C._Hashes(data), C._Hashes(data[2:10])
    at = np.array([2, 10]), np.array([10, 18])
    assert len(set([*whole(*at), *alone(np.array([0]), np.array([8]))])) == 1
    assert whole(*at, np.array([1, 2], np.uint64))[0] != whole(*at, np.array([1, 2], np.uint64))[1]


def test_products_beyond_64_bits(spark):
    """Counts of a corpus of 100 TB: all digits of the products count, and ties go to the first cut."""
    n, a, b, c = 16_000_000_000_007, 3_000_000_000_001, 5_000_000_000_011, 7_000_000_000_003
    phrases = spark.createDataFrame(
        [("en", "x", 1, b), ("en", "y", 1, c), ("en", "z", 1, b), ("en", "x y", 2, a), ("en", "y z", 2, a), ("en", "x y z", 3, a - 1)],
        "lang string, phrase string, words int, f long",
    )
    totals = spark.createDataFrame([("en", n)], "lang string, n long")
    rows = {r.phrase: r for r in C.scored(phrases.where("words > 1"), phrases, totals).collect()}
    assert rows["x y"].score == 1000 * a * n // (b * c)
    assert (rows["x y z"].l, rows["x y z"].r) == (b, a)
    assert rows["x y z"].score == 1000 * (a - 1) * n // (b * a)


def test_closed_phrases(spark):
    rows = [("en", "a b c", 3, 100), ("en", "a b", 2, 100), ("en", "b c", 2, 101), ("fr", "a b", 2, 100), ("en", "a", 1, 200)]
    kept = C.closed(spark.createDataFrame(rows, "lang string, phrase string, words int, f long"))
    assert {(r.lang, r.phrase) for r in kept.collect()} == {("en", "a b c"), ("en", "b c"), ("fr", "a b")}


def test_query_and_empty_table(spark, tmp_path):
    texts = ["Alpha beta, gamma"] * 100 + AWKWARD
    rows = as_query(spark, table(spark, texts, list(range(100)) + IDS), C.op11_collocations, tmp_path)
    assert order(rows) == order(by_hand([("en", t) for t in texts]))
    assert any(r.phrase == "alpha beta" and r.a == 100 for r in rows)
    assert C.collocations(table(spark, ["x"]).limit(0)).collect() == []


def test_sql(spark):
    folder = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet')")
    want = duck.execute(C.ORACLE)
    names = [c[0] for c in want.description]
    rows = want.fetchall()
    assert rows and order(C.op11_collocations(spark, folder).select(*names).collect()) == order(rows)
