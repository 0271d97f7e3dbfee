import itertools
import random
import re
import statistics
from collections import Counter

import duckdb
import pytest

from casemill.llm import hostrules
from helpers import AWKWARD, IDS, SMALL, as_query, table


def repeated(words):
    seen = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    gone = set()
    for i in range(len(words) - 7):
        if seen[tuple(words[i : i + 8])] > 1:
            gone.update(range(i, i + 8))
    return len(gone)


def want(doc, text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = repeated(words)
    return (
        doc,
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        n,
        len(words) < 20 or 100 * n > 30 * len(words),
    )


COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def sql_rows(folder):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}')")
    cursor = duck.execute(hostrules.ORACLE)
    names = [c[0] for c in cursor.description]
    return sorted((tuple(r[names.index(c)] for c in [*COLUMNS, "kept"]) for r in cursor.fetchall()), key=str)


def test_awkward(spark, tmp_path):
    frame = table(spark, AWKWARD, IDS)
    rows = as_query(spark, frame, hostrules.op9_quality_rules, tmp_path)
    got = sorted((tuple(r[c] for c in COLUMNS) for r in rows), key=str)
    assert got == sorted((want(i, t) for i, t in zip(IDS, AWKWARD, strict=True)), key=str)
    whole = sorted((tuple(r[c] for c in [*COLUMNS, "kept"]) for r in rows), key=str)
    assert whole == sql_rows(tmp_path / "documents.parquet/*.parquet")


def test_random_repeats(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randrange(80))) for _ in range(60)]
    rows = hostrules.measures(table(spark, texts).select("doc_id", "text")).collect()
    for r in rows:
        assert r["n_repeat_words"] == repeated(r["text"].split())


def own_points(text):
    """Points per rule, and whether the base rule fails, by plain loops."""
    _, n, chars, symbols, dup, repeat, failed = want(0, text)
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    bare = sum(not any(c.isascii() and c.isalpha() or c > "\x7f" for c in w) for w in words)
    opened = sum(x.rstrip(" \t\n\x0b\x0c\r").endswith(("...", "…")) for x in lines)
    return [
        (10 * symbols > n) + (5 * symbols > n),
        (10 * dup > 3 * len(lines)) + (10 * dup > 6 * len(lines)),
        (chars < 3 * n or chars > 12 * n) + (2 * chars < 3 * n or chars > 24 * n),
        (10 * bare > 3 * n) + (10 * bare > 6 * n),
        (10 * opened > 3 * len(lines)) + (10 * opened > 6 * len(lines)),
    ], failed


def brute(rows):
    """(doc, text, host) -> kept, with the pairs of every host counted one by one."""
    points = [own_points(t) for _, t, _ in rows]
    hosts = sorted({h or "" for _, _, h in rows})
    members = {h: [i for i, r in enumerate(rows) if (r[2] or "") == h] for h in hosts}
    condemned = set()
    for rule in range(6):
        fails = [p[rule] > 0 if rule < 5 else failed for p, failed in points]
        rate = statistics.fmean(statistics.fmean(fails[i] for i in m) for m in members.values())
        pairs = [[fails[i] and fails[j] for i, j in itertools.permutations(m, 2)] for m in members.values() if len(m) > 1]
        between = statistics.fmean(map(statistics.fmean, pairs)) - rate**2 if pairs else 0
        if not 0 < rate < 1 or between <= 1e-12:
            continue
        weight = max(rate * (1 - rate) / between - 1, 0)
        for h, m in members.items():
            f, n = sum(fails[i] for i in m), len(m)
            if f and n > 1 and (f - 1 + rate * weight) / (n - 1 + weight) >= max(0.2, 2 * rate):
                condemned.add((h, rule))
    out = []
    for (doc, _, h), (p, failed) in zip(rows, points, strict=True):
        more = sum((h or "", r) in condemned and p[r] > 0 for r in range(5)) + ((h or "", 5) in condemned and sum(p) > 0)
        out.append((doc, not failed and sum(p) + more < 2))
    return sorted(out)


CLEAN = " ".join(f"word{i}" for i in range(40))
SINGLE = CLEAN + " ######"
SHORT = "too short"
OPENED = "\n".join([CLEAN + " ..."] * 2 + [CLEAN + f" line {i}" for i in range(3)])
BARE = CLEAN + " 12 34 - 56 78 . 90 11 ; 22 33 44 55 66 77 88 99 00 10 20 30"


def kept(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return sorted((r["doc_id"], r["kept"]) for r in hostrules.quality_verdicts(docs).collect())


def numbered(pairs):
    return [(i, t, h) for i, (t, h) in enumerate(pairs)]


def test_condemned_host(spark):
    """One failure passes on a clean host and not on a host of failures; clean documents stay."""
    rows = numbered([(CLEAN, f"h{i % 20}") for i in range(400)] + [(SINGLE, "bad")] * 30 + [(CLEAN, "bad"), (SINGLE, "h1")])
    got = dict(kept(spark, rows))
    assert got == dict(brute(rows))
    assert all(got[i] for i in range(400)) and not any(got[i] for i in range(400, 430)) and got[430] and got[431]


def test_small_hosts_are_not_condemned(spark):
    """400 hosts of one document, 20 of them with a point: all stay, also beside a host that is bad."""
    rows = numbered([(SINGLE if i < 20 else CLEAN, f"h{i}") for i in range(400)])
    assert all(k for _, k in kept(spark, rows))
    more = rows + [(1000 + i, SINGLE if i % 2 else CLEAN, "bad") for i in range(200)]
    got = dict(kept(spark, more))
    assert got == dict(brute(more))
    assert all(got[i] for i in range(400)) and not any(got[i] for i in range(1001, 1200, 2)) and got[1000]


def test_a_host_of_base_failures(spark):
    """Where most documents fail the base rule, a point of any rule rejects."""
    rows = numbered([(CLEAN, f"h{i % 10}") for i in range(200)] + [(SHORT, "spam")] * 40 + [(t, "spam") for t in (CLEAN, OPENED, BARE, SINGLE)])
    got = dict(kept(spark, rows))
    assert got == dict(brute(rows))
    assert got[240] and not got[241] and not got[242] and not got[243]


@pytest.mark.parametrize("seed", range(3))
def test_hosts_of_all_sizes(spark, tmp_path, seed):
    """Random hosts of one to a hundred documents against loops and against SQL."""
    dice = random.Random(seed)
    texts = [CLEAN, SINGLE, OPENED, BARE, SHORT, SINGLE + " " + BARE, None, CLEAN + " ######" * 3]
    pairs = []
    for h in range(60):
        weights = [dice.random() * (8 if i == 0 else dice.choice([0.05, 0.05, 3])) for i in range(len(texts))]
        pairs += [(t, dice.choice([f"h{h}"] * 20 + [None])) for t in dice.choices(texts, weights, k=dice.choice([1, 1, 2, 5, 30, 100]))]
    rows = numbered(pairs)
    assert kept(spark, rows) == brute(rows)
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(str(tmp_path / "docs"))
    assert [(r[0], r[-1]) for r in sorted(sql_rows(f"{tmp_path}/docs/*.parquet"))] == brute(rows)


def test_plan_has_no_python(spark):
    plan = hostrules.measures(spark.read.parquet(f"{SMALL}/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("host", ["source", "lang"])
def test_empty_table(spark, host):
    assert hostrules.quality_verdicts(table(spark, []), host=host).collect() == []
