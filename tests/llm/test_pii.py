import hashlib
import random
import re
from collections import defaultdict

import pytest

from casemill.llm import pii
from helpers import AWKWARD, IDS, SMALL, as_query, table, texts_of

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PLANTED = [
    "mail a.b+c@d-e.com@f.gh x@y xx@@z.com .@a.b user@host.",
    "999.1.1.1 1.2.3.4.5 01.002.0003.255 1.2.3 300.2.3.4",
    "card 4111 1111-1111 1111 and 4111111111111112 4111  1111 79927398713 0000000000000000000",
    "+1 (017) 555-7713 +12 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 + 1 +49.30.1234567",
    'token = "9233a8ecf7c5b09fe5949719b6b82bc439e9329b" Token="unseen77" token = "words only"',
    "key: abc12345 note: everything plain 2020x5 key: 12",
    *[f'password = "{hashlib.sha1(str(i).encode()).hexdigest()}"' for i in range(12)],
    'password = "hunter2000" and Password  =  "a1b2c3d"',
    *[f"fon: +4930123456{i:02d} text" for i in range(12)],
    "fon: 0301234567",
    *[f"note: word{i}x" for i in range(30)],
    "=" * 5000 + ":" * 50,
]


def brute_base(text):
    found = []
    for order, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card":
                doubled = [int(d) if i % 2 == 0 else sum(map(int, str(2 * int(d)))) for i, d in enumerate(reversed(digits))]
                if not 14 <= len(digits) <= 19 or sum(doubled) % 10:
                    continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            found.append((m.start(), order, m.end()))
    return sorted(found)


def brute(rows):
    """Everything, pattern scores included, by plain loops."""
    base = [brute_base(t or "") for _, t in rows]
    seen = [pii.occurrences(t or "", b) for (_, t), b in zip(rows, base, strict=True)]
    links, seeds = defaultdict(set), {}
    for places in seen:
        for pattern, value, _, _, seed in places:
            links[pattern].add(value)
    per_link = defaultdict(set)
    for places in seen:
        for pattern, value, _, _, seed in places:
            if seed:
                per_link[pattern, value].add(seed)
    seeds = defaultdict(float, {(v, max(k)): 1.0 for (_, v), k in per_link.items()})
    instances, patterns = dict(seeds), {}
    for _ in range(pii.ROUNDS):
        patterns = defaultdict(float)
        for p, values in links.items():
            for (v, kind), s in instances.items():
                if v in values:
                    patterns[p, kind] += s / (len(values) + pii.PRIOR)
        told = dict(seeds)
        for (p, kind), s in patterns.items():
            for v in links[p]:
                told[v, kind] = max(told.get((v, kind), 0.0), s)
        instances = told
    worthy = {}
    for (p, kind), s in patterns.items():
        if s >= pii.WORTH:
            worthy[p] = max(worthy.get(p, (0.0, "")), (s, kind))
    out = []
    for (doc, _), spans, places in zip(rows, base, seen, strict=True):
        more = {
            (a, pii.KINDS.index(worthy[p][1]), b)
            for p, v, a, b, _ in places
            if p in worthy and re.match(r"(?=.*[0-9]).{6,}\Z", v) and not any(x < b and y > a for x, _, y in spans)
        }
        said = lambda some: ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in some)
        counts = [sum(k == i for _, k, _ in spans) for i in range(4)]
        out.append((doc, *counts, hashlib.sha256(said(spans).encode()).hexdigest(), said(sorted([*spans, *more]))))
    return sorted(out, key=str)


@pytest.mark.parametrize("texts", [AWKWARD, PLANTED])
def test_awkward(spark, tmp_path, texts):
    ids = IDS if texts is AWKWARD else list(range(len(texts)))
    rows = as_query(spark, table(spark, texts, ids), pii.op8_pii, tmp_path)
    assert sorted(map(tuple, rows), key=str) == brute(list(zip(ids, texts, strict=True)))


def test_patterns_find_unseen_values(spark):
    rows = {r["doc_id"]: r["spans"] for r in pii.personal_data(table(spark, PLANTED)).collect()}
    assert rows[18] == "secret:12:22,secret:42:49"
    assert rows[31] == "phone:5:15"
    assert all(rows[i] == "" for i in range(32, 62))


def test_long_values_are_whole(spark):
    long = "4f" * 700
    texts = [*PLANTED, f'password = "{long}"', f"see password={long}=x1y2z3w4 end"]
    rows = {r["doc_id"]: r["spans"] for r in pii.personal_data(table(spark, texts)).collect()}
    assert rows[len(PLANTED)] == f"secret:12:{12 + len(long)}"
    places = pii.occurrences(texts[-1], [])
    assert places[0][:2] == ("password=", f"{long}=x1y2z3w4")
    places = pii.occurrences("a=" * 200_000, [])
    assert sum(len(v) for _, v, *_ in places) < 100 * 400_000


def test_base_on_random_texts():
    rng = random.Random(3)
    for _ in range(4000):
        text = "".join(rng.choice("a@@..1123 +-()%") for _ in range(rng.randrange(40)))
        assert pii.base_spans(text) == brute_base(text)
    for _ in range(500):
        text = "".join(rng.choice("0123456789 -+.") for _ in range(rng.randrange(120)))
        assert pii.base_spans(text) == brute_base(text)


def test_table(spark):
    assert sorted(map(tuple, pii.op8_pii(spark, SMALL).collect()), key=str) == brute(texts_of())


def test_empty_table(spark, tmp_path):
    assert as_query(spark, table(spark, []), pii.op8_pii, tmp_path) == []


def test_running_text_patterns(spark):
    calls = [f"please call me at +1 (017) 555-{i:04d} now" for i in range(12)]
    texts = [*calls, "please call me at 0175 550 199 now", "call me at noon4567x now"]
    rows = {r["doc_id"]: r["spans"] for r in pii.personal_data(table(spark, texts)).collect()}
    assert rows[12] == "phone:18:30"
    assert rows[13] == ""


def test_json_and_blanks(spark):
    tokens = [f'{{"token": "{hashlib.sha1(str(i).encode()).hexdigest()}"}}' for i in range(12)]
    phones = [f"phone: +1 (017) 555-{i:04d}" for i in range(12)]
    texts = [*tokens, '{"token": "abc123def"}', *phones, "phone: 0175 550 199"]
    rows = {r["doc_id"]: r["spans"] for r in pii.personal_data(table(spark, texts)).collect()}
    assert rows[12] == "secret:11:20"
    assert rows[25] == "phone:7:19"
    assert pii.occurrences(texts[13], pii.base_spans(texts[13]))[0][:2] == ("phone:", "+1 (017) 555-0000")


def test_candidates_take_linear_time():
    for text in ("x" * 300_000, "1 " * 150_000, "a1" * 150_000, "::" * 150_000, "12 34 " * 50_000, "@" * 300_000, "a=" * 150_000):
        pii.candidates(text, pii.base_spans(text))


def test_long_nested_values(spark):
    secret = lambda i: (hashlib.sha512(str(i).encode()).hexdigest() + "y") * 3
    texts = [f'token={hashlib.sha1(str(i).encode()).hexdigest()}' for i in range(12)]
    texts += [
        f"https://x/cb?state=1&token={secret(1)}",
        f"https://x/cb?state=1&token=abc123def&next={'x1' * 200}#{secret(2)}",
        f"config:token={secret(3)}",
    ]
    rows = {r["doc_id"]: r["spans"] for r in pii.personal_data(table(spark, texts)).collect()}
    assert rows[12] == f"secret:27:{27 + len(secret(1))}"
    assert rows[13] == "secret:27:36"
    assert f"secret:13:{13 + len(secret(3))}" in rows[14]


def test_names_of_long_values():
    value = "ab:cd=" + "e1" * 200 + "=f@g" + "x" * 300
    text = f"see a:b=t={value} end"
    places = {p: v for p, v, *_ in pii.occurrences(text, [])}
    assert places["t="] == pii.named(value) and len(places["t="]) < 50
    assert pii.named(value) != pii.named(value + "y") and pii.named("short") == "short"
    texts = ["a=" * 200_000, "a:" * 200_000, "https://x?" + "a=1234&" * 60_000, "http://" + "a=1.2.3.4/" * 30_000]
    for text in texts:
        places = pii.occurrences(text, pii.base_spans(text))
        assert len(places) > 29_000 and sum(len(v) for _, v, *_ in places) < 100 * len(text)


def test_discovered_spans_beside_base_spans(spark):
    inner = "abcdef0123f" + "4111111111111111" + "fabcdef01234c"
    assert len(inner) == 40 and [(a, k) for a, k, _ in pii.base_spans(inner)] == [(11, 2)]
    texts = [f'token = "{hashlib.sha1(str(i).encode()).hexdigest()}"' for i in range(12)]
    texts += [f'token = "{inner}"', 'token = "9!x.y@host.org!8"']
    frame = table(spark, texts)
    rows = {r["doc_id"]: r["spans"] for r in pii.personal_data(frame).collect()}
    assert rows[12].split(",") == ["secret:9:49", f"card:20:{20 + 16}"]
    assert rows[13].split(",")[0] == "secret:9:25" and "email:11:23" in rows[13]
    assert [o[4] for o in pii.occurrences(texts[12], pii.base_spans(texts[12]))][0] == "secret"
    clean = {r["doc_id"]: r["text"] for r in pii.redacted(frame).collect()}
    assert clean[12] == clean[13] == 'token = "<SECRET>"'


def test_sure_patterns_mark_all_values(spark):
    words = [f'password="{hashlib.sha1(str(i).encode()).hexdigest()}"' for i in range(12)]
    mails = [f"contact: a{i}@b.org" for i in range(12)]
    texts = [*words, 'password="correcthorse"', *mails, "contact: root@localhost", "contact: nobody"]
    rows = {r["doc_id"]: r["spans"] for r in pii.personal_data(table(spark, texts)).collect()}
    assert rows[12] == "secret:10:22"
    assert rows[25] == "email:9:23"
    assert rows[26] == ""
