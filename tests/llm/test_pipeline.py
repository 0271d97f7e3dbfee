"""Every stage against plain loops over small tables, and the whole over the smallest one."""

import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from casemill.llm import hostrules
from helpers import AWKWARD, IDS, PASSAGE, SMALL, table
from test_hostrules import own_points
from test_neardup import want as components
from test_pii import brute as personal
from test_tokens import check_packing

WORD = r"[^\x20\x09-\x0D]+"
EXTRA = [
    PASSAGE,
    PASSAGE + " more",
    PASSAGE + " more",
    " ".join(f"a{i}" for i in range(50)) + " x@y.org and " + " ".join(f"b{i}" for i in range(40)),
    " ".join(f"c{i}" for i in range(50)) + " " + " ".join(f"b{i}" for i in range(40)),
    " ".join(f"#{i}$" for i in range(60)),
    " ".join(f"d{i}" for i in range(60)) + " +1 (017) 555-7713",
    " ".join(f"d{i}" for i in range(60)) + " +1 (017) 555-7713",
]


def rows_of(frame):
    return [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]


def quality(rows, hosts):
    """Two points or the base rule reject; the hosts of these tables are too even to be condemned."""
    out = []
    for doc, text in rows:
        points, failed = own_points(text)
        if not failed and sum(points) < 2:
            out.append((doc, text))
    return out


def near(rows):
    kept, seen = [], set()
    state = {}
    for doc, _, component, _ in components(rows, 5):
        state[doc] = component
    for doc, text in rows:
        if doc is None:
            kept.append((doc, text))
        elif state[doc] == doc and doc not in seen:
            seen.add(doc)
            kept.append((doc, text))
    return kept


def substring(rows, width=35):
    cut = [(doc, text, re.findall(WORD, text or "")) for doc, text in rows]
    seen = Counter(tuple(w[i : i + width]) for _, _, w in cut for i in range(len(w) - width + 1))
    out = []
    for doc, text, words in cut:
        gone = {j for i in range(len(words) - width + 1) if seen[tuple(words[i : i + width])] > 1 for j in range(i, i + width)}
        left = [w for j, w in enumerate(words) if j not in gone]
        if not gone or left:
            out.append((doc, " ".join(left) if gone else text))
    return out


def privacy(rows):
    out = []
    for doc, text in rows:
        spans = [s.split(":") for s in personal([(doc, text)])[0][-1].split(",") if s]
        new, at = "", 0
        for kind, a, b in spans:
            if int(a) >= at:
                new += text[at : int(a)] + f"<{kind.upper()}>"
            at = max(at, int(b))
        out.append((doc, new + text[at:] if spans else text))
    return out


def ids(rows):
    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    out = []
    for doc, text in rows:
        found = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(found), 4096)):
            part = np.asarray(found[at : at + 4096], "<u4")
            out.append((doc, piece, at, len(part), zlib.crc32(part.tobytes())))
    return sorted(out, key=str)


def same(frame, rows):
    assert sorted(rows_of(frame), key=str) == sorted(rows, key=str)


@pytest.mark.parametrize("texts", [EXTRA, AWKWARD])
def test_stages(spark, texts):
    base = table(spark, texts, IDS if texts is AWKWARD else [4, 9, 2, 3, 5, 6, 7, 7])
    plain = [(r["doc_id"], r["text"]) for r in base.collect()]
    for stage, want in (
        (corpus_pipeline.near_dedup, near),
        (corpus_pipeline.substring_dedup, substring),
        (corpus_pipeline.privacy, privacy),
    ):
        frame = stage(spark, base, SMALL)
        assert frame.columns == base.columns
        same(frame, want(plain))
        assert all(r["n_chars"] == len(r["text"] or "") for r in frame.collect())
    frame = corpus_pipeline.quality(spark, base, SMALL)
    assert frame.columns == base.columns
    verdicts = hostrules.quality_verdicts(base).where("kept")
    assert sorted(str(r["doc_id"]) for r in frame.collect()) == sorted(str(r["doc_id"]) for r in verdicts.collect())
    rows = corpus_pipeline.pack(spark, base, SMALL).collect()
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows), key=str) == ids(plain)


def test_whole(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = rows_of(docs)
    for step in (lambda r: quality(r, None), near, substring, privacy):
        rows = step(rows)
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=str) == ids(rows)
    check_packing(got)


def test_empty(spark):
    docs = table(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SMALL).collect() == []
