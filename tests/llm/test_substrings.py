import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from casemill.llm import substrings
from helpers import AWKWARD, IDS, SMALL, as_query, table, texts_of


def want(rows, width=35):
    cut = [(doc, re.findall(r"[^\x20\x09-\x0D]+", text or "")) for doc, text in rows]
    seen = Counter(tuple(w[i : i + width]) for _, w in cut for i in range(len(w) - width + 1))
    out = []
    for doc, words in cut:
        gone = set()
        for i in range(len(words) - width + 1):
            if seen[tuple(words[i : i + width])] > 1:
                gone.update(range(i, i + width))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def test_awkward(spark, tmp_path):
    rows = as_query(spark, table(spark, AWKWARD, IDS), substrings.op2_substring_dedup, tmp_path)
    assert sorted(map(tuple, rows), key=str) == want(list(zip(IDS, AWKWARD, strict=True)))


def test_table(spark):
    rows = substrings.op2_substring_dedup(spark, SMALL).collect()
    assert sorted(map(tuple, rows), key=str) == want(texts_of())


@pytest.mark.parametrize("crowd", [1, 3, 8192])
@pytest.mark.parametrize("seed", range(3))
def test_random_repetitive_texts(spark, seed, crowd):
    """Few different words, so that windows repeat within and between texts in every way."""
    rng = random.Random(seed)
    base = [rng.choice("ab") for _ in range(300)]
    texts = []
    for _ in range(40):
        at = rng.randrange(250)
        texts.append(" ".join([rng.choice("abc")] * rng.randrange(9) + base[at : at + rng.randrange(60)]))
    docs = table(spark, texts)
    every, losing = substrings.repeated_words(docs, 6, 3, crowd=crowd)
    lost = {r["doc_id"]: (r["n_removed"], r["kept"]) for r in losing.collect()}
    for doc, n, removed, sha in want(list(enumerate(texts)), 6):
        row = every.where(F.col("doc_id") == doc).first()
        assert row["n_words"] == n
        gone, kept = lost.get(doc, (0, None))
        assert gone == removed
        assert (hashlib.sha256(kept.encode()).hexdigest() if gone else row["sha"]) == sha


def test_empty_table(spark, tmp_path):
    assert as_query(spark, table(spark, []), substrings.op2_substring_dedup, tmp_path) == []
