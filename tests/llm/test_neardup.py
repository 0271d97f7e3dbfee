import random
import re

import pytest

from casemill.llm import neardup
from helpers import AWKWARD, IDS, SMALL, as_query, table, texts_of


def sets_of(texts, ngram):
    out = []
    for text in texts:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
        width = min(ngram, len(words))
        out.append({tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set())
    return out


def want(rows, ngram=2, percent=80):
    sets = sets_of([t for _, t in rows], ngram)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None:
                if 100 * len(a & b) >= percent * len(a | b):
                    root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    out = []
    for i, (doc, _) in enumerate(rows):
        component = None if doc is None else least[find(i)]
        out.append((doc, len(sets[i]), component, doc is None or doc == component))
    return sorted(out, key=str)


def test_awkward(spark, tmp_path):
    rows = as_query(spark, table(spark, AWKWARD, IDS), neardup.op5_minhash_near_dedup, tmp_path)
    assert sorted(map(tuple, rows), key=str) == want(list(zip(IDS, AWKWARD, strict=True)))


def test_table(spark):
    rows = neardup.op5_minhash_near_dedup(spark, SMALL).collect()
    assert sorted(map(tuple, rows), key=str) == want(texts_of())


@pytest.mark.parametrize(("seed", "ngram"), [(0, 2), (1, 5), (2, 2)])
def test_chains_of_near_copies(spark, seed, ngram):
    """Families in which few members are alike to a given one, so that one hub does not do."""
    rng = random.Random(seed)
    texts = []
    for _ in range(12):
        words = [f"{rng.randrange(500)}" for _ in range(rng.choice([3, 12, 60, 200]))]
        for _ in range(rng.randrange(1, 25)):
            words = list(words)
            for _ in range(rng.randrange(1 + len(words) // 20)):
                words[rng.randrange(len(words))] = f"{rng.randrange(500)}"
            texts.append(" ".join(words))
    rng.shuffle(texts)
    rows = neardup.near_duplicates(table(spark, texts), ngram=ngram).drop("hash").collect()
    assert sorted(map(tuple, rows), key=str) == want(list(enumerate(texts)), ngram)


def test_empty_table(spark, tmp_path):
    assert as_query(spark, table(spark, []), neardup.op5_minhash_near_dedup, tmp_path) == []
