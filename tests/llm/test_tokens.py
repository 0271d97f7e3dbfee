import base64
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from casemill.llm import bytebpe, packing, tokencount
from helpers import AWKWARD, IDS, SMALL, as_query, table, texts_of


def want_pieces(rows, capacity=4096):
    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    out = []
    for doc, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            out.append((doc, piece, at, len(part), zlib.crc32(np.asarray(part, "<u4").tobytes())))
    return sorted(out, key=str)


def check_packing(rows, capacity=4096):
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r["length"] for r in rows)
    large = sum(2 * r["length"] > capacity for r in rows)
    return len(held), max(-(-total // capacity), large)


def pieces(rows):
    return sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows), key=str)


def test_packing_awkward(spark, tmp_path):
    rows = as_query(spark, table(spark, AWKWARD, IDS), packing.op1_best_fit_packing, tmp_path)
    assert pieces(rows) == want_pieces(list(zip(IDS, AWKWARD, strict=True)))
    check_packing(rows)


def test_packing_table(spark):
    rows = packing.op1_best_fit_packing(spark, SMALL).collect()
    assert pieces(rows) == want_pieces(texts_of())
    used, least = check_packing(rows)
    assert used <= 1.02 * least + 1


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_everything_once(seed):
    rng = random.Random(seed)
    counts = {rng.randint(1, 100): rng.randint(1, 400) for _ in range(rng.randint(1, 60))}
    held, ranks = defaultdict(list), defaultdict(list)
    for p in packing.plan(counts, 100):
        for rank in range(p.low, p.high):
            at, nth = divmod(rank - p.low, p.per_sequence)
            held[p.first_sequence + at].append((p.offset + nth * p.length, p.length))
            ranks[p.length].append(rank)
    assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in counts.items()}
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 100
        assert sum(3 * n > 100 for _, n in parts) <= 2


def test_ids_on_every_character():
    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    ids = packing.Ids(P.path("word_bpe_49k.json"))
    points = [p for p in range(0x110000) if not 0xD800 <= p < 0xE000]
    texts = ["".join(f"a{chr(p)}1 {chr(p)}{chr(p)}b" for p in points[i : i + 512]) for i in range(0, 0x30000, 512)]
    texts += [t or "" for t in AWKWARD]
    for text, found in zip(texts, ids(texts), strict=True):
        assert np.frombuffer(found, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def reference_codec():
    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def want_codes(rows):
    library = reference_codec()
    out = []
    for doc, text in rows:
        ids = library.encode_ordinary(text or "")
        sha = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        out.append((doc, len(ids), sha, hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=str)


def test_codec_awkward(spark, tmp_path):
    rows = as_query(spark, table(spark, AWKWARD, IDS), bytebpe.op3_byte_bpe, tmp_path)
    assert sorted(map(tuple, rows), key=str) == want_codes(list(zip(IDS, AWKWARD, strict=True)))


def test_codec_table(spark):
    rows = bytebpe.op3_byte_bpe(spark, SMALL).collect()
    assert sorted(map(tuple, rows), key=str) == want_codes(texts_of())


def test_codec_on_every_character():
    """Every code point between letters, digits and spaces, and random bytes of many scripts."""
    library = reference_codec()
    codec = bytebpe.Codec(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    points = [p for p in range(0x110000) if not 0xD800 <= p < 0xE000]
    texts = ["".join(f"a{chr(p)}1 {chr(p)}{chr(p)}b" for p in points[i : i + 512]) for i in range(0, 0x30000, 512)]
    for text, ids in zip(texts, codec.encode(texts), strict=True):
        assert ids == library.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def want_counts(rows, limit=1024):
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    out = []
    for doc, text in rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        out.append((doc, len((text or "").encode()), n, n > limit))
    return sorted(out, key=str)


@pytest.mark.parametrize("head", [0, 20, tokencount.HEAD])
def test_counts_awkward(spark, head):
    docs = table(spark, AWKWARD, IDS)
    rows = tokencount.count_tokens(docs, P.path("byte_bpe_50k.json"), P.PATTERN, head=head).collect()
    assert sorted(map(tuple, rows), key=str) == want_counts(list(zip(IDS, AWKWARD, strict=True)))


def test_counts_table(spark):
    rows = tokencount.op6_token_counts(spark, SMALL).collect()
    assert sorted(map(tuple, rows), key=str) == want_counts(texts_of())


def test_counts_on_every_character(spark):
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    points = [p for p in range(0x110000) if not 0xD800 <= p < 0xE000]
    texts = ["".join(f"a{chr(p)}1 {chr(p)}{chr(p)}b" for p in points[i : i + 512]) for i in range(0, 0x30000, 512)]
    rows = tokencount.count_tokens(table(spark, texts), P.path("byte_bpe_50k.json"), P.PATTERN).collect()
    want = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert [r["n_tokens"] for r in sorted(rows, key=lambda r: r["doc_id"])] == want


@pytest.mark.parametrize(
    "query", [packing.op1_best_fit_packing, bytebpe.op3_byte_bpe, tokencount.op6_token_counts]
)
def test_empty_table(spark, tmp_path, query):
    assert as_query(spark, table(spark, []), query, tmp_path) == []
