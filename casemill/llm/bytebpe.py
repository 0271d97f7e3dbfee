"""Byte-level BPE by a sentencepiece model that is written straight from the rank file.

Each rank becomes a piece whose bytes are spelt as printable characters and whose
score is the negative rank, so the library merges the pair of lowest rank first, as
the rank file asks. Nothing is normalised. The text is cut by the pattern, every
distinct part is encoded once per task, and ids are decoded by the inverse spelling.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.llm.text import Cache, Splitter, byte_letters, slices, spelling

OUT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
NORMAL, UNKNOWN, BPE = 1, 2, 2  # the model format's enumeration values


def ranks_of(path: str) -> list[bytes]:
    """The token of each rank; ranks must run from 0 without a gap."""
    with open(path, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    tokens = dict((int(rank), base64.b64decode(token)) for token, rank in pairs)
    if sorted(tokens) != list(range(len(tokens))):
        raise ValueError("ranks must run from 0 without a gap")
    return [tokens[i] for i in range(len(tokens))]


def _field(number: int, value: bytes | int | float) -> bytes:
    """One field of the model's wire format."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def _varint(value: int) -> bytes:
    out = bytearray()
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    return bytes([*out, value])


def serialise(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model: piece i is token i, scored -i; the unknown piece comes last."""
    letters = spelling()

    def piece(text: str, score: float, kind: int) -> bytes:
        return _field(1, _field(1, text.encode()) + _field(2, score) + _field(3, kind))

    body = [piece("".join(letters[b] for b in t), -float(i), NORMAL) for i, t in enumerate(tokens)]
    body.append(piece("⁇", 0.0, UNKNOWN))  # no byte is spelt so
    trainer = _field(3, BPE) + _field(4, len(body))
    identity = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join([*body, _field(2, trainer), _field(3, identity)])


def kind_in_tiktoken() -> Callable[[str], str]:
    """The class of a character in the Unicode tables of the library whose ids are to be met."""
    import tiktoken

    single = {bytes([b]): b for b in range(256)}
    probes = [
        (name, tiktoken.Encoding(f"probe{name}", pat_str=p, mergeable_ranks=single, special_tokens={}))
        for name, p in (("L", r"\p{L}"), ("N", r"\p{N}"), ("S", r"\s"))
    ]
    return lambda char: next((name for name, probe in probes if probe.encode_ordinary(char)), "O")


class Codec:
    """Encodes parts of text to ids and ids back to bytes."""

    def __init__(self, ranks: str, pattern: str):
        import sentencepiece

        self.tokens = ranks_of(ranks)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise(self.tokens))
        self.letters = byte_letters()
        self.split = Splitter(pattern, kind_in_tiktoken())
        values = {c: b for b, c in enumerate(spelling())}
        self.spelt = [
            bytes(values[c] for c in self.model.id_to_piece(i)) for i in range(len(self.tokens))
        ]
        self.cache = Cache(self._encode_parts)

    def _encode_parts(self, parts: list[str]) -> list[tuple[int, ...]]:
        spelt = [p.encode().decode("latin-1").translate(self.letters) for p in parts]
        return list(map(tuple, self.model.encode(spelt, num_threads=1)))

    def encode(self, texts: list[str]) -> Iterator[list[int]]:
        cut = [self.split(t) for t in texts]
        self.cache.need(set(chain.from_iterable(cut)))
        for parts in cut:
            yield list(chain.from_iterable(map(self.cache.__getitem__, parts)))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.spelt.__getitem__, ids))


@lru_cache(1)
def codec_of(ranks: str, pattern: str) -> Codec:
    """One codec per worker process, so that its cache outlives a task."""
    return Codec(ranks, pattern)


def encode_decode(
    docs: DataFrame, ranks: str, pattern: str, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """Ids of every text and the text decoded from them, as counts and digests.

    A null or empty text has no ids. Null and repeated ids are rows like any other.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(ranks, pattern)
        digits = [str(i) for i in range(len(codec.tokens))]
        sha = lambda data: hashlib.sha256(data).hexdigest()
        for batch in slices(batches, 64):
            counts, ids_sha, back_sha = [], [], []
            for ids in codec.encode([t or "" for t in batch.column(1).to_pylist()]):
                counts.append(len(ids))
                ids_sha.append(sha(",".join(map(digits.__getitem__, ids)).encode()))
                back_sha.append(sha(codec.decode(ids)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha), pa.array(back_sha)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text)).mapInArrow(run, OUT)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode_decode(docs, ranks, public_tokenizers.PATTERN)
