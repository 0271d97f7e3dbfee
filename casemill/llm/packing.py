"""Best-fit packing of tokenised documents into sequences of a fixed capacity.

Lengths are whole numbers of at most ``capacity``, so the number of pieces of each
length is all that a plan needs: a table that does not grow with the corpus. The
plan is made from those counts on the driver. Pieces above a third of the capacity
are matched greedily, two to a bin at most; shorter ones go, longest first, where
they leave the smallest gap. Spark then ranks the pieces of each length, in hashed
groups of bounded size, and looks up the place of each rank.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casemill.llm.text import Cache, Splitter, byte_letters, kind_in_tokenizers, slices, stored

GROUP = 512  # pieces ranked in one group
PIECES = (
    "doc_id long, piece int, start long, length long, ids_crc32 long"
)
PLACES = "length long, low long, high long, first_sequence long, per_sequence long, offset long"


@dataclass(frozen=True)
class Place:
    """Ranks ``low`` to ``high`` of one length: ``per_sequence`` in each of consecutive sequences."""

    length: int
    low: int
    high: int
    first_sequence: int
    per_sequence: int
    offset: int


class Ids:
    """Ids of texts, as bytes, by the tokenizer's own parts; each distinct pre-token is merged once."""

    # The tokenizer's cutting pattern.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
    _FAR = re.compile("[^\x00-\u024f]")  # beyond, lower case can depend on what follows

    def __init__(self, tokenizer: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(tokenizer)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.split = Splitter(self.PATTERN, kind_in_tokenizers())
        self.letters = byte_letters()
        self.parts = Cache(self._merge)

    def _merge(self, parts: list[str]) -> list[bytes]:
        merge = self.library.model.tokenize
        spelt = [p.encode().decode("latin-1").translate(self.letters) for p in parts]
        return [array("I", [t.id for t in merge(p)]).tobytes() for p in spelt]

    def _normal(self, text: str) -> str:
        if text.isascii():
            return text.lower()
        if self._FAR.search(text):
            return self.library.normalizer.normalize_str(text)
        return unicodedata.normalize("NFC", text).lower()

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        cut = [None if any(s in t for s in self.special) else self.split(self._normal(t)) for t in texts]
        self.parts.need({p for parts in cut if parts for p in parts})
        for text, parts in zip(texts, cut, strict=True):
            if parts is None:  # special strings count as such: left to the library
                yield array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()
            else:
                yield b"".join(map(self.parts.__getitem__, parts))


@lru_cache(1)
def ids_by(tokenizer: str) -> Ids:
    """One encoder per worker process, so that its cache outlives a task."""
    return Ids(tokenizer)


def token_pieces(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """One row per piece of at most ``capacity`` ids of each document, with a row number.

    A null or empty text is the end id alone. Null and repeated ids are rows like any other.
    """

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = ids_by(tokenizer), array("I", [end_id]).tobytes()
        for batch in slices(batches):
            columns: list[list] = [[], [], [], [], []]
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for doc, ids in zip(batch.column(0).to_pylist(), encode(texts), strict=True):
                packed = ids + end
                for piece, at in enumerate(range(0, len(packed), 4 * capacity)):
                    part = packed[at : at + 4 * capacity]
                    row = (doc, piece, at // 4, len(part) // 4, zlib.crc32(part))
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names
            )

    pieces = docs.select(F.col(key).cast("long"), F.col(text)).mapInArrow(cut, PIECES)
    return pieces.withColumn("row", F.monotonically_increasing_id())


def plan(counts: dict[int, int], capacity: int) -> list[Place]:
    """Places for so many pieces of each length. The driver's work: at most ``capacity`` counts."""
    left = {n: c for n, c in counts.items() if c > 0}
    used = dict.fromkeys(left, 0)
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap: runs of sequences (first, number)
    places: list[Place] = []
    opened = 0

    def put(length: int, pieces: int, first: int, per: int, offset: int) -> None:
        places.append(Place(length, used[length], used[length] + pieces, first, per, offset))
        used[length] += pieces
        left[length] -= pieces

    large = sorted(n for n in left if 3 * n > capacity)
    for longest in reversed(large):
        while left[longest]:
            mate = next(
                (
                    n
                    for n in reversed(large)
                    if n <= min(longest, capacity - longest) and left[n] > (n == longest)
                ),
                None,
            )
            if mate is None:
                number, gap = left[longest], capacity - longest
                put(longest, number, opened, 1, 0)
            elif mate == longest:
                number, gap = left[longest] // 2, capacity - 2 * longest
                put(longest, 2 * number, opened, 2, 0)
            else:
                number, gap = min(left[longest], left[mate]), capacity - longest - mate
                put(longest, number, opened, 1, 0)
                put(mate, number, opened, 1, longest)
            gaps.setdefault(gap, []).append((opened, number))
            opened += number

    for length in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        for gap in sorted(g for g in gaps if g >= length and gaps[g]):
            runs, gaps[gap] = gaps[gap], []
            per = gap // length
            for first, number in runs:
                full = min(number, left[length] // per)
                if full:
                    put(length, full * per, first, per, capacity - gap)
                    gaps.setdefault(gap - per * length, []).append((first, full))
                    first, number = first + full, number - full
                if number and left[length]:  # fewer than a sequence takes
                    some = left[length]
                    put(length, some, first, some, capacity - gap)
                    gaps.setdefault(gap - some * length, []).append((first, 1))
                    first, number = first + 1, number - 1
                if number:
                    gaps[gap].append((first, number))
            if not left[length]:
                break
        if left[length]:
            per = capacity // length
            full, some = divmod(left[length], per)
            if full:
                put(length, full * per, opened, per, 0)
                gaps.setdefault(capacity - per * length, []).append((opened, full))
                opened += full
            if some:
                put(length, some, opened, some, 0)
                gaps.setdefault(capacity - some * length, []).append((opened, 1))
                opened += 1
    return places




def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` (with ``length`` and a unique ``row``) with ``sequence_id`` and ``offset``.

    ``pieces`` should be a stored table, as it is read more than once. An empty table
    gives an empty one.
    """
    spark = pieces.sparkSession
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    groups = spark.createDataFrame(
        [(n, math.ceil(c / GROUP)) for n, c in counts.items()], "length long, groups long"
    )
    places = spark.createDataFrame(
        [tuple(vars(p).values()) for p in plan(counts, capacity)], PLACES
    )
    # Both tables depend on the capacity, not on the number of documents.
    grouped = pieces.join(F.broadcast(groups), "length").withColumn(
        "group", F.pmod(F.xxhash64("row"), F.col("groups"))
    )
    before = Window.partitionBy("length").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        grouped.groupBy("length", "group")
        .count()
        .select("length", "group", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    )
    inner = Window.partitionBy("length", "group").orderBy("row")
    ranked = grouped.withColumn("inner", F.row_number().over(inner) - 1).join(bases, ["length", "group"])
    rank: Column = F.col("base") + F.col("inner")
    placed = ranked.withColumn("rank", rank).join(
        F.broadcast(places.withColumnRenamed("length", "of")),
        (F.col("length") == F.col("of")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")),
    )
    nth = F.col("rank") - F.col("low")
    return placed.select(
        *[F.col(c) for c in pieces.columns if c != "row"],
        (F.col("first_sequence") + F.floor(nth / F.col("per_sequence"))).alias("sequence_id"),
        (F.col("offset") + nth % F.col("per_sequence") * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = 4096, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """Documents cut, where they must be, and packed into as few sequences as the plan finds."""
    return pack(stored(token_pieces(docs, tokenizer, end_id, capacity, text, key), "pieces"), capacity)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
