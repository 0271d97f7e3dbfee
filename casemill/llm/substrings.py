"""Removal of word sequences that occur again anywhere, by super-k-mer partitioning.

A window is a run of ``width`` consecutive words. Its minimiser is its run of
``grain`` words with the least hash. Consecutive windows whose minimiser stands in the
same place form a super-k-mer, which travels as one packed string to the bucket of
that minimiser. Equal windows have equal minimisers, and windows of one super-k-mer
have their minimiser at different distances, so two equal windows always lie in two
super-k-mers of one bucket. Hence:

1. a first pass keeps only the minimisers' hashes; a minimiser that occurs once
   cannot belong to a repeated window, and its super-k-mer never travels;
2. the others are packed; equal strings are first counted where they are made;
3. each bucket's distinct strings meet, and sorting their windows tells which occur twice;
4. a bucket with more than ``CROWD`` distinct strings is dealt by window instead.

Identity is a document's id with a hash of its text, so repeated rows stay apart from
rows that only share an id; null ids are an id of their own here.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.llm.text import Cache, slices, stored, words_of

WIDTH = 35
GRAIN = 12
CROWD = 8192
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _sha(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


class Cutter:
    """Super-k-mers of word lists."""

    def __init__(self, width: int, grain: int):
        if not 0 < grain <= width:
            raise ValueError("grain must be between 1 and width")
        self.width, self.grain = width, grain
        self.hashes = Cache(lambda words: [xxhash.xxh3_64_intdigest(w) for w in words])

    def __call__(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The minimiser of each super-k-mer, and its first window; the last window is known."""
        windows = len(words) - self.width + 1
        if windows < 1:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        one = np.fromiter(map(self.hashes.__getitem__, words), np.uint64, len(words))
        grams = one[: len(words) - self.grain + 1].copy()
        for i in range(1, self.grain):
            grams *= _ODD
            grams += one[i : i + len(grams)]
        grams ^= grams >> np.uint64(29)
        grams *= _ODD
        grams ^= grams >> np.uint64(32)
        across = self.width - self.grain + 1
        views = np.lib.stride_tricks.sliding_window_view(grams, across)
        at = views.argmin(1) + np.arange(windows)  # the first of equal ones
        firsts = np.flatnonzero(np.diff(at, prepend=-1))
        return grams[at[firsts]].view(np.int64), firsts


def _cut_pass(docs: DataFrame, width: int, grain: int) -> DataFrame:
    """Per row: number of words, digest of all of them, minimisers."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Cutter(width, grain)
        for batch in slices(batches):
            texts = [words_of(t) for t in batch.column(2).to_pylist()]
            cutter.hashes.need(set().union(*texts))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([len(w) for w in texts], pa.int64()),
                    pa.array([_sha(w) for w in texts]),
                    pa.array([cutter(w)[0] for w in texts], pa.list_(pa.int64())),
                ],
                ["doc_id", "hash", "n_words", "sha", "minimisers"],
            )

    return docs.mapInArrow(
        run, "doc_id long, hash long, n_words long, sha string, minimisers array<long>"
    )


def _strings(rows: DataFrame, width: int, grain: int) -> DataFrame:
    """The flagged super-k-mers of ``rows`` (text, numbers) as packed strings."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Cutter(width, grain)
        for batch in slices(batches, 128):
            rows_here, texts, flagged = (c.to_pylist() for c in batch.columns)
            cut = [words_of(t) for t in texts]
            cutter.hashes.need(set().union(*cut))
            out: list[list] = [[], [], [], [], []]
            for own, words, numbers in zip(rows_here, cut, flagged, strict=True):
                minimisers, firsts = cutter(words)
                ends = [*firsts[1:].tolist(), len(words) - width + 1]
                for k in sorted(numbers):
                    first = int(firsts[k])
                    packed = b" ".join(words[first : ends[k] + width - 1])
                    row = (own, first, int(minimisers[k]), xxhash.xxh3_128_digest(packed), packed)
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
            names = ["row", "first", "minimiser", "digest", "packed"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, types, strict=True)], names
            )

    return rows.select("row", "text", "numbers").mapInArrow(
        run, "row long, first int, minimiser long, digest binary, packed binary"
    )


def _windows(packed: bytes, width: int) -> list[bytes]:
    words = packed.split(b" ")
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    return [packed[starts[i] : starts[i + width] - 1] for i in range(len(words) - width + 1)]


def _runs(numbers: list[int]) -> list[int]:
    """Sorted numbers as runs: first, past the last, first, past the last, ..."""
    out: list[int] = []
    for n in numbers:
        if out and out[-1] == n:
            out[-1] = n + 1
        else:
            out += [n, n + 1]
    return out


RANGES = "digest binary, runs array<int>"


def _bucket_runs(strings: DataFrame, width: int) -> DataFrame:
    """Per distinct string, the windows that occur twice in its bucket.

    ``strings``: minimiser, digest, packed, n (how often the string occurs), with no
    more than ``CROWD`` strings per minimiser.
    """

    def settle(bucket: list[tuple[bytes, bytes, int]]) -> Iterator[tuple[bytes, list[int]]]:
        if len(bucket) == 1:
            digest, packed, n = bucket[0]
            if n > 1:
                yield digest, [0, packed.count(b" ") + 2 - width]
            return
        rows = sorted(
            (window, k, i) for k, (_, packed, _) in enumerate(bucket) for i, window in enumerate(_windows(packed, width))
        )
        found: dict[int, list[int]] = {}
        for at, (window, k, i) in enumerate(rows):
            if (
                bucket[k][2] > 1
                or (at and rows[at - 1][0] == window)
                or (at + 1 < len(rows) and rows[at + 1][0] == window)
            ):
                found.setdefault(k, []).append(i)
        for k, numbers in found.items():
            yield bucket[k][0], _runs(sorted(numbers))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, bucket = None, []
        for batch in slices(batches, 1024):
            done: list[tuple[bytes, list[int]]] = []
            for minimiser, digest, packed, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if minimiser != current:
                    done += settle(bucket) if bucket else ()
                    current, bucket = minimiser, []
                bucket.append((digest, packed, n))
            yield _ranges(done)
        if bucket:
            yield _ranges(list(settle(bucket)))

    def _ranges(done: list[tuple[bytes, list[int]]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([d for d, _ in done], pa.binary()), pa.array([r for _, r in done], pa.list_(pa.int32()))],
            ["digest", "runs"],
        )

    return (
        strings.select("minimiser", "digest", "packed", "n")
        .repartition("minimiser")
        .sortWithinPartitions("minimiser")
        .mapInArrow(run, RANGES)
    )


def _crowded_runs(strings: DataFrame, width: int) -> DataFrame:
    """As ``_bucket_runs`` for crowded buckets: each window goes its own way, as a 128-bit digest."""

    def unpack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            out: list[list] = [[], [], [], []]
            for _, digest, packed, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for i, window in enumerate(_windows(packed, width)):
                    for column, value in zip(out, (digest, i, xxhash.xxh3_128_digest(window), n), strict=True):
                        column.append(value)
            types = (pa.binary(), pa.int32(), pa.binary(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, types, strict=True)], ["digest", "number", "window", "n"]
            )

    windows = strings.select("minimiser", "digest", "packed", "n").mapInArrow(
        unpack, "digest binary, number int, window binary, n long"
    )
    repeated = windows.groupBy("window").agg(F.sum("n").alias("all")).where("all > 1").select("window")
    numbers = windows.join(repeated, "window").groupBy("digest").agg(F.sort_array(F.collect_list("number")).alias("m"))
    pairs = F.transform("m", lambda i: F.array(i, i + 1))
    return numbers.select("digest", F.flatten(pairs).alias("runs"))


def repeated_words(
    docs: DataFrame, width: int = WIDTH, grain: int = GRAIN, text: str = "text", key: str = "doc_id", crowd: int = CROWD
) -> tuple[DataFrame, DataFrame]:
    """(every row with n_words and the digest of all its words; the rows that lose words).

    The second has doc_id, hash, text, n_removed and ``kept``, the words left, joined by
    one space; repeated rows may stand there more than once. Both have ``hash``, a hash
    of the text. A null text has no words.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(text).alias("hash"), F.col(text).alias("text"))
    # Row numbers of stored tables stand for the two keys in what is shuffled.
    cut = stored(_cut_pass(rows, width, grain).withColumn("row", F.monotonically_increasing_id()), "minimisers")
    each = cut.select("row", F.posexplode("minimisers").alias("number", "minimiser"))
    # A table of its own: the join then deals both sides itself and may split a frequent minimiser.
    twice = stored(each.groupBy("minimiser").count().where("count > 1").select("minimiser"), "repeated")
    flagged = each.join(twice, "minimiser").groupBy("row").agg(F.collect_set("number").alias("numbers"))
    flagged = cut.select("row", "doc_id", "hash").join(flagged, "row").drop("row")
    flagged = flagged.dropDuplicates(["doc_id", "hash"])  # repeated rows have the same minimisers
    same: Column = F.col("r.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("r.hash") == F.col("f.hash"))
    held = stored(
        rows.alias("r")
        .join(flagged.alias("f"), same)
        .select("r.doc_id", "r.hash", "r.text", "f.numbers", F.monotonically_increasing_id().alias("row")),
        "flagged",
    )
    strings = _strings(held, width, grain)
    # One table for both uses: where each string stands, and what it is.
    strings = stored(strings, "super-k-mers")
    distinct = stored(
        strings.groupBy("minimiser", "digest").agg(F.count("*").alias("n"), F.first("packed").alias("packed")),
        "distinct",
    )
    sizes = distinct.groupBy("minimiser").agg(F.count("*").alias("strings"), F.sum("n").alias("all"))
    crowded = sizes.where(F.col("strings") > crowd).select("minimiser")
    few = distinct.join(crowded, "minimiser", "left_anti")
    runs = _bucket_runs(few, width).unionByName(_crowded_runs(distinct.join(crowded, "minimiser", "left_semi"), width))
    spans = (
        strings.select("row", "first", "digest")
        .join(runs, "digest")
        .groupBy("row")
        .agg(F.flatten(F.collect_set(F.transform("runs", lambda i: i + F.col("first")))).alias("runs"))
    )
    losing = held.drop("numbers").join(spans, "row").select("doc_id", "hash", "text", "runs")

    def remove(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 128):
            kept, removed = [], []
            for whole, runs in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                words = words_of(whole)
                mark = np.zeros(len(words) + 1, np.int32)
                np.add.at(mark, np.asarray(runs[::2]), 1)
                np.add.at(mark, np.asarray(runs[1::2]) + width - 1, -1)
                stay = np.cumsum(mark)[:-1] == 0
                removed.append(int(len(words) - stay.sum()))
                kept.append(b" ".join(words[i] for i in np.flatnonzero(stay)).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                ["doc_id", "hash", "n_removed", "kept"],
            )

    return cut.drop("minimisers", "row"), losing.mapInArrow(remove, "doc_id long, hash long, n_removed long, kept string")


def without_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` less the words in repeated windows; a changed text has its words joined by one space.

    A row that loses all its words goes; one that had none stays as it is.
    """
    _, losing = repeated_words(docs, text=text, key=key)
    losing = losing.select("doc_id", "hash", F.col("kept").alias("_kept")).dropDuplicates(["doc_id", "hash"])
    rows = docs.select(F.struct(*docs.columns).alias("d"), F.xxhash64(text).alias("h"))
    same = F.col(f"d.{key}").eqNullSafe(F.col("doc_id")) & (F.col("h") == F.col("hash"))
    new = F.coalesce("_kept", f"d.{text}").alias(text)
    return (
        rows.join(losing, same, "left")
        .where("_kept IS NULL OR _kept <> ''")
        .select(*[new if c == text else F.col(f"d.{c}") for c in docs.columns])
    )


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    every, losing = repeated_words(docs)
    losing = losing.select("doc_id", "hash", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("sha"))
    losing = losing.dropDuplicates(["doc_id", "hash"])
    same = F.col("e.doc_id").eqNullSafe(F.col("l.doc_id")) & (F.col("e.hash") == F.col("l.hash"))
    return (
        every.alias("e")
        .join(losing.alias("l"), same, "left")
        .select(
            "e.doc_id",
            "n_words",
            F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
            F.coalesce("l.sha", "e.sha").alias("kept_sha256"),
        )
    )
