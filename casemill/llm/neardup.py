"""Near-duplicate documents by one-permutation MinHash, and their components.

Texts with equal shingle sets form one class, and only classes are compared. A class is
sketched by one hash per shingle: the hash's leading bits choose a bin, and each bin
keeps its least value; empty bins borrow from bins drawn by a fixed hash until a full
one is met (optimal densification). Four bins make a band, and classes that agree on a
band share a bucket. ``bands`` times ``rows`` values find a pair of similarity 0.8 with a
probability above 0.999999.

Within a bucket each class is compared with two hubs only, on the full shingle sets, so
the pairs are bounded by the buckets' members. Links make components. A bucket whose
members then lie in one component is settled. The members of the others meet in blocks of
bounded size, where intersections are counted for pairs across components, each in the
first band they share; what passes is confirmed on the full sets. So no candidate pair of
two components stays unchecked, whatever a bucket's size, and no list of pairs is made.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.llm.text import Cache, slices, stored

BINS, ROWS = 128, 4
BLOCK = 1024  # members of one side of a block
_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def lower_words(text: str | None) -> list[bytes]:
    """Words with A-Z lowered and no other letter changed."""
    return text.encode().lower().split() if text else []


def shingles(words: list[bytes], ngram: int) -> set[tuple[bytes, ...]]:
    """The distinct runs of ``ngram`` words; of fewer words, the whole; of none, nothing."""
    if not words:
        return set()
    return set(zip(*(words[i:] for i in range(min(ngram, len(words)))), strict=False))


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * _MIX
    values = (values ^ (values >> np.uint64(27))) * _ODD
    return values ^ (values >> np.uint64(31))


@lru_cache(4)
def _draws(bins: int, tries: int = 8192) -> np.ndarray:
    """For each try and bin, the bin to borrow from."""
    seeds = np.arange(bins * tries, dtype=np.uint64).reshape(tries, bins)
    return (_mixed(seeds * _ODD + np.uint64(1)) % np.uint64(bins)).astype(np.int64)


class Sketcher:
    def __init__(self, ngram: int, bins: int, rows: int):
        if bins & (bins - 1) or bins % rows:
            raise ValueError("bins must be a power of two and a multiple of rows")
        self.ngram, self.bins, self.rows = ngram, bins, rows
        self.shift = np.uint64(64 - bins.bit_length() + 1)
        self.hashes = Cache(lambda words: [xxhash.xxh3_64_intdigest(w) for w in words])

    def hashed(self, words: list[bytes]) -> np.ndarray:
        """The distinct shingles' hashes, sorted."""
        one = np.fromiter(map(self.hashes.__getitem__, words), np.uint64, len(words))
        width = min(self.ngram, len(words))
        out = np.full(len(words) - width + 1, width, np.uint64)
        for i in range(width):
            out *= _ODD
            out += one[i : i + len(out)]
        return np.unique(_mixed(out))

    def bands(self, hashes: np.ndarray) -> np.ndarray:
        place = (hashes >> self.shift).astype(np.int64)
        first = np.flatnonzero(np.diff(place, prepend=-1))
        values, full = np.zeros(self.bins, np.uint64), np.zeros(self.bins, bool)
        values[place[first]], full[place[first]] = hashes[first], True
        empty = np.flatnonzero(~full)
        if len(empty):
            for draw in _draws(self.bins):
                found = full[draw[empty]]
                values[empty[found]] = values[draw[empty[found]]]
                empty = empty[~found]
                if not len(empty):
                    break
            values[empty] = values[place[first[0]]]  # so unlikely as to need no better rule
        values = values.reshape(-1, self.rows)
        out = np.arange(1, len(values) + 1, dtype=np.uint64)
        for column in values.T:
            out = _mixed(out * _ODD + column)
        return out.view(np.int64)


SKETCH = "doc_id long, hash long, n_shingles long, set_key binary, bands array<long>"


def sketches(docs: DataFrame, ngram: int, bins: int, rows: int, text: str, key: str) -> DataFrame:
    """One row per document. An empty set gets a key of its own length that no other row has."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher = Sketcher(ngram, bins, rows)
        for batch in slices(batches):
            texts = [lower_words(t) for t in batch.column(2).to_pylist()]
            sketcher.hashes.need(set().union(*texts))
            sizes, keys, bands = [], [], []
            for words, doc in zip(texts, batch.column(0).to_pylist(), strict=True):
                if words:
                    found = sketcher.hashed(words)
                    sizes.append(len(found))
                    keys.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                    bands.append(sketcher.bands(found))
                else:
                    sizes.append(0)
                    keys.append(struct.pack("<q", doc or 0))
                    bands.append(None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                ["doc_id", "hash", "n_shingles", "set_key", "bands"],
            )

    rows_in = docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(text).alias("hash"), F.col(text).alias("text"))
    return rows_in.mapInArrow(run, SKETCH)


def _alike(a: str, b: str, percent: int) -> Column:
    """What sizes alone must satisfy."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def linked(pairs: DataFrame, texts: DataFrame, ngram: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are alike enough."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, set()
        for batch in slices(batches, 64):
            keep = []
            for a, whole, other in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
                if a != last:
                    last, own = a, shingles(lower_words(whole), ngram)
                far = shingles(lower_words(other), ngram)
                both = len(own & far)
                keep.append(100 * both >= percent * (len(own) + len(far) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    one = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    held = pairs.join(two, "b").join(one, "a").select("a", "b", "text_a", "text_b")
    return held.mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(u, v): each node of ``edges`` (a, b) but the least of its component, with that least one.

    Large-star and small-star steps in turn; each table is stored, and only a count and a
    checksum come to the driver.
    """
    edges = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return edges
        seen = now


def near_duplicates(
    docs: DataFrame,
    ngram: int = 5,
    percent: int = 80,
    bins: int = BINS,
    rows: int = ROWS,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """One row per row: doc_id, hash (of the text), n_shingles, component_id, kept.

    Rows are linked when their shingle sets' intersection is at least ``percent`` in a
    hundred of the union. ``component_id`` is the least id that links lead to. Rows with an
    empty set are linked with nothing, nor are rows without an id, whose component_id is
    null and which are kept. Rows that share an id are linked by their texts only.
    """
    base = stored(sketches(docs, ngram, bins, rows, text, key), "sketches")
    first = F.min(F.struct("doc_id", "hash", "n_shingles", "bands")).alias("one")
    classes = (
        base.where("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("set_key")
        .agg(first)
        .select("set_key", "one.*")
        .withColumn("node", F.monotonically_increasing_id())
    )
    classes = stored(classes, "classes")
    links = _links(classes, docs, ngram, percent, text, key)
    of = classes.select("set_key", "node", "doc_id").join(
        links.select(F.col("u").alias("node"), "v"), "node", "left"
    )
    of = of.select("set_key", "doc_id", F.coalesce("v", "node").alias("root"))
    least = of.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = stored(of.join(least, "root").select("set_key", "component_id"), "named")
    found = F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("component_id")), F.col("doc_id"))
    return (
        base.select("doc_id", "hash", "n_shingles", "set_key")
        .join(named, "set_key", "left")
        .select("doc_id", "hash", "n_shingles", found.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def _links(classes: DataFrame, docs: DataFrame, ngram: int, percent: int, text: str, key: str) -> DataFrame:
    """Stars over the classes' nodes, as ``components`` gives them."""
    each = classes.select("node", F.col("n_shingles").cast("int").alias("n"), F.explode("bands").alias("bucket"))
    shared = stored(
        each.groupBy("bucket")
        .agg(F.count("*").alias("size"), F.min(F.struct("node", "n")).alias("low"), F.max(F.struct("node", "n")).alias("high"))
        .where("size > 1"),
        "buckets",
    )
    members = stored(each.join(shared.select("bucket"), "bucket"), "members")
    nodes = members.select("node").distinct().join(classes.select("node", "doc_id", "hash"), "node")
    own = docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(text).alias("hash"), F.col(text).alias("text"))
    texts = stored(
        own.join(nodes, ["doc_id", "hash"]).select("node", "text").dropDuplicates(["node"]), "texts"
    )

    def compared(pairs: DataFrame) -> DataFrame:
        return stored(linked(pairs.distinct(), texts, ngram, percent), "links")

    hubs = F.explode(F.array_distinct(F.array("low", "high"))).alias("hub")
    hubs = shared.select("bucket", hubs).select("bucket", F.col("hub.node").alias("a"), F.col("hub.n").alias("n_a"))
    near = members.join(hubs, "bucket").where("node <> a").where(_alike("n", "n_a", percent))
    stars = components(compared(near.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b"))))

    root = F.coalesce("v", "node").alias("root")
    placed = members.join(stars.select(F.col("u").alias("node"), "v"), "node", "left").select("bucket", "node", root)
    open_ones = stored(
        placed.groupBy("bucket")
        .agg(F.count("*").alias("size"), F.min("root").alias("one"), F.max("root").alias("other"))
        .where("one <> other AND size > 3")  # all pairs of three members have met a hub
        .select("bucket", F.ceil(F.col("size") / BLOCK).cast("int").alias("parts")),
        "open",
    )
    # A part meets each other one and itself.
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    left = (
        placed.join(open_ones, "bucket")
        .withColumn("part", part)
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("bucket", "node", "root", "part", F.least("part", "with").alias("low"), F.greatest("part", "with").alias("high"))
    )
    sets = _short_sets(texts.join(left.select("node").distinct(), "node", "left_semi"), ngram)
    sets = sets.join(classes.select("node", "bands"), "node")
    found = _blocks(left.join(sets, "node"), percent).distinct()
    more = compared(stored(found, "found"))
    return components(stars.select(F.col("u").alias("a"), F.col("v").alias("b")).unionByName(more))


def _short_sets(texts: DataFrame, ngram: int) -> DataFrame:
    """(node, items): each shingle set as sorted 32-bit hashes; equal ones only add to an intersection."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher = Sketcher(ngram, BINS, ROWS)
        for batch in slices(batches):
            words = [lower_words(t) for t in batch.column(1).to_pylist()]
            sketcher.hashes.need(set().union(*words))
            items = [(sketcher.hashed(w) >> np.uint64(32)).astype(np.uint32).tobytes() for w in words]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(items, pa.binary())], ["node", "items"])

    return texts.select("node", "text").mapInArrow(run, "node long, items binary")


def _blocks(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) across components that may be alike, from rows dealt by (bucket, low, high)."""

    def settle(block: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        nodes, roots, parts = (np.array([r[i] for r in block], np.int64) for i in (1, 2, 3))
        bands = np.array([r[7] for r in block], np.int64)
        band = int(np.flatnonzero((bands == block[0][0]).all(0))[0])
        items = [np.frombuffer(r[6], np.uint32) for r in block]
        sizes = np.array([len(i) for i in items])
        every, owners = np.concatenate(items), np.repeat(np.arange(len(block)), sizes)
        order = np.argsort(every, kind="stable")
        every, owners = every[order], owners[order]
        values, counts = np.unique(roots, return_counts=True)
        main = values[counts.argmax()]  # pairs within a component need no look
        one, two = [], []
        inside = block[0][4] == block[0][5]
        for x in np.flatnonzero(roots != main):
            starts, ends = np.searchsorted(every, items[x]), np.searchsorted(every, items[x], "right")
            lengths = ends - starts
            at = np.repeat(starts - np.concatenate(([0], lengths.cumsum()[:-1])), lengths) + np.arange(lengths.sum())
            both = np.bincount(owners[at], minlength=len(block))
            good = (100 * both >= percent * (sizes + sizes[x] - both)) & (roots != roots[x])
            good &= (parts == parts[x]) if inside else (parts != parts[x])
            good &= ~(bands[:, :band] == bands[x, :band]).any(1)
            for y in np.flatnonzero(good):
                one.append(min(nodes[x], nodes[y]))
                two.append(max(nodes[x], nodes[y]))
        return np.array(one, np.int64), np.array(two, np.int64)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, block = None, []

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c) for c in settle(block)], ["a", "b"])

        for batch in slices(batches):
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                key = (row[0], row[4], row[5])
                if key != current:
                    if block:
                        yield done()
                    current, block = key, []
                block.append(row)
        if block:
            yield done()

    return (
        rows.select("bucket", "node", "root", "part", "low", "high", "items", "bands")
        .repartition("bucket", "low", "high")
        .sortWithinPartitions("bucket", "low", "high")
        .mapInArrow(run, "a long, b long")
    )


def one_of_each(docs: DataFrame, ngram: int = 5, percent: int = 80, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each component: the least id, of its texts the least hash, of equal rows one.

    Rows without an id are linked with nothing and stay.
    """
    found = near_duplicates(docs, ngram, percent, text=text, key=key).where("doc_id IS NOT NULL")
    found = stored(found.select("doc_id", "hash", "component_id"), "verdicts")
    ours = F.struct("doc_id", "hash")
    firsts = found.groupBy("component_id").agg(F.min(ours).alias("first")).select("component_id", "first.*")
    gone = found.join(firsts, ["doc_id", "hash"], "left_anti").select("doc_id", "hash").distinct()
    twice = stored(
        found.join(firsts, ["doc_id", "hash"], "left_semi").groupBy("doc_id", "hash").count().where("count > 1").drop("count"),
        "repeated",
    )
    rows = docs.select(F.struct(*docs.columns).alias("d"), F.col(key).cast("long").alias("doc_id"), F.xxhash64(text).alias("hash"))
    kept = rows.join(gone.unionByName(twice), ["doc_id", "hash"], "left_anti")
    if not twice.isEmpty():
        kept = kept.unionByName(rows.join(twice, ["doc_id", "hash"], "left_semi").dropDuplicates(["doc_id", "hash"]))
    return kept.select("d.*")


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs, ngram=2).drop("hash")
