"""Phrases whose words stand together more often than their parts would, per language.

By prefix-free parsing. Every run of words between punctuation marks is cut into chunks
whose beginnings its own content triggers: a word begins a chunk if its hash says so, as
does the first word. A chunk runs on over the next one's beginning for as many words as a
phrase can reach over, and owns the phrases that begin in front of it, so each occurrence
belongs to one chunk. Text that is repeated is cut alike, so the distinct chunks with
their frequencies make a dictionary that is smaller than the text.

Phrases are counted in distinct chunks, times the frequency, one length after the other: a
phrase can only be frequent if both phrases of one word less in it are. A bit per hash of
the frequent ones is what the next length asks, so that rare phrases, which are most, are
never shuffled. Counts are exact, as a bit set by another phrase only lets more be counted.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casemill.llm.text import RUN_BYTES, byte_runs, stored

TRIGGER = 16  # one word of so many begins a chunk
LONGEST, LEAST, TOP = 5, 100, 2000
FILTER_BITS = 28  # the bits sent to all tasks are 2 ** 28, 32 MB, at most
_BUCKET = 1 << 15  # bits of one bitmap of Spark's

_WORD, _BLANK, _BREAK = 0, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = _BLANK
_KIND[[*b".,;:!?\n\x0b\x0c\r"]] = _BREAK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_FACTOR = 0x9E3779B97F4A7C15
_CHUNKS = "lang string, chunk string, core int, freq long"
_GRAMS = "lang string, phrase string, f long"


@lru_cache(4)
def _powers(size: int, factor: int) -> np.ndarray:
    out = np.full(size, factor, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Hashes:
    """64-bit hashes of any spans of some bytes, from one running sum."""

    def __init__(self, data: np.ndarray):
        size = 1 << max(len(data), 1).bit_length()
        self.back = _powers(size, pow(_FACTOR, -1, 1 << 64))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data + np.uint64(1)) * _powers(size, _FACTOR)[: len(data)], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, stops: np.ndarray, seed: np.ndarray | int = 0) -> np.ndarray:
        h = (self.sums[stops] - self.sums[starts]) * self.back[starts] + np.asarray(seed, np.uint64)
        for _ in range(2):
            h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(32))


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an array of texts without nulls, and where each begins and the last ends."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _gather(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the spans, one after the other, and where each begins and the last ends."""
    ends = np.concatenate(([0], np.cumsum(stops - starts)))
    at = np.repeat(starts - ends[:-1], stops - starts)
    at += np.arange(ends[-1])
    return data[at], ends


def _texts(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> pa.Array:
    held, ends = _gather(data, starts, stops)
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(held))


def _stretches(data: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The rows as they are, or one long row in stretches that end behind a punctuation mark."""
    if len(offsets) > 2 or len(data) <= size:
        yield data, offsets
        return
    low = 0
    while low < len(data):
        high = low + size
        while high < len(data):
            marks = np.flatnonzero(_KIND[data[high : high + 65536]] == _BREAK)
            if len(marks):
                high += int(marks[0]) + 1
                break
            high += 65536
        high = min(high, len(data))
        yield data[low:high], np.array([0, high - low])
        low = high


def _parse(data: np.ndarray, offsets: np.ndarray, longest: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Chunks as text, how many words of each are its own, and the row each lies in."""
    data = _LOWER[data]
    kind = _KIND[data]
    word = np.concatenate(([False], kind == _WORD, [False]))
    edge = np.zeros(len(data) + 1, bool)  # a row begins or ends here
    edge[offsets] = True
    starts = np.flatnonzero(word[1:] & (~word[:-1] | edge))
    stops = np.flatnonzero(word[:-1] & (~word[1:] | edge))
    if not len(starts):
        return pa.array([], pa.string()), starts, starts
    row = np.searchsorted(offsets, starts, "right") - 1
    piece = np.cumsum(kind == _BREAK, dtype=np.int32)[starts]
    first = np.concatenate(([True], (np.diff(row) != 0) | (np.diff(piece) != 0)))
    # Words with one blank behind each; a word's own bytes say whether it begins a chunk.
    size = stops - starts
    place = np.concatenate(([0], np.cumsum(size + 1)))
    closed = np.full(place[-1], 0x20, np.uint8)
    held, ends = _gather(data, starts, stops)
    closed[np.arange(len(held)) + np.repeat(np.arange(len(size)), size)] = held
    trigger = _Hashes(closed)(place[:-1], place[:-1] + size) % np.uint64(TRIGGER) == 0
    begin = np.flatnonzero(first | trigger)
    after = np.append(begin[1:], len(starts))
    heads = np.append(np.flatnonzero(first), len(starts))
    piece_end = heads[np.searchsorted(heads, begin, "right")]
    last = np.minimum(after + longest - 1, piece_end)
    return _texts(closed, place[begin], place[last] - 1), after - begin, row[begin]


def _chunked(longest: int, size: int = RUN_BYTES):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_runs(batches, "text", size):
            langs = batch.column("lang")
            for data, offsets in _stretches(*_bytes_of(batch.column("text")), size):
                chunks, core, row = _parse(data, offsets, longest)
                held = pa.table({"lang": langs.take(pa.array(row)), "chunk": chunks, "core": pa.array(core, pa.int32())})
                counted = held.group_by(["lang", "chunk", "core"]).aggregate([([], "count_all")])
                names = ["lang", "chunk", "core", "count_all"]
                yield from counted.select(names).rename_columns([*names[:3], "freq"]).to_batches()

    return run


def _seeds(langs: pa.Array) -> np.ndarray:
    """A number for the language of each row."""
    coded = langs.dictionary_encode()
    numbers = np.array([zlib.crc32(x.encode()) * _FACTOR % (1 << 64) for x in coded.dictionary.to_pylist()], np.uint64)
    return numbers[coded.indices.to_numpy()] if len(numbers) else np.empty(0, np.uint64)


def _has(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.uint64(8 * len(bits) - 1)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _counted(words: int, seen):
    """Phrases of so many words in distinct chunks, if ``seen`` has both shorter phrases in them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_runs(batches, "chunk"):
            data, offsets = _bytes_of(batch.column("chunk"))
            head = np.zeros(len(data), bool)
            head[offsets[:-1]] = True
            begins = head.copy()
            begins[1:] |= data[:-1] == 0x20
            starts = np.flatnonzero(begins)
            firsts = np.flatnonzero(head[starts])  # the first word of each row
            held = np.diff(firsts, append=len(starts))
            row = np.repeat(np.arange(len(firsts)), held)
            stops = np.append(starts[1:] - 1, len(data))
            stops[firsts[1:] - 1] = offsets[1:-1]
            within = np.arange(len(starts)) - firsts[row]
            core = batch.column("core").to_numpy()
            at = np.flatnonzero((within < core[row]) & (within + words <= held[row]))
            if seen is not None:
                hashes, seeds = _Hashes(data), _seeds(batch.column("lang"))
                at = at[_has(seen.value, hashes(starts[at], stops[at + words - 2], seeds[row[at]]))]
                at = at[_has(seen.value, hashes(starts[at + 1], stops[at + words - 1], seeds[row[at]]))]
            phrases = _texts(data, starts[at], stops[at + words - 1])
            rows = pa.array(row[at])
            found = {"lang": batch.column("lang").take(rows), "phrase": phrases, "f": batch.column("freq").take(rows)}
            counted = pa.table(found).group_by(["lang", "phrase"]).aggregate([("f", "sum")])
            yield from counted.select(["lang", "phrase", "f_sum"]).rename_columns(["lang", "phrase", "f"]).to_batches()

    return run


def _filter(level: DataFrame, bits: int):
    """A bit for the hash of every row, sent to all tasks; 2 ** ``bits`` of them at most."""
    rows = level.count()
    size = min(max(32 * rows, _BUCKET).bit_length(), bits)
    mask = np.uint64((1 << size) - 1)

    def places(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_runs(batches, "phrase"):
            data, offsets = _bytes_of(batch.column("phrase"))
            at = (_Hashes(data)(offsets[:-1], offsets[1:], _seeds(batch.column("lang"))) & mask).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at // _BUCKET), pa.array(at % _BUCKET)], ["bucket", "bit"])

    held = level.mapInArrow(places, "bucket long, bit long").groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
    out = np.zeros((1 << size) // _BUCKET * (_BUCKET // 8), np.uint8)
    for bucket, part in held.collect():
        out[bucket * (_BUCKET // 8) : (bucket + 1) * (_BUCKET // 8)] = np.frombuffer(part, np.uint8)
    return level.sparkSession.sparkContext.broadcast(out)


def dictionary(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST) -> DataFrame:
    """(lang, chunk, core, freq): the distinct chunks, their own words, how often each occurs.

    Memory goes with the longest run of words without a punctuation mark, not with the text.
    """
    rows = docs.select(
        F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    chunks = rows.mapInArrow(_chunked(longest), _CHUNKS)
    return chunks.groupBy("lang", "chunk", "core").agg(F.sum("freq").alias("freq"))


def frequent(chunks: DataFrame, longest: int = LONGEST, least: int = LEAST, bits: int = FILTER_BITS) -> DataFrame:
    """(lang, phrase, words, f) of all phrases of up to ``longest`` words with f of ``least`` or more.

    ``chunks`` is a stored dictionary; it is read once for each length.
    """
    levels, seen = [], None
    for words in range(1, longest + 1):
        counted = chunks.mapInArrow(_counted(words, seen), _GRAMS).groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
        levels.append(stored(counted.where(F.col("f") >= least), f"phrases{words}"))
        if words < longest:
            seen = _filter(levels[-1], bits)
    rows = levels[0].withColumn("words", F.lit(1))
    for words, level in enumerate(levels[1:], 2):
        rows = rows.unionByName(level.withColumn("words", F.lit(words)))
    return rows


def _parts(first: str, count: str) -> Column:
    """So many words of the phrase, from one on."""
    return F.expr(f"array_join(slice(split(phrase, ' '), {first}, {count}), ' ')")


def closed(phrases: DataFrame) -> DataFrame:
    """Phrases of two words and more that lie in no longer one that is as frequent."""
    many = phrases.where("words >= 2")
    inner = (
        many.where("words >= 3")
        .select("lang", "phrase", "words", "f", F.expr("explode(sequence(2, words - 1))").alias("size"))
        .select("*", F.expr("explode(sequence(1, words - size + 1))").alias("first"))
        .select("lang", _parts("first", "size").alias("phrase"), "f")
        .groupBy("lang", "phrase")
        .agg(F.max("f").alias("within"))
    )
    kept = F.col("within").isNull() | (100 * F.col("within") < 100 * F.col("f"))
    return many.join(inner, ["lang", "phrase"], "left").where(kept).drop("within")


def scored(candidates: DataFrame, phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """Candidates with a, l, r, n and score of the lowest-scoring cut, the first of equal ones.

    Products have 38 digits; one that needs more stops the job instead of being rounded.
    """
    exact = lambda name: F.col(name).cast("decimal(20,0)")
    cuts = candidates.select("lang", "phrase", F.col("f").alias("a"), F.expr("explode(sequence(1, words - 1))").alias("k"))
    cuts = cuts.withColumns({"left": _parts("1", "k"), "right": _parts("k + 1", "99")})
    of = lambda name, f: phrases.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    product = F.lit(1000).cast("decimal(4,0)") * exact("a") * exact("n")
    told = (
        cuts.join(of("left", "l"), ["lang", "left"])
        .join(of("right", "r"), ["lang", "right"])
        .join(totals, "lang")
        .withColumns({"_above": product, "_below": exact("l") * exact("r")})
        .withColumn("score", F.expr("_above div _below"))
    )
    best = told.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return best.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def ranked(rows: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` rows of each language, with their rank.

    First those of each of many shares of a language, so that no task sorts a whole one.
    """
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    shares = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = F.pmod(F.xxhash64("phrase"), F.lit(shares))
    rank = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    first = rows.withColumn("_share", share).withColumn("rank", rank("lang", "_share")).where(F.col("rank") <= top)
    return first.withColumn("rank", rank("lang")).where(F.col("rank") <= top).drop("_share")


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    longest: int = LONGEST,
    least: int = LEAST,
    top: int = TOP,
    bits: int = FILTER_BITS,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the best phrases of each language.

    Null texts have no words, null languages are ``und``, and repeated rows count each time.
    An empty table, or one without frequent phrases, gives no rows. Other columns of
    ``docs`` are not read.
    """
    chunks = stored(dictionary(docs, text, lang, longest), "chunks")
    totals = stored(chunks.groupBy("lang").agg(F.sum(F.col("freq") * F.col("core")).alias("n")), "totals")
    phrases = frequent(chunks, longest, least, bits)
    found = ranked(scored(closed(phrases), phrases, totals), top)
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
), totals AS (
  SELECT lang, sum(len(w)) AS n FROM worded GROUP BY lang
), starts AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded
), phrases AS (
  SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, k AS words, count(*) AS f
  FROM starts, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 100
), candidates AS (
  SELECT *, string_split(phrase, ' ') AS w FROM phrases WHERE words >= 2
), inner_phrases AS (
  SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, max(f) AS within
  FROM (SELECT *, unnest(range(1, words)) AS i FROM candidates WHERE words >= 3), (SELECT unnest(range(2, 5)) AS k)
  WHERE k < words AND i + k - 1 <= words GROUP BY ALL
), kept AS (
  SELECT c.* FROM candidates c LEFT JOIN inner_phrases i USING (lang, phrase)
  WHERE within IS NULL OR 100 * within < 100 * f
), cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, k, l.f AS l, r.f AS r, n,
         (1000::HUGEINT * c.f * n) // (l.f::HUGEINT * r.f) AS score
  FROM (SELECT *, unnest(range(1, words)) AS k FROM kept) c
  JOIN phrases l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ')
  JOIN phrases r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:], ' ')
  JOIN totals t ON t.lang = c.lang
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM best
)
SELECT lang, CAST(rank AS INT) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM placed WHERE rank <= 2000
"""
