"""Token counts without token ids: pieces are counted once per distinct pre-token.

One pass gathers the distinct pre-tokens and how often each occurs. Their pieces are
counted once. A second pass makes the frequencies of pre-tokens per document and adds
up the frequent ones at once, by a table of bounded size; the others are joined to
their counts by a shuffle and summed per document. The frequent pre-tokens are the
ones that would make hot join keys.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.llm.text import Splitter, byte_letters, kind_in_tokenizers, slices, stored

HEAD = 1 << 17  # pre-tokens at most, each of at most HEAD_BYTES, that are looked up in a broadcast table
HEAD_BYTES = 64
FLUSH = 100_000  # distinct pre-tokens after which a task hands its counts on


class PreTokens:
    """Cuts a text at the tokenizer's special strings, then by the pattern."""

    def __init__(self, special: list[str], pattern: str):
        self.special = special
        self.split = Splitter(pattern, kind_in_tokenizers())

    def __call__(self, text: str) -> tuple[list[str], int]:
        """The pre-tokens and the number of special tokens."""
        parts, found = [text], 0
        for special in self.special:
            if special in text:
                cut = [p.split(special) for p in parts]
                found += sum(len(c) - 1 for c in cut)
                parts = [p for c in cut for p in c]
        return [t for p in parts for t in self.split(p)], found


def special_strings(tokenizer: str) -> list[str]:
    from tokenizers import Tokenizer

    return [t.content for t in Tokenizer.from_file(tokenizer).get_added_tokens_decoder().values()]


@lru_cache(1)
def merges_of(tokenizer: str) -> Callable[[str], list]:
    """The tokenizer's merging of one spelt pre-token, loaded once per worker process.

    Encoding whole batches instead starts threads in every worker and holds on to memory.
    """
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer).model.tokenize


def _frequencies(docs: DataFrame, special: list[str], pattern: str) -> DataFrame:
    """Distinct pre-tokens with their frequency; each task hands on sums."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, seen = PreTokens(special, pattern), Counter()
        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                if text:
                    seen.update(cut(text)[0])
            if len(seen) > FLUSH:
                yield _counted(seen)
                seen.clear()
        yield _counted(seen)

    def _counted(seen: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())],
            ["piece", "frequency"],
        )

    parts = docs.mapInArrow(count, "piece string, frequency long")
    return parts.groupBy("piece").agg(F.sum("frequency").alias("frequency"))


def _sizes(vocabulary: DataFrame, tokenizer: str) -> DataFrame:
    """``vocabulary`` with ``n``, the number of tokens of each pre-token."""

    def size(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merge, letters = merges_of(tokenizer), byte_letters()
        for batch in slices(batches, 2048):
            spelt = [p.encode().decode("latin-1").translate(letters) for p in batch.column(0).to_pylist()]
            lengths = pa.array([len(merge(p)) for p in spelt], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, lengths], ["piece", "frequency", "n"])

    return vocabulary.mapInArrow(size, "piece string, frequency long, n int")


def head_of(vocabulary: DataFrame, most: int = HEAD) -> dict[str, int]:
    """The pre-tokens above the least frequency that at most ``most`` of them reach."""
    short = vocabulary.where(F.octet_length("piece") <= HEAD_BYTES)
    # Frequencies in steps of a sixteenth of a power of two: fewer than 1,024 groups.
    step = F.floor(F.log2("frequency") * 16)
    groups = short.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect()
    total, least = 0, None
    for group in groups:
        total += group["count"]
        if total > most:
            break
        least = group["step"]
    if least is None:
        return {}
    return {r["piece"]: r["n"] for r in short.where(step >= least).select("piece", "n").collect()}


def count_tokens(
    docs: DataFrame,
    tokenizer: str,
    pattern: str,
    limit: int = 1024,
    text: str = "text",
    key: str = "doc_id",
    head: int = HEAD,
) -> DataFrame:
    """Bytes and tokens of every whole text, and whether the tokens are over ``limit``.

    A null or empty text has none. Null and repeated ids are rows like any other.
    """
    spark = docs.sparkSession
    special = special_strings(tokenizer)
    vocabulary = stored(_sizes(_frequencies(docs.select(text), special, pattern), tokenizer), "pre-tokens")
    shared = spark.sparkContext.broadcast(head_of(vocabulary, head))

    def add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, known = PreTokens(special, pattern), shared.value
        for batch in slices(batches):
            sums, pieces, numbers = [], [], []
            for whole in batch.column(1).to_pylist():
                parts, total = cut(whole or "")
                rest: Counter = Counter()
                sizes = list(map(known.get, parts))
                if None in sizes:
                    rest.update(p for p, n in zip(parts, sizes, strict=True) if n is None)
                    total += sum(filter(None, sizes))
                else:
                    total += sum(sizes)
                sums.append(total)
                pieces.append(list(rest))
                numbers.append(list(rest.values()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(sums, pa.int64()),
                    pa.array(pieces, pa.list_(pa.string())),
                    pa.array(numbers, pa.list_(pa.int32())),
                ],
                ["doc_id", "n_bytes", "sum", "pieces", "numbers"],
            )

    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    parts = docs.select(F.col(key).cast("long"), F.col(text), size).mapInArrow(
        add_up, "doc_id long, n_bytes long, sum long, pieces array<string>, numbers array<int>"
    )
    parts = stored(parts.withColumn("row", F.monotonically_increasing_id()), "frequencies")
    pairs = parts.select("row", F.explode(F.arrays_zip("pieces", "numbers")).alias("pair")).select(
        "row", F.col("pair.pieces").alias("piece"), F.col("pair.numbers").alias("number")
    )
    rest = (
        pairs.join(vocabulary.select("piece", "n"), "piece")
        .groupBy("row")
        .agg(F.sum(F.col("number").cast("long") * F.col("n")).alias("rest"))
    )
    total = F.col("sum") + F.coalesce("rest", F.lit(0))
    return (
        parts.select("row", "doc_id", "n_bytes", "sum")
        .join(rest, "row", "left")
        .select("doc_id", "n_bytes", total.alias("n_tokens"), (total > limit).alias("over_limit"))
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
