"""Helpers shared by the text operators: words, batches, piece caches, scratch tables."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from casemill.layout import scratch_folder

SLICE_ROWS = 256  # rows turned into Python objects at a time
RUN_BYTES = 2 << 20  # of text handled as one array
CACHE_BYTES = 96 << 20  # what a task's cache of pieces may hold, about


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in runs of few rows, so that a task holds few texts as objects."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def byte_runs(batches: Iterable[pa.RecordBatch], column: str, size: int = RUN_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in runs whose texts in ``column`` take ``size`` bytes, or that are one longer text."""
    for batch in batches:
        held = batch.column(batch.schema.get_field_index(column))
        ends = np.frombuffer(held.buffers()[1], np.int32)[held.offset : held.offset + len(held) + 1]
        start = 0
        while start < len(held):
            stop = max(start + 1, int(np.searchsorted(ends, int(ends[start]) + size, "right")) - 1)
            yield batch.slice(start, stop - start)
            start = stop


def words_of(text: str | None) -> list[bytes]:
    """Runs of anything but space and the five ASCII white-space controls, as UTF-8."""
    return text.encode().split() if text else []


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """``frame`` written to the shared scratch folder and read again.

    This cuts the lineage by a table that outlives any executor.
    """
    spark = frame.sparkSession
    path = scratch_folder(spark, purpose)
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


class Cache(dict):
    """Values by key, made in bulk by ``make``; emptied when ``CACHE_BYTES`` is passed."""

    def __init__(self, make: Callable[[list], list], size: Callable[[object], int] = len):
        super().__init__()
        self.make, self.size, self.held = make, size, 0

    def need(self, keys: Iterable) -> None:
        missing = [k for k in keys if k not in self]
        if not missing:
            return
        if self.held > CACHE_BYTES:
            keep = list(keys)
            self.clear()
            self.held = 0
            missing = keep
        self.update(zip(missing, self.make(missing), strict=True))
        self.held += sum(self.size(k) + 200 for k in missing)  # two objects and a table entry


class Splitter:
    """Cuts text by a pattern of letter, number and space classes as a given library does.

    Libraries carry different Unicode versions, so ``kind`` is asked: for each character
    up to U+02FF when the pattern is made, where the classes become plain ranges; for one
    beyond when it is met, and a like character then stands in for it in the cutting.
    """

    _FAR = re.compile("[^\x00-\u02ff]")

    def __init__(self, pattern: str, kind: Callable[[str], str]):
        near = {p: kind(chr(p)) for p in range(0x300)}
        ranges = {
            name: "".join(f"\\u{p:04x}" for p, k in near.items() if k == letter)
            for name, letter in ((r"\p{L}", "L"), (r"\p{N}", "N"), (r"\s", "S"))
        }

        def spell(token: re.Match) -> str:
            if token[0].startswith("["):
                return "[" + re.sub(r"\\p\{\w\}|\\s", lambda m: ranges[m[0]], token[0][1:-1]) + "]"
            return f"[^{ranges[r'\s']}]" if token[0] == r"\S" else f"[{ranges[token[0]]}]"

        self.pattern = re.compile(re.sub(r"\[[^\]]*\]|\\p\{\w\}|\\s|\\S", spell, pattern))
        self.alike = _Alike(kind)

    def __call__(self, text: str) -> list[str]:
        if text.isascii() or not self._FAR.search(text):
            return self.pattern.findall(text)
        return [text[m.start() : m.end()] for m in self.pattern.finditer(text.translate(self.alike))]


class _Alike(dict):
    STAND_IN = {"L": "a", "N": "1", "S": "\t", "O": "!"}

    def __init__(self, kind: Callable[[str], str]):
        super().__init__()
        self.kind = kind

    def __missing__(self, point: int) -> str:
        char = chr(point)
        self[point] = char if point <= 0x2FF else self.STAND_IN[self.kind(char)]
        return self[point]


def kind_in_tokenizers() -> Callable[[str], str]:
    """The class of a character in the Unicode tables of the library whose counts are to be met."""
    from tokenizers import Regex, pre_tokenizers

    probes = [
        (name, pre_tokenizers.Split(Regex(p), "removed"))
        for name, p in (("L", r"\p{L}"), ("N", r"\p{N}"), ("S", r"\s"))
    ]
    return lambda char: next((name for name, probe in probes if not probe.pre_tokenize_str(char)), "O")


@lru_cache(1)
def spelling() -> list[str]:
    """A visible character for each byte: itself where printable, else one from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def byte_letters() -> dict[int, str]:
    """A translation from bytes, read as latin-1, to their visible characters."""
    return str.maketrans({chr(b): c for b, c in enumerate(spelling())})
