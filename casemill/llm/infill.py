"""Fill-in-the-middle: texts cut in three and written with their middle last.

A text moves as bytes. Its cuts are found by counting the first bytes of characters, and
each of the three parts then moves by one distance. A difference array over the bytes of
a batch holds, where a part starts, how its distance differs from the one before; its
cumulative sum is the shift of every byte, by which numpy scatters them to their places.
The way back finds the marks in the output, makes the same array and gathers.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from casemill.llm.text import byte_runs

MARK = 3  # bytes of a mark
PREFIX, SUFFIX, MIDDLE = (np.frombuffer(m, np.uint8) for m in (b"<P>", b"<S>", b"<M>"))
_ANY_MARK = re.compile(b"<[PSM]>")
PLAIN_FROM, SPM_BELOW = 90, 20  # of a hundred
STEP = 1 << 20  # bytes whose shifts are held at a time

_MADE = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def draws(key: Column) -> list[Column]:
    """Four numbers below 2 ** 32 per row, from the key alone."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an array of texts without nulls, and where each begins and the last ends."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _texts_of(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data))


def _shifts(starts: np.ndarray, shifts: np.ndarray, size: int) -> Iterator[tuple[slice, np.ndarray]]:
    """Where each of ``size`` bytes belongs if those from ``starts[i]`` on move by ``shifts[i]``.

    The starts ascend; of equal ones the last counts. Given in steps, so that a very long
    text does not need a number for each of its bytes at once.
    """
    changes = np.diff(shifts, prepend=0)
    shift = 0
    for low in range(0, size, STEP):
        high = min(low + STEP, size)
        here = slice(*np.searchsorted(starts, (low, high)))
        difference = np.zeros(high - low, np.int64)
        np.add.at(difference, starts[here] - low, changes[here])
        difference[0] += shift
        moved = np.cumsum(difference)
        shift = int(moved[-1])
        moved += np.arange(low, high)
        yield slice(low, high), moved


def _marks_in(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place and row of all marks; one that runs over the end of its row is none."""
    places = np.fromiter((m.start() for m in _ANY_MARK.finditer(data)), np.int64)
    rows = np.searchsorted(offsets, places, "right") - 1
    whole = places + MARK <= offsets[rows + 1]
    return places[whole], rows[whole]


def _put(out: np.ndarray, at: np.ndarray, mark: np.ndarray) -> None:
    out[at[:, None] + np.arange(MARK)] = mark


def _transform(texts: pa.Array, h: list[np.ndarray]) -> tuple[pa.Array, ...]:
    """n, form, prefix_chars, middle_chars and output of texts without nulls."""
    data, offsets = _bytes_of(texts)
    begin, end = offsets[:-1], offsets[1:]
    heads = np.cumsum((data & 0xC0) != 0x80, dtype=np.int32)  # characters begun up to each byte
    before = np.concatenate(([0], heads))[offsets].astype(np.int64)
    n = np.diff(before)
    cuts = np.sort([h[0] % (n + 1), h[1] % (n + 1)], axis=0)
    # The byte of a character is the first with its count; one past the last is the text's end.
    first, second = (np.where(c < n, np.searchsorted(heads, before[:-1] + c + 1), end) for c in cuts)
    plain = (n == 0) | (h[2] % 100 >= PLAIN_FROM)
    plain[_marks_in(data, offsets)[1]] = True
    spm = ~plain & (h[3] % 100 < SPM_BELOW)
    psm = ~plain & ~spm

    to = np.concatenate(([0], np.cumsum(end - begin + np.where(plain, 0, 3 * MARK))))
    at = to[:-1]
    prefix, suffix = first - begin, end - second
    places = {
        "prefix": np.where(spm, at + 2 * MARK + suffix, at + MARK),
        "middle": at + 3 * MARK + prefix + suffix,
        "suffix": np.where(spm, at + MARK, at + 2 * MARK + prefix),
    }
    starts = np.stack([begin, first, second], axis=1)
    shifts = np.stack(list(places.values()), axis=1) - starts
    shifts[plain] = (at - begin)[plain, None]
    out = np.empty(to[-1], np.uint8)
    for span, moved in _shifts(starts.ravel(), shifts.ravel(), len(data)):
        out[moved] = data[span]
    for mark, part in ((PREFIX, "prefix"), (MIDDLE, "middle"), (SUFFIX, "suffix")):
        _put(out, places[part][~plain] - MARK, mark)
    forms = pa.array(np.select([plain, spm], ["plain", "spm"], "psm"), pa.string())
    return (
        pa.array(n),
        forms,
        pa.array(cuts[0], mask=plain),
        pa.array(cuts[1] - cuts[0], mask=plain),
        _texts_of(out, to),
    )


def _restore(outputs: pa.Array, forms: pa.Array) -> pa.Array:
    """The texts from which ``outputs`` without nulls were made."""
    data, offsets = _bytes_of(outputs)
    begin, end = offsets[:-1], offsets[1:]
    kind = forms.to_numpy(zero_copy_only=False)
    moved = kind != "plain"
    places, rows = _marks_in(data, offsets)
    # A text that holds a mark is plain, so the others hold the three marks that were put there.
    found = places[moved[rows]].reshape(-1, 3)
    spm = kind[moved] == "spm"
    stop = end[moved]
    # Where the prefix, the middle and the suffix begin and end in the output.
    prefix = np.where(spm, found[:, 1], found[:, 0]) + MARK, np.where(spm, found[:, 2], found[:, 1])
    middle = found[:, 2] + MARK, stop
    suffix = np.where(spm, found[:, 0], found[:, 1]) + MARK, np.where(spm, found[:, 1], found[:, 2])
    to = np.concatenate(([0], np.cumsum(end - begin - np.where(moved, 3 * MARK, 0))))
    starts = np.repeat(to[:-1, None], 3, axis=1)
    starts[moved, 1] += prefix[1] - prefix[0]
    starts[moved, 2] = starts[moved, 1] + middle[1] - middle[0]
    sources = np.repeat(begin[:, None], 3, axis=1)
    sources[moved] = np.stack([prefix[0], middle[0], suffix[0]], axis=1)
    text = np.empty(to[-1], np.uint8)
    for span, source in _shifts(starts.ravel(), (sources - starts).ravel(), len(text)):
        text[span] = data[source]
    return _texts_of(text, to)


def _make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in byte_runs(batches, "text"):
        h = [batch.column(f"h{i}").to_numpy() for i in range(1, 5)]
        made = _transform(batch.column("text"), h)
        names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *made], names)


def fill_in_middle(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and output, one row per row.

    The cuts and the form follow from the key, so repeated ids are cut at the same numbers.
    A null text is an empty one, an empty text is plain, and so is one that holds a mark. A
    null key draws as the empty text does. Other columns, whatever their names, are left out.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    drawn = [h.alias(f"h{i}") for i, h in enumerate(draws(F.col("doc_id")), 1)]
    return rows.select(F.col("doc_id").cast("long"), "text", *drawn).mapInArrow(_make, _MADE)


def restored(made: DataFrame, output: str = "output", form: str = "form") -> DataFrame:
    """``made`` with ``restored``: the exact text, from output and form alone."""

    def back(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_runs(batches, output):
            text = _restore(batch.column(output), batch.column(form))
            yield pa.RecordBatch.from_arrays([*batch.columns, text], [*batch.schema.names, "restored"])

    return made.mapInArrow(back, StructType([*made.schema, StructField("restored", StringType())]))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return restored(made).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )


ORACLE = """
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t, CAST(length(coalesce(text, '')) AS BIGINT) AS n,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), drawn AS (
  SELECT doc_id, t, n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS a,
         CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS b,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS c, CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS d
  FROM texts
), cut AS (
  SELECT doc_id, t, n, least(a, b) AS p, greatest(a, b) - least(a, b) AS m,
         CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR c >= 90 THEN 'plain'
              WHEN d < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), parts AS (
  SELECT *, substr(t, 1, p) AS prefix, substr(t, p + 1, m) AS middle, substr(t, p + m + 1) AS suffix FROM cut
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN p END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN m END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                   ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""
