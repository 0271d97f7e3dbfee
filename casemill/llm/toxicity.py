"""Toxicity by a weighted lexicon, learned from labels and matched by Aho-Corasick.

Texts are folded first: look-alike letters of other scripts and digits or signs written for
letters become Latin letters. The lexicon holds the terms whose share among toxic texts is
far above that among others; exception phrases are neighbours of a term that turn it
harmless. The weights of a text's terms, less those in exception phrases, are normalised
by its length, and a logistic curve fitted to labelled texts makes a score of them.

The labels used are bounded: at most about ``SAMPLE`` labelled rows, drawn by a hash of their
id, so that they can be sent to every task. Labels of held-out ids are never read.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.llm.text import slices, stored

SAMPLE = 50_000  # labelled rows to learn from, about
TERMS = 2_000  # of the lexicon, at most, and as many exception phrases
FLUSH = 200_000  # distinct terms after which a task hands its counts on
MIN_TEXTS = 5  # toxic texts a term, or other texts a phrase, must stand in
MIN_LIFT = 2.0  # log odds of a term

# Letters that look like Latin ones, and signs written for letters.
LOOK_ALIKE = str.maketrans(
    "аеорсухіјѕԁһԛԝвкмнтαορνικτυɡıⅼ",
    "aeopcyxijsdhqwbkmhtaopviktugil",
)
SIGNS = str.maketrans("013457@$!|", "oieastasil")
_FAR = re.compile("[^\x00-ɏ]")
_MIXED = re.compile(r"(?<=[a-z])[013457@$!|]+(?=[a-z])|(?<![a-z0-9])[013457]+(?=[a-z]{2})")
_GAPS = re.compile("[^a-zß-öø-ɏ]+")


def fold(text: str | None) -> str:
    """Lower-case words with one space before, between and after; folded."""
    if not text:
        return " "
    if _FAR.search(text):
        text = unicodedata.normalize("NFKC", text)
        text = "".join(c for c in text if c not in "­​‌‍⁠﻿").lower().translate(LOOK_ALIKE)
    else:
        text = text.lower()
    text = _MIXED.sub(lambda m: m[0].translate(SIGNS), text)
    return f" {_GAPS.sub(' ', text).strip()} "


@dataclass(frozen=True)
class Model:
    """Weights of terms, phrases that excuse a term (with the term's weight), and the curve."""

    terms: dict[str, float]
    excuses: dict[str, float]
    curve: tuple[float, ...]  # constant, then one slope per feature


class Matcher:
    """Aho-Corasick over whole words: every needle has a space on both sides."""

    def __init__(self, needles: Iterable[str]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for needle in needles:
            self.automaton.add_word(f" {needle} ", needle)
        self.some = len(self.automaton) > 0
        if self.some:
            self.automaton.make_automaton()

    def __call__(self, folded: str) -> Iterator[tuple[int, str]]:
        return self.automaton.iter(folded) if self.some else iter(())


def features(folded: str, matcher: Matcher, model: Model) -> tuple[float, float]:
    """The weight of a text's terms, per root of its length and per its logarithm."""
    total = 0.0
    for _, needle in matcher(folded):
        total += model.terms.get(needle, 0.0) - model.excuses.get(needle, 0.0)
    words = max(1, folded.count(" ") - 1)
    total = max(0.0, total)
    return total / math.sqrt(words), total / math.log2(words + 2)


def _tally(train: DataFrame, keys) -> DataFrame:
    """(key, toxic, other): texts of each kind that hold a key; ``keys`` gives those of a folded text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (Counter(), Counter())
        pick = keys()

        def out() -> pa.RecordBatch:
            names = list(seen[0].keys() | seen[1].keys())
            counts = [pa.array([c[n] for n in names], pa.int64()) for c in (seen[1], seen[0])]
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *counts], ["key", "toxic", "other"])

        for batch in slices(batches):
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen[toxic].update(pick(fold(text)))
            if len(seen[0]) + len(seen[1]) > FLUSH:
                yield out()
                seen[0].clear()
                seen[1].clear()
        yield out()

    counts = train.select("text", "toxic").mapInArrow(run, "key string, toxic long, other long")
    return counts.groupBy("key").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def learn(train: DataFrame) -> Model:
    """A model from ``train`` (text, toxic 0 or 1), a bounded stored table."""
    sizes = train.agg(F.count("*"), F.sum("toxic")).first()
    toxic, other = int(sizes[1] or 0), int(sizes[0] - (sizes[1] or 0))
    if not toxic or not other:
        return Model({}, {}, ((30.0 if toxic else -30.0), 0.0, 0.0))

    lift = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("other") + 0.5) / (other + 1))
    # Few texts prove little: a term of as many toxic texts as MIN_TEXTS gets half its lift.
    sure = F.col("toxic") / (F.col("toxic") + MIN_TEXTS)
    best = (
        _tally(train, lambda: lambda folded: set(folded.split()))
        .where((F.col("toxic") >= MIN_TEXTS) & (lift >= MIN_LIFT))
        .select("key", (lift * sure).alias("weight"))
        .orderBy(F.desc("weight"), "key")
        .limit(TERMS)
    )
    terms = {r["key"]: r["weight"] for r in best.collect()}

    def phrases():
        matcher = Matcher(terms)

        def pick(folded: str) -> set[str]:
            found = set()
            for end, term in matcher(folded):
                start = end - len(term)
                before = folded[folded.rfind(" ", 0, start - 1) + 1 : start - 1] if start > 1 else ""
                after = folded[end + 1 : folded.find(" ", end + 1)] if end + 1 < len(folded) else ""
                found |= {f"{before} {term}"} if before else set()
                found |= {f"{term} {after}"} if after else set()
            return found

        return pick

    odds = _tally(train, phrases).where((F.col("other") >= MIN_TEXTS) & (F.col("toxic") / toxic < F.col("other") / other))
    rows = odds.orderBy(F.desc("other"), "key").limit(TERMS).collect()
    excuses = {r["key"]: max(terms.get(w, 0.0) for w in r["key"].split(" ")) for r in rows}
    draft = Model(terms, excuses, (0.0, 0.0, 0.0))
    points = _featured(train, draft).collect()  # a bounded table
    return Model(terms, excuses, _fit(points))


def _featured(train: DataFrame, model: Model) -> DataFrame:
    """(a, b, toxic, n): how many training texts have the same features, rounded."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher([*model.terms, *model.excuses])
        for batch in slices(batches):
            found = [features(fold(t), matcher, model) for t in batch.column(0).to_pylist()]
            columns = [pa.array([round(f[i], 3) for f in found], pa.float64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*columns, batch.column(1)], ["a", "b", "toxic"])

    return train.select("text", "toxic").mapInArrow(run, "a double, b double, toxic int").groupBy("a", "b", "toxic").count()


def _fit(points: list) -> tuple[float, ...]:
    """A logistic curve by Newton's method, with a small penalty so that it stays finite."""
    x = np.array([[1.0, p["a"], p["b"]] for p in points])
    y = np.array([p["toxic"] for p in points], float)
    n = np.array([p["count"] for p in points], float)
    beta = np.zeros(3)
    penalty = np.diag([1e-3, 1e-2, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (n * p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(hessian, x.T @ (n * (y - p)) - penalty @ beta)
        beta += step / max(1.0, np.abs(step).max() / 5)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(map(float, beta))


def score(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, score), one row per row; a null or empty text is scored as one without terms."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher([*model.terms, *model.excuses])
        constant, *slopes = model.curve
        for batch in slices(batches):
            scores = []
            for whole in batch.column(1).to_pylist():
                values = features(fold(whole), matcher, model)
                line = constant + sum(s * v for s, v in zip(slopes, values, strict=True))
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, line)))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text)).mapInArrow(run, "doc_id long, score double")


def _held_out(key: str) -> Column:
    """Whether an id is held out; a null id is not, and has no label either."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(False))


def sampled_labels(labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, toxic) of about ``sample`` ids at most that are not held out; the higher label where ids repeat."""
    known = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(~_held_out("doc_id"))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    share = min(1.0, sample / max(1, known.count()))
    return known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))


def toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, held_out, score and predicted, one row per row."""
    chosen = sampled_labels(labels)  # bounded by its definition
    train = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    train = stored(train.join(F.broadcast(chosen), "doc_id").select("text", "toxic"), "labelled")
    scored = score(docs, learn(train), text, key)
    return scored.select(
        "doc_id", _held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
