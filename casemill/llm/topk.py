"""Exact top-k by inner product, by distributed histogram selection.

Every query is scored against every row, in blocks. A first pass makes one histogram of
scores per query over all blocks and finds the bin that holds the k-th highest score; the
next passes divide that bin until it is a single score. A last pass emits the scores above
it, and of those equal to it the smallest ids. A block emits only bins that its own k best
scores reach, since no lower bin can hold the k-th of all.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casemill.llm.text import stored

ROWS, QUERIES = 4096, 512  # of a block, about; every block of rows meets a copy of the queries
BITS = 12  # a histogram has at most 2 ** BITS bins
_LARGE = (1 << 63) - 1


def whole_vectors(frame: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(vec_id, dim, v): components as floor(256 x). Rows whose ids repeat are rows like others.

    Rows without an id, without a vector, or with a null or non-finite component are left out.
    """
    whole = F.transform(vector, lambda x: F.floor(F.lit(256.0) * x.cast("double")).cast("long"))
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (
        frame.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & sound)
        .select(F.col(key).cast("long").alias("vec_id"), whole.alias("v"))
        .withColumn("dim", F.size("v"))
    )


def _blocks(rows: DataFrame, block: Column, *more: str) -> DataFrame:
    """One row per block of vectors of one length."""
    return rows.groupBy("dim", block.alias("block")).agg(F.collect_list(F.struct("row", "vec_id", "v", *more)).alias("held"))


def _matrix(held: pa.Scalar, dim: int) -> tuple[np.ndarray, np.ndarray, pa.StructArray]:
    rows = held.values
    values = rows.field("v").flatten().to_numpy(zero_copy_only=False)
    return rows.field("row").to_numpy(zero_copy_only=False), values.reshape(len(rows), dim), rows


def _scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products; beyond 64 bits the nearest 64-bit number."""
    size = lambda m: max(abs(int(m.min())), abs(int(m.max()))) if m.size else 0
    most = size(queries) * size(rows) * max(rows.shape[1], 1)
    if most < 1 << 53:
        return (queries.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    if most <= _LARGE:
        return queries @ rows.T
    return np.clip(queries.astype(object) @ rows.astype(object).T, -_LARGE - 1, _LARGE).astype(np.int64)


def _rank_floor(scores: np.ndarray, need: int) -> int:
    """The ``need``-th highest of these scores, or the least if there are fewer."""
    return int(scores.min() if len(scores) <= need else np.partition(scores, -need)[-need])


def _each(frame: DataFrame, out: str, work) -> DataFrame:
    """``work`` on each query's scores in a block: (query row, ids, scores, state) -> arrays of the columns."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                dim = batch.column(0)[i].as_py()
                places, rows, fields = _matrix(batch.column(1)[i], dim)
                ids = fields.field("vec_id").to_numpy(zero_copy_only=False)
                asked, queries, state = _matrix(batch.column(2)[i], dim)
                known = [state.field(n).to_numpy(zero_copy_only=False) for n in ("shift", "prefix", "need")]
                found = []
                scores = _scores(queries, rows)
                for q, query in enumerate(asked):
                    other = places != query
                    found.append(work(int(query), ids[other], scores[q][other], *(int(k[q]) for k in known)))
                columns = [np.concatenate(c) for c in zip(*found, strict=True)]
                names = [c.split()[0] for c in out.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return frame.mapInArrow(run, out)


def _histogram(bits: int):
    def work(query: int, ids: np.ndarray, scores: np.ndarray, shift: int, prefix: int, need: int):
        # Scores are offset so that the bins of all passes nest; shift is that of the pass before.
        inside = scores if shift >= 63 else scores[(scores >> shift) == prefix]
        if not len(inside):
            return (np.empty(0, np.int64),) * 3
        bins, counts = np.unique(inside[inside >= _rank_floor(inside, need)] >> bits, return_counts=True)
        floor = bins[0]
        counts[0] = np.count_nonzero((inside >> bits) == floor)
        return np.full(len(bins), query), bins, counts

    return work


def _best(query: int, ids: np.ndarray, scores: np.ndarray, shift: int, prefix: int, need: int):
    above = scores > prefix if shift == 0 else np.ones(len(scores), bool)
    equal = np.flatnonzero(scores == prefix) if shift == 0 else np.empty(0, np.int64)
    equal = equal[np.argsort(ids[equal], kind="stable")[:need]]
    at = np.concatenate([np.flatnonzero(above), equal])
    return np.full(len(at), query), ids[at], scores[at]


def top_k(vectors: DataFrame, queries: Column, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest scores of each row that ``queries`` selects.

    ``vectors`` as from ``whole_vectors``. Rows score with rows of their own length; a
    query's own row is left out, and no other; ties go to the smaller id; a query with
    fewer than k others gets them all. Rows that share an id are queries and candidates each
    for itself, so such an id has several rows of one rank.
    """
    spark = vectors.sparkSession
    rows = stored(vectors.withColumn("row", F.monotonically_increasing_id()), "vectors")
    asked = rows.where(queries)
    facts = rows.agg(F.count("*"), F.max("dim"), F.max(F.greatest(F.array_max("v"), -F.array_min("v")))).first()
    parts = max(1, -(-facts[0] // ROWS))
    groups = max(1, -(-asked.count() // QUERIES))
    bits = min(63, (max(1, (facts[1] or 0) * (facts[2] or 0) ** 2)).bit_length() + 1)
    block = F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int")
    held = stored(_blocks(rows, block).withColumnRenamed("held", "rows"), "blocks")
    group = F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int")
    # shift 63: nothing is known yet; a query stays so if it has fewer than k others.
    start = {"shift": F.lit(63).cast("long"), "prefix": F.lit(0).cast("long"), "need": F.lit(k).cast("long")}
    state = asked.select("row", *[c.alias(n) for n, c in start.items()])

    def paired(state: DataFrame) -> DataFrame:
        sets = _blocks(asked.join(state, "row"), group, "shift", "prefix", "need")
        sets = sets.select("dim", F.col("held").alias("queries"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("block"))
        # Never a broadcast: the planner's estimate of the sets counts none of their copies, that of the blocks no decoding.
        return held.hint("merge").join(sets, ["dim", "block"]).select("dim", "rows", "queries")

    best_first = Window.partitionBy("query").orderBy(F.desc("bin"))
    while bits > 0:
        bits = max(0, bits - BITS)
        counts = _each(paired(state), "query long, bin long, n long", _histogram(bits))
        sums = counts.groupBy("query", "bin").agg(F.sum("n").alias("n"))
        upto = sums.withColumn("upto", F.sum("n").over(best_first)).join(
            state.select(F.col("row").alias("query"), "need"), "query"
        )
        held_at = upto.where("upto >= need AND upto - n < need").select(
            F.col("query").alias("row"),
            F.lit(bits).cast("long").alias("next"),
            "bin",
            (F.col("need") - F.col("upto") + F.col("n")).alias("left"),
        )
        state = stored(
            state.join(held_at, "row", "left").select(
                "row",
                F.coalesce("next", "shift").alias("shift"),
                F.coalesce("bin", "prefix").alias("prefix"),
                F.coalesce("left", "need").alias("need"),
            ),
            "selection",
        )
    found = _each(paired(state), "query long, vec_id long, score long", _best)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    first = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    ids = asked.select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"))
    return first.join(ids, "query").select("query_id", "rank", "vec_id", "score")


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = whole_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return top_k(vectors, F.col("vec_id") % 50 == 0)


ORACLE = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_inner_product(q.v :: DOUBLE[], c.v :: DOUBLE[]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.r <> c.r AND len(q.v) = len(c.v)
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
