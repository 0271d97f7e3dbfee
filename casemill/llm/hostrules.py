"""Quality rules per document, judged with what is known of the document's host.

Each rule measures a document. Over its limit counts one point, over twice the limit two.
Failures are counted per host, those of the base rule too, and each host's rate is shrunk
towards the hosts' mean rate by a beta prior. How much hosts differ, and so the prior's
weight, is told by pairs: two documents of one host fail together more often than two
documents at large only where hosts differ. A host that still has a high rate without the document in question is
condemned for that rule, which adds a point to each of its documents that fails it; one
condemned for the base rule adds a point to those that fail any rule. So a document is
never evidence against itself, a host of one document is never condemned, and two points
reject a document. One that fails no rule is kept, whatever its host.

Built-in expressions only. The sums per rule that describe all hosts are the only numbers
that come to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.llm.text import stored

SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 8
HIGH = 0.2  # a host is condemned from this shrunk rate on, if it is also twice the mean


@dataclass(frozen=True)
class Rule:
    name: str
    fails: str  # over the limit
    gross: str  # over twice the limit


RULES = (
    Rule("symbols", "10 * n_symbols > n_words", "5 * n_symbols > n_words"),
    Rule("lines", "10 * n_dup_lines > 3 * n_lines", "10 * n_dup_lines > 6 * n_lines"),
    Rule(
        "lengths",
        "word_chars < 3 * n_words OR word_chars > 12 * n_words",
        "2 * word_chars < 3 * n_words OR word_chars > 24 * n_words",
    ),
    Rule("letters", "10 * n_bare_words > 3 * n_words", "10 * n_bare_words > 6 * n_words"),
    Rule("endings", "10 * n_open_lines > 3 * n_lines", "10 * n_open_lines > 6 * n_lines"),
)
LETTER = r"[A-Za-z\x{80}-\x{10FFFF}]"  # a letter, or anything beyond ASCII
OPEN = r"(\.\.\.|\x{2026})[\x20\x09-\x0D]*\z"  # a line that breaks off
BASE_FAILED = "n_words < 20 OR 100 * n_repeat_words > 30 * n_words"


def _twice(items: str) -> Column:
    """The ``at`` of those elements of a sorted array whose ``what`` equals a neighbour's."""
    return F.expr(
        f"transform(filter({items}, (x, j) -> x.what <=> get({items}, j - 1).what AND j > 0"
        f" OR x.what <=> get({items}, j + 1).what AND j + 1 < size({items})), x -> x.at)"
    )


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words,
    n_bare_words (without a letter) and n_open_lines (that end in three dots).

    A word stands in a repeated window if the text holds the window's words twice. Hashes
    of windows are compared first: equal windows have equal hashes, so a text whose hashes
    differ is done. The windows of equal hashes are then compared as text.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(whole, SPACE), lambda w: w != "")
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    none = "CAST(array() AS array<struct<what: {}, at: int>>)"
    return (
        docs.withColumns({"_words": words, "_lines": lines, "n_symbols": F.regexp_count(whole, F.lit(r"[#*$%&|<>]")).cast("long")})
        .withColumns(
            {
                "n_words": F.size("_words").cast("long"),
                "word_chars": F.length(F.array_join("_words", "")).cast("long"),
                "n_lines": F.size("_lines").cast("long"),
                "n_bare_words": F.size(F.filter("_words", lambda w: ~w.rlike(LETTER))).cast("long"),
                "n_open_lines": F.size(F.filter("_lines", lambda line: line.rlike(OPEN))).cast("long"),
                "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
                "_hashes": F.expr(
                    f"CASE WHEN size(_words) < {WINDOW} THEN CAST(array() AS array<bigint>)"
                    f" ELSE transform(sequence(1, size(_words) - {WINDOW - 1}), i -> xxhash64(slice(_words, i, {WINDOW}))) END"
                ),
            }
        )
        .withColumn("_differ", F.size(F.array_distinct("_hashes")) == F.size("_hashes"))
        .withColumn(
            "_sorted",
            F.expr(
                f"CASE WHEN _differ THEN {none.format('bigint')}"
                " ELSE array_sort(transform(_hashes, (h, i) -> named_struct('what', h, 'at', i))) END"
            ),
        )
        .withColumn("_maybe", _twice("_sorted"))
        .withColumn(
            "_texts",
            F.expr(
                "array_sort(transform(_maybe, i -> named_struct('what',"
                f" array_join(slice(_words, i + 1, {WINDOW}), ' '), 'at', i)))"
            ),
        )
        .withColumn("_at", F.array_sort(_twice("_texts")))
        .withColumn(
            "n_repeat_words",
            F.expr(
                "aggregate(transform(_at, (x, j) ->"
                f" least({WINDOW}, coalesce(get(_at, j + 1) - x, {WINDOW}))), 0L, (s, x) -> s + x)"
            ),
        )
        .drop("_words", "_lines", "_hashes", "_differ", "_sorted", "_maybe", "_texts", "_at")
    )


def prior(hosts: int, rates: float, paired: int, pairs: float) -> tuple[float, float] | None:
    """The mean rate of hosts, and the weight in documents of the prior; None if hosts do not differ.

    By moments: ``rates`` is the sum of the hosts' rates, ``pairs`` that of the shares of
    failing pairs in the ``paired`` hosts of two documents and more. Neither grows with
    the noise of small hosts: pairs fail together more often than the mean's square only
    where hosts differ, and a host of one document has none.
    """
    if not hosts or not paired:
        return None
    rate = rates / hosts
    between = pairs / paired - rate * rate
    if not 0.0 < rate < 1.0 or between <= 1e-12:
        return None
    return rate, max(rate * (1 - rate) / between - 1, 0.0)


def judge(rows: DataFrame, host: str) -> DataFrame:
    """``rows`` (stored measures) with base_failed and kept. A null host is a host like any other."""
    points = {r.name: F.expr(f"int({r.fails}) + int({r.gross})") for r in RULES}
    points["base"] = F.expr(f"int({BASE_FAILED})")
    marked = rows.withColumns(
        {"_host": F.coalesce(F.col(host), F.lit("")), **{f"_{n}": p for n, p in points.items()}}
    )
    failures = [F.sum(F.signum(f"_{n}").cast("long")).alias(f"_{n}_failed") for n in points]
    hosts = stored(marked.groupBy("_host").agg(F.count("*").alias("_n"), *failures), "hosts")
    n = F.col("_n").cast("double")
    sums = [F.count("*").alias("hosts"), F.count_if(n > 1).alias("paired")]
    for name in points:
        f = F.col(f"_{name}_failed").cast("double")
        together = F.when(n > 1, f * (f - 1) / (n * (n - 1)))
        sums += [F.sum(f / n).alias(f"{name}_rates"), F.sum(together).alias(f"{name}_pairs")]
    facts = hosts.agg(*sums).first()
    verdicts = []
    for name in points:
        found = prior(facts["hosts"], facts[f"{name}_rates"], facts["paired"], facts[f"{name}_pairs"])
        condemned = F.lit(False)
        if found:
            rate, weight = found
            others = (F.col(f"_{name}_failed") - 1 + rate * weight) / (F.col("_n") - 1 + weight)
            condemned = (F.col("_n") > 1) & (F.col(f"_{name}_failed") > 0) & (others >= max(HIGH, 2 * rate))
        verdicts.append(condemned.alias(f"_{name}_host"))
    judged = marked.join(hosts.select("_host", *verdicts), "_host")
    own = sum((F.col(f"_{r.name}") for r in RULES), F.lit(0))
    added = sum(((F.col(f"_{r.name}_host") & (F.col(f"_{r.name}") > 0)).cast("int") for r in RULES), F.lit(0))
    added += (F.col("_base_host") & (own > 0)).cast("int")
    extra = [c for name in points for c in (f"_{name}", f"_{name}_host")]
    return (
        judged.withColumn("base_failed", F.col("_base") > 0)
        .withColumn("kept", ~F.col("base_failed") & (own + added < 2))
        .drop("_host", *extra)
    )


def quality_verdicts(docs: DataFrame, text: str = "text", host: str = "source", key: str = "doc_id") -> DataFrame:
    """doc_id, the measures, base_failed and kept, one row per row.

    A null or empty text has no words and fails. Null and repeated ids are rows like any other.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.col(host).alias("host"))
    return judge(stored(measures(rows).drop("text"), "measures"), "host").drop("host", "n_lines", "n_bare_words", "n_open_lines")


def passed(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns."""
    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.col(text).alias("text"), F.col(host).alias("host"))
    return judge(stored(measures(rows).drop("text"), "measures"), "host").where("kept").select("doc.*")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = """
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), windows AS (
  SELECT r, i, array_to_string(w[i:i + 7], ' ') AS what
  FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM words WHERE len(w) >= 8)
), repeated AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, what) AS c FROM windows) WHERE c > 1
), covered AS (
  SELECT r, sum(least(8, coalesce(after - i, 8))) AS n
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS after FROM repeated) GROUP BY r
), lines AS (
  SELECT r, count(*) AS n, count(*) - count(DISTINCT line) AS dup,
         count(*) FILTER (regexp_matches(line, '(\\.\\.\\.|\\x{2026})[\\x20\\x09-\\x0D]*\\z')) AS open
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM words)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY r
), m AS (
  SELECT words.r, doc_id, host, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         len([x FOR x IN w IF NOT regexp_matches(x, '[A-Za-z\\x{80}-\\x{10FFFF}]')]) AS bare, coalesce(open, 0) AS open,
         CAST(coalesce(lines.n, 0) AS BIGINT) AS n_lines, CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
  FROM words LEFT JOIN lines USING (r) LEFT JOIN covered USING (r)
), p AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         [CAST(10 * n_symbols > n_words AS INT) + CAST(5 * n_symbols > n_words AS INT),
          CAST(10 * n_dup_lines > 3 * n_lines AS INT) + CAST(10 * n_dup_lines > 6 * n_lines AS INT),
          CAST(word_chars < 3 * n_words OR word_chars > 12 * n_words AS INT)
          + CAST(2 * word_chars < 3 * n_words OR word_chars > 24 * n_words AS INT),
          CAST(10 * bare > 3 * n_words AS INT) + CAST(10 * bare > 6 * n_words AS INT),
          CAST(10 * open > 3 * n_lines AS INT) + CAST(10 * open > 6 * n_lines AS INT)] AS points FROM m
), marks AS (
  SELECT r, host, rule, CASE WHEN rule = 6 THEN CAST(base_failed AS INT) ELSE points[rule] END AS mark,
         list_sum(points) AS own
  FROM p, (SELECT unnest(range(1, 7)) AS rule)
), hosts AS (
  SELECT host, rule, count(*) * 1e0 AS n, count(*) FILTER (mark > 0) * 1e0 AS f FROM marks GROUP BY ALL
), common AS (
  SELECT rule, avg(f / n) AS rate, avg(f * (f - 1) / (n * (n - 1))) FILTER (n > 1) AS pairs FROM hosts GROUP BY rule
), prior AS (
  SELECT rule, rate, CASE WHEN rate > 0 AND rate < 1 AND pairs - rate * rate > 1e-12
    THEN greatest(rate * (1 - rate) / (pairs - rate * rate) - 1, 0) END AS weight FROM common
), verdicts AS (
  SELECT host, rule, n > 1 AND f > 0
    AND (f - 1 + rate * weight) / (n - 1 + weight) >= greatest(0.2e0, 2 * rate) AS condemned
  FROM hosts JOIN prior USING (rule)
), added AS (
  SELECT r, sum(CAST(coalesce(condemned, false) AND CASE WHEN rule = 6 THEN own > 0 ELSE mark > 0 END AS INT)) AS more
  FROM marks JOIN verdicts USING (host, rule) GROUP BY r
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND list_sum(points) + more < 2 AS kept
FROM p JOIN added USING (r)
"""
