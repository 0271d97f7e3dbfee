"""Personal data: exact base kinds, and identifiers found by bootstrapped contexts.

The base kinds are found by pattern. Beside them every place of the form cue, sign, value
(``token = "..."``, ``phone: ...``) is an occurrence of a lexical pattern (cue, sign, quote)
with an instance (the value). So is every identifier-like value in running text ("call me at
+1 ..."), with its one to three words to the left and its one or two to the right as patterns.
A base find is an instance as a whole, blanks included. Base finds and long random strings are
the seeds. Spark scores the graph of patterns and instances in rounds: a pattern is worth the mean worth of its
distinct instances, drawn towards nothing where it has few; an instance that is no seed is
worth as much as its best pattern. A pattern of high worth then marks its values of six or more
characters with a digit, those with an @ for e-mail and, if it is a sure cue and sign of secrets, all as
identifiers of its kind, seen before or not; one of words marks those of the shape of its kind.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.llm.text import slices, stored

KINDS = ("email", "ip", "card", "phone", "secret")  # the order in which spans of one start stand
ROUNDS = 3
PRIOR = 2.0  # instances of no worth that every pattern is credited with
WORTH = 0.6  # of a pattern that marks its values of six characters or more with a digit
SURE = 0.8  # of a pattern of cue and sign for secrets that marks all its values
NAMED = 200  # characters beyond which a hash stands for a value

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
# Possessive and started at a number's first digit: the same finds, in linear time.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_LETTER = re.compile("[^\\W0-9_]")
_SIGN = re.compile("[:=]")
_CUE = re.compile(r"([A-Za-z][A-Za-z0-9_-]*)([\"']?)[ \t]{0,3}\Z")
_LEAD = re.compile(r"[ \t]{0,3}([\"']?)")
_VALUE = re.compile(r"[^\s\"',;]*+")
# Where a value within another one ends: before the next parameter, in an address at any delimiter.
_PARAMETER = re.compile(r"[&?#](?=[A-Za-z][A-Za-z0-9_.-]*+=)")
_DELIMITER = re.compile("[&?#]")
# Values in running text: runs that hold a digit or an @, numbers in groups, and IPv6 addresses.
_RUN = re.compile(
    r"(?<![^\s\"'`<>(){}\[\],;:|=&?#])[^0-9@\s\"'`<>(){}\[\],;:|=&?#]*+[0-9@][^\s\"'`<>(){}\[\],;:|=&?#]*+"
    r"(?:={1,2}(?![^\s\"'`<>(){}\[\],;:|&?#]))?"
)
_NUMBER = re.compile(r"(?<![\w.+@-])(?:\+[0-9]{1,3}[ ().-]{0,3})?\(?[0-9]{2,}+(?:[ ().+/-]{1,3}[0-9]{2,}+)*+(?![\w@])")
_IP6 = re.compile(r"(?<![\w:])(?:[0-9A-Fa-f]{0,4}:){3,7}[0-9A-Fa-f]{0,4}(?![\w:])")
_WORD = re.compile(r"\w+")
NEAR = 96  # characters on each side in which the words beside a value are sought
_RANDOM = re.compile(r"(?=.*[0-9])(?:[0-9a-f]{32,}|[0-9A-F]{32,}|(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/_-]{24,}={0,2})\Z")
_LIKELY = re.compile(r"(?=.*[0-9]).{6,}\Z", re.S)


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping, found from each @ outwards, so that long runs cost nothing extra."""
    end, at = 0, text.find("@")
    while at >= 0:
        found = _DOMAIN.match(text, at)
        start = at
        while found and start > end and _LOCAL.match(text, start - 1):
            start -= 1
        if found and start < at:
            yield start, found.end()
            end = found.end()
        at = text.find("@", max(end, at + 1))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base kinds, sorted."""
    found = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = _digits(m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_digits(m[0])) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def _covering(base: list[tuple[int, int, int]], widest: int, start: int, end: int) -> tuple[int, int, int] | None:
    """The first base span that touches the place."""
    for i in range(bisect_left(base, (start - widest,)), len(base)):
        if base[i][0] >= end:
            return None
        if base[i][2] > start:
            return base[i]
    return None


def _grouped(text: str, start: int, end: int | None = None) -> re.Match | None:
    """A number of 7 to 19 digits at this place, which may have blanks."""
    found = _NUMBER.match(text, start, len(text) if end is None else end)
    return found if found and 7 <= len(_digits(found[0])) <= 19 else None


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, str | None]]:
    """(start, end, seed kind or None) of the values in running text: base spans as a whole, and others by shape."""
    found = [(a, b, KINDS[k]) for a, k, b in base]
    if not ("@" in text or _DIGIT.search(text) or "::" in text):
        return found
    widest = max((b - a for a, _, b in base), default=0)
    for m in _RUN.finditer(text):
        run = m[0].rstrip(".!*~")
        start = m.start() + len(run) - len(run := run.lstrip(".!*~"))
        end = start + len(run)
        random = _RANDOM.match(text, start, end)
        if not random and (len(run) < 6 or not _LETTER.search(run) or _covering(base, widest, start, end)):
            continue
        found.append((start, end, "secret" if random else None))
    for m in _IP6.finditer(text):
        if _DIGIT.search(m[0]) and not _covering(base, widest, *m.span()):
            found.append((*m.span(), None))
    gaps = zip([0, *(b for _, _, b in base)], [*(a for a, _, _ in base), len(text)], strict=True)
    for left, right in gaps:
        for m in _NUMBER.finditer(text, left, right):
            if 7 <= len(_digits(m[0])) <= 19:
                found.append((*m.span(), None))
    return found


def beside(text: str, start: int, end: int) -> Iterator[str]:
    """The patterns of a place in running text: its neighbouring words, each with a blank for the value's side."""
    left = _WORD.findall(text[max(0, start - NEAR) : start].lower())[-3:]
    right = _WORD.findall(text[end : end + NEAR].lower())[:2]
    for n in range(1, len(left) + 1):
        yield " ".join(left[-n:]) + " _"
    for n in range(1, len(right) + 1):
        yield "_ " + " ".join(right[:n])


def _names(text: str, starts: list[int], end: int) -> dict[int, str]:
    """A short name of ``text[start:end]`` for each start, the first and those behind each sign, in one pass.

    Equal values have equal names. A name has a digit or an @ if its value has one.
    """
    names, chain, digit, at = {}, b"", False, False
    for start, stop in zip(reversed(starts), [end, *reversed(starts)], strict=False):
        part = text[start:stop]
        chain = blake2b(part.encode() + chain, digest_size=16).digest()
        digit, at = digit or bool(_DIGIT.search(part)), at or "@" in part
        spelled = "".join(chr(97 + (byte >> 4)) + chr(97 + (byte & 15)) for byte in chain)
        names[start] = f"# {spelled}{'0' * digit}{'@' * at}"
    return names


def named(value: str) -> str:
    """The value, or a name for it if it is long."""
    if len(value) <= NAMED:
        return value
    starts = [0, *(m.end() for m in _SIGN.finditer(value) if m.end() < len(value))]
    return _names(value, starts, len(value))[0]


def occurrences(text: str, base: list[tuple[int, int, int]]) -> list[tuple]:
    """(pattern, value, start, end, seed kind or None) of each cue, sign and value, then of each value and its neighbours.

    A value goes on to the end of its run, however long, or to the end of the base span or
    number in groups that begins there. A sign within a value starts another, to the next
    parameter or else to the same end; if it is long, its name is given, so that the values
    of a text take no more room than a multiple of the text.
    """
    found, reach, stop, url, names = [], 0, 0, False, {}
    widest = max((b - a for a, _, b in base), default=0)
    signs = [m.end() for m in _SIGN.finditer(text)]
    for i, after in enumerate(signs):
        cue = _CUE.search(text, max(0, after - 49), after - 1)
        if not cue:
            continue
        inner = after < reach
        if inner:
            quote, start = "", after
            if stop < start:
                delimiter = (_DELIMITER if url else _PARAMETER).search(text, start, reach)
                stop, names = delimiter.start() if delimiter else reach, {}
            end = stop
            if end - start < 4:
                continue
        else:
            lead = _LEAD.match(text, after)
            quote, start = lead[1], lead.end()
            end = _VALUE.match(text, start).end()
            whole = _covering(base, widest, start, start + 1)
            number = None if whole else _grouped(text, start)
            if end - start < 4 and not whole and not number:
                continue
            end = max(end, whole[2] if whole else 0, number.end() if number else 0)
            reach, stop, url = end, 0, text.find("://", after - 1, end) >= 0
        if inner and end - start > NAMED:
            if start not in names:
                names = _names(text, signs[i : bisect_left(signs, end)], end)
            value = names[start]
        else:
            value = text[start:end]
        near = _covering(base, widest, start, end)
        # A sign before the closing ones rules a random string out.
        later = bisect_right(signs, start)
        plain = later == len(signs) or signs[later] > end - 2
        kind = "secret" if plain and _RANDOM.match(text, start, end) else KINDS[near[1]] if near else None
        found.append((f"{cue[1].lower()}{cue[2]}{text[after - 1]}{quote}", value, start, end, kind))
    for start, end, kind in candidates(text, base):
        value = text[start:end]
        found.extend((pattern, value, start, end, kind) for pattern in beside(text, start, end))
    return found


FOUND = (
    "doc_id long, hash long, base array<struct<start: int, kind: int, end: int>>,"
    " seen array<struct<pattern: string, value: string, start: int, end: int, seed: string>>"
)


def _found(docs: DataFrame, text: str, key: str) -> DataFrame:
    spans = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
    places = pa.list_(
        pa.struct([("pattern", pa.string()), ("value", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("seed", pa.string())])
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            base, seen = [], []
            for whole in batch.column(1).to_pylist():
                whole = whole or ""
                spans_here = base_spans(whole)
                base.append([dict(zip(("start", "kind", "end"), s, strict=True)) for s in spans_here])
                names = ("pattern", "value", "start", "end", "seed")
                seen.append([dict(zip(names, (p, named(v), *o), strict=True)) for p, v, *o in occurrences(whole, spans_here)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(base, spans), pa.array(seen, places)],
                ["doc_id", "hash", "base", "seen"],
            )

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text), F.xxhash64(text)).mapInArrow(run, FOUND)


# Of the values beside worthy words, those that look like the kind.
SHAPED = r"""CASE kind WHEN 'email' THEN contains(value, '@')
    WHEN 'ip' THEN value RLIKE '^([0-9]+[.]){3}[0-9]+$|^([0-9A-Fa-f]{0,4}:){3,7}[0-9A-Fa-f]{0,4}$'
    WHEN 'secret' THEN value RLIKE '[A-Za-z]' AND NOT contains(value, '@')
    ELSE value RLIKE '^[ 0-9().+/-]+$' END"""


# What needs no digit and may be short.
SPARED = f"""CASE kind WHEN 'email' THEN contains(value, '@')
    WHEN 'secret' THEN worth >= {SURE} AND NOT contains(pattern, ' ') ELSE false END"""


def worthy_patterns(places: DataFrame, rounds: int = ROUNDS, worth: float = WORTH) -> DataFrame:
    """(pattern, kind, worth) whose values are identifiers, from ``places`` (pattern, value, seed)."""
    known = F.array(*map(F.lit, sorted(KINDS)))  # as numbers, so that a hash table counts them where they are found
    seed = F.max(F.array_position(known, F.col("seed")).cast("int"))
    pairs = stored(places.groupBy("pattern", "value").agg(seed.alias("k")), "pairs")
    # A pattern of one value gives it back less than it has, so those change nothing.
    sizes = pairs.groupBy("pattern").agg(F.count("*").alias("n")).where("n > 1")
    links = stored(pairs.join(sizes, "pattern"), "links")
    told = pairs.where("k IS NOT NULL").select("value", F.get(known, F.col("k") - 1).alias("kind")).distinct()
    seeds = stored(told.join(links.select("value").distinct(), "value", "left_semi").withColumn("s", F.lit(1.0)), "seeds")
    instances = seeds
    for _ in range(rounds):
        scored = links.join(instances, "value").groupBy("pattern", "n", "kind").agg(F.sum("s").alias("s"))
        patterns = stored(scored.select("pattern", "kind", (F.col("s") / (F.col("n") + PRIOR)).alias("p")), "patterns")
        told = links.join(patterns, "pattern").groupBy("value", "kind").agg(F.max("p").alias("s"))
        instances = told.unionByName(seeds).groupBy("value", "kind").agg(F.max("s").alias("s"))
    best = F.max_by("kind", F.struct("p", "kind")).alias("kind"), F.max("p").alias("worth")
    return patterns.where(F.col("p") >= worth).groupBy("pattern").agg(*best)


def personal_data(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256, spans, marks and hash (of the text), one row per row.

    ``marks`` are all spans as (start, end, kind) in order, discovered ones unless
    they equal a base span; they may overlap. A null or empty text has none. Null and repeated ids are rows like
    any other.
    """
    rows = stored(_found(docs, text, key).withColumn("row", F.monotonically_increasing_id()), "found")
    places = rows.select("row", F.explode("seen").alias("s")).select("row", "s.*")
    marked = (
        places.join(worthy_patterns(places), "pattern")
        .where(F.col("value").rlike(_LIKELY.pattern.replace(r"\Z", "$")) | F.expr(SPARED))
        .where(f"NOT contains(pattern, ' ') OR {SHAPED}")
        .groupBy("row")
        .agg(F.collect_set(F.struct("start", "end", "kind")).alias("more"))
    )
    names = F.array(*map(F.lit, KINDS))
    named = lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("order"), s["end"].alias("end"))
    order = lambda s: F.struct(
        s["start"].alias("start"), (F.array_position(names, s["kind"]) - 1).cast("int").alias("order"), s["end"].alias("end")
    )
    free = lambda s: ~F.exists("base", lambda b: (b["start"] == s["start"]) & (b["end"] == s["end"]))
    said = lambda s: F.concat_ws(":", F.get(names, s["order"]), s["start"], s["end"])
    joined = rows.select("row", "doc_id", "hash", "base").join(marked, "row", "left")
    own = F.transform("base", named)
    every = F.array_sort(F.concat(own, F.coalesce(F.transform(F.filter("more", free), order), F.expr("slice(transform(base, b -> struct(b.start, b.kind AS order, b.end)), 1, 0)"))))
    counts = [F.expr(f"bigint(size(filter(base, s -> s.kind = {k})))").alias(f"n_{KINDS[k]}") for k in range(4)]
    return joined.select(
        "doc_id",
        *counts,
        F.sha2(F.encode(F.array_join(F.transform(own, said), ","), "UTF-8"), 256).alias("base_sha256"),
        F.array_join(F.transform(every, said), ",").alias("spans"),
        F.transform(every, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.get(names, s["order"]).alias("kind"))).alias("marks"),
        "hash",
    )


def redacted(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with each span of ``text`` replaced by its kind in angle brackets; other texts as they are.

    Spans that overlap are replaced as one, by the kind of the first.
    """
    marks = personal_data(docs, text, key).where(F.size("marks") > 0).select("doc_id", "hash", "marks")
    marks = marks.dropDuplicates(["doc_id", "hash"])  # repeated rows have the same marks
    rows = docs.select(F.struct(*docs.columns).alias("d"), F.xxhash64(text).alias("h"))
    same = F.col(f"d.{key}").eqNullSafe(F.col("doc_id")) & (F.col("h") == F.col("hash"))
    clean = F.expr(
        f"""aggregate(marks, named_struct('out', '', 'at', 0), (a, m) ->
            named_struct('out', CASE WHEN m.start < a.at THEN a.out
                ELSE concat(a.out, substring(d.`{text}`, a.at + 1, m.start - a.at), '<', upper(m.kind), '>') END,
                'at', greatest(a.at, m.end)),
            a -> concat(a.out, substring(d.`{text}`, a.at + 1)))"""
    )
    new = F.when(F.col("marks").isNull(), F.col(f"d.{text}")).otherwise(clean).alias(text)
    return rows.join(marks, same, "left").select(*[new if c == text else F.col(f"d.{c}") for c in docs.columns])


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("marks", "hash")
