"""License detection by signature rules, gated by keywords.

The rules below come from a table of licenses, their names, their versions and the forms in
which they are cited. Texts are reduced to lower-case words with one space between, so a
rule is a regular expression over words. A text that has none of the gates' words is done
after a substring test; the others meet only the rules whose keyword they hold.

Detections are intervals of words. One that lies within another goes, as does, of two equal
ones, that of lower priority; of neighbours that still overlap, the one of lower priority goes.

Built-in expressions only.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casemill.llm.text import stored

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # before lowering, A-Z are letters too
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Every rule holds one of these words, and so does every base phrase; "cc" with what may follow is ``CC``.
GATES = (
    "licen", "rights", "copyright", "spdx", "domain", "warranty", "redistribut", "gpl", "gfdl", "proprietary",
    "permission", "clause", "cc0", "creative", "reproduced",
)
CC = r"(?i)(?<![0-9a-z])(cc|creative)[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+(by|commons|0|zero)"


@dataclass(frozen=True)
class Signature:
    id: int
    label: str
    priority: int
    confidence: float
    keyword: str  # a text without it cannot match
    pattern: str


@dataclass(frozen=True)
class License:
    label: str
    names: tuple[str, ...]  # the first word of each is its keyword
    versions: tuple[str, ...] = ()


# Names and versions as licenses are cited; versions are written with spaces for dots.
LICENSES = (
    License("gpl", ("gnu general public license", "general public license", "gnu gpl", "gpl"), ("1", "2", "3")),
    License("lgpl", ("gnu lesser general public license", "gnu library general public license", "lgpl"), ("2", "2 1", "3")),
    License("agpl", ("gnu affero general public license", "affero general public license", "agpl"), ("1", "3")),
    License("gfdl", ("gnu free documentation license", "gfdl"), ("1 1", "1 2", "1 3")),
    License("apache", ("apache license", "apache software license"), ("1", "1 1", "2")),
    License("mpl", ("mozilla public license",), ("1", "1 1", "2")),
    License("epl", ("eclipse public license",), ("1", "2")),
    License("cddl", ("common development and distribution license",), ("1", "1 1")),
    License("cpl", ("common public license",), ("1",)),
    License("eupl", ("european union public licence", "eupl licence"), ("1", "1 1", "1 2")),
    License("osl", ("open software license",), ("1", "2", "2 1", "3")),
    License("afl", ("academic free license",), ("1 1", "1 2", "2", "2 1", "3")),
    License("apsl", ("apple public source license",), ("1", "1 1", "1 2", "2")),
    License("artistic", ("artistic license",), ("1", "2")),
    License("ofl", ("sil open font license", "open font license"), ("1", "1 1")),
    License("lppl", ("latex project public license",), ("1", "1 1", "1 2", "1 3")),
    License("python", ("python software foundation license",), ("2",)),
    License("php", ("php license",), ("3", "3 01")),
    License("zpl", ("zope public license",), ("1 1", "2", "2 1")),
    License("bsl", ("boost software license",), ("1",)),
    License("odbl", ("open database license", "odc open database license"), ("1",)),
    License("ogl", ("open government licence",), ("1", "2", "3")),
    License("openldap", ("openldap public license",), ("2", "2 1", "2 8")),
    License("qpl", ("q public license",), ("1",)),
    License("ms-pl", ("microsoft public license",)),
    License("ms-rl", ("microsoft reciprocal license",)),
    License("mit", ("mit license", "mit licence", "expat license", "x11 license")),
    License("isc", ("isc license",)),
    License("zlib", ("zlib license", "zlib libpng license")),
    License("bsd", ("bsd license", "bsd style license", "berkeley software distribution license")),
    License("unlicense", ("unlicense",)),
    License("wtfpl", ("do what the fuck you want to public license",)),
    License("ncsa", ("university of illinois ncsa open source license", "ncsa license")),
    License("postgresql", ("postgresql license",)),
    License("openssl", ("openssl license",)),
    License("vim", ("vim license",)),
    License("ijg", ("independent jpeg group license",)),
    License("intel", ("intel open source license",)),
    License("upl", ("universal permissive license",), ("1",)),
)
CREATIVE = {"by": "attribution", "sa": "sharealike|share alike", "nc": "noncommercial|non commercial", "nd": "noderivatives|noderivs|no derivatives|no derivs"}
KINDS = (("by",), ("by", "sa"), ("by", "nc"), ("by", "nd"), ("by", "nc", "sa"), ("by", "nc", "nd"))
PORTS = ("1", "2", "2 5", "3", "4")
NOTICES = (
    ("reserved", 2, 0.6, "rights", r"all rights (?:are )?(?:strictly )?reserved"),
    ("some-reserved", 2, 0.6, "rights", r"some rights reserved"),
    ("copyright", 1, 0.4, "copyright", r"copyright (?:c )?(?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2})?"),
    ("mit", 6, 0.9, "permission", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("bsd", 6, 0.9, "redistribution", r"redistribution and use in source and binary forms with or without modification"),
    ("bsd", 6, 0.9, "redistributions", r"redistributions of source code must retain the above copyright notice"),
    ("bsd-2-clause", 7, 0.9, "bsd", r"(?:2|two) clause bsd(?: license)?|bsd (?:2|two) clause(?: license)?"),
    ("bsd-3-clause", 7, 0.9, "bsd", r"(?:3|three) clause bsd(?: license)?|bsd (?:3|three) clause(?: license)?"),
    ("bsd-4-clause", 7, 0.9, "bsd", r"(?:4|four) clause bsd(?: license)?|bsd (?:4|four) clause(?: license)?"),
    ("isc", 6, 0.9, "permission", r"permission to use copy modify and or distribute this software for any purpose"),
    ("public-domain", 3, 0.7, "domain", r"(?:released|dedicated|placed) (?:in|into|to) the public domain"),
    ("cc0", 7, 0.9, "cc0", r"cc0(?: 1 0)?(?: universal)?"),
    ("cc0", 7, 0.9, "zero", r"(?:cc|creative commons) zero(?: 1 0)?"),
    ("proprietary", 3, 0.7, "proprietary", r"(?:proprietary and confidential|confidential and proprietary)"),
    ("proprietary", 3, 0.7, "reproduced", r"no part of this \w+ may be reproduced"),
    ("warranty", 1, 0.4, "warranty", r"without warranty of any kind"),
    ("warranty", 1, 0.4, "warranty", r"without any warranty"),
)

# Identifiers with a suffix, which a rule for the bare name would cut short.
SUFFIXED = (
    ("bsd-2-clause", r"bsd 2 clause(?: (?:patent|views|first lines|freebsd|netbsd|darwin))?"),
    ("bsd-3-clause", r"bsd 3 clause(?: (?:clear|lbnl|modification|attribution|open mpi|flex|hp|sun|acpica|no nuclear license(?: 2014)?|no nuclear warranty|no military license))?"),
    ("bsd-4-clause", r"bsd 4 clause(?: (?:uc|shortened))?"),
    ("bsd", r"bsd (?:1 clause|source code|protection|systemics|attribution hpnd disclaimer)"),
    ("mit", r"mit (?:0|cmu|advertising|enna|feh|festival|modern variant|open group|wu|testregex|click|khronos old)"),
    ("cc0", r"cc0(?: 1 0)?"),
    ("isc", r"isc veillard"),
    ("zlib", r"zlib acknowledgement"),
)


def _version(words: str) -> str:
    """A version with or without its closing zeros."""
    return words if " " in words else f"{words}(?: 0){{0,2}}"


def signatures() -> list[Signature]:
    """All rules, numbered in order."""
    found: list[tuple[str, int, float, str, str]] = []
    for one in LICENSES:
        for name in one.names:
            keyword = name.split()[0]
            found.append((one.label, 4, 0.7, keyword, name))
            found.append((one.label, 5, 0.8, keyword, rf"(?:licensed|released|distributed|available) under (?:the )?(?:terms of the )?{name}"))
            for version in one.versions:
                label = f"{one.label}-{version.replace(' ', '.')}{'' if ' ' in version else '.0'}"
                tail = rf"(?: license)? (?:version |v )?(?:v)?{_version(version)}(?: or (?:any )?later(?: version)?| only)?"
                found.append((label, 8, 0.9, keyword, name + tail))
        for version in one.versions:
            label = f"{one.label}-{version.replace(' ', '.')}{'' if ' ' in version else '.0'}"
            short = one.label.replace("-", " ")
            found.append((label, 9, 0.99, "spdx", rf"spdx license identifier {short} {_version(version)}(?: (?:only|or later))?"))
        if not one.versions:
            found.append((one.label, 9, 0.99, "spdx", rf"spdx license identifier {one.label.replace('-', ' ')}"))
    for kind in KINDS:
        short, label = " ".join(kind), "cc-" + "-".join(kind)
        long = " ".join(f"(?:{CREATIVE[k]})" for k in kind)
        found.append((label, 5, 0.8, "cc", f"cc {short}"))
        found.append((label, 5, 0.8, "commons", f"creative commons {long}(?: licen[cs]e)?"))
        for port in PORTS:
            full = f"{label}-{port.replace(' ', '.')}{'' if ' ' in port else '.0'}"
            found.append((full, 8, 0.9, "cc", f"cc {short} {_version(port)}"))
            found.append((full, 8, 0.9, "commons", f"creative commons {long} {_version(port)}(?: \\w+)? licen[cs]e"))
            found.append((full, 9, 0.99, "spdx", f"spdx license identifier cc {short} {_version(port)}"))
    found += NOTICES
    for label, short in SUFFIXED:
        found.append((label, 9, 0.99, "spdx", f"spdx license identifier {short}"))
    return [Signature(i, *rest) for i, rest in enumerate(found)]


def _whole(pattern: str) -> str:
    return f"(?<= )(?:{pattern})(?= )"


def _words(text: str) -> str:
    return f"regexp_count({text}, '[^ ]+')"


def gated(docs: DataFrame, text: str, key: str) -> DataFrame:
    """doc_id, n_words, and ``norm``: the words with spaces around, where a gate opens; else null."""
    whole = F.coalesce(F.col(text), F.lit(""))
    opens = F.lit(False)
    for gate in GATES:
        opens = opens | F.col("_low").contains(gate)
    norm = F.concat(F.lit(" "), F.array_join(F.regexp_extract_all("_low", F.lit(WORD), F.lit(0)), " "), F.lit(" "))
    return (
        docs.select(F.col(key).alias("doc_id"), whole.alias("_text"))
        .withColumns({"n_words": F.regexp_count("_text", F.lit(WORD)).cast("long"), "_low": F.lower("_text")})
        .withColumn("norm", F.when(opens | F.col("_text").rlike(CC), norm))
        .select("doc_id", "n_words", "norm")
    )


def detections(rows: DataFrame) -> DataFrame:
    """(row, label, confidence) of the surviving detections in ``rows`` (row, norm)."""
    rules = json.dumps([asdict(s) for s in signatures()])
    schema = "array<struct<id: int, label: string, priority: int, confidence: double, keyword: string, pattern: string>>"
    held = F.filter(F.from_json(F.lit(rules), schema), lambda r: F.contains(F.col("norm"), F.concat(F.lit(" "), r["keyword"])))
    pattern = F.concat(F.lit("(?<= )(?:"), F.col("rule.pattern"), F.lit(")(?= )"))
    matched = (
        rows.select("row", "norm", F.explode(held).alias("rule"))
        .withColumn("pattern", pattern)
        .where(F.expr("norm RLIKE pattern"))
        .select("row", "rule", F.split("norm", F.col("pattern")).alias("gaps"), F.regexp_extract_all("norm", F.col("pattern"), F.lit(0)).alias("hits"))
        .select("row", "rule", F.posexplode(F.arrays_zip("gaps", "hits")).alias("k", "piece"))
        .where("piece.hits IS NOT NULL")
        .select("row", "rule", "k", F.expr(_words("piece.gaps")).alias("gap"), F.expr(_words("piece.hits")).alias("size"))
    )
    before = Window.partitionBy("row", "rule.id").orderBy("k")
    spans = matched.select(
        "row", "rule", (F.sum(F.col("gap") + F.col("size")).over(before) - F.col("size")).alias("start"), "size"
    ).select("row", "rule", "start", (F.col("start") + F.col("size")).alias("end"))
    order = [F.col("start"), F.desc("end"), F.desc("rule.priority"), F.col("rule.id")]
    earlier = Window.partitionBy("row").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    outer = spans.withColumn("reach", F.max("end").over(earlier)).where("reach IS NULL OR end > reach")
    near = Window.partitionBy("row").orderBy("start")
    sides = outer.select(
        "*",
        F.lag(F.struct("end", "rule.priority")).over(near).alias("left"),
        F.lead(F.struct("start", "rule.priority")).over(near).alias("right"),
    )
    loses = "(left.end > start AND left.priority > rule.priority) OR (right.start < end AND right.priority > rule.priority)"
    return sides.where(f"NOT coalesce({loses}, false)").select("row", "rule.label", "rule.confidence")


def license_labels(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_words, the base places and labels, all labels, and a score, one row per row.

    ``score`` is the highest confidence of a detection, 0.5 at least where a base phrase
    stands, else 0. A null text has no words. Null and repeated ids are rows like any other.
    """
    rows = stored(gated(docs, text, key).withColumn("row", F.monotonically_increasing_id()), "gated")
    found = (
        detections(rows.where("norm IS NOT NULL").select("row", "norm"))
        .groupBy("row")
        .agg(F.collect_set("label").alias("more"), F.max("confidence").alias("top"))
    )
    base = _whole("|".join(BASE))
    each = [F.when(F.col("norm").rlike(_whole(p)), F.lit(label)) for p, label in BASE.items()]
    sides = rows.select(
        "row",
        "doc_id",
        "n_words",
        F.split(F.coalesce("norm", F.lit("")), base).alias("gaps"),
        F.regexp_extract_all(F.coalesce("norm", F.lit("")), F.lit(base), F.lit(0)).alias("hits"),
        F.array_sort(F.array_compact(F.array(*each))).alias("own"),
    )
    last = f"{_words('element_at(gaps, -1)')} - {_words('element_at(hits, -1)')}"
    labels = F.array_sort(F.array_union("own", F.coalesce("more", F.array().cast("array<string>"))))
    floor = F.when(F.col("n_base") > 0, F.lit(0.5)).otherwise(0.0)
    return (
        sides.withColumn("n_base", F.size("hits").cast("long"))
        .withColumn("first_word", F.expr(f"CASE WHEN n_base > 0 THEN bigint({_words('gaps[0]')}) END"))
        .withColumn("last_word", F.expr(f"CASE WHEN n_base > 0 THEN bigint(n_words - {last}) END"))
        .join(found, "row", "left")
        .select(
            "doc_id",
            "n_words",
            "n_base",
            "first_word",
            "last_word",
            F.array_join("own", ",").alias("base_labels"),
            F.array_join(labels, ",").alias("labels"),
            F.greatest(floor, F.coalesce("top", F.lit(0.0))).alias("score"),
        )
    )


def op10_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_labels(spark.read.parquet(f"{sf_dir}/documents.parquet"))
