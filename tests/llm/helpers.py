"""Small tables with awkward rows, and reading helpers."""

import duckdb

SMALL = "/root/testdata/sf0.001"
TINY = "doc_id long, text string, lang string, source string, n_chars long, extra int, row long, length int, hash string"


def table(spark, texts, ids=None):
    """Documents with extra columns whose names the operators use themselves."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [
        (i, t, "en", f"src{k % 3}", len(t or ""), 1, 7, 3, "x") for k, (i, t) in enumerate(zip(ids, texts, strict=True))
    ]
    return spark.createDataFrame(rows, TINY)


def texts_of(folder=SMALL):
    return duckdb.sql(f"select doc_id, text from '{folder}/documents.parquet' order by doc_id").fetchall()


def as_query(spark, frame, query, tmp_path):
    """The registered query over a folder that holds ``frame`` as its documents."""
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    return query(spark, str(tmp_path)).collect()


PASSAGE = " ".join(f"w{i}" for i in range(60))
AWKWARD = [
    None,
    "",
    " \n\t",
    "one",
    "a  b\tc\x0bd\x0ce\rf",
    "Straße ΣΑΣ ΟΔΟΣ İstanbul ﬁn é́ ひらがな 漢字 😀😀  x y\x1cz\x85w",
    "<|endoftext|> a<|endoftext|>b <|startoftext|>",
    "it's we'll I'D 'S 12345 ½ ²³  ՘ \U0001E030 ́́",
    "x" * 30_000,
    "ab " * 9_000,
    f"left {PASSAGE} right",
    f"other {PASSAGE} end",
    f"other {PASSAGE} end",
    "line\nline\n\nline\n",
]
IDS = [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, None, 11, 11, 13]
