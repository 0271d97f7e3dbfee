"""Every catalogue query against its SQL, on whole tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_point

from cases import SF_DIR

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark"
    " labels conversations"
).split()
NO_SQL = {"model_metrics", "model_best_scores"}


def is_text_query(name):
    """Queries of the optional part have their own tests beside it."""
    return name == "pipeline" or (name[:2] == "op" and name[2:3].isdigit())


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        path = os.path.join(SF_DIR, f"{name}.parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def canonical(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)

    def plain(value):
        if value is None or (isinstance(value, float) and math.isnan(value)):
            return "null"
        return repr(round(value, 9)) if isinstance(value, float) else str(value)

    return sorted(names), sorted(tuple(plain(row[i]) for i in order) for row in rows)


SAME_TYPE = {"boolean": "BOOLEAN", "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE"}


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    frame = entry_point.queries()[name](spark, SF_DIR)
    cursor = duck.execute(entry_point.oracle_sql()[name])
    want = canonical([c[0] for c in cursor.description], cursor.fetchall())
    types = {c[0]: str(c[1]) for c in cursor.description}
    assert {n: SAME_TYPE[t] for n, t in frame.dtypes} == types
    got = canonical(frame.columns, frame.collect())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
    assert got[1], "a query that returns nothing proves nothing"


def test_every_query_has_sql():
    assert {q for q in entry_point.queries() if not is_text_query(q)} - set(entry_point.oracle_sql()) == NO_SQL
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
