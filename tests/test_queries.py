"""Every registered endpoint query against its DuckDB twin, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import endpointlens.queries as q

FOLDER = "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return c


def normal(rows, columns):
    def one(v):
        if v is None:
            return ""
        if isinstance(v, float):
            return repr(round(v, 9) + 0.0)
        if isinstance(v, bool):
            return str(v)
        return str(v)

    return sorted("|".join(one(r[c]) for c in columns) for r in rows)


@pytest.mark.parametrize("name", sorted(q.ORACLE_SQL))
def test_against_sql(spark, duck, name):
    df = q.QUERIES[name](spark, FOLDER)
    got = [r.asDict() for r in df.collect()]
    cursor = duck.execute(q.ORACLE_SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    want = [dict(zip(columns, r)) for r in cursor.fetchall()]
    as_float = {c for c in columns for r in [*got, *want] if isinstance(r[c], float)}
    for r in [*got, *want]:
        for c in as_float:
            r[c] = None if r[c] is None else float(r[c])
    assert normal(got, sorted(columns)) == normal(want, sorted(columns))
    assert got


def test_all_have_sql():
    assert set(q.QUERIES) == set(q.ORACLE_SQL)
