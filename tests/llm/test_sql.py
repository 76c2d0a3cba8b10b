"""The operators that SQL can express, against their SQL on whole tables."""

from pathlib import Path

import duckdb
import pytest
from endpointlens.llm.queries import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_against_sql(spark, name):
    c = duckdb.connect()
    for t in ("documents", "pages", "labels", "embeddings"):
        c.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    cursor = c.execute(ORACLE_SQL[name])
    columns = [d[0] for d in cursor.description]
    got = sorted(tuple(map(str, (r[k] for k in columns))) for r in QUERIES[name](spark, FOLDER).collect())
    assert got == sorted(tuple(map(str, r)) for r in cursor.fetchall())


def test_all_are_registered():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
