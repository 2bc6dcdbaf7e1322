"""Every query gives rows, and what its oracle gives, on the smallest tables."""

import duckdb
import pytest

from foliary.plans import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def cell(v):
    if v is None or v != v:
        return ""
    if isinstance(v, float):
        return f"{v:.9g}"
    return str(v)[:10] if str(v).endswith("00:00:00") else str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(map(cell, r)) for r in df.select(*cols).collect())
    assert got
    if name in ORACLES:
        want = duck.execute(f"SELECT {', '.join(cols)} FROM ({ORACLES[name]})").fetchall()
        assert got == sorted(tuple(map(cell, r)) for r in want)


def test_oracles_have_queries():
    assert set(ORACLES) <= set(QUERIES) and len(QUERIES) - len(ORACLES) < 20
