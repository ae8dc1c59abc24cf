"""Every registered query with SQL against DuckDB; the others run and give rows."""

import duckdb
import pytest

from lorekeep import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def rows(frame):
    frame = frame[sorted(frame.columns)]
    values = frame.astype(object).where(frame.notna(), None).values.tolist()
    return list(frame.columns), sorted([[round(x, 9) if isinstance(x, float) else x for x in r] for r in values], key=lambda r: [(x is None, str(x)) for x in r])


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, sf, duck, name):
    got = rows(catalog.QUERIES[name](spark, sf).toPandas())
    spark.catalog.clearCache()
    if name in catalog.SQL:
        assert got == rows(duck.execute(catalog.SQL[name]).df())
    else:
        assert got[0] and got[1]
