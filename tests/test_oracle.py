"""Every query with an SQL twin equals DuckDB on the smoke tables (the
driver checks the same at sf0.01); queries without a twin must run."""
import math

import duckdb
import pytest

import __spark_entry__ as E

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
QUERIES = E.queries()
ORACLE = E.oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in recs]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    return c


def test_every_query_has_a_name_and_most_have_an_oracle():
    assert len(QUERIES) >= 80
    assert set(ORACLE) <= set(QUERIES)
    assert len(ORACLE) >= 60


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_duckdb(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    srecs = [tuple(r) for r in df.collect()]
    rel = con.execute(ORACLE[name])
    dcols = [d[0] for d in rel.description]
    drecs = rel.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srecs) == len(drecs)
    assert _rows(df.columns, srecs) == _rows(dcols, drecs)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_oracle_runs(spark, sf, name):
    df = QUERIES[name](spark, sf)
    assert df.count() >= 0
    assert len(df.columns) > 0


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["category_id", "flag", "n_images", "n_persons", "n_parts"]
