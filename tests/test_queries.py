"""Every registered query against its DuckDB oracle on sf0.001 (rows,
column names and values, order-insensitive), plus the entry smoke check."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from tables import SF0001

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return cols, sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_every_query_has_an_oracle_or_is_listed():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 60


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    got = E.queries()[name](spark, SF0001).toPandas()
    want = duck.sql(E.oracle_sql()[name]).df()
    gc, gr = _rows(got)
    wc, wr = _rows(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["codigo_municipio", "ano", "dado_identificador", "tipo_dado", "valor"]
    assert df.count() > 0
