"""Driver contract: entry, queries and the DuckDB oracle on the small data."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from stratum.plans import catalog
from stratum.sources.tables import TABLE_NAMES, table_path


def test_entry_returns_gold(spark):
    df = E.entry(spark)
    assert df.columns == [
        "region",
        "gross_revenue_usd",
        "accepted_orders",
        "completed_orders",
        "pipeline_orders",
        "distinct_customers",
    ]
    assert df.count() == 5


def test_every_query_has_an_oracle_or_a_reason():
    # Training-data operators that SQL cannot express have brute-force tests of their own.
    no_oracle = {q for q in set(E.queries()) - set(E.oracle_sql()) if not q.startswith("op") and q != "pipeline"}
    assert no_oracle == set(), no_oracle


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.6g}")
    if hasattr(v, "isoformat"):
        return str(v).replace("T", " ")
    return v


def _rows(records, cols):
    order = sorted(cols)
    idx = [cols.index(c) for c in order]
    return sorted((tuple(_norm(r[i]) for i in idx) for r in records), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    return con


@pytest.mark.parametrize("name", sorted(q for q in E.oracle_sql() if q in catalog.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = _rows([tuple(r) for r in df.collect()], df.columns)
    rel = duck.sql(E.oracle_sql()[name])
    want = _rows(rel.fetchall(), rel.columns)
    assert sorted(df.columns) == sorted(rel.columns)
    assert got == want
