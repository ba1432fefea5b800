"""Every registered query against its DuckDB oracle (row count, columns, value hash)."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from tidemark.sources.tables import TABLES

SQL = E.oracle_sql()
# Spark type -> DuckDB type of the same values.
TYPE_NAMES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
              "date": "DATE", "timestamp_ntz": "TIMESTAMP"}
KEYS = sorted(E.queries())


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    if key not in SQL:
        assert len(df.columns) > 0
        return
    rel = duck.sql(SQL[key])
    otypes = dict(zip(rel.columns, [str(t) for t in rel.types]))
    stypes = {f.name: TYPE_NAMES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    assert stypes == otypes
    cur = duck.execute(SQL[key])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, rows) == _rows(ocols, cur.fetchall())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["claimant_key", "claim_number", "claimant_number", "originating_business_unit",
                          "recovery_date_closed", "recovery_status", "valid_from_date", "update_type"]
    assert df.count() >= 0
