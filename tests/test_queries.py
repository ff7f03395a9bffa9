"""Every registered query of the platform against its oracle on the smallest tables."""

import datetime
import decimal
import math

import duckdb
import pytest

from palimpsest.plans.fixtures import TABLES
from palimpsest.queries import registry

from .conftest import SF


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, (decimal.Decimal, float)):
        return float(f"{float(v):.9g}")
    return str(v) if isinstance(v, (datetime.date, datetime.datetime)) else v


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    want = duck.execute(registry.ORACLES[name])
    names = [x[0] for x in want.description]
    assert sorted(names) == cols
    assert got == sorted((tuple(plain(r[names.index(c)]) for c in cols) for r in want.fetchall()), key=repr)
