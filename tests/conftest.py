import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lexigraph.session import local_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, 4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    """DuckDB with the tables of the smallest data as views."""
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(DATA):
        pytest.skip("no test data")
    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{DATA}/{name}'")
    return con


def plain(value):
    """A value in a form in which both engines' rows compare."""
    import decimal
    import math

    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def same_rows(df, con, sql):
    """Assert that a DataFrame and an SQL statement have the same columns and the same rows."""
    from collections import Counter

    columns = sorted(df.columns)
    answer = con.execute(sql)
    names = [c[0] for c in answer.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    want = Counter(repr(tuple(plain(r[i]) for i in at)) for r in answer.fetchall())
    got = Counter(repr(tuple(plain(r[c]) for c in columns)) for r in df.select(*columns).collect())
    assert got == want
