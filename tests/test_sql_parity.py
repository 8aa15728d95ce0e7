"""Every query of the core against its SQL, on the smallest tables; queries without SQL must run."""

import pytest
from conftest import DATA, same_rows

from lexigraph.plans import loading, quality, reference

QUERIES = {**reference.QUERIES, **quality.QUERIES, **loading.QUERIES}
SQL = {**reference.ORACLE, **quality.ORACLE, **loading.ORACLE}


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, duck, name):
    same_rows(QUERIES[name](spark, DATA), duck, SQL[name])


#: Queries whose answer may be empty on the smallest tables.
MAY_BE_EMPTY = {"by_page", "highlight_nodes", "highlight_edges"}


@pytest.mark.parametrize("name", sorted(set(SQL) - MAY_BE_EMPTY))
def test_sql_compares_something(duck, name):
    """An answer without rows, or a text stage that changes nothing, proves nothing."""
    cur = duck.execute(SQL[name])
    rows, names = cur.fetchall(), [c[0] for c in cur.description]
    assert rows
    if name in ("speech_tags", "language_tags"):
        assert any(x is not None for r in rows for x in r[1:])
    if name == "debounced":
        assert 0 < len(rows) < duck.execute("SELECT count(*) FROM events").fetchone()[0]
    if name == "nested_links_report":
        assert any(r[names.index("links_fixed")] for r in rows)
    if name == "titles_stripped":
        assert duck.execute("SELECT count(*) FROM entries WHERE contains(c, ' title=')").fetchone()[0]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    assert df.columns and df.count() > 0
