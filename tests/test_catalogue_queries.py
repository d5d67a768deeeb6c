"""Every registered query against its DuckDB text."""

import math

import pytest

from skyloom.plans import catalogue


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    clean = lambda v: "nan" if isinstance(v, float) and math.isnan(v) else round(v, 6) if isinstance(v, float) else v
    return sorted(repr(tuple(clean(r[i]) for i in order)) for r in rows)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_equals_sql(spark, duck, data_dir, name):
    found = catalogue.QUERIES[name](spark, data_dir)
    got = rows_of(found.columns, found.collect())
    want = duck.execute(catalogue.ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(found.columns) == sorted(names)
    assert got == rows_of(names, want.fetchall())


def test_every_query_has_sql():
    assert set(catalogue.QUERIES) == set(catalogue.ORACLE_SQL)
