"""Every query with SQL gives what DuckDB gives; every other query runs."""

import math

import pytest

from rastra.plans import oracles, queries
from tests.conftest import SF

QUERIES, SQL = queries.queries(), oracles.oracle_sql()


def rows(frame):
    def plain(v):
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 6) + 0.0
        return v.item() if hasattr(v, "item") else v

    names = sorted(frame.columns)
    return names, sorted((tuple(plain(v) for v in r) for r in frame[names].astype(object).where(frame[names].notna(), None).itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    if name in SQL:
        names, found = rows(got)
        wanted_names, wanted = rows(duck.sql(SQL[name]).df())
        assert names == wanted_names
        assert len(found) == len(wanted)
        for a, b in zip(found, wanted):
            assert all(x == y or (isinstance(x, (int, float)) and isinstance(y, (int, float)) and abs(x - y) < 2e-6) for x, y in zip(a, b)), (a, b)
    else:
        assert len(got) > 0 and not got.isna().any().any()


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["component", "area_px", "score", "compactness", "centroid_x", "centroid_y"]
    assert set(SQL) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())
