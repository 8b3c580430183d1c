"""Every query gives the rows that its SQL gives."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from feedlake.plans import catalog
from tests.oracle import connect, difference


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(catalog()))
def test_query_matches_sql(spark, con, sf_dir, name):
    query = catalog()[name]
    frame = query.run(spark, sf_dir).toPandas()
    assert len(frame)
    if query.sql is not None:
        assert difference(frame, con.execute(query.sql).df()) is None


def test_entry_points(spark):
    counts = {r["region"]: r["n_chunks"] for r in entry(spark).collect()}
    assert counts == {"americas": 104, "emea": 96, "global": 102}
    assert set(oracle_sql()) <= set(queries())
