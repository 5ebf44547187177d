"""Every registered query of the engine against DuckDB."""

from __future__ import annotations

import pytest

from screenforge import catalog

from .conftest import DATA, rows_of


#: Long texts are few in the smallest tables; all checks must find what was planted for them.
MAY_BE_EMPTY = {"chunk_geometry", "chunk_vote"}


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_sql(name, spark, duck):
    found = catalog.QUERIES[name](spark, DATA).toPandas()
    wanted = duck.execute(catalog.ORACLE_SQL[name]).df()
    assert sorted(found.columns) == sorted(wanted.columns)
    assert rows_of(found) == rows_of(wanted)
    assert len(found) or name in MAY_BE_EMPTY
