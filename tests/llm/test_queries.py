"""The queries against their SQL on the smallest tables."""

import duckdb
import pytest

from tests.conftest import SF
from tripmart.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_rows_as_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "labels", "benchmark"):
        con.sql(f"create view {t} as from '{SF}/{t}.parquet'")
    got = QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = con.sql(f"select {', '.join(columns)} from ({ORACLE[name]})").fetchall()
    assert sorted(map(repr, (tuple(r) for r in got.select(*columns).collect()))) == sorted(map(repr, want))
