"""Queries with SQL counterparts: the same rows from both."""

from __future__ import annotations

import pytest

duckdb = pytest.importorskip("duckdb")

from tenurelog.llm.queries import ORACLE, QUERIES  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, sf_dir, name):
    with duckdb.connect() as db:
        for t in ("documents", "pages", "labels", "benchmark"):
            db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
        want = db.sql(ORACLE[name])
        columns = want.columns
        want = sorted(want.fetchall(), key=repr)
    got = QUERIES[name](spark, sf_dir)
    assert sorted(got.columns) == sorted(columns)
    assert sorted((tuple(r) for r in got.select(columns).collect()), key=repr) == want
