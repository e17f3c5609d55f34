"""Every query of this package that has SQL agrees with it on sf0.001, whole tables."""

from __future__ import annotations

import duckdb
import pytest

from clvspark.llm import queries

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def _norm(rows):
    return sorted(tuple("NULL" if v is None else (round(v, 9) if isinstance(v, float) else str(v)) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql_agrees(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    rel = con.sql(queries.ORACLE[name])
    assert sorted(df.columns) == sorted(rel.columns)
    order = [rel.columns.index(c) for c in df.columns]
    assert _norm(df.collect()) == _norm(tuple(r[i] for i in order) for r in rel.fetchall())
