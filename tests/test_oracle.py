"""Every engine query against DuckDB on the smallest tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from tenantgraph import catalog

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings labels".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def _plain(x):
    return (round(x, 4) if math.isfinite(x) else str(x)) if isinstance(x, float) else x


@pytest.mark.parametrize("name", sorted(catalog.RUNS))
def test_query(spark, db, name):
    df = catalog.RUNS[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted(([_plain(r[c]) for c in columns] for r in df.collect()), key=str)
    said = db.sql(catalog.SQL[name])
    assert sorted(said.columns) == columns
    assert got == sorted(([_plain(r[said.columns.index(c)]) for c in columns] for r in said.fetchall()), key=str)


@pytest.fixture(scope="module")
def many(spark, tmp_path_factory):
    """More documents of one tenant, and of each row policy, than a strict search may rank."""
    path = str(tmp_path_factory.mktemp("many"))
    text = "CASE WHEN id % 1000 = 7 THEN NULL WHEN id % 1000 = 9 THEN '' ELSE concat(repeat('Nation, ', int(id % 7)), repeat('stes ', int(id % 5)), repeat('thou-', int(id % 3)), repeat('nationstes ', int(id % 97))) END"
    spark.range(24_000).selectExpr("id AS doc_id", f"{text} AS text", "if(id % 12 = 0, 'de', 'en') AS lang", "'web' AS source", "10L AS n_chars").write.parquet(f"{path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{path}/documents.parquet/*.parquet'")
    return path, con


@pytest.mark.parametrize("name", ["fulltext_bm25", "fulltext_policy"])
def test_full_text_over_a_tenant_beyond_the_ceiling(spark, many, name):
    path, con = many
    got, said = catalog.RUNS[name](spark, path), con.sql(catalog.SQL[name])
    want = [[_plain(x) for x in r] for r in said.fetchall()]
    assert said.columns == got.columns and len(want) == 10
    assert [[_plain(x) for x in r] for r in got.collect()] == want
