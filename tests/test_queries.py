"""Every registered query with SQL against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from lotweave.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def text(v):
    return None if v is None else f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, name):
    df = registry.queries()[name](spark, SF)
    order = sorted(df.columns)
    got = sorted(map(repr, ([text(r[c]) for c in order] for r in df.collect())))
    if name not in registry.oracle_sql():
        return
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    rows = con.execute(f"SELECT {', '.join(order)} FROM ({registry.oracle_sql()[name]})").fetchall()
    assert got == sorted(map(repr, ([text(v) for v in r] for r in rows)))
