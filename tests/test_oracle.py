"""Every registered query that SQL can express against DuckDB, on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd
import pytest

from editlake import registry

FOLDER = Path("/root/testdata/sf0.001")
SQL = registry.oracle_sql()
QUERIES = registry.queries()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in FOLDER.glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def rows(frame):
    """Rows as sorted tuples of comparable text."""

    def text(x):
        if pd.isna(x):
            return ""
        if isinstance(x, bool):
            return str(x)
        if isinstance(x, (int, float)) or type(x).__module__ == "numpy" and getattr(x.dtype, "kind", "") in "iuf":
            return f"{float(x) + 0.0:.5f}".replace("-0.00000", "0.00000")
        return str(x)

    return sorted(tuple(text(x) for x in r) for r in frame[sorted(frame.columns)].astype(object).itertuples(index=False))


@pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, duck, name):
    ours, theirs = QUERIES[name](spark, str(FOLDER)).toPandas(), duck.sql(SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)
    spark.catalog.clearCache()


@pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_others_run(spark, name):
    assert QUERIES[name](spark, str(FOLDER)).count() >= 0
    spark.catalog.clearCache()
