"""Every core query against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

from tessella import queries_io  # noqa: F401  adds its queries to the others
from tessella.queries import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables")


@pytest.fixture(scope="module")
def oracle():
    db = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return db


def rows(df):
    df = df[sorted(df.columns)]

    def plain(v):
        """A value that sorts: floats rounded, null and NaN alike and first."""
        if v is None or v != v:
            return (0,)
        return 1, round(float(v), 9) if isinstance(v, float) or hasattr(v, "dtype") and v.dtype.kind == "f" else v

    return sorted(tuple(map(plain, r)) for r in df.astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    assert rows(QUERIES[name](spark, DATA).toPandas()) == rows(oracle.execute(ORACLE_SQL[name]).df())
