"""Every core query on the smallest tables, against its SQL where there is any."""

import os

import pytest

from sluice.plans import registry

FOLDER = os.environ.get("SLUICE_TEST_TABLES", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for file in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{file}'")
    return con


def plain(value):
    import pandas as pd

    if value is None or value is pd.NaT or value != value:
        return None
    if hasattr(value, "isoformat"):
        stamp = pd.Timestamp(value)
        return str(stamp.tz_localize(None) if stamp.tz is None else stamp.tz_convert(None))
    return round(float(value), 6) if isinstance(value, (int, float)) and not isinstance(value, bool) else value


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    got = registry.QUERIES[name](spark, FOLDER).toPandas()
    if name not in registry.SQL:
        return
    expected = duck.execute(registry.SQL[name]).df()
    columns = sorted(got.columns)
    assert sorted(expected.columns) == columns
    rows = [sorted((tuple(map(plain, r)) for r in df[columns].values.tolist()), key=repr) for df in (got, expected)]
    assert rows[0] == rows[1]
