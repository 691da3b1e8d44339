"""Every report query gives the rows of its SQL; the entry module works with and without the optional parts."""

import math
import os
import subprocess
import sys
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__
from tallyforge.plans import queries

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return None
    return round(float(x), 6) if isinstance(x, int | float | Decimal) and not isinstance(x, bool) else str(x)


def bag(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(repr([plain(r[i]) for i in order]) for r in rows)


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SMALL):
        pytest.skip("no tables here")
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    got = queries.QUERIES[name](spark, SMALL)
    want = duck.execute(queries.ORACLES[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert bag(got.columns, [tuple(r) for r in got.collect()]) == bag(columns, want.fetchall())


def test_entry(spark):
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).limit(1).count() == 1


def test_entry_without_the_optional_parts():
    code = "import sys; sys.modules['tallyforge.llm'] = None\nimport __spark_entry__ as e\nassert e.queries() and not any(k.startswith('op') and k[2].isdigit() for k in e.queries()), sorted(e.queries())"
    found = subprocess.run([sys.executable, "-c", code], cwd=os.path.dirname(os.path.abspath(__spark_entry__.__file__)), capture_output=True, text=True)
    assert found.returncode == 0, found.stderr
