"""Report queries give the rows of their SQL on larger tables, made of copies with other keys, as on small ones."""

import os

import duckdb
import pytest

from tallyforge.plans import queries, store_queries

from .test_queries import SMALL, bag


def check(spark, folder, name, tables):
    """Runs a query over tables given as SQL on the small ones."""
    c = duckdb.connect()
    for t, sql in tables.items():
        c.execute(f"COPY ({sql}) TO '{folder}/{t}.parquet' (FORMAT parquet)")
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    got = queries.QUERIES[name](spark, str(folder))
    want = c.execute(queries.ORACLES[name])
    columns = [d[0] for d in want.description]
    rows = [tuple(r) for r in got.collect()]
    assert bag(got.columns, rows) == bag(columns, want.fetchall())
    return rows


def source(t):
    if not os.path.isdir(SMALL):
        pytest.skip("no tables here")
    return f"'{SMALL}/{t}.parquet'"


def test_gaps_of_a_month_without_any(spark, tmp_path):
    days = f"SELECT o.* REPLACE (7 * i AS o_orderkey, TIMESTAMP '1998-03-01' + to_days(CAST(i AS INT)) AS o_orderdate) FROM (SELECT * FROM {source('orders')} LIMIT 1) o, range(40) r(i)"
    assert check(spark, tmp_path, "recent_gaps", {"orders": days}) == [(0, None)]


def test_nearest_rows_of_customers_with_equal_names_and_balances(spark, tmp_path):
    copies = f"SELECT c.* REPLACE (c_custkey + 100000 * i AS c_custkey, CASE WHEN i = 2 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal) FROM {source('customer')} c, range(3) r(i)"
    assert len(check(spark, tmp_path, "nearest_rows", {"customer": copies})) == 3 * 150 // 5


def test_streaks_of_users_whose_events_come_after_newer_ones_of_others(spark, tmp_path):
    copies = f"SELECT e.* REPLACE (event_id + 1000000 * i AS event_id, user_id + 1000000 * i AS user_id, CASE WHEN event_type = 'error' THEN 'view' ELSE event_type END AS event_type) FROM {source('events')} e, range(3) r(i)"
    check(spark, tmp_path, "stream_streaks", {"events": copies, "region": f"SELECT * FROM {source('region')}"})


def test_text_tables_grow_in_number(spark, tmp_path):
    copies = f"SELECT c.* REPLACE (c_custkey + 100000 * i AS c_custkey) FROM {source('customer')} c, range(3) r(i)"
    check(spark, tmp_path, "text_tables", {"customer": copies})
    files = store_queries.text_files(lambda t: spark.read.parquet(f"{tmp_path}/{t}.parquet"), "utf-8", 50_000)
    assert files.count() == 15
