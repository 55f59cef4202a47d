"""Registered queries against their SQL counterparts at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as driver
from registry import ENTRIES
from tools.check import TABLES, rows

# The remaining ones run through tools/check.py; these cover every module once.
NAMES = [
    "raw_flights_scan",
    "silver_prejoin",
    "obt",
    "dense_key_copies",
    "dim_role_union",
    "fact_keys",
    "mnemonic_fat_flt",
    "gate_suite_silver",
    "gate_suite_gold",
    "missingness_corr",
    "describe",
    "describe_orders",
    "sample_n",
    "sample_fraction",
    "bounded_scan",
    "key_collisions",
    "csv_chunk_union",
    "partition_overwrite_roundtrip",
    "publish_versions",
    "clustered_months",
    "clustered_order",
    "file_inventory",
    "csv_header_union",
    "bucketed_join",
    "cardinality_approx",
    "describe_approx",
    "describe_times",
    "duplicate_counts_by_column",
    "sketch_cardinality",
    "sketch_quantiles",
    "report_raw",
    "report_silver",
    "delay_by_airline",
]


@pytest.fixture(scope="module")
def db(small):
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, small, db, name):
    df = driver.queries()[name](spark, small)
    cursor = db.execute(driver.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(columns, cursor.fetchall())


def test_entry_has_one_row_per_airline(spark):
    found = driver.entry(spark).collect()
    assert found and len({r.airline_name for r in found}) == len(found)


def test_every_query_has_sql():
    assert {name for name, e in ENTRIES.items() if e.sql is None} == set()
