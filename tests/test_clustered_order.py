"""Order within files, compared in stretches."""

import pytest
from pyspark.sql import functions as F

from registry import flow
from tests.helpers import plan_of, rows
from tristrata.sources import scratch, snapshots


@pytest.fixture
def stored(spark, monkeypatch):
    """A file of ten falling days, one of ten rising ones and one of a single row; stretches of four rows."""
    path = scratch.new_path(spark, "lines")
    for start, step, n in ((10, -1, 10), (11, 1, 10), (25, 1, 1)):
        df = spark.range(n).select(
            F.date_add(F.lit("2015-01-01").cast("date"), (start - 1 + step * F.col("id")).cast("int")).cast("timestamp_ntz").alias("l_shipdate"),
            F.lit(1).cast("long").alias("l_orderkey"), F.lit(1).alias("l_linenumber"),
        )
        df.coalesce(1).write.mode("append").parquet(path)
    monkeypatch.setattr(flow, "_clustered", lambda spark, sf_dir: path)
    monkeypatch.setattr(snapshots, "read", lambda spark, path, name: spark.read.parquet(path))
    monkeypatch.setattr(flow, "STRETCH", 4, raising=False)


def test_rows_are_compared_across_stretches_but_not_across_files(spark, stored):
    found = rows(flow.clustered_order(spark, "").select(F.col("ship_month").cast("string"), "n_rows", "out_of_order"))
    assert found == [("2015-01-01", 21, 9)]


def test_paths_do_not_move_with_the_rows(spark, stored):
    """A task's memory was that of two sorted sides whose rows each held the path."""
    plan = plan_of(flow.clustered_order(spark, ""))
    assert "SortMergeJoin" not in plan and plan.count("hashpartitioning(file") == 1
