"""Merged summaries estimate what exact counts say, within the stated bounds."""

import pytest
from pyspark.sql import functions as F

from tests.helpers import plan_of, rows
from tristrata.operators import sketches as sk


def spread(spark, n, parts=1):
    return spark.range(0, n, 1, parts).select(
        F.col("id").alias("k"), (F.col("id") % 1000).cast("smallint").alias("small"), (F.col("id") * 7919 % 10_007 / 3).alias("x"),
        F.when(F.col("id") % 4 > 0, F.concat(F.lit("v"), F.col("id") % 333)).alias("s"), F.expr("date_add(DATE'2000-01-01', CAST(id % 77 AS INT))").alias("d"),
        (F.col("id") % 5).alias("batch"),
    )


@pytest.mark.parametrize("n", [3, 200, 60_000])
def test_bounds_hold_over_merged_batches(spark, n):
    df = spread(spark, n, 4)
    kept = sk.summarise(df, batch="batch")
    got = {r.column: r for r in sk.estimates(sk.merge(kept)).collect()}
    whole = {r.column: r for r in sk.estimates(sk.merge(sk.summarise(df.drop("batch")))).collect()}
    assert set(got) == set(whole) == {"k", "small", "x", "s", "d"}
    exact = df.agg(*(F.count_distinct(c).alias(c) for c in got)).first()
    for c, r in got.items():
        assert r.n_rows == n and r.n_known == df.where(F.col(c).isNotNull()).count()
        assert abs(r.n_unique - exact[c]) <= sk.DISTINCT_ERROR * exact[c] + 0.5
        assert abs(r.n_unique - whole[c].n_unique) <= sk.DISTINCT_ERROR * exact[c] + 0.5
    values = sorted(r.x for r in df.select("x").collect())
    for p, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")):
        below, upto = (sum(f(v) for v in values) / n for f in (lambda v: v < got["x"][name], lambda v: v <= got["x"][name]))
        assert below <= p + sk.RANK_ERROR + 1 / n and upto >= p - sk.RANK_ERROR - 1 / n
    assert (got["x"].low, got["x"].high) == (values[0], values[-1])
    assert got["s"].low is None and got["s"].p50 is None


def test_some_batches_give_what_their_rows_give(spark):
    df = spread(spark, 5000)
    kept = sk.summarise(df, ["k", "s"], "batch")
    two = sk.estimates(sk.merge(kept.where("batch IN (1, 3)"))).orderBy("column").collect()
    direct = sk.estimates(sk.merge(sk.summarise(df.where("batch IN (1, 3)"), ["k", "s"]))).orderBy("column").collect()
    for a, b in zip(two, direct):
        assert (a.column, a.n_rows, a.n_known, a.low, a.high) == (b.column, b.n_rows, b.n_known, b.low, b.high)
        assert abs(a.n_unique - b.n_unique) <= 2 * sk.DISTINCT_ERROR * b.n_unique
    assert abs(two[0].p50 - direct[0].p50) <= 2 * sk.RANK_ERROR * 5000


def test_empty_and_all_null_columns(spark):
    none = spark.createDataFrame([], "a int, b string, batch int")
    assert rows(sk.summarise(none, batch="batch")) == []
    got = rows(sk.estimates(sk.merge(sk.summarise(none.drop("batch")))), "column")
    assert got == [("a", 0, 0, 0, None, None, None, None, None), ("b", 0, 0, 0, None, None, None, None, None)]
    nulls = spark.createDataFrame([(None, None)], "a int, b string")
    assert [r[1:4] for r in rows(sk.estimates(sk.merge(sk.summarise(nulls))), "column")] == [(1, 0, 0)] * 2


def test_zeros_are_one_value_and_merging_reads_no_data(spark, tmp_path):
    df = spark.createDataFrame([(0.0, 1), (-0.0, 2)], "x double, batch int")
    sk.summarise(df, batch="batch").write.parquet(str(tmp_path / "kept"))
    kept = spark.read.parquet(str(tmp_path / "kept"))
    merged = sk.estimates(sk.merge(kept))
    assert merged.first().n_unique == 1
    assert plan_of(merged).count("FileScan") == 1
