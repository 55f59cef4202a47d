"""Layer writes, reconciliation and publication."""

import uuid

from pyspark.sql import DataFrame, SparkSession

from tristrata.operators import gates as gt
from tristrata.sources import fs, snapshots
from tristrata.sources.ingest import PARTITION
from tristrata.sources.snapshots import Layout, ReconciliationError, counted, reconcile

__all__ = [
    "Layout", "ReconciliationError", "as_table", "as_view", "counted", "publish", "reconcile", "to_bronze",
    "write_csv", "write_csv_chunks", "write_layer",
]


def write_layer(
    df: DataFrame,
    path: str,
    date: str,
    partition_by: tuple[str, ...] = (),
    sort_by: tuple[str, ...] = (),
    single_file: bool = False,
) -> None:
    """Replace one processing date of a layer table.

    With ``partition_by`` the rows are rebalanced on those columns: small partitions share a
    task and a partition that holds a large part of the rows is split over many. Without it
    the files follow the input's partitions and nothing is shuffled. ``single_file`` is for
    dimensions only.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if single_file:
        df = df.coalesce(1)
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(
        f"{path.rstrip('/')}/{PARTITION}={date}"
    )


def to_bronze(df: DataFrame, gates: list[gt.Gate], path: str, date: str, dataset: str) -> None:
    """Write a raw relation as Parquet for one processing date, once its gates pass.

    Names are checked first; row gates are counted while the rows are written aside, and key gates
    read what was written, so the raw data is read once. Only then does the folder take its place.
    """
    aside = f"{path.rstrip('/')}/_aside-{uuid.uuid4().hex}"
    by_name = [g for g in gates if g.names is not None]
    by_row = [g for g in gates if g.names is None and g.counted(df) is not None]
    by_key = [g for g in gates if g.names is None and g.counted(df) is None]
    if by_name:
        gt.enforce(gt.run(df, by_name, dataset))
    watched, result = gt.watch(df, by_row, dataset) if by_row else (df, None)
    try:
        watched.write.parquet(aside)
        if result:
            gt.enforce(result())
        if by_key:
            gt.enforce(gt.run(df.sparkSession.read.schema(df.schema).parquet(aside), by_key, dataset))
        fs.move_directory(df.sparkSession, aside, f"{path.rstrip('/')}/{PARTITION}={date}")
    finally:
        fs.delete(df.sparkSession, aside)


def write_csv(df: DataFrame, path: str, append: bool = False) -> None:
    """One relation as CSV with a header; one file if it is small (an inventory, gate results)."""
    df.coalesce(1).write.mode("append" if append else "overwrite").option("header", True).csv(path)


def write_csv_chunks(df: DataFrame, path: str, n: int) -> None:
    """Split a relation into ``n`` CSV files of nearly equal size, each with a header."""
    df.repartition(n).write.mode("overwrite").option("header", True).csv(path)


def publish(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    path: str,
    date: str,
    gates: dict[str, list[gt.Gate]] | None = None,
    layouts: dict[str, Layout] | None = None,
) -> DataFrame:
    """Write and check a set of tables, then make them visible in one commit.

    If anything fails before the commit, readers keep the last version. Returns the gate results.
    """
    run = snapshots.Run(spark, path, date)
    for name, df in tables.items():
        run.stage(name, df, (gates or {}).get(name), (layouts or {}).get(name))
    run.commit()
    return run.outcome()


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Materialise a raw relation as a view."""
    df.createOrReplaceTempView(name)
    return df


def as_table(
    df: DataFrame,
    name: str,
    buckets: int | None = None,
    by: tuple[str, ...] = (),
    path: str | None = None,
) -> DataFrame:
    """Materialise a silver or gold relation as a table of the session's catalog.

    With ``buckets`` the rows are dealt to that many files by a hash of the columns ``by``, and sorted
    by them: tables with equal buckets then join or group on ``by`` without a shuffle. A bucket is
    read by one task, so ``by`` should be a key, or have no value with a large part of the rows.
    ``path`` puts the files elsewhere than in the warehouse.
    """
    if bool(buckets) != bool(by):
        raise ValueError("buckets and their columns go together")
    if buckets:
        df = df.repartition(buckets, *by)  # the hash that deals buckets: one file for each
    writer = df.write.mode("overwrite").format("parquet")
    if buckets:
        writer = writer.bucketBy(buckets, *by).sortBy(*by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)
