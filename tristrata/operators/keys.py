"""Surrogate keys.

A dense 1..n key over a total order needs every row's global position. ``row_number`` over an
unpartitioned window would move the whole table into one task, so the position is built from
two parts that both stay distributed:

1. range-partition and sort by the order, and note each row's partition and place in it;
2. write that table (the placement must not be computed twice: range bounds are sampled);
3. add up the rows of all earlier partitions, one number per partition.

The row's source partition is the last range column. It only separates rows that agree on
every ordered column, so a group of copies of any size spreads over several range partitions
while the result stays the same.
"""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from tristrata.operators import enrich
from tristrata.sources import scratch

_ROW_BITS = 33  # monotonically_increasing_id: partition above, row within partition below
_ROW = (1 << _ROW_BITS) - 1
PART_ROWS = 100_000  # rows that are worth a partition of their own
MOST_ROWS = 500_000  # rows of a partition at most, as its sort is to stay in memory
MAX_GROUPS = 500_000  # counted groups, one row each, that one window may add up


def _placed(df: DataFrame, order: list[str], label: str) -> DataFrame:
    """``df`` range-sorted and written, with ``_part`` and ``_row`` (0-based)."""
    by = [F.col(c).asc_nulls_first() for c in order]
    split = df.withColumn("_split", F.spark_partition_id())
    laid_out = (
        split.repartitionByRange(*by, F.col("_split").asc())
        .sortWithinPartitions(*by, F.col("_split").asc())
        .drop("_split")
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumns(
            {
                "_part": F.shiftright("_at", _ROW_BITS).cast("int"),
                "_row": F.col("_at").bitwiseAND(F.lit(_ROW)),
            }
        )
        .drop("_at")
    )
    return scratch.table(laid_out, label)


def _earlier(placed: DataFrame, amount: Column) -> DataFrame:
    """Per range partition, the sum of ``amount`` over all earlier ones.

    One row per range partition, so at most spark.sql.shuffle.partitions rows: this is what
    bounds both the unpartitioned window and the broadcast of the result.
    """
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.groupBy("_part")
        .agg(amount.alias("_amount"))
        .select(
            F.col("_part"),
            F.coalesce(F.sum("_amount").over(before), F.lit(0)).alias("_offset"),
        )
    )


def dense_key(
    df: DataFrame, name: str, order_by: list[str], ties: list[str] | None = None
) -> DataFrame:
    """Number the rows 1..n in the given order, key column first.

    Rows that agree on ``order_by`` are ordered by ``ties`` (by default every other column),
    which makes the key reproducible. NULL sorts first. Finding the range bounds reads ``df``
    once more, so pass a stored table when ``df`` is costly to compute.
    """
    rest = [c for c in df.columns if c not in order_by] if ties is None else ties
    placed = _placed(df, [*order_by, *rest], f"key-{name}")
    offsets = F.broadcast(_earlier(placed, F.count(F.lit(1))))
    return placed.join(offsets, "_part").select(
        (F.col("_offset") + F.col("_row") + 1).cast("long").alias(name), *df.columns
    )


def _parts(df: DataFrame, rows: int) -> int:
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(usual, -(-rows // PART_ROWS)), -(-rows // MOST_ROWS))


def _placed_groups(df: DataFrame, groups: DataFrame, rows: int, parts: int) -> DataFrame:
    """``df`` with the rows of all earlier groups, of the group and the partition it begins in.

    ``groups`` has one row for each group, its key columns and ``_n``. NULL equals NULL.
    """
    by = [c for c in groups.columns if c != "_n"]
    before = Window.orderBy(*(F.col(c).asc_nulls_first() for c in by)).rowsBetween(Window.unboundedPreceding, -1)
    at = groups.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    at = at.withColumn("_part", F.call_function("div", F.col("_before") * parts, F.lit(rows)).cast("int"))
    at = at.withColumn("_start", F.min("_before").over(Window.partitionBy("_part")))
    side = enrich.measured(at.withColumnsRenamed({c: f"_by_{c}" for c in by}))
    on = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by))
    return df.join(side, on, "left").drop(*(f"_by_{c}" for c in by))


def _sizes(groups: DataFrame):
    return groups.agg(F.count(F.lit(1)).alias("groups"), F.sum("_n").alias("rows"), F.max("_n").alias("largest")).first()


def deal_by_groups(df: DataFrame, groups: DataFrame) -> DataFrame | None:
    """``df`` dealt by ranges of the key columns of ``groups``, or None if there are too many groups.

    Range bounds are sampled, which computes ``df`` twice; the rows of all groups (``_n``, which
    may include rows that ``df`` has lost) tell the same without it. A group beyond a partition's
    share is spread over several by a hash of the row. Pass a stored ``groups``.
    """
    size = _sizes(groups)
    if not size.rows or size.groups > MAX_GROUPS:
        return None
    parts = _parts(df, size.rows)
    placed = _placed_groups(df, groups, size.rows, parts)
    inside = F.when(F.col("_n") * parts > size.rows, F.pmod(F.xxhash64(*df.columns), "_n")).otherwise(0)
    part = F.call_function("div", (F.col("_before") + inside) * parts, F.lit(size.rows)).cast("int")
    return placed.withColumn("_part", part).repartitionById(parts, "_part").select(*df.columns)


def deal_by_number(df: DataFrame, name: str, rows: int) -> DataFrame:
    """``df`` dealt by equal ranges of a dense key 1..rows, with nothing to sample."""
    parts = _parts(df, rows)
    part = F.call_function("div", (F.col(name) - 1) * parts, F.lit(max(1, rows)))
    return df.repartitionById(parts, part.cast("int"))


def dealt_key(df: DataFrame, name: str, order_by: list[str], lead: int) -> DataFrame:
    """The key of ``dense_key`` with rows left in its order: dealt by its ranges, sorted within them.

    Groups that agree on the first ``lead`` columns are counted, and whole groups are dealt by their
    counts, so that the number of earlier rows is known beforehand and the rows are neither sampled
    nor written for it. Groups that are too many, or one far beyond a partition's share, are left to
    ``dense_key``. Reads ``df`` twice, so pass a stored table; write the result once.
    """
    counts = df.groupBy(*order_by[:lead]).agg(F.count(F.lit(1)).alias("_n"))
    groups = scratch.table(counts, f"groups-{name}")
    size = _sizes(groups)
    rows = size.rows or 0
    parts = _parts(df, rows)
    if not rows or size.groups > MAX_GROUPS or (parts > 1 and size.largest * parts > 2 * rows):
        return deal_by_number(dense_key(df, name, order_by), name, rows).sortWithinPartitions(name)
    by = [F.col(c).asc_nulls_first() for c in [*order_by, *(c for c in df.columns if c not in order_by)]]
    return (
        _placed_groups(df, groups, rows, parts)
        .repartitionById(parts, "_part")
        .sortWithinPartitions(*by)
        .withColumn("_row", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW)))
        .select((F.col("_start") + F.col("_row") + 1).cast("long").alias(name), *df.columns)
    )


def dim_key(df: DataFrame, name: str, natural_key: str) -> DataFrame:
    """Dense key of a dimension in the order of its natural key."""
    return dense_key(df, name, [natural_key])


def running_total(df: DataFrame, name: str, order_by: list[str], amount: str) -> DataFrame:
    """Add the sum of ``amount`` over all earlier rows of a total order (0 for the first).

    The total has the type of a sum of ``amount``, so fractions are kept.
    """
    placed = _placed(df, order_by, f"total-{name}")
    offsets = F.broadcast(_earlier(placed, F.sum(amount)))
    inside = (
        Window.partitionBy("_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    )
    local = F.coalesce(F.sum(amount).over(inside), F.lit(0))
    return (
        placed.withColumn("_inside", local)
        .join(offsets, "_part")
        .select(*df.columns, (F.col("_offset") + F.col("_inside")).alias(name))
    )


def hash_key(df: DataFrame, name: str, cols: list[str], wide: bool = False) -> DataFrame:
    """Key computed from identifying columns, with no shuffle and no order.

    The 64-bit form expects about n^2 / 2^65 collisions: fine for billions of rows, not for
    trillions. ``wide`` gives a SHA-256 text instead. NULL differs from every value.
    """
    if wide:
        texts = [F.col(c).cast("string") for c in cols]
        pieces = [
            F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-"))
            for t in texts
        ]
        key = F.sha2(F.concat_ws(",", *pieces), 256)
    else:
        # The hash function skips NULLs, so their places are hashed too.
        key = F.xxhash64(*cols, *(F.col(c).isNull() for c in cols))
    return df.select(key.alias(name), *df.columns)


def fast_id(df: DataFrame, name: str) -> DataFrame:
    """Unique but neither dense nor stable across runs; never use it as a foreign key."""
    return df.select(F.monotonically_increasing_id().alias(name), *df.columns)
