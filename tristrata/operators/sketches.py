"""Profiles that add up: small summaries of columns, kept for each batch and merged.

A batch's rows are read once, when it arrives. Distinct values are kept as HyperLogLog sketches and
the distribution of numbers as KLL sketches, beside exact counts and extremes, in one row for each
column. A profile over any set of batches merges those rows and reads no data again.
"""

from math import sqrt

from pyspark.sql import Column, DataFrame, functions as F, types as T

LG_K = 14  # HyperLogLog registers, as a power of two
KLL_K = 800  # width of the quantile sketches

# Bounds that hold for all but about one of a hundred estimates (three deviations; the stated rank error).
DISTINCT_ERROR = 3 * 1.04 / sqrt(2**LG_K)
RANK_ERROR = 2.446 / KLL_K**0.9433


def _text(df: DataFrame, name: str) -> Column:
    """A column in a form the distinct sketch takes; equal values stay equal."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.IntegerType, T.LongType, T.StringType, T.BinaryType)):
        return F.col(name)
    if isinstance(kind, (T.ByteType, T.ShortType)):
        return F.col(name).cast("int")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return (F.col(name) + F.lit(0.0)).cast("string")
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(F.struct(name))
    return F.col(name).cast("string")


def summarise(df: DataFrame, cols: list[str] | None = None, batch: str | None = None) -> DataFrame:
    """One row for each column, and for each value of ``batch``, in one aggregation.

    ``column``, ``n_rows``, ``n_known``, ``low`` and ``high`` (numbers only), ``distinct_sketch`` and
    ``value_sketch`` (numbers only). An empty table has one row for each column without ``batch``, and
    none with it.
    """
    cols = [c for c in (cols or df.columns) if c != batch]
    numbers = {c for c in cols if isinstance(df.schema[c].dataType, T.NumericType)}
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(cols):
        aggregates += [F.count(c).alias(f"k{i}"), F.hll_sketch_agg(_text(df, c), LG_K).alias(f"d{i}")]
        if c in numbers:
            value = F.col(c).cast("double")
            aggregates += [
                F.min(value).alias(f"l{i}"), F.max(value).alias(f"h{i}"),
                F.kll_sketch_agg_double(value, F.lit(KLL_K)).alias(f"q{i}"),
            ]
    none, nothing = F.lit(None).cast("double"), F.lit(None).cast("binary")
    lines = F.array(*(
        F.struct(
            F.lit(c).alias("column"), F.col("rows").alias("n_rows"), F.col(f"k{i}").alias("n_known"),
            (F.col(f"l{i}") if c in numbers else none).alias("low"), (F.col(f"h{i}") if c in numbers else none).alias("high"),
            F.col(f"d{i}").alias("distinct_sketch"), (F.col(f"q{i}") if c in numbers else nothing).alias("value_sketch"),
        )
        for i, c in enumerate(cols)
    ))
    by = [batch] if batch else []
    return df.groupBy(*by).agg(*aggregates).select(*by, F.inline(lines))


def merge(summaries: DataFrame) -> DataFrame:
    """One row for each column from the rows of any batches."""
    return summaries.groupBy("column").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_known").alias("n_known"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("value_sketch").alias("value_sketch"),
    )


def estimates(merged: DataFrame, ranks: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """``column``, ``n_rows``, ``n_known``, ``n_unique`` (estimated), ``low``, ``high`` and ``p<rank>`` (estimated).

    ``n_unique`` is off by at most ``DISTINCT_ERROR`` of it, and the rank of a quantile by ``RANK_ERROR``.
    """
    known = (F.col("n_known") > 0) & F.col("low").isNotNull()
    return merged.select(
        "column", "n_rows", "n_known", F.hll_sketch_estimate("distinct_sketch").alias("n_unique"), "low", "high",
        *(
            F.when(known, F.kll_sketch_get_quantile_double("value_sketch", F.lit(r))).alias(f"p{round(100 * r):02d}")
            for r in ranks
        ),
    )
