"""Data profiling: missing values, cardinality, duplicates, distributions, relations.

The results are tables of one row per column, value or pair. Input rows are always combined
per task before a shuffle, so one frequent value or one large group of copies is no problem.
"""

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tristrata.functions import normalize as nz
from tristrata.operators import enrich, gates, keys
from tristrata.sources import scratch

_CHUNK = 8  # distinct counts per aggregation: each one multiplies the rows it reads
_NARROW = 3  # columns up to which a key is as cheap to move as its hash
_QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def family(df: DataFrame, suffix: str) -> list[str]:
    """Columns whose names end with the suffix, in any letter case."""
    return [c for c in df.columns if c.lower().endswith(suffix.lower())]


def _melt(df: DataFrame, rows: list[dict[str, Column]]) -> DataFrame:
    """Turn a one-row frame of aggregates into one row per dict."""
    structs = [F.struct(*(v.alias(k) for k, v in row.items())) for row in rows]
    return df.select(F.inline(F.array(*structs)))


def _tall(df: DataFrame, cols: list[str], type_name: str) -> DataFrame:
    """(column, value) for the non-NULL values of several columns, from one read."""
    pairs = [
        F.struct(F.lit(c).alias("column"), F.col(c).cast(type_name).alias("value")) for c in cols
    ]
    return df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").where("value IS NOT NULL")


# -- values -----------------------------------------------------------------------------------


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per value and share of all non-NULL rows in percent, most frequent first."""
    counts = (
        df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    )
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", nz.percent(F.col("n"), total)).orderBy(F.desc("n"), col)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def cardinality(df: DataFrame, cols: list[str] | None = None, approx: bool = False) -> DataFrame:
    """Distinct non-NULL values per column, largest first.

    Exact counts run a few columns per aggregation; each aggregation reads only its columns.
    ``approx`` counts all columns in one pass.
    """
    cols = cols or df.columns
    step = len(cols) if approx else _CHUNK
    counter = F.approx_count_distinct if approx else F.count_distinct
    parts = []
    for start in range(0, len(cols), step):
        chunk = cols[start : start + step]
        one_row = df.agg(*(counter(F.col(c)).alias(c) for c in chunk))
        parts.append(
            _melt(one_row, [{"column": F.lit(c), "n_unique": F.col(c)} for c in chunk])
        )
    return reduce(DataFrame.unionByName, parts).orderBy(F.desc("n_unique"), "column")


def pattern_violations(
    df: DataFrame, cols: list[str], regex: str = nz.PLAIN_TEXT, null_violates: bool = False
) -> DataFrame:
    """(column, value, n) for values that do not match the pattern."""
    pairs = [
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols
    ]
    tall = df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")
    bad = ~F.col("value").rlike(regex)
    if null_violates:
        bad = F.coalesce(bad, F.lit(True))
    return tall.where(bad).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


# -- missing values ---------------------------------------------------------------------------


def null_summary(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Missing values per column: count and percent of rows, largest first."""
    cols = cols or df.columns
    one_row = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *(F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)),
    )
    rows = [
        {
            "column": F.lit(c),
            "n_missing": F.col(f"n{i}"),
            "pct_missing": nz.percent(F.col(f"n{i}"), F.col("_rows")),
        }
        for i, c in enumerate(cols)
    ]
    return _melt(one_row, rows).orderBy(F.desc("n_missing"), "column")


def null_family_share(df: DataFrame, suffix: str) -> DataFrame:
    """Missing values in the columns with the suffix versus all other columns."""
    members = family(df, suffix)
    label = F.when(F.col("column").isin(members), F.lit(f"*{suffix}")).otherwise(F.lit("other"))
    totals = null_summary(df).groupBy(label.alias("family")).agg(
        F.sum("n_missing").alias("n_missing")
    )
    # Two rows, so the unpartitioned window is bounded.
    whole = F.sum("n_missing").over(Window.partitionBy())
    return totals.withColumn("share", nz.percent(F.col("n_missing"), whole))


def null_rate_by(
    df: DataFrame, group: str, cols: list[str], null_group: bool = False
) -> DataFrame:
    """Percent of missing values of each column within each group."""
    source = df if null_group else df.where(F.col(group).isNotNull())
    rates = source.groupBy(group).agg(
        *((F.avg(nz.null_flag(F.col(c))) * 100).alias(f"r{i}") for i, c in enumerate(cols))
    )
    rows = [
        F.struct(F.lit(c).alias("column"), F.col(f"r{i}").alias("pct_missing"))
        for i, c in enumerate(cols)
    ]
    return rates.select(group, F.inline(F.array(*rows)))


def non_null_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """Known values per column."""
    one_row = df.agg(*(F.count(c).alias(c) for c in cols))
    return _melt(one_row, [{"column": F.lit(c), "n_known": F.col(c)} for c in cols])


def count_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows that satisfy a condition, as one row."""
    return df.agg(F.count_if(condition).alias("n"))


def missingness_corr(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Correlation matrix of the missing-value indicators in long form (col_1, col_2, corr).

    Rows are first grouped by their pattern of missing columns, so the pairs of columns are
    formed once per pattern and not once per row; the patterns are stored, as they are read
    several times. Columns that are never or always missing have no correlation and are left
    out.
    """
    cols = cols or df.columns
    pattern = F.concat(*(F.when(F.col(c).isNull(), "1").otherwise("0") for c in cols))
    patterns = df.groupBy(pattern.alias("p")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    numbers = F.lit(list(range(1, len(cols) + 1)))
    missing = F.filter(numbers, lambda i: F.substring(F.col("p"), i, F.lit(1)) == "1")
    flagged = scratch.table(patterns, "patterns").select("n", missing.alias("m"))
    rows = flagged.agg(F.sum("n")).scalar()
    single = flagged.select("n", F.explode("m").alias("i")).groupBy("i").agg(F.sum("n").alias("k"))
    single = single.where(F.col("k") < rows)
    both = (
        flagged.select("n", "m", F.explode("m").alias("i"))
        .select("n", "i", F.explode("m").alias("j"))
        .groupBy("i", "j")
        .agg(F.sum("n").alias("k_ij"))
    )
    # Small: at most one row per column, and one per pair of columns.
    left = single.select(F.col("i").alias("a"), F.col("k").alias("k_a"))
    right = single.select(F.col("i").alias("b"), F.col("k").alias("k_b"))
    every = left.withColumn("b", F.explode(numbers)).join(right, "b")
    joined = every.join(both, (F.col("a") == F.col("i")) & (F.col("b") == F.col("j")), "left")
    k_ab = F.coalesce(F.col("k_ij"), F.lit(0.0))
    covariance = rows * k_ab - F.col("k_a") * F.col("k_b")
    spread = F.sqrt(
        F.col("k_a") * (rows - F.col("k_a")) * F.col("k_b") * (rows - F.col("k_b"))
    )
    names = F.lit(list(cols))
    return joined.select(
        F.element_at(names, F.col("a")).alias("col_1"),
        F.element_at(names, F.col("b")).alias("col_2"),
        (covariance / spread).alias("corr"),
    )


def corr_pairs(
    df: DataFrame, cols: list[str] | None = None, threshold: float = 0.85, k: int = 15
) -> DataFrame:
    """The ``k`` strongest correlations above the threshold, off the diagonal."""
    return (
        missingness_corr(df, cols)
        .where((F.col("col_1") != F.col("col_2")) & (F.col("corr") > threshold))
        .orderBy(F.desc("corr"), "col_1", "col_2")
        .limit(k)
    )


# -- distributions ----------------------------------------------------------------------------


def _quantiles(df: DataFrame, cols: list[str]) -> DataFrame:
    """Exact interpolated quartiles per column: (column, p25, p50, p75).

    The values are counted first; the running total of the counts in value order then tells
    which value holds which rank. No task sees more than a range of one column's values.
    """
    counted = (
        _tall(df, cols, "double").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    ranked = keys.running_total(counted, "before", ["column", "value"], "n")
    sizes = ranked.groupBy(F.col("column").alias("_c")).agg(
        F.min("before").alias("_start"), F.sum("n").alias("_size")
    )
    # One row per column of the table.
    placed = ranked.join(F.broadcast(sizes), F.col("column") == F.col("_c"))
    first = F.col("before") - F.col("_start")
    aggs = []
    for name, q in _QUARTILES.items():
        target = (F.col("_size") - 1) * F.lit(q)
        for end, rank in (("lo", F.floor(target)), ("hi", F.ceil(target))):
            here = (first <= rank) & (rank < first + F.col("n"))
            aggs.append(F.max(F.when(here, F.col("value"))).alias(f"{name}_{end}"))
        aggs.append(F.max(target - F.floor(target)).alias(f"{name}_part"))
    found = placed.groupBy("column").agg(*aggs)
    return found.select(
        "column",
        *(
            (
                F.col(f"{p}_lo") + (F.col(f"{p}_hi") - F.col(f"{p}_lo")) * F.col(f"{p}_part")
            ).alias(p)
            for p in _QUARTILES
        ),
    )


def describe_numbers(df: DataFrame, cols: list[str], approx: bool = False) -> DataFrame:
    """count, mean, std, min, quartiles, max per numeric column."""
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [
            F.count(x).alias(f"count{i}"),
            F.avg(x).alias(f"mean{i}"),
            F.stddev_samp(x).alias(f"std{i}"),
            F.min(x).alias(f"min{i}"),
            F.max(x).alias(f"max{i}"),
        ]
        if approx:
            aggs += [F.percentile_approx(x, q).alias(f"{p}{i}") for p, q in _QUARTILES.items()]
    quartiles = list(_QUARTILES) if approx else []
    stats = _melt(
        df.agg(*aggs),
        [
            {
                "column": F.lit(c),
                **{s: F.col(f"{s}{i}") for s in ("count", "mean", "std", "min", "max", *quartiles)},
            }
            for i, c in enumerate(cols)
        ],
    )
    if not approx:
        stats = stats.join(_quantiles(df, cols), "column", "left")
    return stats.select("column", "count", "mean", "std", "min", *_QUARTILES, "max")


def describe_text(df: DataFrame, cols: list[str]) -> DataFrame:
    """count, distinct values, most frequent value (the smallest of several) and its frequency."""
    counted = (
        _tall(df, cols, "string").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    found = counted.groupBy("column").agg(
        F.sum("n").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"),
        F.max("n").alias("freq"),
    )
    every = df.sparkSession.range(1).select(F.explode(F.lit(list(cols))).alias("column"))
    return every.join(found, "column", "left").select(
        "column",
        F.coalesce("count", F.lit(0)).alias("count"),
        F.coalesce("unique", F.lit(0)).alias("unique"),
        "top",
        "freq",
    )


def describe_times(df: DataFrame, cols: list[str]) -> DataFrame:
    """count, mean, min, quartiles, max of date and timestamp columns, as timestamps."""
    seconds = df.select(
        *(nz.epoch_seconds(F.col(c).cast("timestamp_ntz")).alias(c) for c in cols)
    )
    stats = describe_numbers(seconds, cols)
    moments = [
        nz.from_epoch_seconds(F.col(s)).alias(s) for s in ("mean", "min", *_QUARTILES, "max")
    ]
    return stats.select("column", "count", *moments)


def describe(df: DataFrame, cols: list[str] | None = None, approx: bool = False) -> DataFrame:
    """All columns in one table; statistics that do not apply are NULL.

    Dates and timestamps are described as seconds since 1970.
    """
    fields = [f for f in df.schema if cols is None or f.name in cols]
    numeric = [f.name for f in fields if isinstance(f.dataType, T.NumericType)]
    times = [
        f.name for f in fields if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))
    ]
    df = df.withColumns({c: nz.epoch_seconds(F.col(c).cast("timestamp_ntz")) for c in times})
    numeric += times
    text = [f.name for f in fields if isinstance(f.dataType, (T.StringType, T.BooleanType))]
    parts = []
    if numeric:
        parts.append(describe_numbers(df, numeric, approx))
    if text:
        parts.append(describe_text(df, text))
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    order = [
        ("column", "string"), ("count", "long"), ("unique", "long"), ("top", "string"),
        ("freq", "long"), ("mean", "double"), ("std", "double"), ("min", "double"),
        ("p25", "double"), ("p50", "double"), ("p75", "double"), ("max", "double"),
    ]
    return both.select(
        *(
            (F.col(c) if c in both.columns else F.lit(None)).cast(t).alias(c)
            for c, t in order
        )
    )


def linear_fit(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Least-squares line y = slope * x + intercept for each (x, y), all pairs in one pass."""
    aggs = []
    for i, (x, y) in enumerate(pairs):
        aggs += [
            F.regr_count(y, x).alias(f"n{i}"),
            F.regr_slope(y, x).alias(f"slope{i}"),
            F.regr_intercept(y, x).alias(f"intercept{i}"),
            F.regr_r2(y, x).alias(f"r2{i}"),
        ]
    rows = [
        {
            "x": F.lit(x),
            "y": F.lit(y),
            "n": F.col(f"n{i}"),
            "slope": F.col(f"slope{i}"),
            "intercept": F.col(f"intercept{i}"),
            "r2": F.col(f"r2{i}"),
        }
        for i, (x, y) in enumerate(pairs)
    ]
    return _melt(df.agg(*aggs), rows)


# -- duplicates -------------------------------------------------------------------------------


def _grouped(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("cnt"))


def _repeatable(df: DataFrame, cols: list[str]) -> DataFrame:
    """At least all rows that ``cols`` do not tell apart; wide rows that nothing repeats are left out by a hash."""
    if len(cols) <= _NARROW:
        return df
    rows = gates.suspects(df, cols)
    return df.where(F.lit(False)) if rows is None else rows


def duplicate_count(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Rows beyond the first of each group of equal rows, as one row."""
    on = cols or df.columns
    extra = F.coalesce(F.sum(F.col("cnt") - 1), F.lit(0)).alias("n_duplicates")
    return _grouped(_repeatable(df.select(*on), on), on).agg(extra)


def duplicate_counts_by_column(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Repeated values per column; missing values count as one more value."""
    cols = cols or df.columns
    nulls = null_summary(df, cols).select("column", "n_missing")
    values = cardinality(df, cols)
    rows = df.agg(F.count(F.lit(1))).scalar()
    known = F.col("n_unique") + F.when(F.col("n_missing") > 0, 1).otherwise(0)
    return nulls.join(values, "column").select("column", (rows - known).alias("n_duplicates"))


def duplicate_members(df: DataFrame, cols: list[str]) -> DataFrame:
    """Every row whose key occurs more than once.

    Keys are counted first and the rows joined back, so no group is gathered in one task.
    """
    repeated = _grouped(_repeatable(df.select(*cols), cols), cols).where("cnt > 1")
    return enrich.rows_for_keys(df, repeated, cols)


def duplicate_keys(df: DataFrame, cols: list[str]) -> DataFrame:
    """Keys with several rows and how many."""
    return _grouped(df, cols).where("cnt > 1")


def top_collisions(df: DataFrame, cols: list[str], k: int = 5) -> DataFrame:
    """The ``k`` keys with most rows."""
    return duplicate_keys(df, cols).orderBy(F.desc("cnt"), *cols).limit(k)


def rows_of_key(df: DataFrame, values: dict[str, object], order_by: list[str]) -> DataFrame:
    """Rows of one key tuple in the given order."""
    return df.where(reduce(lambda a, b: a & b, (F.col(c) == v for c, v in values.items()))).orderBy(
        *order_by
    )


def key_collisions(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys with several rows, and whether those rows agree in every column (NULL is a value).

    Rows are grouped by key with a hash of the other columns: different hashes mean different rows.
    Keys with several rows of one hash are written, and only their rows are compared by value.
    """
    rest = [c for c in df.columns if c not in key]
    if not rest:
        return _grouped(df, key).where("cnt > 1").select(*key, F.col("cnt").alias("n_rows"), F.lit(True).alias("identical"))
    place = gates.row_hash(df, rest)
    keyed = df.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n_rows"), (F.min(place) == F.max(place)).alias("one_hash")
    )
    repeated = scratch.table(keyed.where("n_rows > 1"), "repeated_keys")
    differing = repeated.where("NOT one_hash").select(*key, "n_rows", F.lit(False).alias("identical"))
    alike = repeated.where("one_hash").select(*key)
    if alike.isEmpty():
        return differing
    rows = enrich.rows_for_keys(df, alike, key)
    compared = (
        _grouped(rows, df.columns)
        .groupBy(*key)
        .agg(F.sum("cnt").alias("n_rows"), F.count(F.lit(1)).alias("n_variants"))
        .select(*key, "n_rows", (F.col("n_variants") == 1).alias("identical"))
    )
    return differing.unionByName(compared)


def all_collisions_identical(df: DataFrame, key: list[str]) -> DataFrame:
    """TRUE if no key has two different rows, as one row."""
    return key_collisions(df, key).agg(
        F.coalesce(F.bool_and("identical"), F.lit(True)).alias("all_identical")
    )


# -- samples ----------------------------------------------------------------------------------


def sample_n(df: DataFrame, n: int, id_cols: list[str], seed: int = 42) -> DataFrame:
    """``n`` rows in a pseudo-random order that depends only on the ids and the seed.

    Rows are counted by the first digits of their place in that order, so that only rows up to the
    place of the n-th are sorted.
    """
    place = _place(id_cols, seed)
    start = F.substring(place, 1, 4)
    counts = df.groupBy(start.alias("start")).agg(F.count(F.lit(1)).alias("n"))  # 65,536 rows at most
    upto = counts.withColumn("n", F.sum("n").over(Window.orderBy("start"))).where(F.col("n") >= n)
    last = upto.agg(F.min("start")).scalar()
    return df.where(last.isNull() | (start <= last)).orderBy(place, *id_cols).limit(n)


def sample_fraction(
    df: DataFrame, fraction: float, seed: int = 42, id_cols: list[str] | None = None
) -> DataFrame:
    """About this part of the rows; with ``id_cols`` the choice depends only on the ids and the seed."""
    if id_cols is None:
        return df.sample(False, fraction, seed)
    return df.where(F.conv(F.substring(_place(id_cols, seed), 1, 8), 16, 10).cast("long") < fraction * 2**32)


def _place(id_cols: list[str], seed: int) -> Column:
    """A row's place in a pseudo-random order, as 32 hexadecimal digits."""
    return F.md5(F.concat_ws("|", *(F.col(c).cast("string") for c in id_cols), F.lit(str(seed))))


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


def dimensions(df: DataFrame) -> DataFrame:
    """Row and column count, as one row."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns")
    )


def column_types(df: DataFrame) -> DataFrame:
    """Column names, types and known values, in table order."""
    types = dict(df.dtypes)
    counts = df.agg(*(F.count(c).alias(c) for c in df.columns))
    return _melt(
        counts,
        [
            {
                "position": F.lit(i + 1),
                "column": F.lit(c),
                "type": F.lit(types[c]),
                "n_known": F.col(c),
            }
            for i, c in enumerate(df.columns)
        ],
    )
