"""All statistics of a table from two scans.

The first scan groups rows by which slices they belong to and which columns they miss, and keeps a
count and the moments of the numbers for each group: ``cells``, a few hundred rows at most. The second
makes one (slices, column, value) for each column of each row and counts them: ``bag``, one row for each
different value. It is made type by type, each reading its own columns: values are counted as what they
are and only different ones become text, and a statistic opens only the types it asks for. All is
written. Every statistic is then read off these tables and comes as rows of one shape: ``section``,
``key``, ``statistic``, ``value``.
"""

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tristrata.functions import normalize as nz
from tristrata.operators import gates, keys, profile as pf
from tristrata.sources import scratch

ROW_HASH = "*"  # the bag's name for whole rows
QUARTERS = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


@dataclass(frozen=True)
class Tally:
    """The two stored relations of a table and what they were made of."""

    source: DataFrame
    slices: tuple[str, ...]
    columns: tuple[str, ...]
    numbers: tuple[str, ...]
    pairs: tuple[tuple[str, str], ...]
    composites: dict[str, tuple[str, ...]]
    cells: DataFrame
    bag: dict[tuple[str, ...], DataFrame]  # by the names it has values of

    def _in(self, slice_name: str) -> Column:
        return F.col("slices").bitwiseAND(1 << self.slices.index(slice_name)) != 0

    def _cells(self, slice_name: str) -> DataFrame:
        return self.cells.where(self._in(slice_name))

    def _missing(self, column: str) -> Column:
        return F.substring("pattern", self.columns.index(column) + 1, 1) == "1"

    def _values(self, slice_name: str, columns: Sequence[str]) -> DataFrame:
        """``column``, ``value``, ``n`` of a slice."""
        parts = [part for names, part in self.bag.items() if set(names) & set(columns)]
        held = reduce(DataFrame.unionByName, parts).where(self._in(slice_name) & F.col("column").isin(list(columns)))
        return held.groupBy("column", "value").agg(F.sum("n").alias("n"))

    # -- counts of rows and of missing values ------------------------------------------------------

    def size(self, section: str, slice_name: str, columns: Sequence[str] | None = None) -> DataFrame:
        one = self._cells(slice_name).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
        return _lines(one, section, [("", "rows", F.col("rows")), ("", "columns", F.lit(len(columns or self.columns)))])

    def nulls(self, section: str, slice_name: str, columns: Sequence[str] | None = None) -> DataFrame:
        """Missing values of each column, in rows and in percent."""
        cols = list(columns or self.columns)
        one = self._cells(slice_name).agg(
            F.sum("n").alias("rows"), *(F.sum(F.when(self._missing(c), F.col("n")).otherwise(0)).alias(f"c{i}") for i, c in enumerate(cols))
        )
        return _lines(one, section, [
            line for i, c in enumerate(cols)
            for line in ((c, "missing", F.col(f"c{i}")), (c, "percent", nz.percent(F.col(f"c{i}"), F.col("rows"))))
        ])

    def known(self, section: str, slice_name: str, columns: Sequence[str]) -> DataFrame:
        one = self._cells(slice_name).agg(
            *(F.sum(F.when(self._missing(c), 0).otherwise(F.col("n"))).alias(f"c{i}") for i, c in enumerate(columns))
        )
        return _lines(one, section, [(c, "known", F.col(f"c{i}")) for i, c in enumerate(columns)])

    def null_share(self, section: str, slice_name: str, suffix: str) -> DataFrame:
        """Missing values in the columns with the suffix and in the others, and their shares."""
        members = [c for c in self.columns if c.endswith(suffix)]
        others = [c for c in self.columns if c not in members]

        def total(cols: list[str]) -> Column:
            return F.sum(F.col("n") * reduce(add, (self._missing(c).cast("int") for c in cols), F.lit(0)))

        one = self._cells(slice_name).agg(total(members).alias("a"), total(others).alias("b"))
        whole = F.col("a") + F.col("b")
        return _lines(one, section, [
            (name, statistic, value) for name, c in ((f"*{suffix}", "a"), ("other", "b"))
            for statistic, value in (("missing", F.col(c)), ("share", nz.percent(F.col(c), whole)))
        ])

    def null_rate(self, section: str, slice_name: str, slices: Sequence[str], columns: Sequence[str]) -> DataFrame:
        """Percent of missing values of each column within each of several slices."""
        parts = []
        for inner in slices:
            held = self._cells(slice_name).where(self._in(inner))
            one = held.agg(
                F.sum("n").alias("rows"), *(F.sum(F.when(self._missing(c), F.col("n")).otherwise(0)).alias(f"c{i}") for i, c in enumerate(columns))
            ).where("rows > 0")
            parts.append(_lines(one, section, [(f"{inner}|{c}", "percent", F.col(f"c{i}") * 100 / F.col("rows")) for i, c in enumerate(columns)]))
        return reduce(DataFrame.unionByName, parts)

    def missing_pairs(self, section: str, slice_name: str, columns: Sequence[str] | None = None) -> DataFrame:
        """Correlation of the missing-value indicators of each two columns; constant ones have none."""
        cols = list(columns or self.columns)
        flagged = self._cells(slice_name).groupBy("pattern").agg(F.sum("n").cast("double").alias("n"))
        one = flagged.agg(
            F.sum("n").alias("rows"), *(F.sum(F.when(self._missing(c), F.col("n")).otherwise(0.0)).alias(f"k{i}") for i, c in enumerate(cols))
        )
        flags = F.array(*(F.struct(F.lit(i).alias("i"), self._missing(c).alias("m")) for i, c in enumerate(cols)))
        missing = F.transform(F.filter(flags, lambda x: x["m"]), lambda x: x["i"])
        both = flagged.select("n", missing.alias("m")).select("n", "m", F.explode("m").alias("i")).select("n", "i", F.explode("m").alias("j"))
        counted = both.where("i < j").groupBy("i", "j").agg(F.sum("n").alias("k_ij"))
        alone = one.select("rows", F.inline(F.array(*(F.struct(F.lit(i).alias("i"), F.col(f"k{i}").alias("k")) for i in range(len(cols))))))
        alone = alone.where("k > 0 AND k < rows")  # one row for each column
        left = alone.withColumn("j", F.explode(F.sequence(F.col("i") + 1, F.lit(len(cols))))).withColumnRenamed("k", "k_i")
        right = alone.select(F.col("i").alias("j"), F.col("k").alias("k_j"))
        joined = left.join(right, "j").join(counted, ["i", "j"], "left")
        rows, a, b = F.col("rows"), F.col("k_i"), F.col("k_j")
        corr = (rows * F.coalesce("k_ij", F.lit(0.0)) - a * b) / F.sqrt(a * (rows - a) * b * (rows - b))
        names = F.lit(list(cols))
        key = F.concat_ws("|", F.get(names, F.col("i")), F.get(names, F.col("j")))
        return joined.select(F.lit(section).alias("section"), key.alias("key"), F.lit("correlation").alias("statistic"), corr.alias("value"))

    # -- numbers -----------------------------------------------------------------------------------

    def describe(self, section: str, slice_name: str, columns: Sequence[str]) -> DataFrame:
        """count, mean, std, min, max and exact quartiles of number columns.

        Moments of the cells are merged around the mean of all.
        """
        parts = F.array(*(
            F.struct(F.lit(c).alias("column"), F.when(self._missing(c), 0).otherwise(F.col("n")).cast("double").alias("m"), *(
                F.col(f"{what}_{self.numbers.index(c)}").alias(what) for what in ("mean", "spread", "low", "high")
            ))
            for c in columns
        ))
        tall = self._cells(slice_name).select(F.inline(parts)).where("m > 0")
        means = tall.groupBy(F.col("column").alias("_c")).agg((F.sum(F.col("m") * F.col("mean")) / F.sum("m")).alias("_mean"))
        apart = F.col("m") * F.pow(F.col("mean") - F.col("_mean"), 2)
        found = tall.join(means, F.col("column") == F.col("_c")).groupBy("column", "_mean").agg(
            F.sum("m").alias("count"), F.sum(F.col("spread") + apart).alias("_m2"), F.min("low").alias("min"), F.max("high").alias("max")
        )
        std = F.when(F.col("count") > 1, F.sqrt(F.col("_m2") / (F.col("count") - 1)))
        moments = _tall_lines(
            found, section, "column", {"count": F.col("count"), "mean": F.col("_mean"), "std": std, "min": F.col("min"), "max": F.col("max")}
        )
        return moments.unionByName(self._quartiles(section, slice_name, columns))

    def _quartiles(self, section: str, slice_name: str, columns: Sequence[str]) -> DataFrame:
        values = self._values(slice_name, columns).select("column", F.col("value").cast("double").alias("value"), "n")
        ranked = keys.running_total(values, "before", ["column", "value"], "n")
        sizes = ranked.groupBy(F.col("column").alias("_c")).agg(F.min("before").alias("_start"), F.sum("n").alias("_size"))
        placed = ranked.join(F.broadcast(sizes), F.col("column") == F.col("_c"))  # a row for each column
        first = F.col("before") - F.col("_start")

        def at(rank: Column) -> Column:
            return F.max(F.when((first <= rank) & (rank < first + F.col("n")), F.col("value")))

        found = {}
        for name, q in QUARTERS.items():
            target = (F.col("_size") - 1) * F.lit(q)
            low, high = at(F.floor(target)), at(F.ceil(target))
            found[name] = low + (high - low) * F.max(target - F.floor(target))
        grouped = placed.groupBy("column").agg(*(v.alias(k) for k, v in found.items()))
        return _tall_lines(grouped, section, "column", {k: F.col(k) for k in found})

    def fit(self, section: str, slice_name: str) -> DataFrame:
        """Least-squares line of each pair (x, y) over the rows that know both."""
        parts = []
        for i, (x, y) in enumerate(self.pairs):
            held = self._cells(slice_name).where(~self._missing(x) & ~self._missing(y))
            w, mx, my = F.col("n").cast("double"), F.col(f"mean_x_{i}"), F.col(f"mean_y_{i}")
            mean = held.agg((F.sum(w * mx) / F.sum(w)).alias("gx"), (F.sum(w * my) / F.sum(w)).alias("gy"))
            both = held.join(F.broadcast(mean))  # one row
            dx, dy = mx - F.col("gx"), my - F.col("gy")
            one = both.groupBy("gx", "gy").agg(
                F.sum(w).alias("count"), F.sum(F.col(f"cov_{i}") + w * dx * dy).alias("xy"),
                F.sum(F.col(f"xx_{i}") + w * dx * dx).alias("xx"), F.sum(F.col(f"yy_{i}") + w * dy * dy).alias("yy"),
            )
            slope = F.try_divide("xy", "xx")
            parts.append(_lines(one, section, [
                (f"{x}|{y}", "count", F.col("count")), (f"{x}|{y}", "slope", slope),
                (f"{x}|{y}", "intercept", F.col("gy") - slope * F.col("gx")),
                (f"{x}|{y}", "r2", F.try_divide(F.col("xy") * F.col("xy"), F.col("xx") * F.col("yy"))),
            ]))
        return reduce(DataFrame.unionByName, parts)

    # -- values ------------------------------------------------------------------------------------

    def distinct(self, section: str, slice_name: str, columns: Sequence[str] | None = None) -> DataFrame:
        """Different known values of each column; columns without any are left out."""
        cols = list(columns or self.columns)
        found = self._values(slice_name, cols).groupBy("column").agg(F.count(F.lit(1)).alias("u"))
        return _tall_lines(found, section, "column", {"unique": F.col("u")})

    def describe_texts(self, section: str, slice_name: str, columns: Sequence[str]) -> DataFrame:
        """count, unique and the rows of the most frequent value of text columns."""
        found = self._values(slice_name, columns).groupBy("column").agg(
            F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"), F.max("n").alias("freq")
        )
        return _tall_lines(found, section, "column", {c: F.col(c) for c in ("count", "unique", "freq")})

    def counts(self, section: str, slice_name: str, column: str) -> DataFrame:
        """Rows of each value of a column, and their share of all rows that know it."""
        values = self._values(slice_name, [column])
        total = values.agg(F.sum("n")).scalar()
        return _tall_lines(values, section, "value", {"rows": F.col("n"), "share": nz.percent(F.col("n"), total)})

    def repeats(self, section: str, slice_name: str, name: str, top: int = 0) -> DataFrame:
        """Keys of a composite that several rows share: how many, their rows, those beyond the first; the ``top`` largest."""
        shared = self._values(slice_name, [name]).where("n > 1")
        one = shared.agg(F.count(F.lit(1)).alias("k"), F.coalesce(F.sum("n"), F.lit(0)).alias("r"))
        out = _lines(one, section, [("", "keys", F.col("k")), ("", "rows", F.col("r")), ("", "beyond_first", F.col("r") - F.col("k"))])
        if not top:
            return out
        first = shared.orderBy(F.desc("n"), "value").limit(top)
        return out.unionByName(_tall_lines(first, section, "value", {"rows": F.col("n")}))

    def worst_rows(self, section: str, rows: DataFrame, name: str, slice_name: str, columns: Sequence[str]) -> DataFrame:
        """The rows of the composite's most frequent key, with number columns by name.

        ``rows`` are the slice's rows; those of one key are numbered in the order of all their columns.
        """
        shared = self._values(slice_name, [name]).where("n > 1").orderBy(F.desc("n"), "value").limit(1)
        key = gates.key_text(rows, self.composites[name])
        worst = shared.select(F.col("value").alias("_worst"))  # one row
        held = rows.join(F.broadcast(worst), key == F.col("_worst"))
        # Rows of one key of a table whose keys should be unique.
        numbered = held.withColumn("_i", F.row_number().over(Window.partitionBy("_worst").orderBy(*rows.columns)))
        return _tall_lines(numbered, section, "_i", {c: F.col(c) for c in columns})

    def duplicates(self, section: str, rows: DataFrame, slice_name: str) -> DataFrame:
        """Rows beyond the first of each group of equal rows; ``rows`` are the slice's, read only if a hash repeats."""
        again = self._values(slice_name, [ROW_HASH]).where("n > 1")
        if again.isEmpty():
            return _lines(again.agg(F.lit(0).alias("d")), section, [("", "beyond_first", F.col("d"))])
        return _lines(pf.duplicate_count(rows), section, [("", "beyond_first", F.col("n_duplicates"))])


def _lines(one: DataFrame, section: str, lines: list[tuple[str, str, Column]]) -> DataFrame:
    """Rows of the report from a frame of one row."""
    made = F.array(*(
        F.struct(F.lit(section).alias("section"), F.lit(key).alias("key"), F.lit(name).alias("statistic"), value.cast("double").alias("value"))
        for key, name, value in lines
    ))
    return one.select(F.inline(made))


def _tall_lines(df: DataFrame, section: str, key: str, values: dict[str, Column]) -> DataFrame:
    """Rows of the report from a frame of one row for each key."""
    made = F.array(*(F.struct(F.lit(name).alias("statistic"), v.cast("double").alias("value")) for name, v in values.items()))
    return df.select(F.lit(section).alias("section"), F.col(key).cast("string").alias("key"), F.inline(made))


def tally(
    df: DataFrame,
    slices: dict[str, Column] | None = None,
    columns: Sequence[str] | None = None,
    numbers: Sequence[str] = (),
    pairs: Sequence[tuple[str, str]] = (),
    composites: dict[str, Sequence[str]] | None = None,
    whole_rows: bool = True,
) -> Tally:
    """Scan a table twice and write what its statistics need.

    ``slices`` are conditions by name (a slice ``all`` is added); NULL counts as false. ``numbers`` are
    columns with moments, ``pairs`` those with a line fit, ``composites`` keys of several columns.
    """
    conditions = {"all": F.lit(True), **(slices or {})}
    cols = list(columns or df.columns)
    composites = {name: tuple(c) for name, c in (composites or {}).items()}
    bits = reduce(add, (F.coalesce(c, F.lit(False)).cast("int") * (1 << i) for i, c in enumerate(conditions.values())))
    missing = F.array(*(F.col(c).isNull() for c in cols))
    # Within a cell a column is known in all rows or in none, so the cell's count is that of its known values.
    n = F.count(F.lit(1))
    aggregates = [n.alias("n")]
    for i, c in enumerate(numbers):
        value = F.col(c).cast("double")
        aggregates += [
            F.avg(value).alias(f"mean_{i}"), (F.var_pop(value) * n).alias(f"spread_{i}"), F.min(value).alias(f"low_{i}"), F.max(value).alias(f"high_{i}"),
        ]
    for i, (x, y) in enumerate(pairs):
        x, y = (F.col(c).cast("double") for c in (x, y))
        aggregates += [
            F.avg(x).alias(f"mean_x_{i}"), F.avg(y).alias(f"mean_y_{i}"), (F.covar_pop(x, y) * n).alias(f"cov_{i}"),
            (F.var_pop(x) * n).alias(f"xx_{i}"), (F.var_pop(y) * n).alias(f"yy_{i}"),
        ]
    grouped = df.groupBy(bits.alias("slices"), missing.alias("missing")).agg(*aggregates)
    pattern = F.array_join(F.transform("missing", lambda m: m.cast("int").cast("string")), "")
    cells = grouped.withColumn("missing", pattern).withColumnRenamed("missing", "pattern")
    tagged: dict[str, dict[str, Column]] = {}
    for c in cols:
        kind, value = _counted_as(df, c)
        tagged.setdefault(kind, {})[c] = value
    if composites:
        tagged["keys"] = {name: gates.key_text(df, on) for name, on in composites.items()}
    if whole_rows:
        tagged["hash"] = {ROW_HASH: gates.row_hash(df, cols)}
    return Tally(
        df, tuple(conditions), tuple(cols), tuple(numbers), tuple(pairs), composites, scratch.table(cells, "cells"),
        {tuple(values): scratch.table(_bag(df, bits, values), f"bag-{kind}") for kind, values in tagged.items()},
    )


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_AS_IS = (T.StringType, T.BooleanType, T.FloatType, T.DoubleType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _counted_as(df: DataFrame, column: str) -> tuple[str, Column]:
    """A name for the type in which a column's values are counted, and the column in it."""
    kind = df.schema[column].dataType
    if isinstance(kind, _WHOLE):
        return "bigint", F.col(column).cast("long")
    if isinstance(kind, _AS_IS):
        return kind.simpleString(), F.col(column)
    return "string", F.col(column).cast("string")


def _bag(df: DataFrame, bits: Column, values: dict[str, Column]) -> DataFrame:
    """``slices``, ``column``, ``value``, ``n`` of columns of one type."""
    rows = F.array(*(F.struct(F.lit(i).alias("i"), value.alias("value")) for i, value in enumerate(values.values())))
    counted = (
        df.select(bits.alias("slices"), F.inline(rows)).where("value IS NOT NULL")
        .groupBy("slices", "i", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.select("slices", F.get(F.lit(list(values)), F.col("i")).alias("column"), F.col("value").cast("string").alias("value"), "n")
