"""Data-quality gates.

A gate is declared once and used three ways: ``run`` counts violations of many gates,
``violations`` lists the offending rows or keys of one gate, ``watch`` attaches the row gates
to a write so that they cost no extra scan.

Row gates are a predicate and are all counted in one aggregation over one scan. Key gates share a
scan as well: every row gives one tagged key for each gate, and the bag of tagged keys is grouped
once, before the shuffle and after it, so a hot key or a large group of copies arrives as one row per
task; the known keys of all dimensions meet it in one join. Whole rows are compared by a hash first,
and only rows whose hash repeats are compared by value. A table is probed for its first row if
nothing else has to read it. Schema gates look at column names and start no job.
"""

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from tristrata.functions import normalize as nz
from tristrata.operators import enrich
from tristrata.sources import scratch

RESULT_SCHEMA = "gate string, dataset string, violations bigint, passed boolean"


class QualityError(ValueError):
    """At least one gate found violations."""


@dataclass(frozen=True)
class Gate:
    """``count`` is an aggregate over the rows, ``listing`` the offending rows or keys, ``names``
    the offending column names. A row gate has ``breach`` and derives the first two from it.

    A gate with ``key`` is counted in the shared scan of keys: the key's columns, NULL tuple for rows
    that do not count, and ``known``, whose keys are right; without it a key is wrong if it repeats.
    ``probe`` gates are counted from the first row."""

    name: str
    breach: Callable[[DataFrame], Column] | None = None
    count: Callable[[DataFrame], Column] | None = None
    listing: Callable[[DataFrame], DataFrame] | None = None
    names: Callable[[DataFrame], list[str]] | None = None
    key: Callable[[DataFrame], Column] | None = None
    known: Callable[[DataFrame], DataFrame] | None = None
    probe: bool = False

    def counted(self, df: DataFrame) -> Column | None:
        if self.breach is not None:
            return F.count_if(self.breach(df))
        return self.count(df) if self.count is not None else None


# -- row gates --------------------------------------------------------------------------------


def not_null(cols: list[str]) -> Gate:
    """No listed column is NULL."""
    return Gate(
        f"not_null({','.join(cols)})",
        breach=lambda df: reduce(or_, (F.col(c).isNull() for c in cols)),
    )


def not_null_each(cols: list[str]) -> list[Gate]:
    """One gate per column, so that the result shows the NULL count of each."""
    return [not_null([c]) for c in cols]


def ordered(lo: str, hi: str, strict: bool = True) -> Gate:
    """``lo`` before ``hi``; NULLs are ignored and equality fails when strict."""
    return Gate(
        f"ordered({lo},{hi})",
        breach=lambda df: F.col(lo) >= F.col(hi) if strict else F.col(lo) > F.col(hi),
    )


def columns_differ(a: str, b: str) -> Gate:
    return Gate(f"columns_differ({a},{b})", breach=lambda df: F.col(a) == F.col(b))


def positive(col: str, if_present: bool = True) -> Gate:
    """Known values are above zero; with ``if_present`` an absent column passes."""

    def breach(df: DataFrame) -> Column:
        if if_present and col not in df.columns:
            return F.lit(False)
        return F.col(col) <= 0

    return Gate(f"positive({col})", breach=breach)


def sum_consistency(
    total: str, parts: list[str], tol: float = 5.0, only_positive: bool = True
) -> Gate:
    """The parts add up to the total within the tolerance.

    With ``only_positive`` rows count only where total and sum are above zero, and missing parts
    are zero. Without it a row with any missing operand is not judged; add ``not_null`` over the
    operands to see how many those are.
    """

    def breach(df: DataFrame) -> Column:
        if only_positive:
            parts_sum = nz.row_sum([F.col(p) for p in parts])
            off = F.abs(F.col(total) - parts_sum) > tol
            return (F.col(total) > 0) & (parts_sum > 0) & off
        parts_sum = reduce(add, (F.col(p) for p in parts))
        return F.abs(F.col(total) - parts_sum) > tol

    return Gate(f"sum_consistency({total})", breach=breach)


def max_length(col: str, n: int) -> Gate:
    return Gate(f"max_length({col},{n})", breach=lambda df: F.length(col) > n)


def castable(col: str, type_name: str) -> Gate:
    """Non-blank text reads as the type, which includes its value range."""
    return Gate(
        f"castable({col},{type_name})",
        breach=lambda df: nz.blank_to_null(F.col(col)).isNotNull()
        & nz.num(F.col(col), type_name).isNull(),
    )


# -- table, schema and key gates ----------------------------------------------------------------


def not_empty() -> Gate:
    """There is a row; nothing beyond the first is read unless other gates read it anyway."""

    def none_found(df: DataFrame) -> DataFrame:
        return df.limit(1).agg(F.count(F.lit(1)).alias("row_count")).where("row_count = 0")

    return Gate("not_empty", count=lambda df: (F.count(F.lit(1)) == 0).cast("long"), listing=none_found, probe=True)


def required_columns(cols: list[str]) -> Gate:
    """All names exist, in any letter case."""

    def missing(df: DataFrame) -> list[str]:
        present = {c.lower() for c in df.columns}
        return sorted(c.lower() for c in cols if c.lower() not in present)

    return Gate("required_columns", names=missing)


def _key_of(*columns: Column) -> Column:
    """A key tuple as an array of texts: equal for equal tuples of one gate, NULL being a value."""
    return F.array(*(c.cast("string") for c in columns))


def _plain(df: DataFrame, name: str) -> Column:
    """A key column in a form whose text tells different values apart and equal ones alike."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.col(name) + F.lit(0.0)  # the two zeros are equal
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(name)  # a zone's clock shows some times twice
    if isinstance(kind, T.BinaryType):
        return F.hex(name)
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(F.struct(name))
    return F.col(name)


def unique(cols: list[str]) -> Gate:
    """No key tuple occurs twice; the listing gives the keys and their row counts."""
    return Gate(
        f"unique({','.join(cols)})",
        listing=lambda df: df.groupBy(*cols).agg(F.count(F.lit(1)).alias("cnt")).where("cnt > 1"),
        key=lambda df: _key_of(*(_plain(df, c) for c in cols)),
    )


def key_text(df: DataFrame, cols) -> Column:
    """A key tuple as one text: different tuples differ, and NULL is a value."""
    escaped = [
        F.replace(F.replace(_plain(df, c).cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit(r"\|")) for c in cols
    ]
    parts = [F.coalesce(e, F.lit(r"\N")) for e in escaped]
    return F.concat_ws("|", *parts)


def row_hash(df: DataFrame, cols: list[str]) -> Column:
    """64 bits of a row's values; which columns are NULL counts too."""
    return F.xxhash64(*cols, *(F.col(c).isNull() for c in cols))


def suspects(df: DataFrame, cols: list[str]) -> DataFrame | None:
    """The rows whose hash over ``cols`` occurs more than once, or None if no hash does.

    Rows that agree on every column agree on ``cols``, whichever they are.

    Only hashes are shuffled to find them. The repeated hashes are written, so that their size is
    known before the rows are filtered by them.
    """
    hashes = df.select(row_hash(df, cols).alias("_hash")).groupBy("_hash").agg(F.count(F.lit(1)).alias("_n"))
    repeated = scratch.table(hashes.where("_n > 1").select(F.col("_hash").alias("_repeated")), "repeated")
    if repeated.isEmpty():
        return None
    return df.join(enrich.measured(repeated), row_hash(df, cols) == F.col("_repeated"), "left_semi")


def no_full_duplicates(cols: list[str] | None = None, by: list[str] | None = None) -> Gate:
    """No two rows agree on every (listed) column; the listing gives such rows once, with their number.

    ``by`` names some of the columns, which hardly ever agree: only rows that agree on those are
    compared by value, and only those are hashed.
    """

    def listing(df: DataFrame) -> DataFrame:
        on = cols or df.columns
        rows = suspects(df.select(*on), by or on)
        rows = df.select(*on).where(F.lit(False)) if rows is None else rows
        return rows.groupBy(*on).agg(F.count(F.lit(1)).alias("cnt")).where("cnt > 1")

    return Gate("no_full_duplicates", listing=listing)


def fk_exists(col: str, dim: DataFrame, dim_col: str, ignore_nulls: bool = True) -> Gate:
    """Every key occurs in the dimension; the listing gives missing keys and their row counts.

    The keys are grouped before the anti join, so the join sees each key once.
    """

    def listing(df: DataFrame) -> DataFrame:
        held = df.where(F.col(col).isNotNull()) if ignore_nulls else df
        found = held.groupBy(F.col(col).alias("key")).agg(F.count(F.lit(1)).alias("n_rows"))
        known = dim.select(F.col(dim_col).alias("_known"))
        return found.join(known, F.col("key") == F.col("_known"), "left_anti")

    def key(df: DataFrame) -> Column:
        held = _key_of(_plain(df, col))
        return F.when(F.col(col).isNotNull(), held) if ignore_nulls else held

    def known(df: DataFrame) -> DataFrame:
        typed = dim.select(F.col(dim_col).try_cast(df.schema[col].dataType).alias("key")).where("key IS NOT NULL")
        return typed.select(_key_of(_plain(typed, "key")).alias("key"))

    return Gate(
        f"fk_exists({col})",
        listing=listing,
        key=key,
        known=known,
    )


# -- execution --------------------------------------------------------------------------------


def _result(rows: DataFrame, dataset: str) -> DataFrame:
    n = F.col("violations").cast("long")
    return rows.select(
        F.col("gate"),
        F.lit(dataset).alias("dataset"),
        n.alias("violations"),
        (n == 0).alias("passed"),
    )


def _one_row(counts: list[tuple[str, Column]], df: DataFrame) -> DataFrame:
    """(gate, violations) from aggregates over all rows of ``df``."""
    one = df.agg(*(c.alias(f"g{i}") for i, (_, c) in enumerate(counts)))
    lines = [
        F.struct(F.lit(name).alias("gate"), F.col(f"g{i}").cast("long").alias("violations"))
        for i, (name, _) in enumerate(counts)
    ]
    return one.select(F.inline(F.array(*lines)))


def key_counts(df: DataFrame, gates: list[Gate]) -> DataFrame:
    """(gate, violations) of all key gates from one scan of ``df``.

    Each row becomes one (gate, key) pair for each gate; pairs are counted, then joined once with the
    pairs that the dimensions allow.
    """
    tagged = F.array(*(F.struct(F.lit(i).alias("gate"), g.key(df).alias("key")) for i, g in enumerate(gates)))
    pairs = df.select(F.inline(tagged)).where("key IS NOT NULL")
    bag = pairs.groupBy("gate", "key").agg(F.count(F.lit(1)).alias("n"))
    allowed = [
        g.known(df).select(F.lit(i).alias("_gate"), F.col("key").alias("_key")) for i, g in enumerate(gates) if g.known
    ]
    right = F.lit(None).cast("boolean")
    if allowed:
        side = reduce(DataFrame.unionByName, allowed).distinct().withColumn("_known", F.lit(True))
        bag = bag.join(side, (F.col("gate") == F.col("_gate")) & (F.col("key") == F.col("_key")), "left")
        right = F.col("_known")
    counts = []
    for i, g in enumerate(gates):
        wrong = right.isNull() if g.known else F.col("n") > 1
        counts.append((g.name, F.count_if((F.col("gate") == i) & wrong)))
    return _one_row(counts, bag)


def run(df: DataFrame, gates: list[Gate], dataset: str) -> DataFrame:
    """One result row per gate: gate, dataset, violations, passed."""
    spark = df.sparkSession
    by_row = [(g.name, g.counted(df)) for g in gates if g.counted(df) is not None]
    probes = [g for g in gates if g.probe]
    by_key = [g for g in gates if g.key is not None]
    parts = []
    if len(by_row) > len(probes):
        parts.append(_one_row(by_row, df))
    elif probes:  # nothing else needs the rows
        first = df.select(F.lit(1).alias("one")).limit(1)
        parts.append(_one_row([(g.name, g.count(df)) for g in probes], first))
    if by_key:
        parts.append(key_counts(df, by_key))
    for g in gates:
        if g.names is not None:
            found = spark.range(1).select(F.lit(len(g.names(df))).cast("long").alias("violations"))
        elif g.counted(df) is None and g.key is None:
            found = g.listing(df).agg(F.count(F.lit(1)).alias("violations"))
        else:
            continue
        parts.append(found.select(F.lit(g.name).alias("gate"), "violations"))
    return _result(reduce(DataFrame.unionByName, parts), dataset)


def violations(df: DataFrame, gate: Gate) -> DataFrame:
    """The offending rows (row gates), keys (key gates) or column names (schema gates)."""
    if gate.breach is not None:
        return df.where(gate.breach(df))
    if gate.names is not None:
        names = F.lit(gate.names(df)).cast("array<string>")
        return df.sparkSession.range(1).select(F.explode(names).alias("missing_column"))
    return gate.listing(df)


def watch(
    df: DataFrame, gates: list[Gate], dataset: str
) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """Count row gates while ``df`` is written or read to the end.

    Returns the DataFrame to use and a function that gives the result rows after that action;
    ``not_empty`` also counts here, key gates do not.
    """
    spark = df.sparkSession
    fused = [(g.name, g.counted(df)) for g in gates if g.counted(df) is not None]
    observation = Observation()
    observed = df.observe(observation, *(c.alias(f"g{i}") for i, (_, c) in enumerate(fused)))

    def result() -> DataFrame:
        metrics = observation.get
        rows = [(name, int(metrics[f"g{i}"])) for i, (name, _) in enumerate(fused)]
        return _result(spark.createDataFrame(rows, "gate string, violations bigint"), dataset)

    return observed, result


def enforce(result: DataFrame) -> None:
    """Raise if any gate failed. Only the failed result rows, one per gate, reach the driver."""
    failed = result.where(~F.col("passed")).orderBy("dataset", "gate").collect()
    if failed:
        raise QualityError(
            "; ".join(f"{r.dataset}: {r.gate} has {r.violations} violations" for r in failed)
        )
