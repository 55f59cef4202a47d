"""Dimension lookups: left equi-joins of a large table with attribute tables."""

from functools import reduce
from operator import add, or_

from pyspark.sql import DataFrame, functions as F, types as T

# A lookup table is broadcast only when it was measured to fit both bounds.
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def measured(
    dim: DataFrame,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
    key: str | None = None,
) -> DataFrame:
    """``dim`` with a broadcast hint if its measured size allows it, else unchanged.

    With ``key`` a value of that column on several rows raises ValueError; NULL matches nothing.

    One aggregation over the lookup side counts its rows and bytes. Beyond the bound the join
    is left to the engine: a shuffle join whose hot keys AQE splits on the large side, which
    is exact because a lookup table holds one row per key.
    """
    varying = [
        f.name for f in dim.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))
    ]
    fixed_width = 16 * len(dim.columns)
    width = reduce(
        add, (F.coalesce(F.octet_length(c), F.lit(0)) for c in varying), F.lit(fixed_width)
    )
    keys = [F.count(key).alias("k"), F.count_distinct(key).alias("d")] if key else []
    size = dim.agg(F.count(F.lit(1)).alias("n"), F.sum(width.cast("long")).alias("b"), *keys).first()
    if key and size.k != size.d:
        raise ValueError(f"{size.k - size.d} rows repeat a lookup key")
    fits = size.n <= max_rows and (size.b or 0) <= max_bytes
    return F.broadcast(dim) if fits else dim


def is_small(dim: DataFrame) -> bool:
    """Whether ``measured`` broadcasts the table."""
    return measured(dim) is not dim


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: tuple[str, str],
    attrs: dict[str, str],
    on_missing: str = "keep",
    sized: bool = False,
) -> DataFrame:
    """Add attributes of ``dim`` under new names; ``on`` is (column of df, key of dim).

    ``on_missing="drop"`` removes rows whose key has no match. A key that ``dim`` repeats is an
    error, as rows would multiply. ``sized`` says that ``dim`` went
    through ``measured`` already.
    """
    if on_missing not in ("keep", "drop"):
        raise ValueError(f"unknown rule for missing keys: {on_missing}")
    fk, key = on
    side = dim.select(
        F.col(key).alias("_lookup_key"), *(F.col(a).alias(new) for a, new in attrs.items())
    )
    how = "left" if on_missing == "keep" else "inner"
    side = side if sized else measured(side, key="_lookup_key")
    return df.join(side, F.col(fk) == F.col("_lookup_key"), how).drop("_lookup_key")


def role_lookup(
    df: DataFrame,
    dim: DataFrame,
    dim_key: str,
    roles: dict[str, str],
    attrs: dict[str, str],
    on_missing: str = "keep",
    sized: bool = False,
) -> DataFrame:
    """Join the same dimension once per role; attribute names get the role as prefix.

    ``roles`` maps role -> foreign key column, ``attrs`` maps attribute -> name after the prefix.
    """
    if not sized:
        dim = measured(dim.select(dim_key, *attrs), key=dim_key)
    for role, fk in roles.items():
        named = {attr: f"{role}_{name}" for attr, name in attrs.items()}
        df = lookup(df, dim, (fk, dim_key), named, on_missing, sized=True)
    return df


def matched(
    df: DataFrame, dim: DataFrame, dim_key: str, fks: list[str], sized: bool = False
) -> DataFrame:
    """Rows whose foreign keys all exist in the dimension, with no attribute added."""
    keys = dim.select(F.col(dim_key).alias("_match_key"))
    keys = keys if sized else measured(keys)
    for fk in fks:
        df = df.join(keys, F.col(fk) == F.col("_match_key"), "left_semi")
    return df


def unmatched(df: DataFrame, dim: DataFrame, dim_key: str, fks: list[str]) -> DataFrame:
    """Rows with at least one foreign key missing from the dimension (NULL counts as missing)."""
    keys = dim.select(F.col(dim_key).alias("_match_key")).distinct()
    keys = measured(keys)
    out = df
    for fk in fks:
        side = keys.withColumnRenamed("_match_key", f"_match_{fk}")
        out = out.join(side, F.col(fk) == F.col(f"_match_{fk}"), "left")
    missing = reduce(or_, (F.col(f"_match_{fk}").isNull() for fk in fks))
    return out.where(missing).select(*df.columns)


def flag_matches(df: DataFrame, keys: DataFrame, on: tuple[str, str], flag: str) -> DataFrame:
    """TRUE where the key occurs in ``keys``, else FALSE."""
    column, key = on
    side = measured(keys.select(F.col(key).alias("_flag_key")).distinct())
    return (
        df.join(side, F.col(column) == F.col("_flag_key"), "left")
        .withColumn(flag, F.col("_flag_key").isNotNull())
        .drop("_flag_key")
    )


def rows_for_keys(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``df`` whose key tuple occurs in ``keys``; NULL matches NULL."""
    side = keys.select(*(F.col(c).alias(f"_key_{c}") for c in on))
    same = [F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in on]
    return df.join(side, same, "left_semi")


def key_difference(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Distinct non-NULL keys of ``left`` that ``right`` does not have."""
    keys = left.select(F.col(left_key).alias("key")).where("key IS NOT NULL").distinct()
    side = right.select(F.col(right_key).alias("_other"))
    return keys.join(side, F.col("key") == F.col("_other"), "left_anti")
