"""Star schema: entity, role-union and date dimensions, and the fact that points at them."""

from pyspark.sql import DataFrame, functions as F

from tristrata.functions import normalize as nz
from tristrata.operators import enrich, keys


def entity_dim(df: DataFrame, natural_key: str, attrs: list[str], key: str) -> DataFrame:
    """One row per distinct (natural key, attributes) with a dense key."""
    rows = df.where(F.col(natural_key).isNotNull()).select(natural_key, *attrs).distinct()
    return keys.dim_key(rows, key, natural_key)


def role_union(df: DataFrame, roles: list[dict[str, str]]) -> DataFrame:
    """Distinct union of several column sets of the same table.

    Each role maps output column -> source column, in the same order; the first one is the
    natural key. The table is read once: every row yields one struct per role, and the
    distinct combines them before the shuffle.
    """
    natural_key = next(iter(roles[0]))
    views = [F.struct(*(F.col(src).alias(out) for out, src in role.items())) for role in roles]
    return (
        df.select(F.explode(F.array(*views)).alias("row"))
        .select("row.*")
        .where(F.col(natural_key).isNotNull())
        .distinct()
    )


def role_union_dim(df: DataFrame, roles: list[dict[str, str]], key: str) -> DataFrame:
    """Dimension over an entity that appears in several roles, with a dense key."""
    return keys.dim_key(role_union(df, roles), key, next(iter(roles[0])))


def date_dim(
    df: DataFrame,
    date_col: str,
    holidays: list[str] | DataFrame | None = None,
    dow: str = "iso",
) -> DataFrame:
    """Calendar attributes of the distinct dates.

    ``holidays`` is a list of ISO dates or a DataFrame whose first column holds them.
    ``dow="iso"`` counts from Monday = 1, ``"sunday1"`` from Sunday = 1.
    """
    weekday = {"iso": nz.iso_weekday, "sunday1": nz.sunday_weekday}[dow]
    full = F.col("full_date")
    dates = df.select(F.col(date_col).cast("date").alias("full_date")).where(full.isNotNull())
    dates = dates.distinct()
    if isinstance(holidays, DataFrame):
        calendar = holidays.select(F.col(holidays.columns[0]).cast("date").alias("day_off"))
        dates = enrich.flag_matches(dates, calendar, ("full_date", "day_off"), "is_holiday")
    else:
        days = [F.to_date(F.lit(d)) for d in holidays or []]
        dates = dates.withColumn("is_holiday", full.isin(*days) if days else F.lit(False))
    return dates.select(
        full,
        F.year(full).cast("smallint").alias("year"),
        F.month(full).cast("smallint").alias("month"),
        F.dayofmonth(full).cast("smallint").alias("day"),
        weekday(full).cast("smallint").alias("day_of_week"),
        F.quarter(full).cast("smallint").alias("quarter"),
        F.col("is_holiday"),
    )


def attach_keys(
    df: DataFrame, dim: DataFrame, natural_key: str, key: str, roles: dict[str, str]
) -> DataFrame:
    """Add the surrogate key of ``dim`` once per role; ``roles`` maps new column -> natural key."""
    keyed = enrich.measured(dim.select(*dict.fromkeys([natural_key, key])))
    for out, fk in roles.items():
        df = enrich.lookup(df, keyed, (fk, natural_key), {key: out}, sized=True)
    return df


def fact(
    df: DataFrame, lookups: list[tuple[DataFrame, str, str, dict[str, str]]], columns: list[str]
) -> DataFrame:
    """Fact projection: every lookup is (dim, natural key, key, roles) for ``attach_keys``."""
    for dim, natural_key, key, roles in lookups:
        df = attach_keys(df, dim, natural_key, key, roles)
    return df.select(*columns)
