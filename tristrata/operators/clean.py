"""Row-level repair and filtering. Everything here is a projection or a filter: no shuffle."""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from tristrata.functions import normalize as nz
from tristrata.operators import enrich


def operated_only(df: DataFrame, status_cols: list[str]) -> DataFrame:
    """Keep rows whose status flags are all readable and not 1; an unknown status drops the row."""
    return df.where(reduce(and_, (nz.parse_int(F.col(c)) != 1 for c in status_cols)))


def reject_pattern(df: DataFrame, cols: list[str], regex: str = nz.ALL_DIGITS) -> DataFrame:
    """Drop rows where any of the columns matches the pattern (or is NULL)."""
    return df.where(reduce(and_, (~F.col(c).rlike(regex) for c in cols)))


def repair_swapped(
    df: DataFrame, dep: str, arr: str, sched_dep: str, sched_arr: str
) -> DataFrame:
    """Exchange departure and arrival where each is nearer to the other's schedule."""
    departure, arrival = F.col(dep), F.col(arr)
    planned_dep, planned_arr = F.col(sched_dep), F.col(sched_arr)
    crossed = (F.abs(departure - planned_arr) < F.abs(departure - planned_dep)) & (
        F.abs(arrival - planned_dep) < F.abs(arrival - planned_arr)
    )
    return df.withColumns(
        {
            dep: F.when(crossed, arrival).otherwise(departure),
            arr: F.when(crossed, departure).otherwise(arrival),
        }
    )


def adjust_overnight(
    df: DataFrame,
    dep: str,
    arr: str,
    rolled: Column | None = None,
    flag: str = "is_overnight_flight",
) -> DataFrame:
    """Flag rows whose arrival hour precedes the departure hour and move the arrival one day on.

    ``rolled`` marks arrivals that already lie on the following day (clock time 2400): they
    are flagged but not moved a second time.
    """
    wraps = F.coalesce(F.hour(arr) < F.hour(dep), F.lit(False))
    move = wraps if rolled is None else wraps & ~F.coalesce(rolled, F.lit(False))
    return df.withColumns(
        {
            flag: wraps,
            arr: F.when(move, F.col(arr) + F.expr("INTERVAL 1 DAY")).otherwise(F.col(arr)),
        }
    )


def settled(df: DataFrame, cols: list[str]) -> DataFrame:
    """Compute ``cols`` here, once: later filters on them stay above this point.

    The optimizer moves a filter below the projection it reads from by repeating the whole
    expression in the filter. For columns built in several steps that multiplies the work at
    every step. A generator with exactly one output row per input row is where it stops; all
    other columns pass through and are still pruned.
    """
    others = [c for c in df.columns if c not in cols]
    return df.select(*others, F.inline(F.array(F.struct(*cols)))).select(*df.columns)


def valid_interval(df: DataFrame, lo: str, hi: str) -> DataFrame:
    """Keep rows with both ends known and the end after the start."""
    return df.where(F.col(lo) < F.col(hi))


def require_values(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop rows that miss any of the core columns."""
    return df.dropna(how="any", subset=cols)


def fill_missing(df: DataFrame, cols: list[str], value: float = 0.0) -> DataFrame:
    """Default for missing measures."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(value)) for c in cols})


def apply_corrections(
    df: DataFrame, fixes: DataFrame, key: str, value_cols: list[str]
) -> DataFrame:
    """Override ``value_cols`` with the values a correction table holds for the key."""
    fix = fixes.select(
        F.col(key).alias("_fix_key"), *(F.col(c).alias(f"_fix_{c}") for c in value_cols)
    )
    joined = df.join(enrich.measured(fix), F.col(key) == F.col("_fix_key"), "left")
    return joined.select(
        *(
            F.coalesce(F.col(f"_fix_{c}"), F.col(c)).alias(c) if c in value_cols else F.col(c)
            for c in df.columns
        )
    )
