"""Profiling reports: everything the exploratory analyses state, as one relation each.

A report has one row for each ``section``, ``key`` and ``statistic``, with a number as ``value``. Keys are
column names, pairs of them, values, or empty. Each source is scanned once for counts and moments and
once for its values; see ``tally``.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tristrata.functions import normalize as nz
from tristrata.operators import enrich, profile as pf
from tristrata.operators.tally import Tally, tally
from tristrata.plans import contracts as ct

# The pairs, keys and columns the reports look at.
FIT_PAIRS = [
    ("departure_delay", "airline_delay"),
    ("arrival_delay", "airline_delay"),
    ("departure_delay", "arrival_delay"),
]
NATURAL_KEY = ["year", "month", "day", "flight_number", "airline"]
TEXT_COLUMNS = ["iata_code", "airport", "city", "state", "country"]
CORE = ["departure_delay", "arrival_delay", "air_time", "tail_number"]
ELAPSED_PARTS = ["taxi_out", "air_time", "taxi_in"]
TOP = 5


def elapsed_difference(elapsed: str = "elapsed_time") -> Column:
    """Elapsed time minus its parts where they differ, else NULL."""
    off = F.col(elapsed) - reduce(lambda a, b: a + b, (F.col(c) for c in ELAPSED_PARTS))
    return F.when(off != 0, off)


def _missing(t: Tally, slice_name: str, columns: list[str]) -> list[DataFrame]:
    return [
        t.nulls("nulls", slice_name, columns),
        t.null_share("null_share", slice_name, "_delay"),
        t.null_share("null_share", slice_name, "_time"),
        t.missing_pairs("missing_correlation", slice_name, columns),
    ]


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def raw_report(airlines: DataFrame, airports: DataFrame, flights: DataFrame) -> DataFrame:
    """Profile of the raw relations (lower-case names, text columns)."""
    return _union([*_raw_airlines(airlines, flights), *_raw_airports(airports), *_raw_flights(flights)])


def _raw_airlines(airlines: DataFrame, flights: DataFrame) -> list[DataFrame]:
    t = tally(airlines, composites={"key": ["iata_code"]}, whole_rows=False)
    unknown = enrich.key_difference(flights, airlines, "airline", "iata_code").agg(F.count(F.lit(1)).alias("value"))
    return [
        t.size("airline_size", "all"),
        t.repeats("airline_duplicates", "all", "key"),
        t.distinct("airline_unique", "all"),
        t.counts("airline_codes", "all", "iata_code"),
        unknown.select(F.lit("unknown_airlines").alias("section"), F.lit("").alias("key"), F.lit("keys").alias("statistic"), F.col("value").cast("double").alias("value")),
    ]


def _raw_airports(airports: DataFrame) -> list[DataFrame]:
    columns = list(airports.columns)
    t = tally(airports, composites={"key": ["iata_code"]})
    odd = pf.pattern_violations(airports, TEXT_COLUMNS)
    return [
        t.size("airport_size", "all"),
        t.known("airport_known", "all", columns),
        t.nulls("airport_nulls", "all"),
        t.describe_texts("airport_texts", "all", columns),
        t.repeats("airport_key_duplicates", "all", "key"),
        t.duplicates("airport_duplicates", airports, "all"),
        odd.select(
            F.lit("airport_odd_text").alias("section"), F.concat_ws("|", "column", "value").alias("key"),
            F.lit("rows").alias("statistic"), F.col("n").cast("double").alias("value"),
        ),
    ]


def _raw_flights(flights: DataFrame) -> list[DataFrame]:
    """Cancelled flights count only towards the airlines; diverted ones are left out of ``kept``."""
    typed = flights.withColumns({c: nz.num(F.col(c), "double") for c in ct.MEASURES}).drop("cancellation_reason")
    held = F.coalesce(nz.parse_int(F.col("cancelled")) != 1, F.lit(False))
    diverted = nz.parse_int(F.col("diverted"))
    kept = held & F.coalesce(diverted == 0, F.lit(False))
    columns = [c for c in typed.columns if c != "cancelled"]
    own = [c for c in columns if c != "diverted"]
    slices = {
        "held": held, "kept": kept, "punctual": held & (F.col("arrival_delay") <= 0),
        "diverted_0": held & (F.col("diverted") == "0"), "diverted_1": held & (F.col("diverted") == "1"),
    }
    source = typed.withColumn("time_difference", F.when(kept, elapsed_difference()))
    numbers = [*ct.MEASURES, "time_difference"]
    t = tally(source, slices, [*columns, "time_difference"], numbers, FIT_PAIRS, {"natural_key": NATURAL_KEY})
    rows = source.where(kept).select(*own)
    texts = [c for c in own if c not in ct.MEASURES]
    return [
        t.size("size", "held", columns),
        t.counts("flights_by_airline", "all", "airline"),
        t.counts("diverted", "held", "diverted"),
        t.known("known", "held", columns),
        *_missing(t, "held", columns),
        t.describe("numbers", "held", list(ct.MEASURES)),
        t.describe_texts("texts", "held", texts),
        t.known("punctual_reasons", "punctual", list(ct.REASONS)),
        *(t.nulls(f"nulls_{s}", s, ["arrival_delay", "elapsed_time", "arrival_time"]) for s in ("diverted_0", "diverted_1")),
        t.null_rate("time_nulls", "held", ["diverted_0", "diverted_1"], [c for c in columns if c.endswith("time")]),
        t.describe("elapsed_difference", "kept", ["time_difference"]),
        t.duplicates("duplicates", rows, "kept"),
        t.distinct("unique", "kept", own),
        t.repeats("key_repeats", "kept", "natural_key", TOP),
        t.worst_rows("worst_key", rows, "natural_key", "kept", ["departure_delay", "arrival_delay", "distance"]),
        t.nulls("core_nulls", "kept", CORE),
        t.nulls("reason_nulls", "kept", list(ct.REASONS)),
        t.fit("linear_fit", "kept"),
    ]


def silver_report(wide: DataFrame) -> DataFrame:
    """Profile of the wide silver table; clock times are described in days since 1970."""
    columns = list(wide.columns)
    days = {f"{c}_days": nz.epoch_seconds(F.col(c).cast("timestamp_ntz")) / 86400 for c in ct.CLOCKS}
    source = wide.withColumns(days).withColumn("time_difference", elapsed_difference())
    extra = [*days, "time_difference"]
    t = tally(
        source, {"punctual": F.col("arrival_delay") <= 0}, [*columns, *extra], [*ct.MEASURES, *extra], FIT_PAIRS, {"key": ["flight_id"]}
    )
    texts = [c for c, kind in wide.dtypes if kind == "string"]
    return _union([
        t.size("size", "all", columns),
        t.counts("flights_by_airline", "all", "airline_name"),
        t.known("known", "all", columns),
        *_missing(t, "all", columns),
        t.describe("numbers", "all", list(ct.MEASURES)),
        t.describe("times", "all", list(days)),
        t.describe_texts("texts", "all", texts),
        t.known("punctual_reasons", "punctual", list(ct.REASONS)),
        t.describe("elapsed_difference", "all", ["time_difference"]),
        t.repeats("key_repeats", "all", "key"),
        t.duplicates("duplicates", wide, "all"),
        t.distinct("unique", "all", columns),
        t.nulls("core_nulls", "all", [*CORE, "airline_name"]),
        t.nulls("reason_nulls", "all", list(ct.REASONS)),
        t.fit("linear_fit", "all"),
    ])
