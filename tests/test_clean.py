"""Hand-made rows for the repair rules."""

from datetime import datetime

from pyspark.sql import functions as F

from tests.helpers import rows
from tristrata.operators import clean
from tristrata.plans import contracts as ct, pipeline

CASES = [
    # name, scheduled departure, departure, scheduled arrival, arrival
    ("normal", "0800", "0810", "1000", "1005"),
    ("swapped", "0800", "1005", "1000", "0810"),
    ("overnight", "2300", "2310", "0130", "0140"),
    ("same hour wrap", "2330", "2330", "2310", "2310"),
    ("suffix", "800.0", "5.0", "1000", "930.0"),
    ("no arrival", "0800", "0810", "1000", None),
    ("equal", "0800", "0800", "0800", "0800"),
    ("arrival 2400", "2200", "2200", "2355", "2400"),
    ("departure 2400", "2359", "2400", "0130", "0140"),
]


def at(day, hour, minute):
    return datetime(2015, 1, day, hour, minute)


def raw_rows(spark):
    """Raw flights whose tail number names the case."""
    values = []
    for name, sched_dep, dep, sched_arr, arr in CASES:
        row = dict.fromkeys(ct.RAW_FLIGHTS.columns, "1")
        row |= {"year": "2015", "tail_number": name, "diverted": "0", "cancelled": "0"}
        row |= {"origin_airport": "AAA", "destination_airport": "BBB"}
        row |= {"scheduled_departure": sched_dep, "departure_time": dep}
        row |= {"scheduled_arrival": sched_arr, "arrival_time": arr}
        values.append(tuple(row[c] for c in ct.RAW_FLIGHTS.columns))
    return spark.createDataFrame(values, ", ".join(f"{c} string" for c in ct.RAW_FLIGHTS.columns))


def repaired(spark, midnight):
    df = pipeline.repaired_flights(pipeline.typed_flights(raw_rows(spark), midnight))
    found = df.select("tail_number", "departure_time", "arrival_time", "is_overnight_flight")
    return {r[0]: tuple(r[1:]) for r in found.collect()}


def kept(spark, midnight):
    return {r.tail_number for r in pipeline.silver_flights(raw_rows(spark), midnight).collect()}


def test_golden_rows_next_day(spark):
    assert repaired(spark, "next_day") == {
        "normal": (at(1, 8, 10), at(1, 10, 5), False),
        "swapped": (at(1, 8, 10), at(1, 10, 5), False),
        "overnight": (at(1, 23, 10), at(2, 1, 40), True),
        "same hour wrap": (at(1, 23, 30), at(1, 23, 10), False),
        "suffix": (at(1, 0, 5), at(1, 9, 30), False),
        "no arrival": (at(1, 8, 10), None, False),
        "equal": (at(1, 8, 0), at(1, 8, 0), False),
        "arrival 2400": (at(1, 22, 0), at(2, 0, 0), True),
        "departure 2400": (at(2, 0, 0), at(1, 1, 40), False),
    }
    assert kept(spark, "next_day") == {
        "normal", "swapped", "overnight", "suffix", "arrival 2400",
    }


def test_golden_rows_null_midnight(spark):
    found = repaired(spark, "null")
    assert found["arrival 2400"] == (at(1, 22, 0), None, False)
    assert found["departure 2400"] == (None, at(1, 1, 40), False)
    assert kept(spark, "null") == {"normal", "swapped", "overnight", "suffix"}


def test_unknown_status_drops_the_row(spark):
    df = spark.createDataFrame(
        [("0", "0"), ("1", "0"), ("0", None), ("", "0"), ("0", "0.0")], "a string, b string"
    )
    assert rows(clean.operated_only(df, ["a", "b"])) == [("0", "0")]


def test_reject_pattern(spark):
    df = spark.createDataFrame([("ABC",), ("123",), ("A1",), (None,)], "c string")
    assert rows(clean.reject_pattern(df, ["c"]), "c") == [("A1",), ("ABC",)]


def test_corrections_override_only_named_columns(spark):
    df = spark.createDataFrame([("X", 1.0, 2.0), ("Y", None, 3.0)], "k string, a double, b double")
    fixes = spark.createDataFrame([("Y", 9.0, 8.0)], "k string, a double, b double")
    assert rows(clean.apply_corrections(df, fixes, "k", ["a"]), "k") == [
        ("X", 1.0, 2.0),
        ("Y", 9.0, 3.0),
    ]


def test_fill_and_require(spark):
    df = spark.createDataFrame([(None, 1.0), (2.0, None)], "a double, b double")
    assert rows(clean.fill_missing(df, ["a"]), "a") == [(0.0, 1.0), (2.0, None)]
    assert rows(clean.require_values(df, ["b"])) == [(None, 1.0)]


def test_filters_do_not_repeat_the_repair_expressions(spark):
    """The interval filter reads settled columns instead of a copy of how they were made."""
    plan = pipeline.silver_flights(raw_rows(spark))._jdf.queryExecution().optimizedPlan()
    filters = [line for line in plan.toString().splitlines() if "Filter" in line]
    assert all("timestampadd" not in line.lower() for line in filters)


def test_settled_keeps_rows_and_order_of_columns(spark):
    df = spark.range(100).select("id", (F.col("id") * 2).alias("a"), (F.col("id") % 3).alias("b"))
    out = clean.settled(df, ["a"])
    assert out.columns == df.columns
    assert rows(out, "id") == rows(df, "id")
