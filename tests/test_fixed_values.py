"""Constants that results depend on, written out here, so that a slip in them fails although SQL shares them."""

from tristrata.functions import normalize as nz
from tristrata.operators import enrich
from tristrata.plans import contracts as ct, pipeline, reports, suites


def test_calendar_and_corrections():
    assert ct.HOLIDAYS_2015 == [
        "2015-01-01", "2015-01-19", "2015-02-16", "2015-05-25", "2015-07-04", "2015-09-07", "2015-10-12", "2015-11-11", "2015-11-26", "2015-12-25",
    ]
    assert sorted(ct.AIRPORT_FIXES) == [("ECP", 30.3549, -86.6160), ("PBG", 44.6895, -68.0448), ("UST", 42.0703, -87.9539)]


def test_order_of_flights_and_keys():
    assert pipeline.FLIGHT_ORDER == [
        "flight_date", "airline_iata_code", "flight_number", "origin_airport_iata_code", "dest_airport_iata_code",
    ]
    assert reports.NATURAL_KEY == ["year", "month", "day", "flight_number", "airline"]
    assert ct.SILVER_FLIGHTS.pk == ("flight_id",) and ct.AIRLINES.pk == ("airline_iata_code",)
    assert ct.FAT_FLT.fks == {
        "full_date": ("dim_dat", "full_date"), "airline_id": ("dim_air", "airline_id"),
        "origin_airport_id": ("dim_apt", "airport_id"), "dest_airport_id": ("dim_apt", "airport_id"),
    }


def test_reasons_and_tolerance():
    assert ct.REASONS == ("air_system_delay", "security_delay", "airline_delay", "late_aircraft_delay", "weather_delay")
    assert suites.REPORTED == {
        "columns_differ(origin_airport_iata_code,dest_airport_iata_code)", "sum_consistency(arrival_delay)",
        "sum_consistency(elapsed_time)", "not_null(elapsed_time,taxi_out,air_time,taxi_in)",
        "fk_exists(origin_airport_iata_code)", "fk_exists(dest_airport_iata_code)", "fk_exists(airline_iata_code)",
    }


def test_patterns_and_bounds():
    assert nz.PLAIN_TEXT == r"^[A-Za-zÀ-ÿ\s\-\.']+$" and nz.ALL_DIGITS == "^[0-9]+$"
    assert (enrich.MAX_BROADCAST_ROWS, enrich.MAX_BROADCAST_BYTES) == (1_000_000, 67_108_864)
