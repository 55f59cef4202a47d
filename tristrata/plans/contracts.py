"""Declared table contracts and the operations that follow from them.

A contract names the columns of a relation in order, their types and their rules. The flight
tables below are one configuration; the functions work with any contract.
"""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from tristrata.functions import normalize as nz
from tristrata.operators import gates as gt

_NUMERIC = {"smallint", "int", "bigint", "double"}


@dataclass(frozen=True)
class Table:
    name: str
    columns: dict[str, str]
    pk: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    max_len: dict[str, int] = field(default_factory=dict)
    fks: dict[str, tuple[str, str]] = field(default_factory=dict)  # column -> (table, key)
    aliases: dict[str, tuple[str, ...]] = field(default_factory=dict)
    optional: tuple[str, ...] = ()  # an input may lack these


def require(df: DataFrame, cols: list[str]) -> DataFrame:
    """Raise KeyError if a column is missing; looks at names only and starts no job."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"missing columns: {missing}")
    return df


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*(c.lower() for c in df.columns))


def rename_present(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename the columns that exist and leave the others out of it."""
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns})


def canonicalise(df: DataFrame, table: Table) -> DataFrame:
    """Give columns that arrive under an alternative name their contract name."""
    found = {}
    for name, others in table.aliases.items():
        other = next((o for o in others if o in df.columns), None)
        if name not in df.columns and other:
            found[other] = name
    return df.withColumnsRenamed(found)


def _typed(df: DataFrame, name: str, type_name: str) -> Column:
    if name not in df.columns:
        return F.lit(None).cast(type_name).alias(name)
    held = dict(df.dtypes)[name]
    column = F.col(name)
    if held != type_name:
        if held == "string" and type_name in _NUMERIC:
            column = nz.num(column, type_name)
        else:
            column = column.try_cast(type_name)
    return column.alias(name)


def conform(df: DataFrame, table: Table) -> DataFrame:
    """Exactly the contract's columns, in its order and types; unreadable values become NULL.

    An optional column the input lacks is a typed NULL; any other raises KeyError.
    """
    require(df, [c for c in table.columns if c not in table.optional])
    return df.select(*(_typed(df, name, t) for name, t in table.columns.items()))


def gates_of(table: Table, tables: dict[str, DataFrame] | None = None) -> list[gt.Gate]:
    """The gates a contract implies; foreign keys need the referenced DataFrames."""
    out = [gt.not_empty(), gt.required_columns(list(table.columns))]
    required = dict.fromkeys([*table.pk, *table.not_null])
    out += gt.not_null_each(list(required))
    if table.pk:
        out.append(gt.unique(list(table.pk)))
    out += [gt.unique([c]) for c in table.unique]
    out += [gt.max_length(c, n) for c, n in table.max_len.items()]
    for column, (target, key) in table.fks.items():
        if tables and target in tables:
            out.append(gt.fk_exists(column, tables[target], key))
    return out


def _text(*names: str) -> dict[str, str]:
    return dict.fromkeys(names, "string")


def _typed_as(type_name: str, *names: str) -> dict[str, str]:
    return dict.fromkeys(names, type_name)


# The relations of the flight-delay data set.
REASONS = (
    "air_system_delay",
    "security_delay",
    "airline_delay",
    "late_aircraft_delay",
    "weather_delay",
)
DATE_PARTS = ("year", "month", "day", "day_of_week")
CLOCKS = (
    "scheduled_departure",
    "departure_time",
    "scheduled_arrival",
    "arrival_time",
    "wheels_off",
    "wheels_on",
)
DURATIONS = ("taxi_out", "taxi_in", "air_time", "elapsed_time", "scheduled_time", "distance")
MEASURES = (*DURATIONS, "departure_delay", "arrival_delay", *REASONS)

RAW_AIRLINES = Table("raw_airlines", _text("iata_code", "airline"))
RAW_AIRPORTS = Table(
    "raw_airports",
    _text("iata_code", "airport", "city", "state", "country", "latitude", "longitude"),
)
RAW_FLIGHTS = Table(
    "raw_flights",
    _text(
        "year",
        "month",
        "day",
        "day_of_week",
        "airline",
        "flight_number",
        "tail_number",
        "origin_airport",
        "destination_airport",
        "scheduled_departure",
        "departure_time",
        "departure_delay",
        "taxi_out",
        "wheels_off",
        "scheduled_time",
        "elapsed_time",
        "air_time",
        "distance",
        "wheels_on",
        "taxi_in",
        "scheduled_arrival",
        "arrival_time",
        "arrival_delay",
        "diverted",
        "cancelled",
        "cancellation_reason",
        *REASONS,
    ),
)
AIRLINES = Table(
    "airlines",
    _text("airline_iata_code", "airline_name"),
    pk=("airline_iata_code",),
    aliases={"airline_iata_code": ("iata_code",), "airline_name": ("airline",)},
)
AIRPORTS = Table(
    "airports",
    {
        **_text("airport_iata_code", "airport_name", "city", "state"),
        **_typed_as("double", "latitude", "longitude"),
    },
    pk=("airport_iata_code",),
    aliases={"airport_iata_code": ("iata_code",), "airport_name": ("airport",)},
)
FLIGHTS = Table(
    "flights",
    {
        **_typed_as("smallint", "flight_year", "flight_month", "flight_day", "flight_day_of_week"),
        "flight_date": "date",
        "airline_iata_code": "string",
        "flight_number": "int",
        **_text("tail_number", "origin_airport_iata_code", "dest_airport_iata_code"),
        **_typed_as("timestamp_ntz", *CLOCKS),
        **_typed_as("double", *MEASURES),
        "is_overnight_flight": "boolean",
    },
    aliases={
        "airline_iata_code": ("airline",),
        "origin_airport_iata_code": ("origin_airport",),
        "dest_airport_iata_code": ("destination_airport",),
    },
)
SILVER_FLIGHTS = Table(
    "silver_flights",
    {
        "flight_id": "bigint",
        **_typed_as("smallint", "flight_year", "flight_month", "flight_day", "flight_day_of_week"),
        "flight_date": "date",
        **_text("airline_iata_code", "airline_name"),
        "flight_number": "int",
        "tail_number": "string",
        **{
            f"{role}_{name}": t
            for role in ("origin", "dest")
            for name, t in {
                **_text("airport_iata_code", "airport_name", "city", "state"),
                **_typed_as("double", "latitude", "longitude"),
            }.items()
        },
        **_typed_as("timestamp_ntz", *CLOCKS),
        **_typed_as("double", *MEASURES),
        "is_overnight_flight": "boolean",
    },
    pk=("flight_id",),
    not_null=(
        "flight_year",
        "flight_month",
        "flight_day",
        "flight_day_of_week",
        "flight_date",
        "flight_number",
        "airline_iata_code",
        "airline_name",
        "origin_airport_iata_code",
        "origin_airport_name",
        "dest_airport_iata_code",
        "is_overnight_flight",
    ),
    max_len={
        "airline_iata_code": 3,
        "airline_name": 100,
        "tail_number": 10,
        "origin_airport_iata_code": 3,
        "origin_airport_name": 100,
        "origin_city": 50,
        "origin_state": 3,
        "dest_airport_iata_code": 3,
        "dest_airport_name": 100,
        "dest_city": 50,
        "dest_state": 3,
    },
)
# Columns of the wide table that must be known before it is published.
SILVER_CRITICAL = (
    "airline_iata_code",
    "airline_name",
    "origin_airport_iata_code",
    "origin_airport_name",
    "origin_latitude",
    "origin_longitude",
    "dest_airport_iata_code",
    "dest_airport_name",
    "dest_latitude",
    "dest_longitude",
)
DIM_AIR = Table(
    "dim_air",
    {"airline_id": "bigint", **_text("airline_iata_code", "airline_name")},
    pk=("airline_id",),
    not_null=("airline_iata_code", "airline_name"),
    unique=("airline_iata_code",),
    max_len={"airline_iata_code": 3, "airline_name": 100},
)
DIM_APT = Table(
    "dim_apt",
    {
        "airport_id": "bigint",
        **_text("airport_iata_code", "airport_name", "state_code", "state_name", "city_name"),
        **_typed_as("double", "latitude", "longitude"),
    },
    pk=("airport_id",),
    not_null=("airport_iata_code", "airport_name", "city_name", "state_code"),
    unique=("airport_iata_code",),
    max_len={
        "airport_iata_code": 3,
        "airport_name": 100,
        "state_code": 3,
        "state_name": 100,
        "city_name": 100,
    },
    optional=("state_name",),
)
DIM_DAT = Table(
    "dim_dat",
    {
        "full_date": "date",
        **_typed_as("smallint", "year", "month", "day", "day_of_week", "quarter"),
        "is_holiday": "boolean",
    },
    pk=("full_date",),
    not_null=("year", "month", "day", "day_of_week"),
)
FAT_FLT = Table(
    "fat_flt",
    {
        "flight_id": "bigint",
        "full_date": "date",
        **_typed_as("bigint", "airline_id", "origin_airport_id", "dest_airport_id"),
        **_typed_as("timestamp_ntz", *CLOCKS),
        **_typed_as(
            "double",
            "distance",
            "air_time",
            "elapsed_time",
            "scheduled_time",
            "taxi_out",
            "taxi_in",
            "departure_delay",
            "arrival_delay",
        ),
        "is_overnight_flight": "boolean",
        **_typed_as("double", *REASONS),
    },
    pk=("flight_id",),
    not_null=("full_date", "airline_id", "origin_airport_id", "dest_airport_id"),
    fks={
        "airline_id": ("dim_air", "airline_id"),
        "origin_airport_id": ("dim_apt", "airport_id"),
        "dest_airport_id": ("dim_apt", "airport_id"),
        "full_date": ("dim_dat", "full_date"),
    },
)

# Coordinates for three airports the raw file leaves blank.
AIRPORT_FIXES = [
    ("ECP", 30.3549, -86.6160),
    ("PBG", 44.6895, -68.0448),
    ("UST", 42.0703, -87.9539),
]
AIRPORT_FIXES_SCHEMA = "airport_iata_code string, latitude double, longitude double"

# US federal holidays of 2015.
HOLIDAYS_2015 = [
    "2015-01-01",
    "2015-01-19",
    "2015-02-16",
    "2015-05-25",
    "2015-07-04",
    "2015-09-07",
    "2015-10-12",
    "2015-11-11",
    "2015-11-26",
    "2015-12-25",
]

# Short output names of the gold tables, in output order.
MNEMONICS = {
    "dim_air": {
        "airline_id": "srk_air",
        "airline_iata_code": "air_iata",
        "airline_name": "air_name",
    },
    "dim_apt": {
        "airport_id": "srk_apt",
        "airport_iata_code": "apt_iata",
        "airport_name": "apt_name",
        "state_code": "st_cd",
        "state_name": "st_name",
        "city_name": "cty_name",
        "latitude": "lat_val",
        "longitude": "lon_val",
    },
    "dim_dat": {
        "date_id": "srk_dat",
        "full_date": "full_dat",
        "year": "yr",
        "month": "mm",
        "day": "dd",
        "day_of_week": "dow",
        "quarter": "qtr",
        "is_holiday": "is_hol",
    },
    "fat_flt": {
        "flight_id": "srk_flt",
        "date_id": "srk_dat",
        "airline_id": "srk_air",
        "origin_airport_id": "srk_ori",
        "dest_airport_id": "srk_dst",
        "scheduled_departure": "sch_dep",
        "departure_time": "dep_time",
        "scheduled_arrival": "sch_arr",
        "arrival_time": "arr_time",
        "distance": "dist_val",
        "air_time": "air_time",
        "elapsed_time": "elp_time",
        "scheduled_time": "sch_time",
        "departure_delay": "dep_dly",
        "arrival_delay": "arr_dly",
        "air_system_delay": "sys_dly",
        "security_delay": "sec_dly",
        "airline_delay": "air_dly",
        "late_aircraft_delay": "acft_dly",
        "weather_delay": "wx_dly",
        "is_overnight_flight": "is_ovn_flt",
    },
}
