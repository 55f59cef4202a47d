"""SQL counterparts of the layer transformations, as nested WITH clauses."""

from registry import inputs
from tristrata.plans import contracts as ct

MINUTE_PARTS = "CAST(substr({h},1,2) AS INT)*60 + CAST(substr({h},3,2) AS INT)"
DATE = (
    "TRY_CAST(lpad(year,4,'0') || '-' || lpad(month,2,'0') || '-' || lpad(day,2,'0') AS DATE)"
)


def with_(steps: list[tuple[str, str]], final: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in steps) + "\n" + final


def hhmm(c: str) -> str:
    t = f"regexp_replace(nullif(trim({c}),''),'\\.0$','')"
    return f"CASE WHEN regexp_matches({t},'^[0-9]{{1,4}}$') THEN lpad({t},4,'0') END"


def clock(date: str, h: str, midnight: str = "next_day") -> str:
    late = f"CAST({date} AS TIMESTAMP) + INTERVAL 1 DAY" if midnight == "next_day" else "NULL"
    minutes = MINUTE_PARTS.format(h=h)
    return (
        f"CASE WHEN {h} = '2400' THEN {late} "
        f"WHEN CAST(substr({h},1,2) AS INT) < 24 AND CAST(substr({h},3,2) AS INT) < 60 "
        f"THEN CAST({date} AS TIMESTAMP) + to_minutes({minutes}) END"
    )


def parse_int(c: str) -> str:
    return f"CASE WHEN regexp_matches({c},'^[0-9]+$') THEN TRY_CAST({c} AS INT) END"


def number(c: str, t: str) -> str:
    return f"TRY_CAST(nullif(trim({c}),'') AS {t})"


RAW = ("raw_flights", inputs.plain_sql(inputs.RAW_FLIGHTS))
AIRLINES = (
    "airlines",
    "SELECT iata_code AS airline_iata_code, airline AS airline_name FROM ("
    + inputs.plain_sql(inputs.RAW_AIRLINES)
    + ")",
)
AIRPORTS = (
    "airports",
    f"""SELECT r.iata_code AS airport_iata_code, r.airport AS airport_name, r.city, r.state,
        coalesce(f.latitude, {number('r.latitude', 'DOUBLE')}) AS latitude,
        coalesce(f.longitude, {number('r.longitude', 'DOUBLE')}) AS longitude
      FROM ({inputs.plain_sql(inputs.RAW_AIRPORTS)}) r
      LEFT JOIN ({inputs.plain_sql(inputs.AIRPORT_FIXES)}) f ON r.iata_code = f.airport_iata_code""",
)
OPERATED = (
    "operated",
    f"""SELECT * FROM raw_flights WHERE {parse_int('cancelled')} <> 1
        AND {parse_int('diverted')} <> 1
        AND NOT regexp_matches(origin_airport,'^[0-9]+$')
        AND NOT regexp_matches(destination_airport,'^[0-9]+$')""",
)


def typed(midnight: str = "next_day") -> list[tuple[str, str]]:
    hours = ", ".join(f"{hhmm(c)} AS h_{c}" for c in ct.CLOCKS)
    clocks = ", ".join(f"{clock('flight_date', f'h_{c}', midnight)} AS {c}" for c in ct.CLOCKS)
    measures = ", ".join(
        f"coalesce({number(c, 'DOUBLE')}, 0.0) AS {c}"
        if c in ct.REASONS
        else f"{number(c, 'DOUBLE')} AS {c}"
        for c in ct.MEASURES
    )
    parts = ", ".join(
        f"{number(c, 'SMALLINT')} AS flight_{c}" for c in ("year", "month", "day", "day_of_week")
    )
    return [
        RAW,
        OPERATED,
        ("clocked", f"SELECT *, {DATE} AS flight_date, {hours} FROM operated"),
        (
            "typed",
            f"""SELECT {parts}, flight_date, airline AS airline_iata_code,
              {number('flight_number', 'INT')} AS flight_number, tail_number,
              origin_airport AS origin_airport_iata_code,
              destination_airport AS dest_airport_iata_code,
              {clocks}, {measures} FROM clocked""",
        ),
    ]


def _apart(a: str, b: str) -> str:
    return f"abs(epoch({a}) - epoch({b}))"


CROSSED = (
    f"{_apart('departure_time', 'scheduled_arrival')}"
    f" < {_apart('departure_time', 'scheduled_departure')} AND "
    f"{_apart('arrival_time', 'scheduled_departure')}"
    f" < {_apart('arrival_time', 'scheduled_arrival')}"
)
SWAPPED = (
    "swapped",
    f"""SELECT * REPLACE (
        CASE WHEN {CROSSED} THEN arrival_time ELSE departure_time END AS departure_time,
        CASE WHEN {CROSSED} THEN departure_time ELSE arrival_time END AS arrival_time)
      FROM typed""",
)
WRAPS = "coalesce(hour(arrival_time) < hour(departure_time), FALSE)"
REPAIRED = (
    "repaired",
    f"""SELECT * REPLACE (
        CASE WHEN {WRAPS} AND CAST(arrival_time AS DATE) <= flight_date
             THEN arrival_time + INTERVAL 1 DAY ELSE arrival_time END AS arrival_time),
        {WRAPS} AS is_overnight_flight FROM swapped""",
)
FLIGHTS = ("flights", "SELECT * FROM repaired WHERE departure_time < arrival_time")


def prejoin(midnight: str = "next_day") -> list[tuple[str, str]]:
    return [*typed(midnight), SWAPPED, REPAIRED, FLIGHTS]


ORDER = [
    "flight_date",
    "airline_iata_code",
    "flight_number",
    "origin_airport_iata_code",
    "dest_airport_iata_code",
]


def wide(on_missing: str = "drop") -> list[tuple[str, str]]:
    rest = [c for c in ct.FLIGHTS.columns if c not in ORDER]
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in [*ORDER, *rest])
    keep = ""
    if on_missing == "drop":
        keep = """WHERE origin_airport_iata_code IN (SELECT airport_iata_code FROM airports)
            AND dest_airport_iata_code IN (SELECT airport_iata_code FROM airports)"""
    attrs = ("airport_name", "city", "state", "latitude", "longitude")
    roles = ", ".join(f"{r}.{a} AS {r}_{a}" for r in ("origin", "dest") for a in attrs)
    return [
        *prejoin(),
        AIRLINES,
        AIRPORTS,
        (
            "numbered",
            f"""SELECT CAST(row_number() OVER (ORDER BY {order}) AS BIGINT) AS flight_id, *
              FROM flights {keep}""",
        ),
        (
            "wide",
            f"""SELECT f.*, a.airline_name, {roles} FROM numbered f
              LEFT JOIN airlines a ON f.airline_iata_code = a.airline_iata_code
              LEFT JOIN airports origin ON f.origin_airport_iata_code = origin.airport_iata_code
              LEFT JOIN airports dest ON f.dest_airport_iata_code = dest.airport_iata_code""",
        ),
    ]


HOLIDAYS = ", ".join(f"DATE '{d}'" for d in ct.HOLIDAYS_2015)


def dates(source: str, column: str, weekday: str = "isodow(d)", off: str | None = None) -> str:
    holiday = f"coalesce(d IN ({off or HOLIDAYS}), FALSE)"
    return f"""SELECT d AS full_date, CAST(year(d) AS SMALLINT) AS year,
        CAST(month(d) AS SMALLINT) AS month, CAST(day(d) AS SMALLINT) AS day,
        CAST({weekday} AS SMALLINT) AS day_of_week, CAST(quarter(d) AS SMALLINT) AS quarter,
        {holiday} AS is_holiday
      FROM (SELECT DISTINCT CAST({column} AS DATE) AS d FROM {source} WHERE {column} IS NOT NULL)"""


def star() -> list[tuple[str, str]]:
    attrs = ("airport_name", "state", "city", "latitude", "longitude")
    union = " UNION ".join(
        f"SELECT {r}_airport_iata_code AS airport_iata_code, "
        f"{', '.join(f'{r}_{a} AS {a}' for a in attrs)} FROM wide "
        f"WHERE {r}_airport_iata_code IS NOT NULL"
        for r in ("origin", "dest")
    )
    fact = [c for c in ct.FAT_FLT.columns if c not in
            ("airline_id", "origin_airport_id", "dest_airport_id", "full_date")]
    return [
        *wide(),
        (
            "dim_air",
            """SELECT CAST(row_number() OVER (ORDER BY airline_iata_code) AS BIGINT) AS airline_id,
              * FROM (SELECT DISTINCT airline_iata_code, airline_name FROM wide
                      WHERE airline_iata_code IS NOT NULL)""",
        ),
        (
            "dim_apt",
            f"""SELECT CAST(row_number() OVER (ORDER BY airport_iata_code) AS BIGINT) AS airport_id,
              airport_iata_code, airport_name, state AS state_code,
              CAST(NULL AS VARCHAR) AS state_name, city AS city_name, latitude, longitude
              FROM ({union})""",
        ),
        ("dim_dat", dates("wide", "flight_date")),
        (
            "fat_flt",
            f"""SELECT {', '.join(f'w.{c}' for c in fact)}, d.full_date, a.airline_id,
              o.airport_id AS origin_airport_id, t.airport_id AS dest_airport_id
              FROM wide w LEFT JOIN dim_air a ON w.airline_iata_code = a.airline_iata_code
              LEFT JOIN dim_apt o ON w.origin_airport_iata_code = o.airport_iata_code
              LEFT JOIN dim_apt t ON w.dest_airport_iata_code = t.airport_iata_code
              LEFT JOIN dim_dat d ON w.flight_date = d.full_date""",
        ),
    ]


def mnemonic(name: str) -> str:
    """Projection of a gold table to its short names; dates are numbered in date order."""
    dated = (
        "dated",
        "SELECT CAST(row_number() OVER (ORDER BY full_date) AS BIGINT) AS date_id, * FROM dim_dat",
    )
    source = {
        "dim_dat": "dated",
        "fat_flt": "(SELECT f.*, d.date_id FROM fat_flt f "
        "LEFT JOIN dated d ON f.full_date = d.full_date)",
    }.get(name, name)
    columns = ", ".join(f"{c} AS {short}" for c, short in ct.MNEMONICS[name].items())
    return with_([*star(), dated], f"SELECT {columns} FROM {source}")
