"""The layer transformations: raw text relations -> cleaned and wide silver -> gold star."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tristrata.functions import normalize as nz
from tristrata.operators import clean, enrich, keys, star
from tristrata.operators import gates as gt
from tristrata.plans import contracts as ct, suites
from tristrata.sources import scratch, snapshots
from tristrata.sources.snapshots import Layout

# The order in which flights are numbered.
FLIGHT_ORDER = [
    "flight_date",
    "airline_iata_code",
    "flight_number",
    "origin_airport_iata_code",
    "dest_airport_iata_code",
]


def silver_airlines(raw: DataFrame) -> DataFrame:
    named = ct.lower_names(raw)
    ct.require(named, ["iata_code", "airline"])
    return ct.conform(ct.canonicalise(named, ct.AIRLINES), ct.AIRLINES)


def airport_fixes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ct.AIRPORT_FIXES, ct.AIRPORT_FIXES_SCHEMA)


def silver_airports(raw: DataFrame, fixes: DataFrame | None = None) -> DataFrame:
    """Typed airports with the corrected coordinates; the country column is left out."""
    named = ct.lower_names(raw)
    ct.require(named, ["iata_code", "airport", "city", "state", "latitude", "longitude"])
    typed = ct.conform(ct.canonicalise(named, ct.AIRPORTS), ct.AIRPORTS)
    if fixes is None:
        fixes = airport_fixes(raw.sparkSession)
    return clean.apply_corrections(typed, fixes, "airport_iata_code", ["latitude", "longitude"])


def clocked_flights(raw: DataFrame, midnight: str = "next_day") -> DataFrame:
    """Operated flights with their date and the six times as recorded; the rest is still text."""
    named = ct.lower_names(raw)
    ct.require(named, list(ct.RAW_FLIGHTS.columns))
    operated = clean.operated_only(named, ["cancelled", "diverted"])
    operated = clean.reject_pattern(operated, ["origin_airport", "destination_airport"])
    date = nz.ymd_date(F.col("year"), F.col("month"), F.col("day"))
    dated = operated.withColumns(
        {"flight_date": date, **{c: nz.clock_number(F.col(c)) for c in ct.CLOCKS}}
    )
    return dated.withColumns(
        {c: nz.build_ts(F.col("flight_date"), F.col(c), midnight) for c in ct.CLOCKS}
    )


def measured_flights(clocked: DataFrame) -> DataFrame:
    """Contract names and types for the remaining text columns; missing delay reasons are 0."""
    numbers = {c: nz.num(F.col(c), "double") for c in ct.MEASURES}
    numbers |= {c: F.coalesce(numbers[c], F.lit(0.0)) for c in ct.REASONS}
    dates = {f"flight_{c}": nz.num(F.col(c), "smallint") for c in ct.DATE_PARTS}
    names = {
        "airline_iata_code": F.col("airline"),
        "flight_number": nz.num(F.col("flight_number"), "int"),
        "origin_airport_iata_code": F.col("origin_airport"),
        "dest_airport_iata_code": F.col("destination_airport"),
    }
    made = dates | names | numbers
    kept = [c for c in ct.FLIGHTS.columns if c in made or c in clocked.columns]
    return clocked.select(*(made[c].alias(c) if c in made else c for c in kept))


def typed_flights(raw: DataFrame, midnight: str = "next_day") -> DataFrame:
    """Operated flights with typed columns; times still as recorded."""
    clocked = clean.settled(clocked_flights(raw, midnight), list(ct.CLOCKS))
    return measured_flights(clocked)


def repaired_flights(flights: DataFrame) -> DataFrame:
    """Swapped times exchanged and overnight arrivals moved to the next day."""
    swapped = clean.repair_swapped(
        flights, "departure_time", "arrival_time", "scheduled_departure", "scheduled_arrival"
    )
    rolled = F.to_date("arrival_time") > F.col("flight_date")
    return clean.adjust_overnight(swapped, "departure_time", "arrival_time", rolled)


def silver_flights(raw: DataFrame, midnight: str = "next_day") -> DataFrame:
    """Cleaned flights before enrichment. One pass over the raw rows, no shuffle.

    The steps are separate projections, so that each compiles to a small method, and the
    measures are parsed last, for the rows that remain.
    """
    repaired = clean.settled(
        repaired_flights(clocked_flights(raw, midnight)),
        ["departure_time", "arrival_time", "is_overnight_flight"],
    )
    return measured_flights(clean.valid_interval(repaired, "departure_time", "arrival_time"))


AIRPORT_ATTRS = {
    "airport_name": "airport_name",
    "city": "city",
    "state": "state",
    "latitude": "latitude",
    "longitude": "longitude",
}
ROLES = {"origin": "origin_airport_iata_code", "dest": "dest_airport_iata_code"}


def widen(
    flights: DataFrame, airlines: DataFrame, airports: DataFrame, sized: bool = False
) -> DataFrame:
    """Airline and airport attributes for every flight."""
    named = enrich.lookup(
        flights,
        airlines,
        ("airline_iata_code", "airline_iata_code"),
        {"airline_name": "airline_name"},
        sized=sized,
    )
    return enrich.role_lookup(
        named, airports, "airport_iata_code", ROLES, AIRPORT_ATTRS, sized=sized
    )


def obt(
    flights: DataFrame,
    airlines: DataFrame,
    airports: DataFrame,
    on_missing: str = "drop",
    dealt: bool = False,
) -> DataFrame:
    """The wide silver table with its flight key.

    Flights with an unknown airport are dropped first (``on_missing="keep"`` leaves them in),
    then numbered while still narrow, and widened last: the sort behind the key moves no
    dimension attributes. Pass stored flights, as ``dense_key`` reads them twice. ``dealt`` leaves
    the rows in the order of their key, for a table that is written once.
    """
    airlines, airports = enrich.measured(airlines), enrich.measured(airports)
    if on_missing == "drop":
        codes = list(ROLES.values())
        flights = enrich.matched(flights, airports, "airport_iata_code", codes, sized=True)
    if dealt:
        numbered = keys.dealt_key(flights, "flight_id", FLIGHT_ORDER, 2)
    else:
        numbered = keys.dense_key(flights, "flight_id", FLIGHT_ORDER)
    return ct.conform(widen(numbered, airlines, airports, sized=True), ct.SILVER_FLIGHTS)


def rejected_flights(flights: DataFrame, airports: DataFrame) -> DataFrame:
    """Cleaned flights that ``obt`` drops because an airport is unknown."""
    return enrich.unmatched(flights, airports, "airport_iata_code", list(ROLES.values()))


def dim_air(wide: DataFrame) -> DataFrame:
    return star.entity_dim(wide, "airline_iata_code", ["airline_name"], "airline_id")


def airport_role(role: str) -> dict[str, str]:
    """Source columns of the airport dimension in one role."""
    return {
        "airport_iata_code": f"{role}_airport_iata_code",
        "airport_name": f"{role}_airport_name",
        "state_code": f"{role}_state",
        "city_name": f"{role}_city",
        "latitude": f"{role}_latitude",
        "longitude": f"{role}_longitude",
    }


def dim_apt(wide: DataFrame) -> DataFrame:
    roles = [airport_role("origin"), airport_role("dest")]
    keyed = star.role_union_dim(wide, roles, "airport_id")
    return ct.conform(keyed, ct.DIM_APT)


def dim_dat(
    wide: DataFrame, holidays: list[str] | DataFrame | None = None, dow: str = "iso"
) -> DataFrame:
    days = ct.HOLIDAYS_2015 if holidays is None else holidays
    return star.date_dim(wide, "flight_date", days, dow)


def fat_flt(wide: DataFrame, air: DataFrame, apt: DataFrame, dat: DataFrame) -> DataFrame:
    return star.fact(
        wide,
        [
            (air, "airline_iata_code", "airline_id", {"airline_id": "airline_iata_code"}),
            (
                apt,
                "airport_iata_code",
                "airport_id",
                {f"{role}_airport_id": fk for role, fk in ROLES.items()},
            ),
            (dat, "full_date", "full_date", {"full_date": "flight_date"}),
        ],
        list(ct.FAT_FLT.columns),
    )


def build_star(
    wide: DataFrame, holidays: list[str] | DataFrame | None = None, dow: str = "iso"
) -> dict[str, DataFrame]:
    """The four gold tables. The dimensions are written tables, so their sizes are known."""
    air = dim_air(wide)
    apt = dim_apt(wide)
    dat = scratch.table(dim_dat(wide, holidays, dow), "dim_dat")
    return {
        "dim_air": air,
        "dim_apt": apt,
        "dim_dat": dat,
        "fat_flt": fat_flt(wide, air, apt, dat),
    }


def to_mnemonic(gold: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The gold tables under their short names, with a surrogate key for dates."""
    dates = keys.dim_key(gold["dim_dat"], "date_id", "full_date")
    fact = star.attach_keys(
        gold["fat_flt"], dates, "full_date", "date_id", {"date_id": "full_date"}
    )
    tables = {**gold, "dim_dat": dates, "fat_flt": fact}
    return {
        name: df.select(*(F.col(c).alias(short) for c, short in ct.MNEMONICS[name].items()))
        for name, df in tables.items()
    }


# Where rows of the large tables lie: a directory for each month, in flight order.
LAYOUTS = {
    "flights": Layout({"month_start": "trunc(flight_date, 'MM')"}, ("flight_date", "airline_iata_code")),
    "silver_flights": Layout({"month_start": "trunc(flight_date, 'MM')"}, ("flight_date", "flight_id")),
    "dim_air": Layout(order=("airline_id",)),
    "dim_apt": Layout(order=("airport_id",)),
    "dim_dat": Layout(order=("full_date",)),
    "fat_flt": Layout({"month_start": "trunc(full_date, 'MM')"}, ("full_date", "flight_id")),
}

def flight_days(raw: DataFrame) -> DataFrame:
    """Raw rows (``_n``) of each day and airline, in the order of the flights' layout.

    Days are read after the rows were counted by their texts.
    """
    named = ct.lower_names(raw)
    texts = named.groupBy("year", "month", "day", "airline").agg(F.count(F.lit(1)).alias("_n"))
    date = nz.ymd_date(F.col("year"), F.col("month"), F.col("day"))
    return texts.groupBy(date.alias("flight_date"), F.col("airline").alias("airline_iata_code")).agg(
        F.sum("_n").alias("_n")
    )


RAW = {"airlines": ct.RAW_AIRLINES, "airports": ct.RAW_AIRPORTS, "flights": ct.RAW_FLIGHTS}


def run(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    destination: str,
    date: str,
    midnight: str = "next_day",
    on_missing: str = "drop",
    fixes: DataFrame | None = None,
    holidays: list[str] | DataFrame | None = None,
    dow: str = "iso",
    reported: frozenset[str] = suites.REPORTED,
    extra_gates: dict[str, list[gt.Gate]] | None = None,
    layouts: dict[str, Layout] | None = None,
) -> dict[str, DataFrame]:
    """Raw relations to published gold tables for one processing date.

    ``raw`` holds ``airlines``, ``airports`` and ``flights``; ``fixes`` are coordinates by airport,
    ``holidays`` and ``dow`` go to the date dimension (the default calendar is that of 2015). Every
    suite of ``suites`` runs on its table, plus ``extra_gates`` by table name. A failed gate ends the
    run, except those in ``reported``, which real data is known to fail. All layers become visible in
    one commit at the end: ``raw_*``, ``airlines``, ``airports``, ``flights``, ``silver_flights``, the
    gold tables and ``gate_results``. Returns the gold tables and the gate results.
    """
    out = snapshots.Run(spark, destination, date)
    more = extra_gates or {}
    placed = LAYOUTS if layouts is None else layouts

    def stage(name: str, df: DataFrame, gates: list[gt.Gate], dealt: bool = False) -> DataFrame:
        return out.stage(name, df, [*gates, *more.get(name, [])], placed.get(name), reported, dealt)

    def usual(name: str) -> bool:
        return placed.get(name) == LAYOUTS[name]

    bronze = {name: stage(f"raw_{name}", raw[name], suites.raw(table)) for name, table in RAW.items()}
    airlines = stage("airlines", silver_airlines(bronze["airlines"]), suites.silver_base(ct.AIRLINES))
    airports = stage("airports", silver_airports(bronze["airports"], fixes), suites.silver_base(ct.AIRPORTS))
    cleaned = silver_flights(bronze["flights"], midnight)
    by_day = None
    if usual("flights"):
        by_day = keys.deal_by_groups(cleaned, scratch.table(flight_days(bronze["flights"]), "days"))
    flights = stage(
        "flights",
        cleaned if by_day is None else by_day,
        [*suites.silver_flights(airports), *suites.planned_flight_checks(airlines)],
        by_day is not None,
    )
    ordered = usual("silver_flights") and enrich.is_small(airlines) and enrich.is_small(airports)
    wide = obt(flights, airlines, airports, on_missing, ordered)
    silver = stage("silver_flights", wide, [*suites.silver_wide(), gt.no_full_duplicates(by=["flight_id"])], ordered)
    made = {"dim_air": dim_air(silver), "dim_apt": dim_apt(silver), "dim_dat": dim_dat(silver, holidays, dow)}
    gold = {name: stage(name, df, suites.gold_dim(name)) for name, df in made.items()}
    fact = fat_flt(silver, gold["dim_air"], gold["dim_apt"], gold["dim_dat"])
    numbered = usual("fat_flt")
    if numbered:
        fact = keys.deal_by_number(fact, "flight_id", out.tables["silver_flights"].rows)
    gold["fat_flt"] = stage("fat_flt", fact, suites.gold(gold)["fat_flt"], numbered)
    results = out.outcome()
    gold["gate_results"] = out.stage("gate_results", results)
    out.commit()
    return gold
