"""Gate suites of the layers, as lists for ``gates.run``."""

from functools import reduce

from pyspark.sql import DataFrame

from tristrata.operators import gates as gt
from tristrata.plans import contracts as ct

# Gates that real data is known to fail; a run reports them and goes on.
REPORTED = frozenset({
    "columns_differ(origin_airport_iata_code,dest_airport_iata_code)",
    "sum_consistency(arrival_delay)",
    "sum_consistency(elapsed_time)",
    "not_null(elapsed_time,taxi_out,air_time,taxi_in)",
    "fk_exists(origin_airport_iata_code)",
    "fk_exists(dest_airport_iata_code)",
    "fk_exists(airline_iata_code)",
})


def raw(table: ct.Table) -> list[gt.Gate]:
    return [gt.not_empty(), gt.required_columns(list(table.columns))]


def silver_base(table: ct.Table) -> list[gt.Gate]:
    pk = list(table.pk)
    return [
        gt.not_empty(),
        gt.required_columns(list(table.columns)),
        gt.not_null(pk),
        gt.unique(pk),
        gt.no_full_duplicates(),
    ]


def _flight_rows() -> list[gt.Gate]:
    return [
        gt.ordered("departure_time", "arrival_time"),
        gt.columns_differ("origin_airport_iata_code", "dest_airport_iata_code"),
        gt.positive("distance"),
    ]


def silver_flights(airports: DataFrame, ignore_nulls: bool = False) -> list[gt.Gate]:
    """Cleaned flights before enrichment; NULL airports count as unknown by default."""
    return [
        gt.not_empty(),
        *_flight_rows(),
        gt.sum_consistency("arrival_delay", list(ct.REASONS)),
        *(
            gt.fk_exists(f"{role}_airport_iata_code", airports, "airport_iata_code", ignore_nulls)
            for role in ("origin", "dest")
        ),
    ]


def planned_flight_checks(airlines: DataFrame) -> list[gt.Gate]:
    """Elapsed time adds up, its operands are known, and every airline exists."""
    parts = ["taxi_out", "air_time", "taxi_in"]
    return [
        gt.sum_consistency("elapsed_time", parts, tol=0.0, only_positive=False),
        gt.not_null(["elapsed_time", *parts]),
        gt.fk_exists("airline_iata_code", airlines, "airline_iata_code"),
    ]


def silver_wide() -> list[gt.Gate]:
    return [
        gt.not_empty(),
        gt.unique(["flight_id"]),
        *gt.not_null_each(list(ct.SILVER_CRITICAL)),
        *_flight_rows(),
    ]


def silver_wide_declared() -> list[gt.Gate]:
    """The declarative bindings of the wide table."""
    return [
        gt.not_empty(),
        gt.not_null(["flight_id"]),
        gt.unique(["flight_id"]),
        gt.no_full_duplicates(list(ct.SILVER_FLIGHTS.columns)),
        *_flight_rows(),
        gt.sum_consistency("arrival_delay", list(ct.REASONS)),
        gt.not_null(list(ct.SILVER_CRITICAL)),
    ]


def gold_dim(name: str) -> list[gt.Gate]:
    """The key gate of one gold dimension."""
    key = {"dim_air": "airline_iata_code", "dim_apt": "airport_iata_code", "dim_dat": "full_date"}[name]
    return [gt.unique([key])]


def gold(tables: dict[str, DataFrame]) -> dict[str, list[gt.Gate]]:
    """Gates per gold table; foreign keys look up the other tables of ``tables``."""
    fact = ct.FAT_FLT
    keys = [
        gt.fk_exists(column, tables[target], key, ignore_nulls=False)
        for column, (target, key) in fact.fks.items()
    ]
    return {
        **{name: gold_dim(name) for name in ("dim_air", "dim_apt", "dim_dat")},
        "fat_flt": [gt.unique(["flight_id"]), gt.not_null(list(fact.not_null)), *keys],
    }


def gold_declared(tables: dict[str, DataFrame]) -> dict[str, list[gt.Gate]]:
    """The declarative bindings of the gold tables."""
    declared = {
        t.name: [
            gt.not_empty(),
            gt.not_null(list(t.pk)),
            gt.unique(list(t.pk)),
            *(gt.unique([c]) for c in t.unique),
            gt.not_null(list(dict.fromkeys([*t.not_null]))),
        ]
        for t in (ct.DIM_AIR, ct.DIM_APT, ct.DIM_DAT, ct.FAT_FLT)
    }
    declared["fat_flt"] += [
        gt.fk_exists(column, tables[target], key)
        for column, (target, key) in ct.FAT_FLT.fks.items()
    ]
    return declared


def run_all(tables: dict[str, DataFrame], suites: dict[str, list[gt.Gate]]) -> DataFrame:
    """Results of several suites in one table."""
    return reduce(
        DataFrame.unionByName,
        (gt.run(tables[name], gates, name) for name, gates in suites.items()),
    )
