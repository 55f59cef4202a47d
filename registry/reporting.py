"""The profiling reports, and the same statistics as SQL: one aggregate for each statement."""

from itertools import combinations

from registry import inputs as src, layers, sql
from registry.entry import Entry, rounded
from tristrata.plans import contracts as ct, reports
from tristrata.sources import scratch

KEPT = f"{sql.parse_int('cancelled')} <> 1 AND {sql.parse_int('diverted')} = 0"
HELD = f"{sql.parse_int('cancelled')} <> 1"


class _Sql:
    """SQL of report rows over one table."""

    def __init__(self, table: str):
        self.table = table
        self.lines: list[str] = []

    def stats(self, section, where, lines):
        """Rows (key, statistic, aggregate) from the rows that satisfy a condition."""
        made = ", ".join(
            f"{{'key': '{key}', 'statistic': '{name}', 'value': CAST({value} AS DOUBLE)}}" for key, name, value in lines
        )
        self.lines.append(
            f"SELECT '{section}' AS section, u.key AS key, u.statistic AS statistic, u.value AS value FROM "
            f"(SELECT unnest([{made}]) AS u FROM {self.table} WHERE {where})"
        )

    def tall(self, section, query, key, stats):
        """Rows from a query with one row for each key."""
        for name, value in stats.items():
            self.lines.append(
                f"SELECT '{section}' AS section, CAST({key} AS VARCHAR) AS key, '{name}' AS statistic, CAST({value} AS DOUBLE) AS value FROM ({query})"
            )

    def size(self, section, where, columns):
        self.stats(section, where, [("", "rows", "count(*)"), ("", "columns", str(len(columns)))])

    def known(self, section, where, columns):
        self.stats(section, where, [(c, "known", f"count({c})") for c in columns])

    def nulls(self, section, where, columns):
        self.stats(section, where, [
            line for c in columns for line in (
                (c, "missing", f"count(*) FILTER ({c} IS NULL)"),
                (c, "percent", f"round(count(*) FILTER ({c} IS NULL) * 100.0 / count(*), 2)"),
            )
        ])

    def missing(self, where, columns, every):
        self.nulls("nulls", where, columns)
        for suffix in ("_delay", "_time"):
            total = {
                name: " + ".join(f"count(*) FILTER ({c} IS NULL)" for c in every if c.endswith(suffix) == inside)
                for name, inside in ((f"*{suffix}", True), ("other", False))
            }
            whole = " + ".join(f"({t})" for t in total.values())
            self.stats("null_share", where, [
                line for name, t in total.items()
                for line in ((name, "missing", f"({t})"), (name, "share", f"round(({t}) * 100.0 / ({whole}), 2)"))
            ])
        pairs = [(f"{a}|{b}", "correlation", f"corr(CAST({a} IS NULL AS INT), CAST({b} IS NULL AS INT))") for a, b in combinations(columns, 2)]
        start = len(self.lines)
        self.stats("missing_correlation", where, pairs)
        self.lines[start] = f"SELECT * FROM ({self.lines[start]}) WHERE value IS NOT NULL AND NOT isnan(value)"

    def describe(self, section, where, columns):
        lines = []
        for c in columns:
            lines += [
                (c, "count", f"count({c})"), (c, "mean", f"avg({c})"), (c, "std", f"stddev_samp({c})"), (c, "min", f"min({c})"),
                (c, "max", f"max({c})"), *((c, p, f"quantile_cont(CAST({c} AS DOUBLE), {q})") for p, q in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))),
            ]
        self.stats(section, where, lines)

    def texts(self, section, where, columns):
        for c in columns:
            inner = f"SELECT count(*) AS n FROM {self.table} WHERE {where} AND {c} IS NOT NULL GROUP BY {c}"
            query = f"SELECT sum(n) AS a, count(*) AS b, max(n) AS c FROM ({inner}) HAVING count(*) > 0"
            self.tall(section, query, f"'{c}'", {"count": "a", "unique": "b", "freq": "c"})

    def distinct(self, section, where, columns):
        start = len(self.lines)
        self.stats(section, where, [(c, "unique", f"count(DISTINCT {c})") for c in columns])
        self.lines[start] = f"SELECT * FROM ({self.lines[start]}) WHERE value > 0"

    def counts(self, section, where, column):
        query = (
            f"SELECT {column} AS k, count(*) AS n, sum(count(*)) OVER () AS total FROM {self.table} "
            f"WHERE {where} AND {column} IS NOT NULL GROUP BY {column}"
        )
        self.tall(section, query, "k", {"rows": "n", "share": "round(n * 100.0 / total, 2)"})

    def repeats(self, section, where, columns, top=0):
        key = "concat_ws('|', " + ", ".join(f"CAST({c} AS VARCHAR)" for c in columns) + ")"
        shared = f"SELECT {key} AS k, count(*) AS n FROM {self.table} WHERE {where} GROUP BY k HAVING count(*) > 1"
        query = f"SELECT count(*) AS a, coalesce(sum(n), 0) AS b FROM ({shared})"
        self.tall(section, query, "''", {"keys": "a", "rows": "b", "beyond_first": "b - a"})
        if top:
            self.tall(section, f"{shared} ORDER BY n DESC, k LIMIT {top}", "k", {"rows": "n"})
        return key, shared

    def duplicates(self, section, where, columns):
        query = f"SELECT count(*) AS n FROM {self.table} WHERE {where} GROUP BY {', '.join(columns)}"
        self.tall(section, f"SELECT coalesce(sum(n - 1), 0) AS a FROM ({query})", "''", {"beyond_first": "a"})

    def fit(self, section, where):
        self.stats(section, where, [
            line for x, y in reports.FIT_PAIRS for line in (
                (f"{x}|{y}", "count", f"regr_count({y}, {x})"), (f"{x}|{y}", "slope", f"regr_slope({y}, {x})"),
                (f"{x}|{y}", "intercept", f"regr_intercept({y}, {x})"), (f"{x}|{y}", "r2", f"regr_r2({y}, {x})"),
            )
        ])


def _finished(steps, *parts):
    # Materialised, as each statement reads them.
    named = ",\n".join(f"{name} AS MATERIALIZED (\n{text}\n)" for name, text in steps)
    body = "\nUNION ALL ".join(line for p in parts for line in p.lines)
    return f"WITH {named}\nSELECT section, key, statistic, round(value, 6) AS value FROM (\n{body}\n)"


def _raw_sql():
    airlines, airports, flights = _Sql("raw_airlines"), _Sql("raw_airports"), _Sql("held")
    airlines.size("airline_size", "true", ct.RAW_AIRLINES.columns)
    airlines.repeats("airline_duplicates", "true", ["iata_code"])
    airlines.distinct("airline_unique", "true", ct.RAW_AIRLINES.columns)
    airlines.counts("airline_codes", "true", "iata_code")
    unknown = "SELECT count(DISTINCT airline) AS a FROM raw_flights WHERE airline NOT IN (SELECT iata_code FROM raw_airlines)"
    airlines.tall("unknown_airlines", unknown, "''", {"keys": "a"})

    columns = list(ct.RAW_AIRPORTS.columns)
    airports.size("airport_size", "true", columns)
    airports.known("airport_known", "true", columns)
    airports.nulls("airport_nulls", "true", columns)
    airports.texts("airport_texts", "true", columns)
    airports.repeats("airport_key_duplicates", "true", ["iata_code"])
    airports.duplicates("airport_duplicates", "true", columns)
    for c in reports.TEXT_COLUMNS:
        odd = f"SELECT '{c}|' || {c} AS k, count(*) AS n FROM raw_airports WHERE NOT regexp_matches({c}, '^[A-Za-zÀ-ÿ\\s\\-\\.'']+$') GROUP BY k"
        airports.tall("airport_odd_text", odd, "k", {"rows": "n"})

    every = [c for c in ct.RAW_FLIGHTS.columns if c not in ("cancelled", "cancellation_reason")]
    own = [c for c in every if c != "diverted"]
    whole = _Sql("typed_flights")
    whole.counts("flights_by_airline", "true", "airline")
    flights.size("size", "true", every)
    flights.counts("diverted", "true", "diverted")
    flights.known("known", "true", every)
    flights.missing("true", every, [*every, "time_difference"])
    flights.describe("numbers", "true", ct.MEASURES)
    flights.texts("texts", "true", [c for c in own if c not in ct.MEASURES])
    flights.known("punctual_reasons", "arrival_delay <= 0", ct.REASONS)
    for d in "01":
        flights.nulls(f"nulls_diverted_{d}", f"diverted = '{d}'", ["arrival_delay", "elapsed_time", "arrival_time"])
        flights.stats("time_nulls", f"diverted = '{d}'", [
            (f"diverted_{d}|{c}", "percent", f"count(*) FILTER ({c} IS NULL) * 100.0 / count(*)") for c in every if c.endswith("time")
        ])
    flights.describe("elapsed_difference", "time_difference IS NOT NULL", ["time_difference"])
    flights.duplicates("duplicates", "kept", [*own, "time_difference"])
    flights.distinct("unique", "kept", own)
    key, shared = flights.repeats("key_repeats", "kept", reports.NATURAL_KEY, reports.TOP)
    order = ", ".join(f"{c} NULLS FIRST" for c in own)
    worst = (
        f"SELECT *, row_number() OVER (ORDER BY {order}) AS i FROM held WHERE kept AND {key} = "
        f"(SELECT k FROM ({shared}) ORDER BY n DESC, k LIMIT 1)"
    )
    flights.tall("worst_key", worst, "i", {c: c for c in ("departure_delay", "arrival_delay", "distance")})
    flights.nulls("core_nulls", "kept", reports.CORE)
    flights.nulls("reason_nulls", "kept", ct.REASONS)
    flights.fit("linear_fit", "kept")

    numbers = ", ".join(f"{sql.number(c, 'DOUBLE')} AS {c}" for c in ct.MEASURES)
    off = "elapsed_time - (taxi_out + air_time + taxi_in)"
    steps = [
        sql.RAW, ("raw_airlines", src.plain_sql(src.RAW_AIRLINES)), ("raw_airports", src.plain_sql(src.RAW_AIRPORTS)),
        ("typed_flights", f"SELECT * REPLACE ({numbers}) FROM raw_flights"),
        ("judged", f"SELECT *, coalesce({KEPT}, false) AS kept FROM typed_flights WHERE {HELD}"),
        ("held", f"SELECT *, CASE WHEN kept AND {off} <> 0 THEN {off} END AS time_difference FROM judged"),
    ]
    return _finished(steps, airlines, airports, whole, flights)


def _silver_sql():
    columns = list(ct.SILVER_FLIGHTS.columns)
    extra = [f"{c}_days" for c in ct.CLOCKS]
    t = _Sql("held")
    t.size("size", "true", columns)
    t.counts("flights_by_airline", "true", "airline_name")
    t.known("known", "true", columns)
    t.missing("true", columns, [*columns, *extra, "time_difference"])
    t.describe("numbers", "true", ct.MEASURES)
    t.describe("times", "true", extra)
    t.texts("texts", "true", [c for c, kind in ct.SILVER_FLIGHTS.columns.items() if kind == "string"])
    t.known("punctual_reasons", "arrival_delay <= 0", ct.REASONS)
    t.describe("elapsed_difference", "time_difference IS NOT NULL", ["time_difference"])
    t.repeats("key_repeats", "true", ["flight_id"])
    t.duplicates("duplicates", "true", columns)
    t.distinct("unique", "true", columns)
    t.nulls("core_nulls", "true", [*reports.CORE, "airline_name"])
    t.nulls("reason_nulls", "true", ct.REASONS)
    t.fit("linear_fit", "true")
    off = "elapsed_time - (taxi_out + air_time + taxi_in)"
    days = ", ".join(f"epoch({c}) / 86400.0 AS {c}_days" for c in ct.CLOCKS)
    held = f"SELECT {', '.join(columns)}, {days}, CASE WHEN {off} <> 0 THEN {off} END AS time_difference FROM wide"
    return _finished([*sql.wide(), ("held", held)], t)


def report_raw(spark, sf_dir):
    airlines, airports, flights = (
        scratch.table(f(spark, sf_dir), "raw") for f in (src.raw_airlines, src.raw_airports, src.raw_flights)
    )
    return rounded(reports.raw_report(airlines, airports, flights))


def report_silver(spark, sf_dir):
    return rounded(reports.silver_report(scratch.table(layers.wide(spark, sf_dir), "wide")))


ENTRIES = {"report_raw": Entry(report_raw, _raw_sql()), "report_silver": Entry(report_silver, _silver_sql())}
