"""Queries over the raw, silver and gold transformations."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from registry import inputs as src, sql
from registry.entry import Entry, rounded
from tristrata.functions import normalize as nz
from tristrata.operators import clean, enrich, keys, star
from tristrata.plans import contracts as ct, pipeline
from tristrata.sources import scratch, sinks

ENTRIES: dict[str, Entry] = {}


def _add(name: str, text: str | None = None):
    def register(build):
        ENTRIES[name] = Entry(build, text)
        return build

    return register


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.silver_flights(src.raw_flights(spark, sf_dir))


def airlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.silver_airlines(src.raw_airlines(spark, sf_dir))


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = src.raw_airports(spark, sf_dir)
    return pipeline.silver_airports(raw, src.airport_fixes(spark, sf_dir))


def wide(spark: SparkSession, sf_dir: str, on_missing: str = "drop") -> DataFrame:
    stored = scratch.table(flights(spark, sf_dir), "flights")
    named = scratch.table(airlines(spark, sf_dir), "airlines")
    placed = scratch.table(airports(spark, sf_dir), "airports")
    return pipeline.obt(stored, named, placed, on_missing=on_missing)


def gold(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The star over the wide table.

    The numbered flights and the lookup tables are written; what is wide about them is joined again
    where it is read, which for the fact and the dates is hardly any column.
    """
    return pipeline.build_star(wide(spark, sf_dir))


# -- raw ----------------------------------------------------------------------------------------


@_add("raw_flights_scan", sql.RAW[1])
def raw_flights_scan(spark, sf_dir):
    return src.raw_flights(spark, sf_dir)


@_add("raw_airlines_view", src.plain_sql(src.RAW_AIRLINES))
def raw_airlines_view(spark, sf_dir):
    sinks.as_view(src.raw_airlines(spark, sf_dir), "raw_airlines")
    return spark.table("raw_airlines").select("iata_code", "airline")


@_add("raw_airports_view", src.plain_sql(src.RAW_AIRPORTS))
def raw_airports_view(spark, sf_dir):
    sinks.as_view(src.raw_airports(spark, sf_dir), "raw_airports")
    return spark.table("raw_airports").select(*ct.RAW_AIRPORTS.columns)


@_add(
    "operated_filter",
    sql.with_(
        [sql.RAW],
        f"""SELECT * FROM raw_flights WHERE {sql.parse_int('cancelled')} <> 1
            AND {sql.parse_int('diverted')} <> 1""",
    ),
)
def operated_filter(spark, sf_dir):
    return clean.operated_only(src.raw_flights(spark, sf_dir), ["cancelled", "diverted"])


@_add(
    "reject_digit_codes",
    sql.with_(
        [sql.RAW],
        """SELECT airline, flight_number, origin_airport, destination_airport FROM raw_flights
           WHERE NOT regexp_matches(origin_airport,'^[0-9]+$')
             AND NOT regexp_matches(destination_airport,'^[0-9]+$')""",
    ),
)
def reject_digit_codes(spark, sf_dir):
    cols = ["origin_airport", "destination_airport"]
    kept = clean.reject_pattern(src.raw_flights(spark, sf_dir), cols)
    return kept.select("airline", "flight_number", *cols)


@_add(
    "parse_int",
    sql.with_(
        [sql.RAW],
        f"""SELECT departure_time, {sql.parse_int('departure_time')} AS as_int,
              diverted, {sql.parse_int('diverted')} AS diverted_int,
              coalesce({sql.parse_int('diverted')}, -1) AS diverted_known FROM raw_flights""",
    ),
)
def parse_int(spark, sf_dir):
    flag = nz.parse_int(F.col("diverted"))
    return src.raw_flights(spark, sf_dir).select(
        "departure_time",
        nz.parse_int(F.col("departure_time")).alias("as_int"),
        "diverted",
        flag.alias("diverted_int"),
        F.coalesce(flag, F.lit(-1)).alias("diverted_known"),
    )


@_add(
    "ymd_date",
    sql.with_([sql.RAW], f"SELECT year, month, day, {sql.DATE} AS flight_date FROM raw_flights"),
)
def ymd_date(spark, sf_dir):
    parts = [F.col(c) for c in ("year", "month", "day")]
    return src.raw_flights(spark, sf_dir).select(*parts, nz.ymd_date(*parts).alias("flight_date"))


@_add(
    "hhmm_normalize",
    sql.with_(
        [sql.RAW],
        "SELECT "
        + ", ".join(f"{c}, {sql.hhmm(c)} AS {c}_hhmm" for c in ct.CLOCKS)
        + " FROM raw_flights",
    ),
)
def hhmm_normalize(spark, sf_dir):
    raw = src.raw_flights(spark, sf_dir)
    return raw.select(*ct.CLOCKS, *(nz.hhmm(F.col(c)).alias(f"{c}_hhmm") for c in ct.CLOCKS))


def _clock_sql(midnight: str) -> str:
    steps = [
        sql.RAW,
        (
            "h",
            f"SELECT {sql.DATE} AS d, {sql.hhmm('departure_time')} AS dep, "
            f"{sql.hhmm('arrival_time')} AS arr FROM raw_flights",
        ),
    ]
    return sql.with_(
        steps,
        f"SELECT d AS flight_date, {sql.clock('d', 'dep', midnight)} AS departure_time, "
        f"{sql.clock('d', 'arr', midnight)} AS arrival_time FROM h",
    )


def _clocks(spark, sf_dir, midnight):
    raw = src.raw_flights(spark, sf_dir)
    dated = raw.withColumn("flight_date", nz.ymd_date(F.col("year"), F.col("month"), F.col("day")))
    return dated.select(
        "flight_date",
        *(
            nz.build_ts(F.col("flight_date"), nz.hhmm(F.col(c)), midnight).alias(c)
            for c in ("departure_time", "arrival_time")
        ),
    )


@_add("build_ts", _clock_sql("next_day"))
def build_ts(spark, sf_dir):
    return _clocks(spark, sf_dir, "next_day")


@_add("build_ts_null_midnight", _clock_sql("null"))
def build_ts_null_midnight(spark, sf_dir):
    return _clocks(spark, sf_dir, "null")


@_add(
    "lenient_timestamp",
    """SELECT event_id,
         TRY_CAST(CASE WHEN event_id % 7 = 0 THEN 'unknown' WHEN event_id % 11 = 0 THEN ''
              ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS TIMESTAMP) AS parsed FROM events""",
)
def lenient_timestamp(spark, sf_dir):
    events = src.table(spark, sf_dir, "events")
    text = (
        F.when(F.col("event_id") % 7 == 0, "unknown")
        .when(F.col("event_id") % 11 == 0, "")
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    )
    return events.select("event_id", nz.lenient_ts(text).alias("parsed"))


@_add("conform_types", sql.with_(sql.typed(), "SELECT * FROM typed"))
def conform_types(spark, sf_dir):
    return pipeline.typed_flights(src.raw_flights(spark, sf_dir))


@_add(
    "abs_minutes",
    sql.with_(
        sql.typed(),
        """SELECT flight_date, flight_number, departure_time, scheduled_departure,
             abs(epoch(departure_time) - epoch(scheduled_departure))/60.0 AS minutes FROM typed""",
    ),
)
def abs_minutes(spark, sf_dir):
    typed = pipeline.typed_flights(src.raw_flights(spark, sf_dir))
    minutes = nz.abs_minutes(F.col("departure_time"), F.col("scheduled_departure"))
    return rounded(
        typed.select(
            "flight_date",
            "flight_number",
            "departure_time",
            "scheduled_departure",
            minutes.alias("minutes"),
        )
    )


@_add(
    "row_sum_defaults",
    sql.with_(
        [sql.RAW],
        f"""SELECT flight_number, {' + '.join(
            f"coalesce({sql.number(c, 'DOUBLE')}, 0.0)" for c in ct.REASONS)} AS reasons,
            {', '.join(f"CAST({c} IS NULL AS INT) AS no_{c}" for c in ct.REASONS)}
            FROM raw_flights""",
    ),
)
def row_sum_defaults(spark, sf_dir):
    return src.raw_flights(spark, sf_dir).select(
        "flight_number",
        nz.row_sum([nz.num(F.col(c), "double") for c in ct.REASONS]).alias("reasons"),
        *(nz.null_flag(F.col(c)).alias(f"no_{c}") for c in ct.REASONS),
    )


# -- silver -------------------------------------------------------------------------------------

_TIMES = "flight_date, flight_number, departure_time, arrival_time"


@_add("swap_repair", sql.with_([*sql.typed(), sql.SWAPPED], f"SELECT {_TIMES} FROM swapped"))
def swap_repair(spark, sf_dir):
    typed = pipeline.typed_flights(src.raw_flights(spark, sf_dir))
    return clean.repair_swapped(
        typed, "departure_time", "arrival_time", "scheduled_departure", "scheduled_arrival"
    ).select(*_TIMES.split(", "))


@_add(
    "overnight_adjust",
    sql.with_(
        [*sql.typed(), sql.SWAPPED, sql.REPAIRED],
        f"SELECT {_TIMES}, is_overnight_flight FROM repaired",
    ),
)
def overnight_adjust(spark, sf_dir):
    typed = pipeline.typed_flights(src.raw_flights(spark, sf_dir))
    return pipeline.repaired_flights(typed).select(*_TIMES.split(", "), "is_overnight_flight")


@_add(
    "valid_interval",
    """SELECT l_orderkey, l_linenumber, l_partkey, o_orderdate, l_shipdate
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderdate < l_shipdate""",
)
def valid_interval(spark, sf_dir):
    lineitem, orders = (src.table(spark, sf_dir, t) for t in ("lineitem", "orders"))
    both = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return clean.valid_interval(both, "o_orderdate", "l_shipdate").select(
        "l_orderkey", "l_linenumber", "l_partkey", "o_orderdate", "l_shipdate"
    )


@_add("silver_prejoin", sql.with_(sql.prejoin(), "SELECT * FROM flights"))
def silver_prejoin(spark, sf_dir):
    return flights(spark, sf_dir)


@_add("silver_prejoin_null_midnight", sql.with_(sql.prejoin("null"), "SELECT * FROM flights"))
def silver_prejoin_null_midnight(spark, sf_dir):
    return pipeline.silver_flights(src.raw_flights(spark, sf_dir), midnight="null")


@_add("silver_airlines", sql.with_([sql.AIRLINES], "SELECT * FROM airlines"))
def silver_airlines(spark, sf_dir):
    return airlines(spark, sf_dir)


@_add("airport_corrections", sql.with_([sql.AIRPORTS], "SELECT * FROM airports"))
def airport_corrections(spark, sf_dir):
    return airports(spark, sf_dir)


@_add(
    "lookup_left",
    sql.with_(
        [*sql.prejoin(), sql.AIRPORTS],
        """SELECT flight_date, flight_number, dest_airport_iata_code, airport_name, latitude
           FROM flights LEFT JOIN airports ON dest_airport_iata_code = airport_iata_code""",
    ),
)
def lookup_left(spark, sf_dir):
    return enrich.lookup(
        flights(spark, sf_dir).select("flight_date", "flight_number", "dest_airport_iata_code"),
        airports(spark, sf_dir),
        ("dest_airport_iata_code", "airport_iata_code"),
        {"airport_name": "airport_name", "latitude": "latitude"},
    )


@_add(
    "role_lookup",
    """SELECT l_orderkey, l_linenumber, l_partkey, s_nationkey, c_nationkey,
         a.n_name AS origin_name, a.n_regionkey AS origin_region,
         b.n_name AS dest_name, b.n_regionkey AS dest_region
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
       LEFT JOIN nation a ON s_nationkey = a.n_nationkey
       LEFT JOIN nation b ON c_nationkey = b.n_nationkey""",
)
def role_lookup(spark, sf_dir):
    lineitem, orders, customer, supplier, nation = (
        src.table(spark, sf_dir, t)
        for t in ("lineitem", "orders", "customer", "supplier", "nation")
    )
    legs = (
        lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select("l_orderkey", "l_linenumber", "l_partkey", "s_nationkey", "c_nationkey")
    )
    roles = {"origin": "s_nationkey", "dest": "c_nationkey"}
    attrs = {"n_name": "name", "n_regionkey": "region"}
    return enrich.role_lookup(legs, nation, "n_nationkey", roles, attrs)


@_add(
    "lookup_drop_missing",
    """SELECT doc_id, lang, source, quality, toxic FROM documents JOIN labels USING (doc_id)""",
)
def lookup_drop_missing(spark, sf_dir):
    documents, labels = (src.table(spark, sf_dir, t) for t in ("documents", "labels"))
    attrs = {"quality": "quality", "toxic": "toxic"}
    found = enrich.lookup(documents, labels, ("doc_id", "doc_id"), attrs, on_missing="drop")
    return found.select("doc_id", "lang", "source", "quality", "toxic")


@_add("obt", sql.with_(sql.wide(), "SELECT * FROM wide"))
def obt(spark, sf_dir):
    return wide(spark, sf_dir)


@_add("obt_keep_unmatched", sql.with_(sql.wide("keep"), "SELECT * FROM wide"))
def obt_keep_unmatched(spark, sf_dir):
    return wide(spark, sf_dir, on_missing="keep")


@_add(
    "rejected_flights",
    sql.with_(
        [*sql.prejoin(), sql.AIRPORTS],
        """SELECT * FROM flights
           WHERE origin_airport_iata_code NOT IN (SELECT airport_iata_code FROM airports)
              OR dest_airport_iata_code NOT IN (SELECT airport_iata_code FROM airports)""",
    ),
)
def rejected_flights(spark, sf_dir):
    return pipeline.rejected_flights(flights(spark, sf_dir), airports(spark, sf_dir))


# -- keys ---------------------------------------------------------------------------------------

_LINE = (
    "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, "
    "l_tax, l_returnflag, l_linestatus"
)


@_add(
    "dense_key_lineitem",
    f"""SELECT CAST(row_number() OVER (ORDER BY l_shipdate, {_LINE}) AS BIGINT) AS line_id,
          l_shipdate, {_LINE} FROM lineitem""",
)
def dense_key_lineitem(spark, sf_dir):
    lineitem = src.table(spark, sf_dir, "lineitem").select("l_shipdate", *_LINE.split(", "))
    return keys.dense_key(lineitem, "line_id", ["l_shipdate"])


@_add(
    "dense_key_copies",
    """SELECT CAST(row_number() OVER (ORDER BY l_returnflag, l_linestatus, l_linenumber)
         AS BIGINT) AS line_id, l_returnflag, l_linestatus, l_linenumber FROM lineitem""",
)
def dense_key_copies(spark, sf_dir):
    copies = src.table(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_linenumber"
    )
    return keys.dense_key(copies, "line_id", ["l_returnflag"])


@_add(
    "running_total",
    """SELECT o_orderkey, o_custkey,
         CAST(coalesce(sum(o_custkey) OVER (ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING
           AND 1 PRECEDING), 0) AS BIGINT) AS before FROM orders""",
)
def running_total(spark, sf_dir):
    orders = src.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return keys.running_total(orders, "before", ["o_orderkey"], "o_custkey")


@_add(
    "dim_key_part",
    """SELECT CAST(row_number() OVER (ORDER BY p_brand) AS BIGINT) AS brand_id, p_brand
       FROM (SELECT DISTINCT p_brand FROM part)""",
)
def dim_key_part(spark, sf_dir):
    brands = src.table(spark, sf_dir, "part").select("p_brand").distinct()
    return keys.dim_key(brands, "brand_id", "p_brand")


@_add(
    "hash_key_unique",
    """SELECT count(DISTINCT (l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS n_keys,
         count(*) AS n_rows FROM lineitem""",
)
def hash_key_unique(spark, sf_dir):
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    keyed = keys.hash_key(src.table(spark, sf_dir, "lineitem").select(*cols), "line_key", cols)
    return keyed.agg(
        F.count_distinct("line_key").alias("n_keys"), F.count(F.lit(1)).alias("n_rows")
    )


_PIECE = "CAST(length({t}) AS VARCHAR) || ':' || {t}"


@_add(
    "hash_key_wide",
    f"""SELECT sha256({_PIECE.format(t="CAST(event_id AS VARCHAR)")} || ','
          || {_PIECE.format(t="event_type")} || ',' || {_PIECE.format(t="CAST(user_id AS VARCHAR)")})
          AS event_key, event_id, event_type, user_id FROM events""",
)
def hash_key_wide(spark, sf_dir):
    cols = ["event_id", "event_type", "user_id"]
    return keys.hash_key(
        src.table(spark, sf_dir, "events").select(*cols), "event_key", cols, wide=True
    )


@_add("fast_id_unique", "SELECT count(*) AS n_ids, count(*) AS n_rows FROM orders")
def fast_id_unique(spark, sf_dir):
    marked = keys.fast_id(src.table(spark, sf_dir, "orders").select("o_orderkey"), "row_id")
    return marked.agg(F.count_distinct("row_id").alias("n_ids"), F.count(F.lit(1)).alias("n_rows"))


# -- gold ---------------------------------------------------------------------------------------


@_add("dim_entity", sql.with_(sql.star(), "SELECT * FROM dim_air"))
def dim_entity(spark, sf_dir):
    return pipeline.dim_air(wide(spark, sf_dir))


@_add("dim_role_union", sql.with_(sql.star(), "SELECT * FROM dim_apt"))
def dim_role_union(spark, sf_dir):
    return pipeline.dim_apt(wide(spark, sf_dir))


@_add("dim_date", sql.dates("events", "ts"))
def dim_date(spark, sf_dir):
    return star.date_dim(src.table(spark, sf_dir, "events"), "ts", ct.HOLIDAYS_2015)


@_add("dim_date_sunday1", sql.dates("orders", "o_orderdate", "dayofweek(d) + 1"))
def dim_date_sunday1(spark, sf_dir):
    return star.date_dim(
        src.table(spark, sf_dir, "orders"), "o_orderdate", ct.HOLIDAYS_2015, "sunday1"
    )


@_add(
    "dim_date_holiday_table",
    sql.dates(
        "lineitem",
        "l_shipdate",
        off="SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderpriority = '1-URGENT'",
    ),
)
def dim_date_holiday_table(spark, sf_dir):
    days_off = (
        src.table(spark, sf_dir, "orders")
        .where("o_orderpriority = '1-URGENT'")
        .select(F.to_date("o_orderdate").alias("day"))
    )
    return star.date_dim(src.table(spark, sf_dir, "lineitem"), "l_shipdate", days_off)


@_add("dim_date_silver", sql.with_(sql.star(), "SELECT * FROM dim_dat"))
def dim_date_silver(spark, sf_dir):
    return pipeline.dim_dat(wide(spark, sf_dir))


@_add("fact_keys", sql.with_(sql.star(), "SELECT * FROM fat_flt"))
def fact_keys(spark, sf_dir):
    return gold(spark, sf_dir)["fat_flt"]


def _short(name):
    return lambda spark, sf_dir: pipeline.to_mnemonic(gold(spark, sf_dir))[name]


for _name in ct.MNEMONICS:
    ENTRIES[f"mnemonic_{_name}"] = Entry(_short(_name), sql.mnemonic(_name))


@_add(
    "delay_by_airline",
    sql.with_(
        sql.star(),
        """SELECT airline_name, count(*) AS flights,
             round(avg(arrival_delay), 6) AS avg_arrival_delay,
             round(100.0 * count(*) FILTER (arrival_delay > 15) / count(*), 6) AS pct_late,
             count(*) FILTER (is_overnight_flight) AS overnight,
             round(sum(air_system_delay + security_delay + airline_delay + late_aircraft_delay
               + weather_delay), 6) AS reason_minutes
           FROM fat_flt JOIN dim_air USING (airline_id) GROUP BY airline_name""",
    ),
)
def delay_by_airline(spark, sf_dir):
    tables = gold(spark, sf_dir)
    named = enrich.lookup(
        tables["fat_flt"],
        tables["dim_air"],
        ("airline_id", "airline_id"),
        {"airline_name": "airline_name"},
        on_missing="drop",
    )
    rows = F.count(F.lit(1))
    return rounded(
        named.groupBy("airline_name").agg(
            rows.alias("flights"),
            F.avg("arrival_delay").alias("avg_arrival_delay"),
            (F.count_if(F.col("arrival_delay") > 15) * 100.0 / rows).alias("pct_late"),
            F.count_if("is_overnight_flight").alias("overnight"),
            F.sum(nz.row_sum([F.col(c) for c in ct.REASONS])).alias("reason_minutes"),
        )
    )
