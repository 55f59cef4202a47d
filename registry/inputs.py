"""Raw relations of the flight model, derived from the given tables.

The SQL runs unchanged on both engines but for the weekday function and the way tables are
named, so the same text feeds the Spark queries and their SQL counterparts. Orders grow with the
line items, so their join is a shuffle at every size, never a broadcast of what happens to be small.
"""

from pyspark.sql import DataFrame, SparkSession

from tristrata.operators import clean

TABLES = ("lineitem", "orders", "customer", "supplier", "nation", "region")

RAW_FLIGHTS = """
WITH base AS (
  SELECT /*+ SHUFFLE_HASH(o) */ l.l_orderkey*31 + l.l_linenumber*7 + l.l_partkey AS k,
         l.l_shipdate, l.l_suppkey, l.l_orderkey, l.l_linenumber,
         s.s_nationkey, c.c_nationkey
  FROM {lineitem} l
  JOIN {orders} o   ON l.l_orderkey = o.o_orderkey
  JOIN {customer} c ON o.o_custkey  = c.c_custkey
  JOIN {supplier} s ON l.l_suppkey  = s.s_suppkey
), mins AS (
  SELECT *, (k*37) % 1440 AS sd, (k*37 + k % 19) % 1440 AS dp,
         60 + k % 300 AS dur
  FROM base
), m2 AS (
  SELECT *, (sd + dur) % 1440 AS sa, (dp + dur + k % 11) % 1440 AS ar
  FROM mins
), hm AS (
  SELECT *,
    lpad(CAST(CAST((sd - sd % 60)/60 AS BIGINT)*100 + sd % 60 AS STRING),4,'0') AS sd_h,
    lpad(CAST(CAST((dp - dp % 60)/60 AS BIGINT)*100 + dp % 60 AS STRING),4,'0') AS dp_h,
    lpad(CAST(CAST((sa - sa % 60)/60 AS BIGINT)*100 + sa % 60 AS STRING),4,'0') AS sa_h,
    lpad(CAST(CAST((ar - ar % 60)/60 AS BIGINT)*100 + ar % 60 AS STRING),4,'0') AS ar_h
  FROM m2
)
SELECT
  CAST(year(l_shipdate) AS STRING) AS year, CAST(month(l_shipdate) AS STRING) AS month,
  CAST(day(l_shipdate) AS STRING) AS day,   CAST({weekday} AS STRING) AS day_of_week,
  'A' || lpad(CAST(l_suppkey % 14 AS STRING),2,'0') AS airline,
  CAST(l_orderkey % 9000 AS STRING) AS flight_number,
  'T' || CAST(k % 500 AS STRING) AS tail_number,
  CASE WHEN k % 41 = 0 THEN '10397'
       ELSE 'N' || lpad(CAST(s_nationkey AS STRING),2,'0') END AS origin_airport,
  CASE WHEN k % 43 = 0 THEN '12892'
       ELSE 'N' || lpad(CAST(c_nationkey AS STRING),2,'0') END AS destination_airport,
  sd_h AS scheduled_departure,
  CASE WHEN k % 37 = 0 THEN NULL WHEN k % 53 = 0 THEN ar_h WHEN dp = 0 THEN '2400'
       WHEN k % 5 = 0 THEN dp_h || '.0' ELSE dp_h END AS departure_time,
  CAST(k % 19 AS STRING) AS departure_delay, CAST(10 + k % 9 AS STRING) AS taxi_out,
  dp_h AS wheels_off, CAST(dur AS STRING) AS scheduled_time,
  CASE WHEN k % 61 = 0 THEN CAST(dur + 1 AS STRING) ELSE CAST(dur AS STRING) END AS elapsed_time,
  CAST(dur - 15 - k % 9 AS STRING) AS air_time, CAST(100 + k % 2400 AS STRING) AS distance,
  ar_h AS wheels_on, '5' AS taxi_in, sa_h AS scheduled_arrival,
  CASE WHEN k % 37 = 0 THEN NULL WHEN k % 53 = 0 THEN dp_h WHEN ar = 0 THEN '2400'
       ELSE ar_h END AS arrival_time,
  CAST(k % 19 + k % 11 AS STRING) AS arrival_delay,
  CASE WHEN k % 31 = 0 THEN '1' WHEN k % 997 = 0 THEN NULL ELSE '0' END AS diverted,
  CASE WHEN k % 29 = 0 THEN '1' ELSE '0' END AS cancelled,
  CASE WHEN k % 29 = 0 THEN 'B' END AS cancellation_reason,
  CASE WHEN k % 19 + k % 11 >= 15 THEN CAST(k % 11 AS STRING) END AS air_system_delay,
  CASE WHEN k % 19 + k % 11 >= 15 THEN '0' END AS security_delay,
  CASE WHEN k % 19 + k % 11 >= 15
       THEN CAST(k % 19 + CASE WHEN k % 67 = 0 THEN 9 ELSE 0 END AS STRING) END AS airline_delay,
  CASE WHEN k % 19 + k % 11 >= 15 THEN '0' END AS late_aircraft_delay,
  CASE WHEN k % 19 + k % 11 >= 15 THEN '0' END AS weather_delay
FROM hm
"""

RAW_AIRLINES = """
SELECT DISTINCT 'A' || lpad(CAST(s_suppkey % 14 AS STRING),2,'0') AS iata_code,
       'Airline ' || CAST(s_suppkey % 14 AS STRING) AS airline
FROM {supplier}
"""

# Nation 24 is left out, so flights there have an unknown airport.
RAW_AIRPORTS = """
SELECT 'N' || lpad(CAST(n_nationkey AS STRING),2,'0') AS iata_code,
       n_name || ' Field' AS airport, r_name AS city, substr(n_name,1,2) AS state,
       'USA' AS country,
       CASE WHEN n_nationkey % 8 = 3 THEN NULL
            ELSE CAST(10 + n_nationkey AS STRING) || '.5' END AS latitude,
       CASE WHEN n_nationkey % 8 = 3 THEN ''
            ELSE '-' || CAST(70 + n_nationkey AS STRING) || '.25' END AS longitude
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
WHERE n_nationkey <> 24
"""

AIRPORT_FIXES = """
SELECT 'N' || lpad(CAST(n_nationkey AS STRING),2,'0') AS airport_iata_code,
       CAST(40 + n_nationkey AS DOUBLE) AS latitude,
       CAST(-80 - n_nationkey AS DOUBLE) AS longitude
FROM {nation} WHERE n_nationkey % 8 = 3
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _run(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    used = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text.replace("{weekday}", "(weekday(l_shipdate)+1)"), **used)


def raw_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settled, so that filters on the raw text do not repeat how it was derived."""
    flags = ["origin_airport", "destination_airport", "cancelled", "diverted"]
    return clean.settled(_run(spark, sf_dir, RAW_FLIGHTS), flags)


def raw_airlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, RAW_AIRLINES)


def raw_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, RAW_AIRPORTS)


def airport_fixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, AIRPORT_FIXES)


def plain_sql(text: str) -> str:
    """The same text over views that carry the tables' own names."""
    names = {t: t for t in TABLES}
    return text.format(weekday="isodow(l_shipdate)", **names).strip()
