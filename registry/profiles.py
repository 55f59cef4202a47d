"""Queries over the profiling operators."""

from pyspark.sql import functions as F

from registry import inputs as src, layers, sql
from registry.entry import Entry, rounded
from tristrata.functions import normalize as nz
from tristrata.operators import clean, enrich, profile as pf
from tristrata.plans import contracts as ct, reports
from tristrata.sources import scratch

ENTRIES: dict[str, Entry] = {}


def _add(name: str, text: str | None = None):
    def register(build):
        ENTRIES[name] = Entry(build, text)
        return build

    return register


def _raw(spark, sf_dir):
    """Raw flights as a written table, for profiles that read them more than once."""
    return scratch.table(src.raw_flights(spark, sf_dir), "raw_flights")


def _union(lines: list[str]) -> str:
    return "\nUNION ALL\n".join(lines)


def _pct(part: str, whole: str, places: int = 2) -> str:
    return f"round({part} * 100.0 / {whole}, {places})"


# -- values -------------------------------------------------------------------------------------


@_add(
    "value_counts_share",
    f"""SELECT event_type, count(*) AS n,
          {_pct('count(*)', '(SELECT count(*) FROM events WHERE event_type IS NOT NULL)')} AS share
        FROM events WHERE event_type IS NOT NULL GROUP BY event_type""",
)
def value_counts_share(spark, sf_dir):
    return pf.value_counts(src.table(spark, sf_dir, "events"), "event_type")


@_add(
    "value_counts_airline",
    sql.with_(
        [sql.RAW],
        f"""SELECT airline, count(*) AS n,
              {_pct('count(*)', '(SELECT count(*) FROM lineitem)')} AS share
            FROM raw_flights GROUP BY airline""",
    ),
)
def value_counts_airline(spark, sf_dir):
    return pf.value_counts(_raw(spark, sf_dir), "airline")


@_add("distinct_values", "SELECT DISTINCT p_brand FROM part")
def distinct_values(spark, sf_dir):
    return pf.distinct_values(src.table(spark, sf_dir, "part"), "p_brand")


_PAGES = ["page_id", "url", "html"]
_LINEITEM = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
    "l_returnflag l_linestatus l_shipdate"
).split()


def _cardinality(table: str, cols: list[str]) -> str:
    return _union(
        [f'SELECT \'{c}\' AS "column", count(DISTINCT {c}) AS n_unique FROM {table}' for c in cols]
    )


@_add("cardinality", _cardinality("lineitem", _LINEITEM))
def cardinality(spark, sf_dir):
    return pf.cardinality(src.table(spark, sf_dir, "lineitem"))


@_add("cardinality_pages", _cardinality("pages", _PAGES))
def cardinality_pages(spark, sf_dir):
    return pf.cardinality(src.table(spark, sf_dir, "pages"), _PAGES)


_ALL = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@_add("cardinality_approx", _union([f"""SELECT '{c}' AS "column", TRUE AS within FROM lineitem HAVING count(*) > 0""" for c in _ALL]))
def cardinality_approx(spark, sf_dir):
    """Whether each estimate is within three deviations (5 % each) of the exact number."""
    lineitem = src.table(spark, sf_dir, "lineitem").select(*_ALL)
    both = pf.cardinality(lineitem, approx=True).join(pf.cardinality(lineitem).withColumnRenamed("n_unique", "exact"), "column")
    return both.select("column", (F.abs(F.col("n_unique") - F.col("exact")) <= 0.15 * F.col("exact")).alias("within"))


@_add(
    "pattern_violations",
    _union(
        [
            f"""SELECT '{c}' AS "column", {c} AS value, count(*) AS n FROM part
                WHERE NOT regexp_matches({c}, '^[A-Za-zÀ-ÿ\\s\\-\\.'']+$') GROUP BY {c}"""
            for c in ("p_name", "p_brand", "p_type")
        ]
    ),
)
def pattern_violations(spark, sf_dir):
    return pf.pattern_violations(
        src.table(spark, sf_dir, "part"), ["p_name", "p_brand", "p_type"]
    )


# -- missing values -----------------------------------------------------------------------------

_RAW_COLS = list(ct.RAW_FLIGHTS.columns)


def _nulls(table: str, cols: list[str]) -> str:
    return _union(
        [
            f"""SELECT '{c}' AS "column", count(*) FILTER ({c} IS NULL) AS n_missing,
                {_pct(f'count(*) FILTER ({c} IS NULL)', 'count(*)')} AS pct_missing FROM {table}"""
            for c in cols
        ]
    )


@_add("null_summary", sql.with_([sql.RAW], _nulls("raw_flights", _RAW_COLS)))
def null_summary(spark, sf_dir):
    return pf.null_summary(src.raw_flights(spark, sf_dir))


_DELAYS = [c for c in _RAW_COLS if c.endswith("_delay")]


@_add("null_summary_family", sql.with_([sql.RAW], _nulls("raw_flights", _DELAYS)))
def null_summary_family(spark, sf_dir):
    raw = src.raw_flights(spark, sf_dir)
    return pf.null_summary(raw, pf.family(raw, "_delay"))


@_add(
    "null_family_share",
    sql.with_(
        [sql.RAW, ("n", _nulls("raw_flights", _RAW_COLS))],
        f"""SELECT CASE WHEN "column" LIKE '%\\_delay' ESCAPE '\\' THEN '*_delay' ELSE 'other' END
              AS family, CAST(sum(n_missing) AS BIGINT) AS n_missing,
              {_pct('sum(n_missing)', '(SELECT sum(n_missing) FROM n)')} AS share FROM n GROUP BY 1""",
    ),
)
def null_family_share(spark, sf_dir):
    return pf.null_family_share(_raw(spark, sf_dir), "_delay")


_TIMES = ["departure_time", "arrival_time", "air_system_delay"]


@_add(
    "null_rate_by",
    sql.with_(
        [sql.RAW],
        _union(
            [
                f"""SELECT diverted, '{c}' AS "column",
                    round(avg(CAST({c} IS NULL AS INT)) * 100, 6) AS pct_missing
                    FROM raw_flights WHERE diverted IS NOT NULL GROUP BY diverted"""
                for c in _TIMES
            ]
        ),
    ),
)
def null_rate_by(spark, sf_dir):
    return rounded(pf.null_rate_by(src.raw_flights(spark, sf_dir), "diverted", _TIMES))


@_add(
    "non_null_counts",
    sql.with_(
        [sql.RAW],
        _union(
            [
                f"""SELECT '{c}' AS "column", count({c}) AS n_known FROM raw_flights
                    WHERE CAST(arrival_delay AS DOUBLE) <= 0"""
                for c in ct.REASONS
            ]
        ),
    ),
)
def non_null_counts(spark, sf_dir):
    raw = src.raw_flights(spark, sf_dir)
    on_time = raw.where(nz.num(F.col("arrival_delay"), "double") <= 0)
    return pf.non_null_counts(on_time, list(ct.REASONS))


@_add(
    "count_where",
    f"""SELECT count(*) FILTER (quality IS NULL AND lang = 'en') AS n
        FROM documents LEFT JOIN labels USING (doc_id)""",
)
def count_where(spark, sf_dir):
    documents, labels = (src.table(spark, sf_dir, t) for t in ("documents", "labels"))
    both = documents.join(labels, "doc_id", "left")
    return pf.count_where(both, F.col("quality").isNull() & (F.col("lang") == "en"))


_HOLES = [
    "departure_time",
    "arrival_time",
    "diverted",
    "cancellation_reason",
    "air_system_delay",
    "weather_delay",
]


def _corr_steps(cols: list[str]) -> list[tuple[str, str]]:
    flags = ", ".join(f"CAST({c} IS NULL AS DOUBLE) AS {c}" for c in cols)
    pairs = _union(
        [
            f"""SELECT '{a}' AS col_1, '{b}' AS col_2, CASE WHEN stddev_pop({a}) > 0
                AND stddev_pop({b}) > 0 THEN round(corr({a}, {b}), 6) END AS corr FROM flags"""
            for a in cols
            for b in cols
        ]
    )
    return [sql.RAW, ("flags", f"SELECT {flags} FROM raw_flights"), ("pairs", pairs)]


@_add(
    "missingness_corr",
    sql.with_(_corr_steps(_HOLES), "SELECT * FROM pairs WHERE corr IS NOT NULL"),
)
def missingness_corr(spark, sf_dir):
    narrow = src.raw_flights(spark, sf_dir).select(*_HOLES, "airline")
    return rounded(pf.missingness_corr(scratch.table(narrow, "holes")))


@_add(
    "corr_pairs",
    sql.with_(
        _corr_steps([*_HOLES, "security_delay", "airline_delay", "late_aircraft_delay"]),
        """SELECT * FROM pairs WHERE col_1 <> col_2 AND corr > 0.85
           ORDER BY corr DESC, col_1, col_2 LIMIT 15""",
    ),
)
def corr_pairs(spark, sf_dir):
    return rounded(pf.corr_pairs(_raw(spark, sf_dir)))


# -- distributions ------------------------------------------------------------------------------

_STATS = ("mean", "std", "min", "p25", "p50", "p75", "max")


def _numbers(table: str, cols: list[str]) -> list[str]:
    quartiles = ", ".join(
        f"round(quantile_cont(CAST({{c}} AS DOUBLE), {q}), 6) AS {p}"
        for p, q in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))
    )
    line = (
        'SELECT \'{c}\' AS "column", count({c}) AS count, CAST(NULL AS BIGINT) AS "unique", '
        "CAST(NULL AS VARCHAR) AS top, CAST(NULL AS BIGINT) AS freq, "
        "round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
        "round(CAST(min({c}) AS DOUBLE), 6) AS min, "
        + quartiles
        + ", round(CAST(max({c}) AS DOUBLE), 6) AS max FROM {t}"
    )
    return [line.format(c=c, t=table) for c in cols]


def _texts(table: str, cols: list[str]) -> list[str]:
    empty = ", ".join(f"CAST(NULL AS DOUBLE) AS {s}" for s in _STATS)
    return [
        f"""SELECT '{c}' AS "column", (SELECT count({c}) FROM {table}) AS count,
            (SELECT count(DISTINCT {c}) FROM {table}) AS "unique", value AS top, n AS freq, {empty}
            FROM (SELECT CAST({c} AS VARCHAR) AS value, count(*) AS n FROM {table}
                  WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY n DESC, value LIMIT 1)"""
        for c in cols
    ]


@_add(
    "describe",
    _union(
        [
            f"SELECT * FROM ({q})"
            for q in [
                *_numbers("part", ["p_partkey", "p_size", "p_retailprice"]),
                *_texts("part", ["p_name", "p_brand", "p_type"]),
            ]
        ]
    ),
)
def describe(spark, sf_dir):
    return rounded(pf.describe(src.table(spark, sf_dir, "part")))


@_add(
    "describe_orders",
    sql.with_(
        [("o", "SELECT o_orderkey, o_custkey, CAST(epoch(o_orderdate) AS BIGINT) AS o_orderdate FROM orders")],
        _union(_numbers("o", ["o_orderkey", "o_custkey", "o_orderdate"])),
    ),
)
def describe_orders(spark, sf_dir):
    cols = ["o_orderkey", "o_custkey", "o_orderdate"]
    return rounded(pf.describe(src.table(spark, sf_dir, "orders"), cols))


def _stats(columns: str) -> str:
    return f'SELECT "column", count, {columns} FROM '


@_add(
    "describe_numbers",
    _union(
        [
            f"SELECT \"column\", count, {', '.join(_STATS)} FROM ({q})"
            for q in _numbers("lineitem", ["l_quantity", "l_extendedprice", "l_discount"])
        ]
    ),
)
def describe_numbers(spark, sf_dir):
    cols = ["l_quantity", "l_extendedprice", "l_discount"]
    return rounded(pf.describe_numbers(src.table(spark, sf_dir, "lineitem"), cols))


_EXACT = '"column", count, "unique", top, freq, mean, std, min, max'


@_add(
    "describe_approx",
    _union(
        [f"SELECT {_EXACT}, TRUE AS near FROM ({q})" for q in _numbers("part", ["p_partkey", "p_size", "p_retailprice"])]
        + [f"SELECT {_EXACT}, CAST(NULL AS BOOLEAN) AS near FROM ({q})" for q in _texts("part", ["p_name", "p_brand", "p_type"])]
    ),
)
def describe_approx(spark, sf_dir):
    """Whether each approximate quartile, a value of the table, is within a twentieth of the value range of the exact one."""
    part = src.table(spark, sf_dir, "part")
    exact = pf.describe(part).select(F.col("column").alias("_c"), *(F.col(p).alias(f"_{p}") for p in ("p25", "p50", "p75")))
    found = pf.describe(part, approx=True).join(exact, F.col("column") == F.col("_c"))
    off = F.greatest(*(F.abs(F.col(p) - F.col(f"_{p}")) for p in ("p25", "p50", "p75")))
    near = (off <= 0.05 * (F.col("max") - F.col("min"))).alias("near")
    return rounded(found.select("column", "count", "unique", "top", "freq", "mean", "std", "min", "max", near))


@_add(
    "describe_text",
    _union(
        [
            f"""SELECT "column", count, "unique", top, freq FROM ({q})"""
            for q in _texts("documents", ["lang", "source", "text"])
        ]
    ),
)
def describe_text(spark, sf_dir):
    return pf.describe_text(src.table(spark, sf_dir, "documents"), ["lang", "source", "text"])


@_add(
    "describe_times",
    """SELECT 'o_orderdate' AS "column", count(o_orderdate) AS count,
         make_timestamp(CAST(round(avg(epoch(o_orderdate))) * 1000000 AS BIGINT)) AS mean, min(o_orderdate) AS min, """
    + ", ".join(
        f"make_timestamp(CAST(quantile_cont(epoch(o_orderdate), {q}) * 1000000 AS BIGINT)) AS {p}"
        for p, q in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))
    )
    + ", max(o_orderdate) AS max FROM orders",
)
def describe_times(spark, sf_dir):
    stats = pf.describe_times(src.table(spark, sf_dir, "orders"), ["o_orderdate"])
    # The mean to the second, as sums of fractions differ in their last digits.
    return stats.withColumn("mean", F.date_trunc("second", F.col("mean") + F.expr("INTERVAL 0.5 SECOND")).cast("timestamp_ntz"))


@_add(
    "describe_difference",
    sql.with_(
        [
            *sql.prejoin(),
            (
                "d",
                """SELECT elapsed_time - (taxi_out + air_time + taxi_in) AS time_difference
                   FROM flights WHERE elapsed_time <> taxi_out + air_time + taxi_in""",
            ),
        ],
        _numbers("d", ["time_difference"])[0],
    ),
)
def describe_difference(spark, sf_dir):
    timed = layers.flights(spark, sf_dir).select(reports.elapsed_difference().alias("time_difference"))
    off = timed.where("time_difference IS NOT NULL")
    return rounded(pf.describe(scratch.table(off, "difference")))


_PAIRS = [("l_quantity", "l_extendedprice"), ("l_discount", "l_tax")]


def _fits(table: str, pairs: list[tuple[str, str]]) -> str:
    return _union(
        [
            f"""SELECT '{x}' AS x, '{y}' AS y, CAST(regr_count({y}, {x}) AS BIGINT) AS n,
                round(regr_slope({y}, {x}), 6) AS slope,
                round(regr_intercept({y}, {x}), 6) AS intercept,
                round(regr_r2({y}, {x}), 6) AS r2 FROM {table}"""
            for x, y in pairs
        ]
    )


@_add("linear_fit", _fits("lineitem", _PAIRS))
def linear_fit(spark, sf_dir):
    return rounded(pf.linear_fit(src.table(spark, sf_dir, "lineitem"), _PAIRS))


@_add("linear_fit_delays", sql.with_(sql.prejoin(), _fits("flights", reports.FIT_PAIRS)))
def linear_fit_delays(spark, sf_dir):
    return rounded(pf.linear_fit(layers.flights(spark, sf_dir), reports.FIT_PAIRS))


# -- duplicates ---------------------------------------------------------------------------------


@_add(
    "duplicate_count",
    "SELECT count(*) - count(DISTINCT text) AS n_duplicates FROM documents",
)
def duplicate_count(spark, sf_dir):
    return pf.duplicate_count(src.table(spark, sf_dir, "documents"), ["text"])


@_add(
    "duplicate_count_rows",
    """SELECT (SELECT count(*) FROM lineitem) - count(*) AS n_duplicates
       FROM (SELECT DISTINCT * FROM lineitem)""",
)
def duplicate_count_rows(spark, sf_dir):
    return pf.duplicate_count(src.table(spark, sf_dir, "lineitem"))


@_add(
    "duplicate_counts_by_column",
    sql.with_(
        [("d", "SELECT * FROM documents LEFT JOIN labels USING (doc_id)")],
        _union(
            [
                f"""SELECT '{c}' AS "column", count(*) - count(DISTINCT {c})
                    - CAST(count(*) > count({c}) AS BIGINT) AS n_duplicates FROM d"""
                for c in ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic")
            ]
        ),
    ),
)
def duplicate_counts_by_column(spark, sf_dir):
    documents, labels = (src.table(spark, sf_dir, t) for t in ("documents", "labels"))
    return pf.duplicate_counts_by_column(documents.join(labels, "doc_id", "left"))


@_add(
    "duplicate_members",
    """SELECT doc_id, lang, source, n_chars FROM documents WHERE text IN
         (SELECT text FROM documents GROUP BY text HAVING count(*) > 1)""",
)
def duplicate_members(spark, sf_dir):
    members = pf.duplicate_members(src.table(spark, sf_dir, "documents"), ["text"])
    return members.drop("text")


_KEY = reports.NATURAL_KEY
_KEY_LIST = ", ".join(_KEY)


@_add(
    "key_collisions",
    sql.with_(
        [sql.RAW],
        f"""SELECT {_KEY_LIST}, CAST(sum(cnt) AS BIGINT) AS n_rows, count(*) = 1 AS identical FROM
              (SELECT {', '.join(_RAW_COLS)}, count(*) AS cnt FROM raw_flights GROUP BY ALL)
            GROUP BY {_KEY_LIST} HAVING sum(cnt) > 1""",
    ),
)
def key_collisions(spark, sf_dir):
    return pf.key_collisions(src.raw_flights(spark, sf_dir), _KEY)


@_add(
    "collisions_identical",
    """SELECT coalesce(bool_and(v = 1), TRUE) AS all_identical FROM
         (SELECT count(*) AS v, sum(n) AS n FROM
           (SELECT text, lang, count(*) AS n FROM documents GROUP BY text, lang) GROUP BY text)
       WHERE n > 1""",
)
def collisions_identical(spark, sf_dir):
    contents = src.table(spark, sf_dir, "documents").select("text", "lang")
    return pf.all_collisions_identical(contents, ["text"])


@_add(
    "topk_collisions",
    """SELECT l_orderkey, l_linenumber, count(*) AS cnt FROM lineitem
       GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
       ORDER BY cnt DESC, l_orderkey, l_linenumber LIMIT 5""",
)
def topk_collisions(spark, sf_dir):
    return pf.top_collisions(
        src.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], 5
    )


@_add(
    "rows_of_key",
    """SELECT user_id, event_type, ts, event_id, value FROM events
       WHERE user_id = 7 AND event_type = 'click'""",
)
def rows_of_key(spark, sf_dir):
    rows = pf.rows_of_key(
        src.table(spark, sf_dir, "events"),
        {"user_id": 7, "event_type": "click"},
        ["ts", "event_id"],
    )
    return rows.select("user_id", "event_type", "ts", "event_id", "value")


@_add(
    "semi_rows_for_keys",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
       SEMI JOIN (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1) d
       USING (l_orderkey, l_linenumber)""",
)
def semi_rows_for_keys(spark, sf_dir):
    cols = ["l_orderkey", "l_linenumber"]
    lineitem = src.table(spark, sf_dir, "lineitem")
    found = enrich.rows_for_keys(lineitem, pf.duplicate_keys(lineitem, cols), cols)
    return found.select(*cols, "l_partkey", "l_suppkey")


@_add(
    "key_difference",
    """SELECT DISTINCT c_custkey AS key FROM customer
       ANTI JOIN orders ON c_custkey = o_custkey""",
)
def key_difference(spark, sf_dir):
    customer, orders = (src.table(spark, sf_dir, t) for t in ("customer", "orders"))
    return enrich.key_difference(customer, orders, "c_custkey", "o_custkey")


@_add(
    "require_values",
    """SELECT doc_id, lang, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)
       WHERE lang IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL""",
)
def require_values(spark, sf_dir):
    documents, labels = (src.table(spark, sf_dir, t) for t in ("documents", "labels"))
    both = documents.select("doc_id", "lang").join(labels, "doc_id", "left")
    return clean.require_values(both, ["lang", "quality", "toxic"])


# -- samples and shape --------------------------------------------------------------------------


_IDS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
_PLACE = f"md5(concat_ws('|', {', '.join(_IDS)}, '42'))"


@_add("sample_n", f"SELECT * FROM lineitem ORDER BY {_PLACE}, {', '.join(_IDS)} LIMIT 5000")
def sample_n(spark, sf_dir):
    lineitem = src.table(spark, sf_dir, "lineitem")
    return pf.sample_n(lineitem, 5000, _IDS)


@_add(
    "sample_fraction",
    f"SELECT * FROM lineitem WHERE CAST('0x' || substr({_PLACE}, 1, 8) AS BIGINT) < 0.1 * 4294967296",
)
def sample_fraction(spark, sf_dir):
    return pf.sample_fraction(src.table(spark, sf_dir, "lineitem"), 0.1, 42, _IDS)


@_add("bounded_scan", f"SELECT * FROM lineitem ORDER BY {', '.join(_LINEITEM)} LIMIT 20")
def bounded_scan(spark, sf_dir):
    """The first rows in a given order, as many as the caller asks for."""
    return pf.preview(src.table(spark, sf_dir, "lineitem").orderBy(*_LINEITEM), 20)


@_add("dimensions", "SELECT count(*) AS n_rows, 11 AS n_columns FROM lineitem")
def dimensions(spark, sf_dir):
    return pf.dimensions(src.table(spark, sf_dir, "lineitem"))


_PART = {"p_partkey": "bigint", "p_name": "string", "p_brand": "string", "p_type": "string",
         "p_size": "int", "p_retailprice": "double"}


@_add(
    "column_types",
    _union(
        [
            f"""SELECT {i + 1} AS position, '{c}' AS "column", '{t}' AS type,
                count({c}) AS n_known FROM part"""
            for i, (c, t) in enumerate(_PART.items())
        ]
    ),
)
def column_types(spark, sf_dir):
    return pf.column_types(src.table(spark, sf_dir, "part").select(*_PART))
