"""Queries over the quality gates: offending rows or keys, counts, and whole suites."""

from pyspark.sql import functions as F

from registry import inputs as src, layers, sql
from registry.entry import Entry, rounded
from tristrata.operators import gates as gt
from tristrata.plans import contracts as ct, suites
from tristrata.sources import scratch

ENTRIES: dict[str, Entry] = {}


def _add(name: str, text: str | None = None):
    def register(build):
        ENTRIES[name] = Entry(build, text)
        return build

    return register


def _legs(spark, sf_dir):
    """Line items with their order date and the nations of both ends."""
    lineitem, orders, customer, supplier = (
        src.table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer", "supplier")
    )
    return (
        lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    )


def _labelled(spark, sf_dir):
    """Documents with their label; most have none."""
    documents, labels = (src.table(spark, sf_dir, t) for t in ("documents", "labels"))
    return documents.select("doc_id", "lang", "n_chars").join(labels, "doc_id", "left")


LEGS = """lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey"""
LABELLED = "documents LEFT JOIN labels USING (doc_id)"


@_add(
    "gate_not_empty",
    """SELECT 'not_empty' AS gate, 'lineitem' AS dataset, CAST(count(*) = 0 AS BIGINT)
       AS violations, count(*) > 0 AS passed FROM lineitem""",
)
def gate_not_empty(spark, sf_dir):
    return gt.run(src.table(spark, sf_dir, "lineitem"), [gt.not_empty()], "lineitem")


@_add(
    "gate_not_empty_fails",
    "SELECT count(*) AS row_count FROM lineitem WHERE l_quantity < 0 HAVING count(*) = 0",
)
def gate_not_empty_fails(spark, sf_dir):
    none = src.table(spark, sf_dir, "lineitem").where("l_quantity < 0")
    return gt.violations(none, gt.not_empty())


@_add(
    "gate_required_columns",
    """SELECT c AS missing_column FROM (VALUES ('event_id'), ('ts'), ('session_id'), ('value'))
       AS v(c) WHERE c NOT IN (SELECT lower(column_name) FROM (DESCRIBE events))""",
)
def gate_required_columns(spark, sf_dir):
    wanted = ["EVENT_ID", "ts", "session_id", "value"]
    return gt.violations(src.table(spark, sf_dir, "events"), gt.required_columns(wanted))


@_add(
    "gate_not_null",
    f"SELECT doc_id, lang, n_chars, quality, toxic FROM {LABELLED} WHERE quality IS NULL "
    "OR toxic IS NULL",
)
def gate_not_null(spark, sf_dir):
    return gt.violations(_labelled(spark, sf_dir), gt.not_null(["quality", "toxic"]))


@_add(
    "gate_not_null_each",
    f"""SELECT * FROM (
        SELECT 'not_null(lang)' AS gate, count(*) FILTER (lang IS NULL) AS violations FROM {LABELLED}
        UNION ALL SELECT 'not_null(quality)', count(*) FILTER (quality IS NULL) FROM {LABELLED}
        UNION ALL SELECT 'not_null(toxic)', count(*) FILTER (toxic IS NULL) FROM {LABELLED})""",
)
def gate_not_null_each(spark, sf_dir):
    gates = gt.not_null_each(["lang", "quality", "toxic"])
    return gt.run(_labelled(spark, sf_dir), gates, "documents").select("gate", "violations")


@_add(
    "gate_unique",
    """SELECT l_orderkey, l_linenumber, count(*) AS cnt FROM lineitem
       GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def gate_unique(spark, sf_dir):
    lineitem = src.table(spark, sf_dir, "lineitem")
    return gt.violations(lineitem, gt.unique(["l_orderkey", "l_linenumber"]))


@_add(
    "gate_unique_column",
    "SELECT text, count(*) AS cnt FROM documents GROUP BY text HAVING count(*) > 1",
)
def gate_unique_column(spark, sf_dir):
    return gt.violations(src.table(spark, sf_dir, "documents"), gt.unique(["text"]))


@_add(
    "gate_full_duplicates",
    """SELECT text, lang, source, n_chars, count(*) AS cnt FROM documents
       GROUP BY text, lang, source, n_chars HAVING count(*) > 1""",
)
def gate_full_duplicates(spark, sf_dir):
    contents = src.table(spark, sf_dir, "documents").drop("doc_id")
    return gt.violations(contents, gt.no_full_duplicates())


_LEG = ["l_orderkey", "l_linenumber", "l_partkey"]


@_add(
    "gate_ordered",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, o_orderdate, l_shipdate FROM {LEGS}
        WHERE o_orderdate >= l_shipdate""",
)
def gate_ordered(spark, sf_dir):
    late = gt.violations(_legs(spark, sf_dir), gt.ordered("o_orderdate", "l_shipdate"))
    return late.select(*_LEG, "o_orderdate", "l_shipdate")


@_add(
    "gate_columns_differ",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, s_nationkey, c_nationkey FROM {LEGS}
        WHERE s_nationkey = c_nationkey""",
)
def gate_columns_differ(spark, sf_dir):
    same = gt.violations(_legs(spark, sf_dir), gt.columns_differ("s_nationkey", "c_nationkey"))
    return same.select(*_LEG, "s_nationkey", "c_nationkey")


@_add("gate_positive", "SELECT * FROM customer WHERE c_acctbal <= 0")
def gate_positive(spark, sf_dir):
    return gt.violations(src.table(spark, sf_dir, "customer"), gt.positive("c_acctbal"))


@_add(
    "gate_positive_absent",
    """SELECT 'positive(distance)' AS gate, 'customer' AS dataset, CAST(0 AS BIGINT) AS violations,
       TRUE AS passed FROM (SELECT count(*) FROM customer)""",
)
def gate_positive_absent(spark, sf_dir):
    return gt.run(src.table(spark, sf_dir, "customer"), [gt.positive("distance")], "customer")


_SUM = " + ".join(ct.REASONS)


@_add(
    "gate_sum_consistency",
    sql.with_(
        sql.prejoin(),
        f"""SELECT * FROM flights WHERE arrival_delay > 0 AND {_SUM} > 0
            AND abs(arrival_delay - ({_SUM})) > 5.0""",
    ),
)
def gate_sum_consistency(spark, sf_dir):
    gate = gt.sum_consistency("arrival_delay", list(ct.REASONS))
    return gt.violations(layers.flights(spark, sf_dir), gate)


@_add(
    "gate_elapsed",
    sql.with_(
        sql.prejoin(),
        """SELECT flight_date, flight_number, elapsed_time, taxi_out, air_time, taxi_in
           FROM flights WHERE elapsed_time <> taxi_out + air_time + taxi_in""",
    ),
)
def gate_elapsed(spark, sf_dir):
    parts = ["taxi_out", "air_time", "taxi_in"]
    gate = gt.sum_consistency("elapsed_time", parts, tol=0.0, only_positive=False)
    off = gt.violations(layers.flights(spark, sf_dir), gate)
    return off.select("flight_date", "flight_number", "elapsed_time", *parts)


@_add(
    "gate_fk",
    """SELECT doc_id AS key, count(*) AS n_rows FROM documents
       WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY doc_id""",
)
def gate_fk(spark, sf_dir):
    documents, labels = (src.table(spark, sf_dir, t) for t in ("documents", "labels"))
    return gt.violations(documents, gt.fk_exists("doc_id", labels, "doc_id"))


def _toxic_keys(spark, sf_dir):
    return src.table(spark, sf_dir, "labels").where("quality = 1").select("toxic").distinct()


@_add(
    "gate_fk_with_nulls",
    f"""SELECT toxic AS key, count(*) AS n_rows FROM {LABELLED}
        WHERE toxic IS NULL OR toxic NOT IN (SELECT toxic FROM labels WHERE quality = 1)
        GROUP BY toxic""",
)
def gate_fk_with_nulls(spark, sf_dir):
    gate = gt.fk_exists("toxic", _toxic_keys(spark, sf_dir), "toxic", ignore_nulls=False)
    return gt.violations(_labelled(spark, sf_dir), gate)


@_add("gate_max_length", "SELECT * FROM part WHERE length(p_name) > 10")
def gate_max_length(spark, sf_dir):
    return gt.violations(src.table(spark, sf_dir, "part"), gt.max_length("p_name", 10))


@_add(
    "gate_castable",
    sql.with_(
        [sql.RAW],
        """SELECT departure_time, count(*) AS n FROM raw_flights
           WHERE nullif(trim(departure_time),'') IS NOT NULL
             AND NOT regexp_matches(departure_time, '^[0-9]+$') GROUP BY departure_time""",
    ),
)
def gate_castable(spark, sf_dir):
    unread = gt.violations(
        src.raw_flights(spark, sf_dir), gt.castable("departure_time", "smallint")
    )
    return unread.groupBy("departure_time").agg(F.count(F.lit(1)).alias("n"))


# -- suites -------------------------------------------------------------------------------------


def _line(gate: str, count: str, source: str, dataset: str) -> str:
    return (
        f"SELECT '{gate}' AS gate, '{dataset}' AS dataset, CAST(n AS BIGINT) AS violations, "
        f"n = 0 AS passed FROM (SELECT {count} AS n FROM {source})"
    )


def _rows(condition: str) -> str:
    return f"count(*) FILTER ({condition})"


def _dups(cols: str, source: str) -> str:
    return f"(SELECT 1 FROM {source} GROUP BY {cols} HAVING count(*) > 1)"


def _missing(col: str, source: str, dim: str, key: str, nulls: bool) -> str:
    extra = "" if nulls else f" AND {col} IS NOT NULL"
    return (
        f"(SELECT DISTINCT {col} FROM {source} s WHERE NOT EXISTS "
        f"(SELECT 1 FROM {dim} d WHERE d.{key} = s.{col}){extra})"
    )


def _union(lines: list[str]) -> str:
    return "\nUNION ALL\n".join(lines)


def _flight_lines(source: str, name: str) -> list[str]:
    return [
        _line(
            "ordered(departure_time,arrival_time)",
            _rows("departure_time >= arrival_time"),
            source,
            name,
        ),
        _line(
            "columns_differ(origin_airport_iata_code,dest_airport_iata_code)",
            _rows("origin_airport_iata_code = dest_airport_iata_code"),
            source,
            name,
        ),
        _line("positive(distance)", _rows("distance <= 0"), source, name),
    ]


_DELAYS = _rows(f"arrival_delay > 0 AND {_SUM} > 0 AND abs(arrival_delay - ({_SUM})) > 5.0")
_NOT_EMPTY = "CAST(count(*) = 0 AS BIGINT)"


@_add(
    "gate_suite_raw",
    sql.with_(
        [sql.RAW],
        _union(
            [
                _line("not_empty", _NOT_EMPTY, "raw_flights", "raw_flights"),
                _line("required_columns", "0", "(SELECT 1)", "raw_flights"),
            ]
        ),
    ),
)
def gate_suite_raw(spark, sf_dir):
    return gt.run(src.raw_flights(spark, sf_dir), suites.raw(ct.RAW_FLIGHTS), "raw_flights")


_BASE = {"airlines": ct.AIRLINES, "airports": ct.AIRPORTS}


def _base_lines(name: str) -> list[str]:
    table = _BASE[name]
    pk = ",".join(table.pk)
    return [
        _line("not_empty", _NOT_EMPTY, name, name),
        _line("required_columns", "0", "(SELECT 1)", name),
        _line(f"not_null({pk})", _rows(f"{pk} IS NULL"), name, name),
        _line(f"unique({pk})", "count(*)", _dups(pk, name), name),
        _line("no_full_duplicates", "count(*)", _dups(",".join(table.columns), name), name),
    ]


@_add(
    "gate_suite_silver_base",
    sql.with_(
        [sql.AIRLINES, sql.AIRPORTS], _union(_base_lines("airlines") + _base_lines("airports"))
    ),
)
def gate_suite_silver_base(spark, sf_dir):
    tables = {
        "airlines": layers.airlines(spark, sf_dir),
        "airports": layers.airports(spark, sf_dir),
    }
    return suites.run_all(tables, {n: suites.silver_base(t) for n, t in _BASE.items()})


@_add(
    "gate_suite_silver_flights",
    sql.with_(
        [*sql.prejoin(), sql.AIRPORTS],
        _union(
            [
                _line("not_empty", _NOT_EMPTY, "flights", "flights"),
                *_flight_lines("flights", "flights"),
                _line("sum_consistency(arrival_delay)", _DELAYS, "flights", "flights"),
                *(
                    _line(
                        f"fk_exists({r}_airport_iata_code)",
                        "count(*)",
                        _missing(
                            f"{r}_airport_iata_code",
                            "flights",
                            "airports",
                            "airport_iata_code",
                            True,
                        ),
                        "flights",
                    )
                    for r in ("origin", "dest")
                ),
            ]
        ),
    ),
)
def gate_suite_silver_flights(spark, sf_dir):
    flights = scratch.table(layers.flights(spark, sf_dir), "flights")
    return gt.run(flights, suites.silver_flights(layers.airports(spark, sf_dir)), "flights")


@_add(
    "gate_suite_planned",
    sql.with_(
        [*sql.prejoin(), sql.AIRLINES],
        _union(
            [
                _line(
                    "sum_consistency(elapsed_time)",
                    _rows("elapsed_time <> taxi_out + air_time + taxi_in"),
                    "flights",
                    "flights",
                ),
                _line(
                    "not_null(elapsed_time,taxi_out,air_time,taxi_in)",
                    _rows("elapsed_time + taxi_out + air_time + taxi_in IS NULL"),
                    "flights",
                    "flights",
                ),
                _line(
                    "fk_exists(airline_iata_code)",
                    "count(*)",
                    _missing("airline_iata_code", "flights", "airlines", "airline_iata_code", False),
                    "flights",
                ),
            ]
        ),
    ),
)
def gate_suite_planned(spark, sf_dir):
    flights = scratch.table(layers.flights(spark, sf_dir), "flights")
    checks = suites.planned_flight_checks(layers.airlines(spark, sf_dir))
    return gt.run(flights, checks, "flights")


def _null_lines(cols, source: str) -> list[str]:
    return [_line(f"not_null({c})", _rows(f"{c} IS NULL"), source, source) for c in cols]


@_add(
    "gate_suite_silver",
    sql.with_(
        sql.wide("keep"),
        _union(
            [
                _line("not_empty", _NOT_EMPTY, "wide", "wide"),
                _line("unique(flight_id)", "count(*)", _dups("flight_id", "wide"), "wide"),
                *_null_lines(ct.SILVER_CRITICAL, "wide"),
                *_flight_lines("wide", "wide"),
            ]
        ),
    ),
)
def gate_suite_silver(spark, sf_dir):
    wide = layers.wide(spark, sf_dir, on_missing="keep")
    return gt.run(wide, suites.silver_wide(), "wide")


def _any_null(cols) -> str:
    return _rows(" OR ".join(f"{c} IS NULL" for c in cols))


@_add(
    "gate_suite_silver_declared",
    sql.with_(
        sql.wide("keep"),
        _union(
            [
                _line("not_empty", _NOT_EMPTY, "wide", "wide"),
                _line("not_null(flight_id)", _rows("flight_id IS NULL"), "wide", "wide"),
                _line("unique(flight_id)", "count(*)", _dups("flight_id", "wide"), "wide"),
                _line(
                    "no_full_duplicates",
                    "count(*)",
                    _dups(",".join(ct.SILVER_FLIGHTS.columns), "wide"),
                    "wide",
                ),
                *_flight_lines("wide", "wide"),
                _line("sum_consistency(arrival_delay)", _DELAYS, "wide", "wide"),
                _line(
                    f"not_null({','.join(ct.SILVER_CRITICAL)})",
                    _any_null(ct.SILVER_CRITICAL),
                    "wide",
                    "wide",
                ),
            ]
        ),
    ),
)
def gate_suite_silver_declared(spark, sf_dir):
    wide = layers.wide(spark, sf_dir, on_missing="keep")
    return gt.run(wide, suites.silver_wide_declared(), "wide")


_CONTRACT = ct.SILVER_FLIGHTS


@_add(
    "gate_suite_contract",
    sql.with_(
        sql.wide("keep"),
        _union(
            [
                _line("not_empty", _NOT_EMPTY, "wide", "silver_flights"),
                _line("required_columns", "0", "(SELECT 1)", "silver_flights"),
                *(
                    _line(f"not_null({c})", _rows(f"{c} IS NULL"), "wide", "silver_flights")
                    for c in dict.fromkeys([*_CONTRACT.pk, *_CONTRACT.not_null])
                ),
                _line("unique(flight_id)", "count(*)", _dups("flight_id", "wide"), "silver_flights"),
                *(
                    _line(f"max_length({c},{n})", _rows(f"length({c}) > {n}"), "wide",
                          "silver_flights")
                    for c, n in _CONTRACT.max_len.items()
                ),
            ]
        ),
    ),
)
def gate_suite_contract(spark, sf_dir):
    wide = layers.wide(spark, sf_dir, on_missing="keep")
    return gt.run(wide, ct.gates_of(_CONTRACT), _CONTRACT.name)


def _gold_fks(nulls: bool) -> list[str]:
    return [
        _line(
            f"fk_exists({c})", "count(*)", _missing(c, "fat_flt", dim, key, nulls), "fat_flt"
        )
        for c, (dim, key) in ct.FAT_FLT.fks.items()
    ]


def _unique_line(col: str, table: str) -> str:
    return _line(f"unique({col})", "count(*)", _dups(col, table), table)


@_add(
    "gate_suite_gold",
    sql.with_(
        sql.star(),
        _union(
            [
                _unique_line("airline_iata_code", "dim_air"),
                _unique_line("airport_iata_code", "dim_apt"),
                _unique_line("full_date", "dim_dat"),
                _unique_line("flight_id", "fat_flt"),
                _line(
                    f"not_null({','.join(ct.FAT_FLT.not_null)})",
                    _any_null(ct.FAT_FLT.not_null),
                    "fat_flt",
                    "fat_flt",
                ),
                *_gold_fks(True),
            ]
        ),
    ),
)
def gate_suite_gold(spark, sf_dir):
    tables = layers.gold(spark, sf_dir)
    return suites.run_all(tables, suites.gold(tables))


def _declared_lines() -> list[str]:
    lines = []
    for t in (ct.DIM_AIR, ct.DIM_APT, ct.DIM_DAT, ct.FAT_FLT):
        pk = ",".join(t.pk)
        lines += [
            _line("not_empty", _NOT_EMPTY, t.name, t.name),
            _line(f"not_null({pk})", _any_null(t.pk), t.name, t.name),
            _unique_line(pk, t.name),
            *(_unique_line(c, t.name) for c in t.unique),
            _line(f"not_null({','.join(t.not_null)})", _any_null(t.not_null), t.name, t.name),
        ]
    return lines + _gold_fks(False)


@_add("gate_suite_gold_declared", sql.with_(sql.star(), _union(_declared_lines())))
def gate_suite_gold_declared(spark, sf_dir):
    tables = layers.gold(spark, sf_dir)
    return suites.run_all(tables, suites.gold_declared(tables))
