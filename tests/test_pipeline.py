import pytest
from pyspark.sql import functions as F

from registry import inputs as src, layers
from tests.helpers import plan_of, rows
from tristrata.operators import gates as gt, keys
from tristrata.plans import contracts as ct, pipeline, reports, suites
from tristrata.sources import scratch, snapshots


@pytest.fixture(scope="module")
def parts(spark, small):
    flights = scratch.table(layers.flights(spark, small), "flights")
    return flights, layers.airlines(spark, small), layers.airports(spark, small)


@pytest.fixture(scope="module")
def wide(parts):
    return pipeline.obt(*parts)


def test_wide_table_follows_its_contract(wide):
    assert wide.dtypes == list(ct.SILVER_FLIGHTS.columns.items())
    assert len(ct.SILVER_FLIGHTS.columns) == 42


def test_flight_ids_are_dense_without_gaps(wide):
    r = wide.agg(F.min("flight_id"), F.max("flight_id"), F.count_distinct("flight_id")).first()
    assert r[0] == 1 and r[1] == r[2] == wide.count()


def test_dropped_and_kept_flights_add_up(parts, wide):
    flights, _, airports = parts
    rejected = pipeline.rejected_flights(flights, airports).count()
    assert rejected > 0
    assert wide.count() + rejected == flights.count()
    kept = pipeline.obt(*parts, on_missing="keep")
    assert kept.count() == flights.count()


def test_gold_tables_follow_their_contracts(wide):
    gold = pipeline.build_star(wide)
    for table in (ct.DIM_AIR, ct.DIM_APT, ct.DIM_DAT, ct.FAT_FLT):
        assert gold[table.name].dtypes == list(table.columns.items()), table.name
    gt.enforce(suites.run_all(gold, suites.gold(gold)))
    gt.enforce(suites.run_all(gold, suites.gold_declared(gold)))
    assert gold["fat_flt"].count() == wide.count()


def test_silver_is_one_pass(spark, small):
    """No shuffle but the spreading of a small scan, no Python, no window."""
    plan = plan_of(layers.flights(spark, small))
    assert "hashpartitioning" not in plan and "rangepartitioning" not in plan
    assert "Python" not in plan and "Window" not in plan
    assert "SinglePartition" not in plan


def test_upper_case_raw_names_are_accepted(spark, small, parts):
    raw = src.raw_flights(spark, small)
    upper = raw.toDF(*(c.upper() for c in raw.columns))
    assert pipeline.silver_flights(upper).count() == parts[0].count()
    with pytest.raises(KeyError, match="arrival_time"):
        pipeline.silver_flights(raw.drop("arrival_time"))


def test_airports_get_the_declared_coordinates(spark):
    raw = spark.createDataFrame(
        [
            ("ECP", "Beaches", "Panama City", "FL", "USA", None, ""),
            ("ABC", "Field", "Town", "XY", "USA", "1.5", "-2.5"),
        ],
        ", ".join(f"{c} string" for c in ct.RAW_AIRPORTS.columns),
    )
    found = pipeline.silver_airports(raw)
    assert found.columns == list(ct.AIRPORTS.columns)
    assert rows(found.select("airport_iata_code", "latitude", "longitude"), "latitude") == [
        ("ABC", 1.5, -2.5),
        ("ECP", 30.3549, -86.6160),
    ]


def test_conform_fills_optional_columns_and_reads_alternative_names(spark):
    table = ct.Table("t", {"a": "int", "b": "double", "z": "string"}, aliases={"a": ("aa",)}, optional=("z",))
    df = spark.createDataFrame([("5", "x")], "aa string, b string")
    out = ct.conform(ct.canonicalise(df, table), table)
    assert out.dtypes == list(table.columns.items())
    assert rows(out) == [(5, None, None)]
    with pytest.raises(KeyError, match="b"):
        ct.conform(df.select(F.col("aa").alias("a")), table)
    both = spark.createDataFrame([("1", "2")], "a string, aa string")
    assert ct.canonicalise(both, table).columns == ["a", "aa"]
    assert ct.rename_present(both, {"aa": "b", "q": "r"}).columns == ["a", "b"]


@pytest.fixture(scope="module")
def raw(spark, small):
    return {
        "airlines": src.raw_airlines(spark, small),
        "airports": src.raw_airports(spark, small),
        "flights": src.raw_flights(spark, small),
    }


def test_run_publishes_every_layer_in_one_commit(spark, small, raw, tmp_path):
    lake, fixes = str(tmp_path / "lake"), src.airport_fixes(spark, small)
    gold = pipeline.run(spark, raw, lake, "2015-01-31", fixes=fixes, holidays=["1995-02-03"], dow="sunday1")
    held = snapshots.version(spark, lake, "2015-01-31")
    assert held.number == 1
    assert held.tables.keys() == {
        "raw_airlines", "raw_airports", "raw_flights", "airlines", "airports", "flights", "silver_flights",
        "dim_air", "dim_apt", "dim_dat", "fat_flt", "gate_results",
    }
    n = snapshots.read(spark, lake, "silver_flights").count()
    assert gold["fat_flt"].count() == n > 0
    dates = snapshots.read(spark, lake, "dim_dat")
    assert rows(dates.where("is_holiday").select(F.col("full_date").cast("string"))) == [("1995-02-03",)]
    assert rows(dates.where("day_of_week <> dayofweek(full_date)")) == []
    results = {(r.dataset, r.gate): r.passed for r in snapshots.read(spark, lake, "gate_results").collect()}
    assert {d for d, _ in results} == held.tables.keys() - {"gate_results"}
    assert {g for (_, g), passed in results.items() if not passed} <= suites.REPORTED
    assert not results["flights", "sum_consistency(arrival_delay)"]


def test_run_computes_no_large_table_for_range_bounds(spark, small, raw, tmp_path, monkeypatch):
    """Flights, wide flights and facts are dealt by counts and numbers, and lie as their layouts say."""
    sampled, real = [], snapshots.Layout.arrange

    def arrange(self, df, dealt=False):
        sampled.extend([] if dealt or not self.order else [df.columns])
        return real(self, df, dealt)

    monkeypatch.setattr(snapshots.Layout, "arrange", arrange)
    monkeypatch.setattr(keys, "PART_ROWS", 500)
    monkeypatch.setattr(keys, "_placed", lambda df, order, label, place=keys._placed: (sampled.append(order), place(df, order, label))[1])
    lake = str(tmp_path / "lake")
    pipeline.run(spark, raw, lake, "2015-01-31", fixes=src.airport_fixes(spark, small))
    assert not [c for c in sampled if {"departure_delay", "flight_number"} <= set(c)]
    for name, by in {"flights": ["flight_date", "airline_iata_code"], "silver_flights": ["flight_id"], "fat_flt": ["flight_id"]}.items():
        at = snapshots.read(spark, lake, name).select("_metadata.file_path", "_metadata.row_index", *by).collect()
        files = {}
        for path, _, *place in sorted(map(tuple, at)):
            files.setdefault(path, []).append(place)
        spans = sorted((f[0], f[-1]) for f in files.values())
        assert all(f == sorted(f) for f in files.values()) and len(files) > 2
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_a_gate_ends_the_run_and_nothing_shows(spark, small, raw, tmp_path):
    lake = str(tmp_path / "lake")
    with pytest.raises(gt.QualityError, match="latitude"):
        pipeline.run(spark, raw, lake, "2015-01-31")  # airports without coordinates and no fixes
    assert snapshots.dates(spark, lake) == []
    more = {"airlines": [gt.max_length("airline_name", 3)]}
    with pytest.raises(gt.QualityError, match="max_length"):
        pipeline.run(spark, raw, lake, "2015-01-31", fixes=src.airport_fixes(spark, small), extra_gates=more)


def test_silver_report_agrees_with_the_table(wide):
    stored = scratch.table(wide, "wide")
    found = {(r.section, r.key, r.statistic): r.value for r in reports.silver_report(stored).collect()}
    n = stored.count()
    assert found["size", "", "rows"] == n and found["size", "", "columns"] == 42
    assert found["key_repeats", "", "keys"] == found["duplicates", "", "beyond_first"] == 0
    assert found["numbers", "distance", "count"] == n
    one = stored.agg(F.avg("distance"), F.stddev("distance"), F.median("distance"), F.max("distance")).first()
    for i, name in enumerate(("mean", "std", "p50", "max")):
        assert found["numbers", "distance", name] == pytest.approx(one[i])
