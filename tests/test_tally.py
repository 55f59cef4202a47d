"""Statistics read off the two stored relations equal those of the operators that read the table."""

import math

import pytest
from pyspark.sql import functions as F

from tests.helpers import plan_of, rows
from tristrata.operators import profile as pf
from tristrata.operators.tally import tally
from tristrata.plans import contracts as ct, reports
from tristrata.sources import scratch

SCHEMA = "a int, b double, c string, d string, x double, y double"


@pytest.fixture
def df(spark):
    data = [
        (i, None if i % 3 == 0 else i / 7, ["u", None, "v|w", "u"][i % 4], "same", float(i % 11), None if i % 5 == 0 else float(i % 11 * 2 + i % 3))
        for i in range(200)
    ]
    return spark.createDataFrame(data + data[:7], SCHEMA)


@pytest.fixture
def made(df):
    return tally(
        df, {"some": F.col("a") % 2 == 0, "known": F.col("b") > 5}, numbers=["a", "b", "x"], pairs=[("x", "y")],
        composites={"cd": ["c", "d"], "row": ["a", "c"]},
    )


def values(report):
    return {(r.key, r.statistic): r.value for r in report.collect()}


def test_counts_and_missing_values(df, made):
    some = df.where("a % 2 = 0")
    assert values(made.size("s", "some")) == {("", "rows"): some.count(), ("", "columns"): 6}
    want = {(r.column, "missing"): r.n_missing for r in pf.null_summary(some).collect()}
    want |= {(r.column, "percent"): r.pct_missing for r in pf.null_summary(some).collect()}
    assert values(made.nulls("s", "some")) == want
    assert values(made.known("s", "known", ["b", "c"])) == {("b", "known"): df.where("b > 5").count(), ("c", "known"): df.where("b > 5 AND c IS NOT NULL").count()}
    corr = {(f"{r.col_1}|{r.col_2}", "correlation"): r["corr"] for r in pf.missingness_corr(df).collect() if r.col_1 < r.col_2}
    got = values(made.missing_pairs("s", "all"))
    assert got.keys() == corr.keys() and all(math.isclose(got[k], corr[k]) for k in got)
    rate = values(made.null_rate("s", "all", ["some"], ["c"]))
    assert rate == {("some|c", "percent"): pytest.approx(100 * some.where("c IS NULL").count() / some.count())}


def test_numbers_and_fits(df, made):
    for name, rows_of in (("all", df), ("some", df.where("a % 2 = 0"))):
        got = values(made.describe("s", name, ["a", "b", "x"]))
        for r in pf.describe_numbers(rows_of, ["a", "b", "x"]).collect():
            for statistic in ("count", "mean", "std", "min", "p25", "p50", "p75", "max"):
                assert got[r.column, statistic] == pytest.approx(r[statistic]), (name, r.column, statistic)
        fit = pf.linear_fit(rows_of, [("x", "y")]).first()
        line = values(made.fit("s", name))
        assert [line["x|y", s] for s in ("count", "slope", "intercept", "r2")] == pytest.approx([fit.n, fit.slope, fit.intercept, fit.r2])


def test_values_and_repeats(df, made):
    assert values(made.distinct("s", "all"))["b", "unique"] == df.select("b").where("b IS NOT NULL").distinct().count()
    counts = values(made.counts("s", "some", "c"))
    assert counts["u", "rows"] == df.where("a % 2 = 0 AND c = 'u'").count()
    assert values(made.describe_texts("s", "all", ["c"])) == {("c", "count"): df.where("c IS NOT NULL").count(), ("c", "unique"): 2, ("c", "freq"): df.where("c = 'u'").count()}
    repeats = values(made.repeats("s", "all", "row"))
    assert repeats == {("", "keys"): 7, ("", "rows"): 14, ("", "beyond_first"): 7}
    top = values(made.repeats("s", "all", "cd", 1))
    assert top["u|same", "rows"] == df.where("c = 'u'").count() and ("v\\\\|w|same", "rows") not in top
    assert values(made.duplicates("s", df, "all")) == {("", "beyond_first"): 7}
    once = tally(df.dropDuplicates())
    assert values(once.duplicates("s", df, "all")) == {("", "beyond_first"): 0}


def test_rows_of_the_worst_key(df, made):
    got = values(made.worst_rows("s", df, "cd", "all", ["a"]))
    assert sorted(got.values()) == sorted(r.a for r in df.where("c = 'u'").collect())


def test_a_report_scans_its_source_twice(spark, df, tmp_path):
    df.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    t = tally(stored, numbers=["a"])
    plan = plan_of(t.describe("s", "all", ["a"]).unionByName(t.nulls("n", "all")).unionByName(t.distinct("d", "all")))
    assert str(tmp_path / "t") not in plan
    assert rows(t.cells.agg(F.sum("n"))) == [(207,)] and t.cells.count() < 10


def test_no_rows(spark):
    t = tally(spark.createDataFrame([], SCHEMA), {"s": F.col("a") > 1}, numbers=["a"], pairs=[("x", "y")], composites={"k": ["a", "b"]})
    assert values(t.size("s", "all")) == {("", "rows"): 0, ("", "columns"): 6}
    for empty in (t.describe("s", "all", ["a"]), t.distinct("s", "all"), t.counts("s", "s", "c"), t.missing_pairs("s", "all")):
        assert empty.collect() == []
    assert values(t.repeats("s", "all", "k", 3)) == {("", "keys"): 0, ("", "rows"): 0, ("", "beyond_first"): 0}


def test_raw_report_of_a_few_rows(spark):
    line = dict.fromkeys(ct.RAW_FLIGHTS.columns, "1") | {"cancelled": "0", "diverted": "0", "airline": "A"}
    other = line | {"airline": "Z", "diverted": "1", "arrival_time": None, "elapsed_time": "9"}
    gone = line | {"cancelled": "1", "airline": "A"}
    text = ", ".join(f"{c} string" for c in ct.RAW_FLIGHTS.columns)
    flights = spark.createDataFrame([tuple(r[c] for c in ct.RAW_FLIGHTS.columns) for r in (line, line, other, gone)], text)
    airlines = spark.createDataFrame([("A", "One")], "iata_code string, airline string")
    airports = spark.createDataFrame([("X", "F1", "C", "S", "U", None, "1")], ", ".join(f"{c} string" for c in ct.RAW_AIRPORTS.columns))
    got = {(r.section, r.key, r.statistic): r.value for r in reports.raw_report(airlines, airports, flights).collect()}
    assert got["size", "", "rows"] == 3 and got["unknown_airlines", "", "keys"] == 1
    assert got["flights_by_airline", "A", "rows"] == 3 and got["duplicates", "", "beyond_first"] == 1
    assert got["key_repeats", "1|1|1|1|A", "rows"] == 2 and got["worst_key", "2", "distance"] == 1
    assert got["nulls_diverted_1", "arrival_time", "missing"] == 1 and got["airport_odd_text", "airport|F1", "rows"] == 1
    assert got["elapsed_difference", "time_difference", "mean"] == -2


def test_generated_methods_stay_small_enough_to_be_compiled(spark, small):
    """The JVM interprets methods beyond 8,000 bytes, which made the scans of the wide table many times slower."""
    import re

    from registry import layers

    sizes = []
    stored = scratch.table

    def table(df, label="table"):
        if label.split("-")[0] in ("cells", "bag"):
            spark.conf.set("spark.sql.adaptive.enabled", "false")
            text = spark.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
            spark.conf.set("spark.sql.adaptive.enabled", "true")
            sizes.extend(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text))
        return stored(df, label)

    wide = stored(layers.wide(spark, small), "wide")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(scratch, "table", table)
        reports.silver_report(wide)
    assert sizes and max(sizes) < 8000


def test_values_of_all_types_are_counted_as_text(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, 2.5D, DATE '2015-01-02', TIMESTAMP_NTZ '2015-01-02 03:04:05', true, 'a|b', CAST(7 AS SMALLINT), array(1)), "
        "(1, -0.0D, DATE '2015-01-02', NULL, false, 'a\\\\b', NULL, array(1)), (2, 0.0D, NULL, NULL, NULL, NULL, NULL, NULL) AS t(i, d, day, ts, b, s, h, a)"
    )
    t = tally(df, composites={"key": ["s", "i"]})
    found = {(r.column, r.value): r.n for r in t._values("all", [*df.columns, "key"]).collect()}
    assert found == {
        ("i", "1"): 2, ("i", "2"): 1, ("d", "2.5"): 1, ("d", "0.0"): 2, ("day", "2015-01-02"): 2, ("ts", "2015-01-02 03:04:05"): 1,
        ("b", "true"): 1, ("b", "false"): 1, ("s", "a|b"): 1, ("s", "a\\b"): 1, ("h", "7"): 1, ("a", "[1]"): 2,
        ("key", "a\\|b|1"): 1, ("key", "a\\\\b|1"): 1, ("key", "\\N|2"): 1,
    }
    missing = {(r.pattern): r.n for r in t.cells.collect()}
    assert missing == {"00000000": 1, "00010010": 1, "00111111": 1}


def test_patterns_of_more_columns_than_a_number_has_bits(spark):
    df = spark.range(3).select(*(F.when(F.col("id") == i % 4, 1).alias(f"c{i}") for i in range(130)))
    t = tally(df, whole_rows=False)
    expected = {"".join("0" if i % 4 == row else "1" for i in range(130)) for row in range(3)}
    assert {r.pattern for r in t.cells.collect()} == expected
