import math
import statistics

import pytest
from pyspark.sql import functions as F

from tests.helpers import plan_of, rows
from tristrata.operators import profile as pf


@pytest.fixture(scope="module")
def df(spark):
    data = [
        (1, "a", 1.0, None),
        (2, "a", 2.0, None),
        (3, "b", None, 1.0),
        (4, None, 4.0, 2.0),
        (4, None, 4.0, 2.0),
    ]
    return spark.createDataFrame(data, "i int, c string, x_delay double, y_time double").cache()


def test_value_counts_share_is_of_known_rows(df):
    assert rows(pf.value_counts(df, "c")) == [("a", 2, 66.67), ("b", 1, 33.33)]


def test_null_summary_and_families(df):
    assert rows(pf.null_summary(df)) == [
        ("c", 2, 40.0),
        ("y_time", 2, 40.0),
        ("x_delay", 1, 20.0),
        ("i", 0, 0.0),
    ]
    assert pf.family(df, "_DELAY") == ["x_delay"]
    share = rows(pf.null_family_share(df, "_delay"), "family")
    assert share == [("*_delay", 1, 20.0), ("other", 4, 80.0)]


def test_null_summary_of_an_empty_table_has_no_percentages(df):
    assert {r.pct_missing for r in pf.null_summary(df.where("i > 9")).collect()} == {None}


def test_null_rate_by_group(df):
    kept = rows(pf.null_rate_by(df, "c", ["x_delay"]), "c")
    assert kept == [("a", "x_delay", 0.0), ("b", "x_delay", 100.0)]
    with_null = rows(pf.null_rate_by(df, "c", ["x_delay"], null_group=True), "c")
    assert with_null[0] == (None, "x_delay", 0.0)


def test_cardinality_and_duplicates(df):
    assert rows(pf.cardinality(df)) == [("i", 4), ("x_delay", 3), ("c", 2), ("y_time", 2)]
    assert dict(rows(pf.cardinality(df, approx=True))) == dict(rows(pf.cardinality(df)))
    assert rows(pf.duplicate_count(df)) == [(1,)]
    assert rows(pf.duplicate_count(df, ["c"])) == [(2,)]
    by_column = dict(rows(pf.duplicate_counts_by_column(df)))
    assert by_column == {"i": 1, "c": 2, "x_delay": 1, "y_time": 2}


def test_cardinality_in_chunks(spark):
    wide = spark.range(50).select(*((F.col("id") % (i + 1)).alias(f"c{i:02}") for i in range(20)))
    assert dict(rows(pf.cardinality(wide))) == {f"c{i:02}": i + 1 for i in range(20)}


def test_duplicate_members_returns_every_row_of_the_group(df):
    members = rows(pf.duplicate_members(df, ["c"]).select("i"), "i")
    assert members == [(1,), (2,), (4,), (4,)]


def test_duplicate_members_needs_no_window(df):
    assert "Window" not in plan_of(pf.duplicate_members(df, ["c"]))


def test_key_collisions(df):
    assert rows(pf.key_collisions(df, ["c"]), "c") == [(None, 2, True), ("a", 2, False)]
    assert rows(pf.all_collisions_identical(df, ["c"])) == [(False,)]
    assert rows(pf.all_collisions_identical(df, ["i"])) == [(True,)]
    assert rows(pf.top_collisions(df, ["i"])) == [(4, 2)]


def test_missingness_correlation_matches_the_formula(df):
    found = {(r.col_1, r.col_2): r.corr for r in pf.missingness_corr(df).collect()}
    flags = {
        c: [float(r[c] is None) for r in df.collect()] for c in ("c", "x_delay", "y_time")
    }
    assert set(found) == {(a, b) for a in flags for b in flags}
    for (a, b), corr in found.items():
        assert corr == pytest.approx(statistics.correlation(flags[a], flags[b]), abs=1e-12)


def test_corr_pairs_are_off_the_diagonal(spark):
    df = spark.range(100).select(
        F.when(F.col("id") % 3 == 0, 1).alias("a"),
        F.when(F.col("id") % 3 == 0, 2).alias("b"),
        F.when(F.col("id") % 2 == 0, 3).alias("c"),
    )
    pairs = [(r.col_1, r.col_2) for r in pf.corr_pairs(df).collect()]
    assert pairs == [("a", "b"), ("b", "a")]


def quantile(values, q):
    values = sorted(values)
    at = (len(values) - 1) * q
    lo, hi = math.floor(at), math.ceil(at)
    return values[lo] + (values[hi] - values[lo]) * (at - lo)


def test_describe_numbers_is_exact_on_skewed_values(spark):
    i = F.col("id")
    df = spark.range(0, 5000, 1, 8).select(
        F.when(i % 3 == 0, 7.0).otherwise((i * 37 % 1013).cast("double")).alias("x"),
        F.when(i % 5 == 0, None).otherwise(i % 17).alias("y"),
        F.lit(None).cast("double").alias("empty"),
    )
    found = {r["column"]: r for r in pf.describe_numbers(df, ["x", "y", "empty"]).collect()}
    for c in ("x", "y"):
        values = [float(r[0]) for r in df.select(c).where(f"{c} IS NOT NULL").collect()]
        r = found[c]
        assert r["count"] == len(values)
        assert r["mean"] == pytest.approx(statistics.fmean(values))
        assert r["std"] == pytest.approx(statistics.stdev(values))
        for name, q in (("min", 0), ("p25", 0.25), ("p50", 0.5), ("p75", 0.75), ("max", 1)):
            assert r[name] == pytest.approx(quantile(values, q)), (c, name)
    assert found["empty"]["count"] == 0 and found["empty"]["p50"] is None


def test_describe_mixes_types(df):
    found = {r["column"]: r for r in pf.describe(df).collect()}
    assert (found["c"]["count"], found["c"]["unique"], found["c"]["top"]) == (3, 2, "a")
    assert found["c"]["freq"] == 2 and found["c"]["mean"] is None
    assert found["i"]["p50"] == 3.0 and found["i"]["top"] is None
    assert set(pf.describe(df, ["c"]).toPandas()["column"]) == {"c"}


def test_describe_times(spark):
    df = spark.sql(
        "SELECT explode(array(TIMESTAMP_NTZ'2015-01-01 00:00:00', "
        "TIMESTAMP_NTZ'2015-01-03 12:00:00')) AS t"
    )
    r = pf.describe_times(df, ["t"]).first()
    assert (str(r["min"]), str(r["p50"]), str(r["max"])) == (
        "2015-01-01 00:00:00",
        "2015-01-02 06:00:00",
        "2015-01-03 12:00:00",
    )


def test_linear_fit(spark):
    df = spark.range(10).select(F.col("id").alias("x"), (F.col("id") * 3 + 1).alias("y"))
    r = pf.linear_fit(df, [("x", "y")]).first()
    assert (r.n, round(r.slope, 9), round(r.intercept, 9), round(r.r2, 9)) == (10, 3.0, 1.0, 1.0)


def test_pattern_violations(spark):
    df = spark.createDataFrame([("Ágil St. O'Neil-X",), ("A1",), ("A1",), ("",), (None,)], "c string")
    assert rows(pf.pattern_violations(df, ["c"]), "value") == [("c", "", 1), ("c", "A1", 2)]
    strict = rows(pf.pattern_violations(df, ["c"], null_violates=True), "value")
    assert strict[0] == ("c", None, 1)


def test_sample_is_repeatable_and_ignores_layout(spark):
    df = spark.range(10_000)
    first = rows(pf.sample_n(df, 100, ["id"], seed=7), "id")
    assert first == rows(pf.sample_n(df.repartition(5), 100, ["id"], seed=7), "id")
    assert len(first) == 100
    assert first != rows(pf.sample_n(df, 100, ["id"], seed=8), "id")


def test_shape(df):
    assert rows(pf.dimensions(df)) == [(5, 4)]
    assert [tuple(r) for r in pf.column_types(df).orderBy("position").collect()][1] == (
        2, "c", "string", 3,
    )
    assert rows(pf.non_null_counts(df, ["c", "x_delay"]), "column") == [("c", 3), ("x_delay", 4)]
    assert rows(pf.count_where(df, F.col("i") > 3)) == [(2,)]
    assert rows(pf.rows_of_key(df, {"c": "a"}, ["i"]).select("i")) == [(1,), (2,)]
    assert pf.preview(df, 2).count() == 2
    assert pf.sample_fraction(df, 1.0, 1).count() == 5
    assert rows(pf.distinct_values(df, "c"), "c") == [(None,), ("a",), ("b",)]


def test_sample_fraction_by_ids_is_repeatable(spark):
    df = spark.range(0, 10_000, 1, 3)
    first = rows(pf.sample_fraction(df, 0.1, 7, ["id"]), "id")
    assert first == rows(pf.sample_fraction(df.repartition(5), 0.1, 7, ["id"]), "id")
    assert 800 < len(first) < 1200
    assert len(rows(pf.sample_n(df, 20_000, ["id"]), "id")) == 10_000


def test_describe_counts_dates_in_seconds(spark):
    df = spark.sql("SELECT DATE'1970-01-02' AS d, TIMESTAMP_NTZ'1970-01-01 00:00:10' AS t, 1 AS n")
    found = {r.column: r["mean"] for r in pf.describe(df).collect()}
    assert found == {"d": 86400, "t": 10, "n": 1}
