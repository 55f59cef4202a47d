from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tristrata.functions import normalize as nz


def evaluate(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, c string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("c"))).collect()]


def test_hhmm_keeps_one_to_four_digits(spark):
    texts = ["5", "5.0", "930.0", "0930", " 930 ", "2400", "", None, "12345", "abc", "9.5", "-5"]
    expected = ["0005", "0005", "0930", "0930", "0930", "2400", *[None] * 6]
    assert evaluate(spark, texts, nz.hhmm) == expected


@pytest.mark.parametrize(
    ("rule", "midnight"), [("next_day", datetime(2015, 1, 2)), ("null", None)]
)
def test_build_ts(spark, rule, midnight):
    texts = ["0000", "0810", "2359", "2400", "2460", "2559", "2401", None]
    got = evaluate(
        spark, texts, lambda c: nz.build_ts(F.lit("2015-01-01").cast("date"), c, rule)
    )
    day = [datetime(2015, 1, 1, h, m) for h, m in ((0, 0), (8, 10), (23, 59))]
    assert got == [*day, midnight, None, None, None, None]


def test_build_ts_accepts_numbers_and_rejects_unknown_rules(spark):
    df = spark.sql("SELECT DATE'2015-03-08' AS d, 230 AS n")
    assert df.select(nz.build_ts(F.col("d"), F.col("n"))).first()[0] == datetime(2015, 3, 8, 2, 30)
    with pytest.raises(ValueError):
        nz.build_ts(F.col("d"), F.col("n"), "previous")


def test_times_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.sql("SELECT DATE'2015-03-08' AS d, '0230' AS a, '0130' AS b")
        a, b = (nz.build_ts(F.col("d"), F.col(c)) for c in ("a", "b"))
        row = df.select(a.alias("a"), nz.abs_minutes(a, b).alias("m")).first()
        assert row.a == datetime(2015, 3, 8, 2, 30)
        assert row.m == 60.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_ymd_date(spark):
    rows = [("2015", "1", "5"), ("2015", "02", "30"), ("2015", "1", ""), (None, "1", "1")]
    df = spark.createDataFrame(rows, "y string, m string, d string")
    got = [r[0] for r in df.select(nz.ymd_date(*(F.col(c) for c in "ymd"))).collect()]
    assert got == [date(2015, 1, 5), None, None, None]
    with pytest.raises(TypeError):
        nz.ymd_date("y", F.col("m"), F.col("d"))


def test_parse_int(spark):
    texts = ["0", "1", "1.0", "", "x", None, "99999999999"]
    assert evaluate(spark, texts, nz.parse_int) == [0, 1, None, None, None, None, None]


def test_num_covers_range_and_blanks(spark):
    texts = ["5", " 5 ", "", "70000", "x", None]
    expected = [5, 5, None, None, None, None]
    assert evaluate(spark, texts, lambda c: nz.num(c, "smallint")) == expected
    assert evaluate(spark, ["", "-1.5"], lambda c: nz.num(c, "double")) == [None, -1.5]


def test_row_sum_counts_null_as_zero(spark):
    df = spark.sql("SELECT 1.5D AS a, CAST(NULL AS DOUBLE) AS b")
    assert df.select(nz.row_sum([F.col("a"), F.col("b")])).first()[0] == 1.5


def test_weekdays(spark):
    df = spark.sql("SELECT explode(array(DATE'2015-01-05', DATE'2015-01-04')) AS d")
    got = df.select(nz.iso_weekday(F.col("d")), nz.sunday_weekday(F.col("d"))).collect()
    assert [tuple(r) for r in got] == [(1, 2), (7, 1)]


def test_epoch_round_trip(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2015-06-01 12:34:56.789012' AS t")
    back = nz.from_epoch_seconds(nz.epoch_seconds(F.col("t")))
    assert df.select(back == F.col("t")).first()[0]
