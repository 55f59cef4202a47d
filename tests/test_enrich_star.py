from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.helpers import plan_of, rows
from tristrata.operators import enrich, star
from tristrata.plans import contracts as ct, pipeline


@pytest.fixture
def fact(spark):
    return spark.createDataFrame(
        [(1, "A", "B"), (2, "B", "Z"), (3, None, "A"), (4, "Z", "Z")], "i int, o string, d string"
    )


@pytest.fixture
def dim(spark):
    return spark.createDataFrame([("A", 10), ("B", 20), ("C", 30)], "code string, x int")


def test_lookup_keeps_or_drops(fact, dim):
    kept = enrich.lookup(fact, dim, ("o", "code"), {"x": "o_x"})
    assert rows(kept.select("i", "o_x"), "i") == [(1, 10), (2, 20), (3, None), (4, None)]
    dropped = enrich.lookup(fact, dim, ("o", "code"), {"x": "o_x"}, on_missing="drop")
    assert rows(dropped.select("i", "o_x"), "i") == [(1, 10), (2, 20)]
    with pytest.raises(ValueError):
        enrich.lookup(fact, dim, ("o", "code"), {}, on_missing="skip")


def test_a_repeated_lookup_key_is_an_error(fact, dim):
    with pytest.raises(ValueError, match="repeat"):
        enrich.lookup(fact, dim.unionByName(dim), ("o", "code"), {"x": "o_x"})
    with pytest.raises(ValueError, match="repeat"):
        enrich.role_lookup(fact, dim.unionByName(dim), "code", {"from": "o"}, {"x": "x"})


def test_role_lookup(fact, dim):
    both = enrich.role_lookup(fact, dim, "code", {"from": "o", "to": "d"}, {"x": "x"})
    assert rows(both.select("i", "from_x", "to_x"), "i") == [
        (1, 10, 20),
        (2, 20, None),
        (3, None, 10),
        (4, None, None),
    ]


def test_matched_and_unmatched_split_the_rows(fact, dim):
    assert rows(enrich.matched(fact, dim, "code", ["o", "d"]).select("i")) == [(1,)]
    rest = enrich.unmatched(fact, dim, "code", ["o", "d"])
    assert rows(rest.select("i"), "i") == [(2,), (3,), (4,)]


def test_broadcast_only_within_the_measured_bounds(fact, dim, spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        small = fact.join(enrich.measured(dim), F.col("o") == F.col("code"))
        too_many = fact.join(enrich.measured(dim, max_rows=2), F.col("o") == F.col("code"))
        too_wide = fact.join(enrich.measured(dim, max_bytes=10), F.col("o") == F.col("code"))
        assert "BroadcastHashJoin" in plan_of(small)
        for beyond in (too_many, too_wide):
            assert "SortMergeJoin" in plan_of(beyond)
            assert rows(beyond, "i") == rows(small, "i")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_rows_for_keys_matches_null_with_null(fact):
    keys = fact.where("o IS NULL").select("o")
    assert rows(enrich.rows_for_keys(fact, keys, ["o"]).select("i")) == [(3,)]


def test_key_difference(fact, dim):
    assert rows(enrich.key_difference(fact, dim, "o", "code")) == [("Z",)]


def test_entity_and_role_union_dimensions(spark, fact):
    air = star.entity_dim(fact, "o", [], "id")
    assert rows(air, "id") == [(1, "A"), (2, "B"), (3, "Z")]
    union = star.role_union_dim(fact, [{"code": "o"}, {"code": "d"}], "id")
    assert rows(union, "id") == [(1, "A"), (2, "B"), (3, "Z")]


def test_role_union_reads_the_table_once(spark, small):
    lineitem = spark.read.parquet(f"{small}/lineitem.parquet")
    plan = plan_of(star.role_union(lineitem, [{"k": "l_partkey"}, {"k": "l_suppkey"}]))
    assert plan.count("FileScan") == 1


def test_date_dimension(spark):
    days = ["2015-01-05", "2015-01-04", "2015-05-25", "2015-07-05", "2015-05-25", None]
    df = spark.createDataFrame([(d,) for d in days], "d string")
    iso = {r.full_date: r for r in star.date_dim(df, "d", ct.HOLIDAYS_2015).collect()}
    sunday = {r.full_date: r for r in star.date_dim(df, "d", None, "sunday1").collect()}
    assert len(iso) == 4
    assert iso[date(2015, 1, 5)].day_of_week == 1 and iso[date(2015, 1, 4)].day_of_week == 7
    assert sunday[date(2015, 1, 5)].day_of_week == 2 and sunday[date(2015, 1, 4)].day_of_week == 1
    memorial = iso[date(2015, 5, 25)]
    assert memorial.quarter == 2 and memorial.is_holiday
    assert not iso[date(2015, 7, 5)].is_holiday
    assert not sunday[date(2015, 5, 25)].is_holiday


def test_holidays_from_a_table_equal_holidays_from_a_list(spark):
    df = spark.sql("SELECT explode(sequence(DATE'2015-01-01', DATE'2015-12-31')) AS d")
    table = spark.createDataFrame([(d,) for d in ct.HOLIDAYS_2015], "day string")
    by_list = rows(star.date_dim(df, "d", ct.HOLIDAYS_2015), "full_date")
    assert rows(star.date_dim(df, "d", table), "full_date") == by_list
    assert sum(r[-1] for r in by_list) == 10


def test_mnemonics_cover_every_gold_column_but_the_extra_measures():
    extra = {"wheels_off", "wheels_on", "taxi_out", "taxi_in"}
    for table in (ct.DIM_AIR, ct.DIM_APT, ct.DIM_DAT, ct.FAT_FLT):
        named = set(ct.MNEMONICS[table.name])
        missing = set(table.columns) - named
        expected = extra | {"full_date"} if table is ct.FAT_FLT else set()
        assert missing == expected
