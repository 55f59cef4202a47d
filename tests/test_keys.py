import pytest
from pyspark.sql import functions as F

from tests.helpers import plan_of, rows
from tristrata.operators import keys
from tristrata.sources import scratch


def skewed(spark, n=20_000):
    """One key holds a third of the rows, and half of those are exact copies."""
    i = F.col("id")
    hot = i % 3 == 0
    return spark.range(0, n, 1, 8).select(
        F.when(hot, "hot").otherwise(F.concat(F.lit("k"), (i % 97).cast("string"))).alias("k"),
        F.when(hot & (i % 2 == 0), 0).otherwise(i % 1009).alias("v"),
        F.when(i % 11 == 0, None).otherwise(i % 5).alias("w"),
    )


def expected_numbers(df, columns):
    def place(r):
        return tuple((r[c] is not None, r[c] if r[c] is not None else 0) for c in columns)

    ordered = sorted(df.collect(), key=place)
    return [(i + 1, *(r[c] for c in columns)) for i, r in enumerate(ordered)]


def test_dense_key_is_the_global_row_number(spark):
    df = skewed(spark)
    got = rows(keys.dense_key(df, "id", ["k"]), "id")
    assert got == expected_numbers(df, ["k", "v", "w"])


def test_dense_key_spreads_hot_copies(spark):
    """Copies of one row occupy several range partitions instead of one."""
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    copies = spark.range(0, 200_000, 1, 64).select(F.lit("same").alias("k"))
    try:
        spark.conf.set(setting, "false")  # small partitions would be merged again
        placed = keys._placed(copies, ["k"], "copies")
    finally:
        spark.conf.unset(setting)
    sizes = [r[1] for r in placed.groupBy("_part").count().collect()]
    assert sum(sizes) == 200_000
    assert len(sizes) > 1
    assert max(sizes) < 200_000 / 2


def test_dense_key_never_gathers_the_table(spark):
    """The only single-partition step works on one row per range partition."""
    keyed = keys.dense_key(skewed(spark), "id", ["k"])
    plan = plan_of(keyed)
    assert "BatchEvalPython" not in plan and "CartesianProduct" not in plan
    before, _, _ = plan.partition("SinglePartition")
    below_single = plan[len(before):]
    assert "HashAggregate" in below_single
    windowed = [line for line in plan.splitlines() if "Window" in line and "row_number" in line]
    assert windowed == []


def test_dense_key_of_nothing(spark):
    assert rows(keys.dense_key(skewed(spark).where("k = 'none'"), "id", ["k"])) == []


def test_running_total(spark):
    df = skewed(spark).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    got = rows(keys.running_total(df, "before", ["k"], "n"), "k")
    total = 0
    for k, n, before in got:
        assert before == total, k
        total += n
    assert total == 20_000


def test_dim_key(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("c", 3)], "code string, x int")
    assert rows(keys.dim_key(df, "id", "code"), "id") == [(1, "a", 2), (2, "b", 1), (3, "c", 3)]


@pytest.mark.parametrize("wide", [False, True])
def test_hash_key_tells_nulls_and_boundaries_apart(spark, wide):
    df = spark.createDataFrame(
        [("a", None), (None, "a"), (None, None), ("", None), ("ab", "c"), ("a", "bc"), ("a,1:b", "")],
        "x string, y string",
    )
    keyed = keys.hash_key(df, "key", ["x", "y"], wide=wide)
    assert keyed.select("key").distinct().count() == 7
    assert rows(keyed, "x", "y") == rows(keys.hash_key(df, "key", ["x", "y"], wide=wide), "x", "y")


def test_fast_id_is_unique(spark):
    assert keys.fast_id(skewed(spark), "id").select("id").distinct().count() == 20_000


def test_running_total_keeps_fractions(spark):
    df = spark.createDataFrame([(i, x) for i, x in enumerate([0.5, 0.25, 0.75, 0.5])], "k int, amount double")
    found = keys.running_total(df, "before", ["k"], "amount").orderBy("k").collect()
    assert [r.before for r in found] == [0, 0.5, 0.75, 1.5]


def in_files(df, path, *columns):
    """The rows of ``df`` as written: a list for each file."""
    df.write.parquet(path)
    files = {}
    at = df.sparkSession.read.parquet(path).select("_metadata.file_path", "_metadata.row_index", *columns)
    for path, _, *values in sorted(map(tuple, at.collect()), key=lambda r: r[:2]):
        files.setdefault(path, []).append(tuple(values))
    return list(files.values())


def grouped(spark, n=3_000):
    i = F.col("id")
    return spark.range(0, n, 1, 4).select(
        F.when(i % 13 > 0, i % 13).alias("a"), F.concat(F.lit("g"), i * 7 % 5).alias("b"), (i % 29).alias("c"), (i % 31).alias("d"),
    )


@pytest.mark.parametrize("lead", [1, 2])
def test_dealt_key_is_the_dense_key_in_order(spark, tmp_path, monkeypatch, lead):
    """Rows are numbered without a sample, and files hold ranges of the key in order."""
    monkeypatch.setattr(keys, "PART_ROWS", 500)
    df = scratch.table(grouped(spark))
    keyed = keys.dealt_key(df, "id", ["a", "b", "c"], lead)
    assert "rangepartitioning" not in plan_of(keyed) and "idpassthrough" in plan_of(keyed).lower()
    assert rows(keyed, "id") == rows(keys.dense_key(df, "id", ["a", "b", "c"]), "id")
    files = in_files(keyed, str(tmp_path / "t"), "id")
    assert len(files) > 1 and sorted(files, key=min) == [[(i,) for i in range(f[0][0], f[-1][0] + 1)] for f in sorted(files, key=min)]


@pytest.mark.parametrize("empty", [False, True])
def test_dealt_key_leaves_hot_groups_to_the_dense_key(spark, monkeypatch, empty):
    monkeypatch.setattr(keys, "PART_ROWS", 500)
    df = scratch.table(skewed(spark, 5_000).where(F.lit(not empty)))
    keyed = keys.dealt_key(df, "id", ["k", "v"], 1)
    assert rows(keyed, "id") == rows(keys.dense_key(df, "id", ["k", "v"]), "id")


def test_deal_by_groups_keeps_rows_and_spreads_a_hot_group(spark, tmp_path, monkeypatch):
    """Groups that are gone, unknown to the counts or NULL lose no row and repeat none."""
    monkeypatch.setattr(keys, "PART_ROWS", 500)
    i = F.col("id")
    df = spark.range(0, 4_000, 1, 4).select(F.when(i % 2 == 0, 5).when(i % 7 > 0, i % 7).alias("a"), i)
    counts = df.withColumn("a", F.when(~F.col("a").eqNullSafe(3), F.col("a") + F.lit(0))).where("a IS NULL OR a <> 2")
    counts = scratch.table(counts.groupBy("a").agg(F.count(F.lit(1)).alias("_n")))
    dealt = keys.deal_by_groups(df, counts)
    assert dealt.columns == df.columns and rows(dealt, "id") == rows(df, "id")
    files = in_files(dealt.where("a = 5"), str(tmp_path / "t"), "a")
    assert len(files) > 2 and max(map(len, files)) < 1_000
    monkeypatch.setattr(keys, "MAX_GROUPS", 3)
    assert keys.deal_by_groups(df, counts) is None
    assert keys.deal_by_groups(df, counts.where("false")) is None


def test_deal_by_number(spark):
    df = spark.range(1, 250_001).withColumnRenamed("id", "n")
    dealt = keys.deal_by_number(df, "n", 250_000).groupBy(F.spark_partition_id().alias("p")).agg(F.min("n"), F.max("n"), F.count("n"))
    spans = [tuple(r)[1:] for r in dealt.orderBy("p").collect()]
    assert len(spans) == 3 and all(a[1] < b[0] for a, b in zip(spans, spans[1:])) and sum(s[2] for s in spans) == 250_000


def test_partitions_stay_small_whatever_their_usual_number(spark, monkeypatch):
    monkeypatch.setattr(keys, "MOST_ROWS", 1_000)
    df = spark.range(1, 250_001).withColumnRenamed("id", "n")
    assert keys.deal_by_number(df, "n", 250_000).groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] == 1_000
