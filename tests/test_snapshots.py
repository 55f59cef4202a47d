"""A set of tables is published whole or not at all, whatever step fails."""

import json

import pytest
from pyspark.sql import functions as F

from tests.helpers import rows
from tristrata.operators import gates as gt
from tristrata.sources import fs, snapshots
from tristrata.sources.snapshots import Layout, Run

DAY = "2015-01-31"


def frames(spark, n):
    return {"a": spark.range(n).withColumnRenamed("id", "k"), "b": spark.range(n * 2).withColumnRenamed("id", "k")}


def publish(spark, base, n, gates=None):
    run = Run(spark, base, DAY)
    for name, df in frames(spark, n).items():
        run.stage(name, df, (gates or {}).get(name))
    return run.commit()


def seen(spark, base):
    return tuple(snapshots.read(spark, base, t).count() for t in ("a", "b"))


def test_versions_follow_one_another_and_stay_readable(spark, tmp_path):
    base = str(tmp_path / "set")
    assert [publish(spark, base, n) for n in (3, 5)] == [1, 2]
    assert seen(spark, base) == (5, 10)
    assert snapshots.read(spark, base, "a", "date", DAY, number=1).count() == 3
    assert snapshots.dates(spark, base) == [DAY]


# Every call that changes something; the n-th such call breaks, before or after it took effect.
STEPS = [
    ("fs", "write_text"), ("fs", "rename_if_new"), ("snapshots", "reconcile"), ("snapshots", "counted"), ("gt", "run"), ("gt", "enforce"),
]


@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("where,name", STEPS)
def test_a_failure_at_any_step_leaves_a_whole_set(spark, tmp_path, monkeypatch, where, name, after):
    base = str(tmp_path / "set")
    gates = {t: [gt.unique(["k"]), gt.not_empty()] for t in ("a", "b")}
    publish(spark, base, 3, gates)
    module = {"fs": fs, "snapshots": snapshots, "gt": gt}[where]
    real = getattr(module, name)
    calls = 0
    for broken in (1, 2, 4, 7):
        calls = 0

        def breaking(*args, **kwargs):
            nonlocal calls
            calls += 1
            if calls == broken and not after:
                raise OSError("lost")
            out = real(*args, **kwargs)
            if calls == broken:
                raise OSError("lost")
            return out

        before = seen(spark, base)
        with monkeypatch.context() as patch:
            patch.setattr(module, name, breaking)
            try:
                publish(spark, base, 3 + broken, gates)
                failed = False
            except OSError:
                failed = True
        now = seen(spark, base)
        if not failed:
            assert now == (3 + broken, 2 * (3 + broken))
            break
        # Only a break after the rename itself may show the new set, and then all of it.
        assert now == before or (name == "rename_if_new" and after and now == (3 + broken, 2 * (3 + broken)))
    assert publish(spark, base, 50, gates) and seen(spark, base) == (50, 100)


def test_a_failed_gate_exposes_nothing(spark, tmp_path):
    base = str(tmp_path / "set")
    publish(spark, base, 3)
    run = Run(spark, base, DAY)
    run.stage("a", spark.range(9).withColumnRenamed("id", "k"))
    with pytest.raises(gt.QualityError):
        run.stage("b", spark.range(9).select(F.lit(1).alias("k")), [gt.unique(["k"])])
    assert seen(spark, base) == (3, 6)
    reported = Run(spark, base, DAY)
    reported.stage("b", spark.range(9).select(F.lit(1).alias("k")), [gt.unique(["k"])], reported=frozenset({"unique(k)"}))
    reported.commit()
    assert seen(spark, base) == (3, 9)
    assert rows(reported.outcome()) == [("unique(k)", "b", 1, False)]


def test_two_runs_at_once_keep_both_their_tables(spark, tmp_path):
    base = str(tmp_path / "set")
    one, two = Run(spark, base, DAY), Run(spark, base, DAY)
    one.stage("a", spark.range(1))
    two.stage("b", spark.range(2))
    one.commit()
    assert two.commit() == 2
    assert seen(spark, base) == (1, 2)


def test_a_taken_number_is_tried_again(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "set")
    run = Run(spark, base, DAY)
    run.stage("a", spark.range(4))
    real, between = fs.rename_if_new, []

    def overtaken(spark, source, destination):
        if not between:
            between.append(1)
            other = Run(spark, base, DAY)
            other.stage("b", spark.range(7))
            other.commit()
        return real(spark, source, destination)

    monkeypatch.setattr(fs, "rename_if_new", overtaken)
    assert run.commit() == 2
    assert seen(spark, base) == (4, 7)
    assert snapshots.version(spark, base, DAY, 1).tables.keys() == {"b"}
    assert not fs.glob(spark, f"{base}/_commits/{DAY}/_*", False)


def test_expired_versions_go_with_what_only_they_use(spark, tmp_path):
    base = str(tmp_path / "set")
    for n in (1, 2, 3):
        publish(spark, base, n)
    pending = Run(spark, base, DAY)
    pending.stage("a", spark.range(4))
    assert len(snapshots.expire(spark, base, DAY, keep=2)) == 1  # the young snapshots stay
    assert snapshots.versions(spark, base, DAY) == [2, 3]
    snapshots.expire(spark, base, DAY, keep=1, grace_hours=0)
    assert snapshots.versions(spark, base, DAY) == [3] and seen(spark, base) == (3, 6)
    with pytest.raises(ValueError):
        snapshots.expire(spark, base, DAY, keep=0)


def test_what_cannot_be_read_is_an_error(spark, tmp_path):
    base = str(tmp_path / "set")
    with pytest.raises(FileNotFoundError):
        snapshots.read(spark, base, "a")
    publish(spark, base, 1)
    for call in ({"mode": "date", "date": "2015-1-1"}, {"mode": "oldest"}):
        with pytest.raises(ValueError):
            snapshots.read(spark, base, "a", **call)
    with pytest.raises(FileNotFoundError):
        snapshots.read(spark, base, "zz")
    with pytest.raises(ValueError):
        Run(spark, base, "someday")


def days(spark, n=400):
    return spark.range(n).select(
        F.col("id").alias("k"), F.expr("date_add(DATE'2015-01-01', CAST(id * 7919 % 365 AS INT))").alias("d"),
        F.when(F.col("id") % 3 > 0, "x").alias("s"),
    )


MONTHS = Layout({"month": "trunc(d, 'MM')"}, ("d", "k"))


def test_layout_prunes_directories_and_keeps_order(spark, tmp_path):
    base = str(tmp_path / "set")
    given = days(spark)
    run = Run(spark, base, DAY)
    run.stage("t", given, layout=MONTHS)
    run.stage("none", given.where("false"), layout=MONTHS)
    run.commit()
    assert rows(snapshots.read(spark, base, "t"), "k") == rows(given, "k")
    assert snapshots.read(spark, base, "t").columns == given.columns
    assert snapshots.read(spark, base, "none").count() == 0
    april = snapshots.read(spark, base, "t", between=("d", "2015-04-03", "2015-04-30"))
    assert rows(april, "k") == rows(given.where("d BETWEEN '2015-04-03' AND '2015-04-30'"), "k")
    plan = april._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "month" in plan.split("PartitionFilters: ")[1].splitlines()[0] and "GreaterThanOrEqual(d,2015-04-03)" in plan
    files = {r[0].split("/month=")[1][:10] for r in april.select("_metadata.file_path").distinct().collect()}
    assert files == {"2015-04-01"}
    scan = april._jdf.queryExecution().executedPlan()
    april._jdf.collect()
    leaf = scan.collectLeaves().head()
    assert leaf.metrics().apply("numPartitions").value() == 1
    placed = snapshots.read(spark, base, "t").select("d", "k", "_metadata.file_path", "_metadata.row_index").collect()
    by_file = {}
    for r in sorted(placed, key=lambda r: (r.file_path, r.row_index)):
        by_file.setdefault(r.file_path, []).append((r.d, r.k))
    assert all(v == sorted(v) for v in by_file.values())


def test_a_large_directory_is_spread_in_disjoint_ranges(spark, tmp_path):
    base = str(tmp_path / "set")
    hot = spark.range(40_000).select(
        F.col("id").alias("k"), F.when(F.col("id") % 3 == 0, F.lit("2015-02-01")).otherwise("2015-01-05").cast("date").alias("d"),
        F.sha2(F.col("id").cast("string"), 256).alias("s"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        run = Run(spark, base, DAY)
        run.stage("t", hot, layout=MONTHS)
        run.commit()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spans = (
        snapshots.read(spark, base, "t", between=("d", "2015-01-01", "2015-01-31"))
        .groupBy("_metadata.file_path").agg(F.min("k").alias("lo"), F.max("k").alias("hi")).orderBy("lo").collect()
    )
    assert len(spans) > 2 and all(a.hi < b.lo for a, b in zip(spans, spans[1:]))


def test_between_on_a_column_no_directory_is_made_from(spark, tmp_path):
    base = str(tmp_path / "set")
    run = Run(spark, base, DAY)
    run.stage("t", days(spark), layout=MONTHS)
    run.commit()
    assert snapshots.read(spark, base, "t", between=("k", 10, 19)).count() == 10


def test_directory_names_may_not_clash(spark, tmp_path):
    with pytest.raises(ValueError, match="names of the table"):
        Run(spark, str(tmp_path), DAY).stage("t", days(spark), layout=Layout({"K": "trunc(d, 'MM')"}))


def test_commits_name_relative_paths(spark, tmp_path):
    publish(spark, str(tmp_path / "set"), 2)
    (tmp_path / "set").rename(tmp_path / "moved")
    assert seen(spark, str(tmp_path / "moved")) == (2, 4)
    held = json.loads((tmp_path / "moved/_commits" / DAY / "00000001.json").read_text())
    assert all(not t["path"].startswith("/") for t in held["tables"].values())
