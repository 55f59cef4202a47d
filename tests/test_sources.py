import pytest
from pyspark.sql import functions as F

from registry.flow import bucketed_pair
from tests.helpers import plan_of, rows
from tristrata.operators import gates as gt
from tristrata.sources import fs, ingest, jdbc, scratch, sinks, snapshots


@pytest.fixture
def orders(spark, small):
    return spark.read.parquet(f"{small}/orders.parquet").select("o_orderkey", "o_orderstatus")


def test_csv_is_read_as_text_and_chunks_add_up(spark, orders, tmp_path):
    path = str(tmp_path / "csv")
    sinks.write_csv_chunks(orders, path, 4)
    files = ingest.list_files(spark, path, "part-*.csv")
    assert len(files) == 4
    whole = ingest.scan_csv(spark, files, ["o_orderkey", "o_orderstatus"])
    assert {t for _, t in whole.dtypes} == {"string"}
    assert whole.count() == orders.count()
    sizes = [ingest.scan_csv(spark, files, chunks=[i]).count() for i in (1, 2, 3, 4)]
    assert sum(sizes) == orders.count() and max(sizes) - min(sizes) <= 4
    filtered = ingest.scan_csv(spark, path, name_filter="part-00000*.csv")
    assert filtered.count() in sizes


def test_csv_header_is_checked(spark, orders, tmp_path):
    path = str(tmp_path / "csv")
    sinks.write_csv_chunks(orders, path, 1)
    with pytest.raises(Exception, match="(?i)header"):
        ingest.scan_csv(spark, path, ["o_orderkey", "other"]).collect()


def test_csv_files_with_other_headers_raise(spark, tmp_path):
    for name, text in (("a", "A,B\n1,2\n"), ("b", "B,A\n10,20\n")):
        (tmp_path / f"{name}.csv").write_text(text)
    both = [f"{tmp_path}/{name}.csv" for name in ("a", "b")]
    with pytest.raises(Exception, match="(?i)header"):
        ingest.scan_csv(spark, both).collect()
    assert rows(ingest.scan_csv(spark, both[:1]), "A") == [("1", "2")]


def test_no_files_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError):
        ingest.scan_csv(spark, [])
    with pytest.raises(FileNotFoundError):
        ingest.list_files(spark, str(tmp_path), "*.csv")


def test_generic_scan_and_exclusion(spark, orders, tmp_path):
    orders.write.option("header", True).csv(str(tmp_path / "c"))
    assert ingest.scan(spark, "CSV", str(tmp_path / "c")).columns == orders.columns
    names = ingest.list_files(spark, str(tmp_path / "c"), "*", exclude=("_SUCCESS",))
    assert all(n.endswith(".csv") for n in names)


def test_partitions(spark, orders, tmp_path):
    path = str(tmp_path / "layer")
    sinks.write_layer(orders, path, "2015-01-09")
    sinks.write_layer(orders.limit(3), path, "2015-01-10")
    (tmp_path / "layer" / "ingest_date=someday").mkdir()
    assert ingest.resolve_partition(spark, path) == "2015-01-10"
    assert ingest.scan_partition(spark, path).count() == 3
    assert ingest.scan_partition(spark, path, "date", "2015-01-09").count() == orders.count()
    for bad in (None, "2015-1-9", "2015-02-30", "x"):
        with pytest.raises(ValueError):
            ingest.resolve_partition(spark, path, "date", bad)
    with pytest.raises(ValueError):
        ingest.resolve_partition(spark, path, "oldest")
    with pytest.raises(FileNotFoundError):
        ingest.resolve_partition(spark, str(tmp_path / "nothing"))


def test_write_layer_replaces_one_date_even_with_nothing(spark, orders, tmp_path):
    path = str(tmp_path / "layer")
    sinks.write_layer(orders, path, "2015-01-09", ("o_orderstatus",), ("o_orderkey",))
    sinks.write_layer(orders, path, "2015-01-10", single_file=True)
    sinks.write_layer(orders.where("false"), path, "2015-01-09")
    assert ingest.scan_partition(spark, path, "date", "2015-01-09").count() == 0
    assert ingest.scan_partition(spark, path, "date", "2015-01-10").count() == orders.count()
    assert len(ingest.list_files(spark, f"{path}/ingest_date=2015-01-10", "part-*")) == 1


def test_a_hot_partition_is_split_over_tasks(spark, tmp_path):
    """Two thirds of the rows share one output partition and still go to several files."""
    i = F.col("id")
    hot = spark.range(0, 300_000, 1, 8).select(
        F.when(i % 3 == 0, i % 5).otherwise(99).alias("p"), F.sha2(i.cast("string"), 256).alias("t")
    )
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    try:
        spark.conf.set(setting, "1MB")
        sinks.write_layer(hot, str(tmp_path / "hot"), "2015-01-01", ("p",))
    finally:
        spark.conf.unset(setting)
    files = fs.glob(spark, f"{tmp_path}/hot/ingest_date=2015-01-01/p=99/*.parquet", False)
    assert len(files) > 1
    assert spark.read.parquet(str(tmp_path / "hot")).count() == 300_000


def test_to_bronze_writes_only_what_passes(spark, orders, tmp_path):
    path = str(tmp_path / "bronze")
    with pytest.raises(gt.QualityError):
        sinks.to_bronze(orders, [gt.required_columns(["zz"])], path, "2015-01-01", "orders")
    assert not fs.exists(spark, path)
    sinks.to_bronze(orders, [gt.not_empty()], path, "2015-01-01", "orders")
    assert ingest.scan_partition(spark, path).count() == orders.count()


def test_publish_shows_only_checked_tables(spark, orders, tmp_path):
    path = str(tmp_path / "gold")
    good = {"orders": [gt.not_empty(), gt.unique(["o_orderkey"])]}
    result = sinks.publish(spark, {"orders": orders}, path, "2015-01-01", good)
    assert {r.gate for r in result.collect()} == {"not_empty", "unique(o_orderkey)"}
    before = snapshots.read(spark, path, "orders").count()
    bad = {"orders": [gt.unique(["o_orderstatus"])]}
    with pytest.raises(gt.QualityError):
        sinks.publish(spark, {"orders": orders.limit(9)}, path, "2015-01-01", bad)
    assert snapshots.read(spark, path, "orders").count() == before
    sinks.publish(spark, {"orders": orders.limit(9)}, path, "2015-01-01")
    assert snapshots.read(spark, path, "orders").count() == 9


def test_reconcile(spark, orders):
    sinks.reconcile(orders.count(), orders, "orders")
    with pytest.raises(sinks.ReconciliationError, match="1 rows sent"):
        sinks.reconcile(1, orders, "orders")


def test_views_and_tables(spark, orders):
    assert sinks.as_view(orders, "orders_view").count() == spark.table("orders_view").count()


def test_buckets_join_without_moving_rows(spark, small):
    lines, orders = bucketed_pair(spark, small)
    joined = lines.hint("merge").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    plan = plan_of(joined)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert "Exchange" not in plan_of(lines.groupBy("l_orderkey").count())
    assert joined.count() == spark.read.parquet(f"{small}/lineitem.parquet").count()
    assert len(fs.glob(spark, f"{lines.inputFiles()[0].rsplit('/', 1)[0]}/part-*", False)) == 16


def test_tables_replace_and_buckets_need_columns(spark, orders, tmp_path):
    for n in (5, 2):
        stored = sinks.as_table(orders.limit(n), "plain_orders", path=str(tmp_path / f"t{n}"))
        assert stored.count() == n
    for bad in ({"buckets": 4}, {"by": ("o_orderkey",)}):
        with pytest.raises(ValueError):
            sinks.as_table(orders, "plain_orders", **bad)
    spark.sql("DROP TABLE plain_orders")


def test_file_inventory_lists_empty_files(spark, orders, tmp_path):
    path = str(tmp_path / "data")
    orders.repartition(3).write.parquet(path)
    orders.where("false").write.mode("append").parquet(path)
    found = ingest.file_inventory(spark, path, "parquet", "2015-01-01")
    listed = found.collect()
    assert sum(r.row_count for r in listed) == orders.count()
    assert any(r.row_count == 0 for r in listed)
    assert all(r.file_size_bytes > 0 and r.file_format == "PARQUET" for r in listed)
    assert all(r.file_path.endswith(r.file_name) for r in listed)
    assert "FileScan parquet" not in plan_of(found)


def test_inventories_by_footer_and_by_scan_agree(spark, orders, tmp_path, monkeypatch):
    path = str(tmp_path / "with space")
    orders.repartition(2).write.partitionBy("o_orderstatus").parquet(path)
    footers = rows(ingest.file_inventory(spark, path), "file_path")
    monkeypatch.setattr(ingest, "DIRECT", frozenset())
    scanned = ingest.file_inventory(spark, path)
    assert rows(scanned, "file_path") == footers and len(footers) > 2
    assert "ReadSchema: struct<>" in plan_of(scanned)
    orders.write.option("header", True).csv(str(tmp_path / "c"))
    csv = ingest.file_inventory(spark, str(tmp_path / "c"), "csv").collect()
    assert sum(r.row_count for r in csv) == orders.count()


def test_inventory_written_as_csv_grows_by_run(spark, orders, tmp_path):
    path, listed = str(tmp_path / "data"), str(tmp_path / "listed")
    orders.write.parquet(path)
    for day in ("2015-01-01", "2015-01-02"):
        sinks.write_csv(ingest.file_inventory(spark, path, "parquet", day), listed, append=True)
    back = spark.read.option("header", True).csv(listed)
    assert {r.ingestion_date for r in back.collect()} == {"2015-01-01", "2015-01-02"}


def write_files(folder, files):
    for name, text in files.items():
        (folder / name).write_text(text, encoding="utf-8")
    return [f"{folder}/{name}" for name in files]


def test_files_with_other_headers_are_united_by_name(spark, tmp_path):
    files = write_files(tmp_path, {
        "a.csv": "A,B\n1,2\n", "b.csv": "b,a,C\n20,10,30\n", "c.csv": '\ufeffB,"A"\n"x,y",\n', "d.csv": "A,B\n",
    })
    got = ingest.scan_csv_union(spark, files, ["A", "B"], ("C",))
    assert got.dtypes == [("A", "string"), ("B", "string"), ("C", "string")]
    assert sorted(rows(got), key=str) == [("1", "2", None), ("10", "20", "30"), (None, "x,y", None)]
    with pytest.raises(ValueError, match="undeclared columns: \\['c'\\]"):
        ingest.scan_csv_union(spark, files, ["A", "B"])
    assert ingest.scan_csv_union(spark, files, ["B"], extra="drop").count() == 3
    with pytest.raises(KeyError, match="C"):
        ingest.scan_csv_union(spark, files, ["A", "B", "C"])


def test_header_union_of_odd_files(spark, tmp_path):
    semicolons = write_files(tmp_path, {"s.csv": "A;B.x\n1;2\n"})
    assert rows(ingest.scan_csv_union(spark, semicolons, ["B.x"], ("A",), options={"sep": ";"})) == [("2", "1")]
    with pytest.raises(ValueError, match="repeats"):
        ingest.scan_csv_union(spark, write_files(tmp_path, {"r.csv": "a,A\n1,2\n"}), ["a"])
    with pytest.raises(KeyError):
        ingest.scan_csv_union(spark, write_files(tmp_path, {"e.csv": ""}), ["a"])
    with pytest.raises(ValueError):
        ingest.scan_csv_union(spark, [], ["a"])
    with pytest.raises(ValueError):
        ingest.scan_csv_union(spark, semicolons, ["a"], extra="keep")


def test_scratch_uses_the_folder_named_by_the_session(spark, orders):
    root = spark.conf.get("spark.checkpoint.dir")
    stored = scratch.table(orders, "orders")
    assert all(f.startswith(f"file://{root}") for f in stored.inputFiles())
    assert rows(stored, "o_orderkey") == rows(orders, "o_orderkey")


def test_stored_tables_leave_no_shuffle_files(spark, orders):
    import glob

    local = spark.sparkContext.getConf().get("spark.local.dir", "/tmp")
    seen = lambda: set(glob.glob(f"{local}/blockmgr-*/*/shuffle_*.data"))
    before = seen()
    stored = scratch.table(orders.repartition(4, "o_orderkey"), "orders")
    assert seen() <= before and stored.count() == orders.count()
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    orders.repartition(4, "o_orderkey").write.format("noop").mode("overwrite").save()
    assert seen() - before


class Recorder:
    """Stands in for a JDBC reader or writer and keeps what it was told."""

    def __init__(self):
        self.calls, self.options, self.saved = [], {}, None

    def jdbc(self, url, table, **options):
        self.calls.append((url, table, options))
        return self

    def select(self, *columns):
        self.calls.append(columns)
        return self

    def mode(self, name):
        self.saved = name
        return self

    def option(self, key, value):
        self.options[key] = value
        return self


class Holder:
    def __init__(self):
        self.read = self.write = Recorder()


def test_jdbc_reads_split_by_predicates_or_bounds():
    held = Holder()
    jdbc.read_table(held, "u", "t", columns=["a"], predicates=["x < 5", "x >= 5"])
    jdbc.read_table(held, "u", "t", bounds=("id", 0, 100, 4), props={"user": "me"})
    assert held.read.calls == [
        ("u", "t", {"properties": {}, "predicates": ["x < 5", "x >= 5"]}),
        ("a",),
        (
            "u",
            "t",
            {
                "properties": {"user": "me"},
                "column": "id",
                "lowerBound": 0,
                "upperBound": 100,
                "numPartitions": 4,
            },
        ),
    ]
    with pytest.raises(ValueError):
        jdbc.read_table(held, "u", "t", predicates=["x"], bounds=("id", 0, 1, 2))


def test_jdbc_truncate_keeps_the_table_and_append_adds():
    held = Holder()
    jdbc.write_table(held, "u", "t", cascade=True, connections=8)
    assert held.write.saved == "overwrite"
    assert held.write.options == {"truncate": True, "cascadeTruncate": True, "numPartitions": 8}
    held = Holder()
    jdbc.write_table(held, "u", "t", mode="append")
    assert held.write.saved == "append" and held.write.options == {}
    with pytest.raises(ValueError):
        jdbc.write_table(held, "u", "t", mode="replace")
