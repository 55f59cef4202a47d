"""Queries that write and read back: CSV chunks, partitioned layers, publication, inventory."""

import uuid

from pyspark.sql import Window, functions as F

from registry import inputs as src, sql
from registry.entry import Entry
from tristrata.operators import gates as gt, profile as pf, sketches as sk
from tristrata.plans import contracts as ct, pipeline
from tristrata.sources import ingest, scratch, sinks, snapshots
from tristrata.sources.snapshots import Layout

ENTRIES: dict[str, Entry] = {}
DAY = "2015-01-31"


def _add(name: str, text: str | None = None):
    def register(build):
        ENTRIES[name] = Entry(build, text)
        return build

    return register


_ORDERS = """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR)
  AS o_custkey, o_orderstatus, o_orderpriority FROM orders"""
_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]


def _orders(spark, sf_dir):
    return src.table(spark, sf_dir, "orders").select(*_COLS)


@_add("csv_chunk_union", _ORDERS)
def csv_chunk_union(spark, sf_dir):
    path = scratch.new_path(spark, "csv")
    sinks.write_csv_chunks(_orders(spark, sf_dir), path, 10)
    files = ingest.list_files(spark, path, "part-*.csv")
    return ingest.scan_csv(spark, files, _COLS)


@_add("csv_delimited", _ORDERS)
def csv_delimited(spark, sf_dir):
    path = scratch.new_path(spark, "csv")
    _orders(spark, sf_dir).write.options(header=True, sep=";").csv(path)
    return ingest.scan_csv(spark, path, options={"sep": ";"}, name_filter="*.csv")


@_add("csv_first_chunk", "SELECT count(*) AS n_rows, CAST(10 AS BIGINT) AS n_files FROM orders")
def csv_first_chunk(spark, sf_dir):
    path = scratch.new_path(spark, "csv")
    sinks.write_csv_chunks(_orders(spark, sf_dir), path, 10)
    files = ingest.list_files(spark, path, "part-*.csv")
    parts = [
        ingest.scan_csv(spark, files, _COLS, chunks=[i]).agg(F.count(F.lit(1)).alias("n"))
        for i in range(1, len(files) + 1)
    ]
    total = parts[0]
    for part in parts[1:]:
        total = total.unionByName(part)
    return total.agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_files"))


@_add("generic_scan", "SELECT * FROM orders")
def generic_scan(spark, sf_dir):
    return ingest.scan(spark, "PARQUET", f"{sf_dir}/orders.parquet")


@_add("bronze_roundtrip", sql.RAW[1])
def bronze_roundtrip(spark, sf_dir):
    path = scratch.new_path(spark, "bronze")
    gates = [gt.not_empty(), gt.required_columns(list(ct.RAW_FLIGHTS.columns))]
    sinks.to_bronze(src.raw_flights(spark, sf_dir), gates, path, DAY, "raw_flights")
    return ingest.scan_partition(spark, path)


@_add(
    "partition_overwrite_roundtrip",
    """SELECT o_orderkey, o_orderstatus, o_orderpriority, CAST(d AS DATE) AS ingest_date
       FROM orders CROSS JOIN (VALUES ('2015-01-30'), ('2015-01-31')) AS v(d)
       WHERE d = '2015-01-30' OR o_orderstatus = 'O'""",
)
def partition_overwrite_roundtrip(spark, sf_dir):
    path = scratch.new_path(spark, "layer")
    orders = src.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority"
    )
    sinks.write_layer(orders, path, "2015-01-30", ("o_orderpriority",), ("o_orderkey",))
    sinks.write_layer(orders, path, "2015-01-31")
    sinks.write_layer(orders.where("o_orderstatus = 'O'"), path, "2015-01-31", ("o_orderpriority",))
    return spark.read.parquet(path)


@_add(
    "latest_partition",
    "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'",
)
def latest_partition(spark, sf_dir):
    path = scratch.new_path(spark, "layer")
    orders = src.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    sinks.write_layer(orders, path, "2015-01-09")
    sinks.write_layer(orders.where("o_orderstatus = 'F'"), path, "2015-01-10")
    return ingest.scan_partition(spark, path)


@_add("reconcile_counts", "SELECT count(*) AS sent, count(*) AS found FROM events")
def reconcile_counts(spark, sf_dir):
    path = scratch.new_path(spark, "events")
    events, sent = sinks.counted(src.table(spark, sf_dir, "events"))
    events.write.parquet(path)
    target = spark.read.parquet(path)
    sinks.reconcile(sent.get["rows"], target, "events")
    return target.agg(
        F.lit(sent.get["rows"]).cast("long").alias("sent"), F.count(F.lit(1)).alias("found")
    )


@_add(
    "gates_on_write",
    """SELECT 'not_empty' AS gate, 'lineitem' AS dataset, CAST(0 AS BIGINT) AS violations,
         TRUE AS passed UNION ALL
       SELECT 'positive(l_discount)', 'lineitem', n, n = 0 FROM
         (SELECT count(*) FILTER (l_discount <= 0) AS n FROM lineitem) UNION ALL
       SELECT 'columns_differ(l_partkey,l_suppkey)', 'lineitem', n, n = 0 FROM
         (SELECT count(*) FILTER (l_partkey = l_suppkey) AS n FROM lineitem)""",
)
def gates_on_write(spark, sf_dir):
    gates = [
        gt.not_empty(),
        gt.positive("l_discount"),
        gt.columns_differ("l_partkey", "l_suppkey"),
    ]
    watched, result = gt.watch(src.table(spark, sf_dir, "lineitem"), gates, "lineitem")
    watched.write.parquet(scratch.new_path(spark, "lineitem"))
    return result()


@_add("publish_roundtrip", "SELECT * FROM supplier")
def publish_roundtrip(spark, sf_dir):
    path = scratch.new_path(spark, "published")
    supplier = src.table(spark, sf_dir, "supplier")
    nation = src.table(spark, sf_dir, "nation")
    gates = [
        gt.not_empty(),
        gt.not_null(["s_suppkey", "s_nationkey"]),
        gt.unique(["s_suppkey"]),
        gt.fk_exists("s_nationkey", nation, "n_nationkey"),
    ]
    sinks.publish(spark, {"supplier": supplier}, path, DAY, {"supplier": gates})
    return snapshots.read(spark, path, "supplier")


@_add(
    "publish_versions",
    """SELECT 1 AS version, o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'
       UNION ALL SELECT 2, o_orderkey, o_orderstatus FROM orders""",
)
def publish_versions(spark, sf_dir):
    """Two commits of one date; the first set stays readable by its number."""
    path = scratch.new_path(spark, "published")
    orders = src.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    gates = {"orders": [gt.not_empty(), gt.unique(["o_orderkey"])]}
    sinks.publish(spark, {"orders": orders.where("o_orderstatus = 'F'")}, path, DAY, gates)
    sinks.publish(spark, {"orders": orders}, path, DAY, gates)
    sets = [
        snapshots.read(spark, path, "orders", number=n).select(F.lit(n).alias("version"), "*") for n in (1, 2)
    ]
    return sets[0].unionByName(sets[1])


BY_MONTH = Layout({"ship_month": "trunc(l_shipdate, 'MM')"}, ("l_shipdate", "l_orderkey", "l_linenumber"))


STRETCH = 65_536  # Fixed value: rows of a file that are compared in one window.


def _clustered(spark, sf_dir):
    path = scratch.new_path(spark, "clustered")
    lineitem = src.table(spark, sf_dir, "lineitem")
    sinks.publish(spark, {"lineitem": lineitem}, path, DAY, layouts={"lineitem": BY_MONTH})
    return path


@_add(
    "clustered_months",
    """SELECT * FROM lineitem WHERE l_shipdate BETWEEN DATE '1995-02-10' AND DATE '1995-04-20'""",
)
def clustered_months(spark, sf_dir):
    """A range of days from a table stored by month: other months' directories are not opened."""
    path = _clustered(spark, sf_dir)
    return snapshots.read(spark, path, "lineitem", between=("l_shipdate", "1995-02-10", "1995-04-20"))


@_add(
    "clustered_order",
    """SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS ship_month, count(*) AS n_rows,
         CAST(0 AS BIGINT) AS out_of_order FROM lineitem GROUP BY 1""",
)
def clustered_order(spark, sf_dir):
    """Rows read back in file order, by month, and how many come before their predecessor.

    Rows are compared with the next one of their file by its number, within stretches of a file; the
    first row of a stretch is also the end of the one before, so no file is gathered. Only the hash of a
    file's path moves with each row, whatever the length of the path.
    """
    stored = snapshots.read(spark, _clustered(spark, sf_dir), "lineitem")
    row = F.col("row")
    placed = stored.select(
        F.trunc("l_shipdate", "MM").alias("ship_month"), "l_shipdate", "l_orderkey", "l_linenumber",
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"),
    )
    here = F.floor(row / STRETCH)
    before = F.when((row % STRETCH == 0) & (row > 0), F.struct((here - 1).alias("stretch"), F.lit(False).alias("own")))
    both = F.array_compact(F.array(F.struct(here.alias("stretch"), F.lit(True).alias("own")), before))
    rows = placed.select("*", F.inline(both))
    after = Window.partitionBy("file", "stretch").orderBy("row")
    place = F.struct("l_shipdate", "l_orderkey", "l_linenumber")
    return (
        rows.select("ship_month", "own", (place > F.lead(place).over(after)).alias("late"))
        .where("own")
        .groupBy("ship_month")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("late").alias("out_of_order"))
    )


def _raw_tables(spark, sf_dir):
    raw = {
        "airlines": src.raw_airlines(spark, sf_dir),
        "airports": src.raw_airports(spark, sf_dir),
        "flights": src.raw_flights(spark, sf_dir),
    }
    fixes = src.airport_fixes(spark, sf_dir)
    return raw, fixes


@_add("pipeline_fact", sql.with_(sql.star(), "SELECT * FROM fat_flt"))
def pipeline_fact(spark, sf_dir):
    """The whole run: raw to published gold, with the gates of every layer."""
    raw, fixes = _raw_tables(spark, sf_dir)
    path = scratch.new_path(spark, "lake")
    pipeline.run(spark, raw, path, DAY, fixes=fixes)
    return snapshots.read(spark, path, "fat_flt")


@_add(
    "file_inventory",
    """SELECT o_orderstatus, count(*) AS n_rows, 'PARQUET' AS file_format, DATE '2015-01-31' AS ingestion_date,
         TRUE AS all_sized, TRUE AS all_named FROM orders GROUP BY o_orderstatus""",
)
def file_inventory(spark, sf_dir):
    """Files of a partitioned table, their inventory written as CSV and read back."""
    path = scratch.new_path(spark, "layer")
    sinks.write_layer(src.table(spark, sf_dir, "orders"), path, DAY, ("o_orderstatus",))
    listed = scratch.new_path(spark, "inventory")
    sinks.write_csv(ingest.file_inventory(spark, path, "parquet", DAY), listed)
    back = ingest.scan_csv(
        spark, listed, ["file_name", "file_path", "file_format", "row_count", "file_size_bytes", "ingestion_date"], name_filter="*.csv"
    )
    return back.groupBy(
        F.regexp_extract("file_path", "o_orderstatus=([^/]*)", 1).alias("o_orderstatus"), "file_format",
        F.col("ingestion_date").cast("date").alias("ingestion_date"),
    ).agg(
        F.sum(F.col("row_count").cast("long")).alias("n_rows"),
        F.bool_and(F.col("file_size_bytes").cast("long") > 0).alias("all_sized"),
        F.bool_and(F.col("file_path").endswith(F.col("file_name"))).alias("all_named"),
    )


@_add(
    "csv_header_union",
    """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus,
         CASE WHEN o_orderkey % 3 = 1 THEN o_orderpriority END AS o_orderpriority FROM orders""",
)
def csv_header_union(spark, sf_dir):
    """Chunks in another column order, with a further column, and in upper case."""
    path = scratch.new_path(spark, "csv")
    orders = _orders(spark, sf_dir)
    shapes = (
        ["o_orderstatus", "o_orderkey"], ["o_custkey", "o_orderkey", "o_orderpriority", "o_orderstatus"], ["O_ORDERKEY", "O_ORDERSTATUS"],
    )
    for i, names in enumerate(shapes):
        part = orders.where(F.col("o_orderkey") % 3 == i).select(*(F.col(n.lower()).alias(n) for n in names))
        sinks.write_csv_chunks(part, f"{path}/{i}", 2)
    files = [f for i in range(len(shapes)) for f in ingest.list_files(spark, f"{path}/{i}", "part-*.csv")]
    return ingest.scan_csv_union(spark, files, ["o_orderkey", "o_orderstatus"], ("o_orderpriority",), extra="drop")


@_add(
    "bucketed_join",
    """SELECT o_orderpriority, count(*) AS n_lines, CAST(sum(l_quantity) AS DOUBLE) AS quantity
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderpriority""",
)
def bucketed_join(spark, sf_dir):
    """Two catalogue tables with equal buckets; the join moves no row."""
    lines, orders = bucketed_pair(spark, sf_dir)
    both = lines.hint("merge").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return both.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").cast("double").alias("quantity")
    )


def bucketed_pair(spark, sf_dir):
    out = []
    for name, key in (("lineitem", "l_orderkey"), ("orders", "o_orderkey")):
        stored = f"bucketed_{name}_{uuid.uuid4().hex}"
        df = src.table(spark, sf_dir, name)
        out.append(sinks.as_table(df, stored, 16, (key,), scratch.new_path(spark, stored)))
    return out


_SKETCHED = ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate", "l_returnflag", "l_linestatus"]


def _sketches(spark, sf_dir):
    """Summaries of the line items of each ship year, written, as they are kept for each batch."""
    lineitem = src.table(spark, sf_dir, "lineitem").withColumn("batch", F.year("l_shipdate"))
    path = scratch.new_path(spark, "sketches")
    sk.summarise(lineitem.select("batch", *_SKETCHED), batch="batch").write.partitionBy("batch").parquet(path)
    return sk.estimates(sk.merge(spark.read.parquet(path)))


@_add(
    "sketch_cardinality",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) AS n_rows, count({c}) AS n_known, TRUE AS within FROM lineitem" for c in _SKETCHED
    ),
)
def sketch_cardinality(spark, sf_dir):
    """Distinct values from merged sketches, and whether each is within the bound of the exact number."""
    exact = pf.cardinality(src.table(spark, sf_dir, "lineitem").select(*_SKETCHED)).withColumnRenamed("n_unique", "exact")
    found = _sketches(spark, sf_dir).join(exact, "column")
    off = F.abs(F.col("n_unique") - F.col("exact"))
    return found.select("column", "n_rows", "n_known", (off <= sk.DISTINCT_ERROR * F.col("exact") + 0.5).alias("within"))


@_add(
    "sketch_quantiles",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(min({c}) AS DOUBLE) AS low, CAST(max({c}) AS DOUBLE) AS high,
            TRUE AS within_p25, TRUE AS within_p50, TRUE AS within_p75 FROM lineitem"""
        for c in ("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
    ),
)
def sketch_quantiles(spark, sf_dir):
    """Quartiles from merged sketches, and whether the rank of each is within the bound."""
    names = ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice"]
    lineitem = src.table(spark, sf_dir, "lineitem")
    found = _sketches(spark, sf_dir).where(F.col("column").isin(names))
    pairs = F.array(*(F.struct(F.lit(c).alias("of"), F.col(c).cast("double").alias("value")) for c in names))
    values = lineitem.select(F.inline(pairs)).groupBy("of", "value").agg(F.count(F.lit(1)).alias("n"))
    ranks = values.join(F.broadcast(found), F.col("of") == F.col("column")).groupBy("column", "low", "high").agg(  # four rows
        F.sum("n").alias("all"),
        *(
            F.sum(F.when(test, F.col("n")).otherwise(0)).alias(f"{side}_{p}")
            for p in ("p25", "p50", "p75")
            for side, test in (("below", F.col("value") < F.col(p)), ("upto", F.col("value") <= F.col(p)))
        ),
    )
    within = [
        (
            (F.col(f"below_{p}") <= (r + sk.RANK_ERROR) * F.col("all")) & (F.col(f"upto_{p}") >= (r - sk.RANK_ERROR) * F.col("all"))
        ).alias(f"within_{p}")
        for p, r in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))
    ]
    return ranks.select("column", "low", "high", *within)
