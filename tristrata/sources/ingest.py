"""Scans of raw files and of date-partitioned layers."""

import csv
from datetime import datetime
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tristrata.sources import fs

PARTITION = "ingest_date"
DIRECT = frozenset({"file", "s3", "gs"})  # stores whose files a task can open without Spark


def scan_csv(
    spark: SparkSession,
    paths: str | list[str],
    columns: list[str] | None = None,
    options: dict[str, str] | None = None,
    name_filter: str | None = None,
    chunks: list[int] | None = None,
) -> DataFrame:
    """One relation of text columns from any number of CSV files with a header line.

    The header of every file is checked against ``columns``, or against the names in the first
    file's header, so columns in another order raise and never end up under a wrong name.
    ``name_filter`` is a file name pattern, ``chunks`` picks paths by their 1-based position in
    the list.
    """
    files = [paths] if isinstance(paths, str) else list(paths)
    if chunks is not None:
        files = [files[i - 1] for i in chunks]
    if not files:
        raise ValueError("no CSV files to read")
    reader = spark.read.option("header", True).option("inferSchema", False)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    if options:
        reader = reader.options(**options)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns or reader.csv(files).columns])
    return reader.schema(schema).option("enforceSchema", False).csv(files)


def csv_header(spark: SparkSession, path: str, sep: str = ",") -> tuple[str, ...]:
    """Column names in a file's first line; only its beginning is read."""
    line = fs.first_line(spark, path).removeprefix("\ufeff")
    return tuple(next(csv.reader([line], delimiter=sep), []))


def scan_csv_union(
    spark: SparkSession,
    paths: list[str],
    columns: list[str],
    optional: tuple[str, ...] = (),
    extra: str = "raise",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """One relation of text columns from CSV files whose headers differ.

    Files are grouped by header, each group is one scan with its header checked, and the groups are
    united by name in the order of ``columns``. Names match in any letter case. A column of ``optional``
    that a file lacks is NULL there; lacking another raises KeyError. Columns that are not declared
    raise ValueError, or are left out with ``extra="drop"``. Headers are read on the driver, one short
    read for each file, as is the listing.
    """
    if extra not in ("raise", "drop"):
        raise ValueError(f"unknown rule for undeclared columns: {extra}")
    if not paths:
        raise ValueError("no CSV files to read")
    groups: dict[tuple[str, ...], list[str]] = {}
    for path in paths:
        groups.setdefault(csv_header(spark, path, (options or {}).get("sep", ",")), []).append(path)
    wanted = [*columns, *(c for c in optional if c not in columns)]
    parts = []
    for header, files in groups.items():
        held = {name.lower(): name for name in header}
        if len(held) < len(header):
            raise ValueError(f"a header repeats a name: {files[0]}")
        missing = [c for c in wanted if c.lower() not in held and c not in optional]
        if missing:
            raise KeyError(f"missing columns: {missing} in {files[0]}")
        unknown = sorted(held.keys() - {c.lower() for c in wanted})
        if unknown and extra == "raise":
            raise ValueError(f"undeclared columns: {unknown} in {files[0]}")
        found = scan_csv(spark, files, list(header), options)
        parts.append(found.select(*(
            F.col(f"`{held[c.lower()]}`").alias(c) if c.lower() in held else F.lit(None).cast("string").alias(c) for c in wanted
        )))
    return reduce(DataFrame.unionByName, parts)


def scan(
    spark: SparkSession, fmt: str, path: str | list[str], options: dict[str, str] | None = None
) -> DataFrame:
    """Scan of any file format; CSV files are taken to have a header line."""
    reader = spark.read.format(fmt.lower())
    if fmt.lower() == "csv":
        reader = reader.option("header", True)
    return reader.options(**(options or {})).load(path)


def list_files(
    spark: SparkSession, path: str, pattern: str = "*", exclude: tuple[str, ...] = ()
) -> list[str]:
    """Sorted files of a folder by name pattern; none found is an error."""
    found = fs.glob(spark, f"{path.rstrip('/')}/{pattern}", directories=False)
    kept = [p for p in found if p.rsplit("/", 1)[-1] not in exclude]
    if not kept:
        raise FileNotFoundError(f"no file matches {pattern} in {path}")
    return kept


def is_date(text: str) -> bool:
    try:
        return datetime.strptime(text, "%Y-%m-%d").strftime("%Y-%m-%d") == text
    except ValueError:
        return False


def resolve_partition(
    spark: SparkSession, path: str, mode: str = "latest", date: str | None = None
) -> str:
    """The processing date to read: the newest one present, or the given one if it is a date."""
    if mode == "date":
        if not date or not is_date(date):
            raise ValueError(f"not a processing date (YYYY-MM-DD): {date}")
        return date
    if mode != "latest":
        raise ValueError(f"unknown mode: {mode}")
    folders = fs.glob(spark, f"{path.rstrip('/')}/{PARTITION}=*", directories=True)
    dates = [f.rsplit("=", 1)[-1] for f in folders]
    valid = sorted(d for d in dates if is_date(d))
    if not valid:
        raise FileNotFoundError(f"no processing date in {path}")
    return valid[-1]


def scan_partition(
    spark: SparkSession, path: str, mode: str = "latest", date: str | None = None
) -> DataFrame:
    """One processing date of a layer table, without the date column."""
    chosen = resolve_partition(spark, path, mode, date)
    return spark.read.parquet(f"{path.rstrip('/')}/{PARTITION}={chosen}")


def _footers(files: DataFrame) -> DataFrame:
    """``_path`` and ``_rows`` of Parquet files from their footers, read in tasks."""

    def run(batches):
        from pyarrow import fs as stores, parquet

        for batch in batches:
            counts = []
            for path in batch.column(0).to_pylist():
                store, place = stores.FileSystem.from_uri(path)
                with store.open_input_file(place) as opened:
                    counts.append(parquet.read_metadata(opened).num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], names=["_path", "_rows"])

    return files.mapInArrow(run, "_path string, _rows long")


def file_inventory(
    spark: SparkSession, path: str, fmt: str = "parquet", date: str | None = None
) -> DataFrame:
    """Name, path, format, row count and size of every data file below ``path``.

    Sizes come from the file listing (contents are not read), so files with no rows show up
    with a count of zero. Row counts of Parquet files come from their footers where tasks can open
    the files themselves (``DIRECT``), one file at a time; elsewhere, and for other formats, the files
    are scanned, Parquet without any column.
    """
    listing = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        .where(~F.col("path").rlike("/[_.][^/]*$"))
        .select(
            F.col("_metadata.file_name").alias("file_name"),
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_size").alias("file_size_bytes"),
        )
    )
    scheme = fs.qualified(spark, path).split(":", 1)[0]
    if fmt.lower() == "parquet" and scheme in DIRECT:
        spread = spark.sparkContext.defaultParallelism
        rows = _footers(listing.select("file_path").repartition(spread, "file_path"))
    else:
        data = scan(spark, fmt, path, {"recursiveFileLookup": "true"})
        rows = data.groupBy(F.col("_metadata.file_path").alias("_path")).agg(F.count(F.lit(1)).alias("_rows"))
    return listing.join(rows, F.col("file_path") == F.col("_path"), "left").select(
        "file_name",
        "file_path",
        F.lit(fmt.upper()).alias("file_format"),
        F.coalesce("_rows", F.lit(0)).alias("row_count"),
        "file_size_bytes",
        F.lit(date).cast("date").alias("ingestion_date"),
    )
