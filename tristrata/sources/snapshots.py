"""Published sets of tables: snapshots that a run writes, and commits that expose them.

    <base>/_data/<date>/<run>/<table>/...   written once, never changed
    <base>/_commits/<date>/<version>.json   which snapshot of each table the version consists of

A run stages any number of tables and checks them. Its commit is the rename of one small file to the
next version number, so readers, who take the largest number, see the whole old set or the whole new
one. A number that is taken means that another run was first: the commit then starts from that run's
set. Staging, checking and committing never touch what a reader can see, so a failure between any
two steps leaves the last version as it was. Old versions stay readable until ``expire``.
"""

import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from tristrata.operators import gates as gt
from tristrata.sources import fs, scratch
from tristrata.sources.ingest import is_date

_TRIES = 100  # commits that may come in between before a run gives up


class ReconciliationError(ValueError):
    """The written table does not hold the rows that were sent."""


@dataclass(frozen=True)
class Layout:
    """Where the rows of a stored table lie.

    ``partitions`` maps a directory column to the SQL expression it is made from; an expression must
    not decrease while its column grows. ``order`` is the order within the files. Rows are dealt to
    tasks by ranges of both, so a task fills few directories, files of one directory hold disjoint
    ranges, and a directory with a large part of the rows is spread over many tasks. Equal places are
    told apart by a hash of the whole row. Directory columns have names that the table does not use;
    they are not among the columns that are read back.
    """

    partitions: dict[str, str] = field(default_factory=dict)
    order: tuple[str, ...] = ()

    def arrange(self, df: DataFrame, dealt: bool = False) -> DataFrame:
        """The rows dealt by ranges, unless they are; still to be sorted within their tasks."""
        if clash := {c.lower() for c in df.columns} & {p.lower() for p in self.partitions}:
            raise ValueError(f"directory columns have names of the table: {sorted(clash)}")
        made = df.withColumns({name: F.expr(text) for name, text in self.partitions.items()})
        keys = [*self.partitions, *self.order]
        return made.repartitionByRange(*keys, F.xxhash64(*df.columns)) if keys and not dealt else made

    def sort(self, df: DataFrame) -> DataFrame:
        keys = [*self.partitions, *self.order]
        return df.sortWithinPartitions(*keys) if keys else df


@dataclass(frozen=True)
class Stored:
    """One table of a version: where it is, relative to the base, and what it holds."""

    path: str
    rows: int
    schema: dict
    partitions: dict[str, str] = field(default_factory=dict)
    order: tuple[str, ...] = ()


@dataclass(frozen=True)
class Version:
    number: int
    run: str
    tables: dict[str, Stored]


def _folder(base: str, date: str) -> str:
    return f"{base.rstrip('/')}/_commits/{date}"


def dates(spark: SparkSession, base: str) -> list[str]:
    """Processing dates that have a version, oldest first."""
    found = fs.glob(spark, f"{base.rstrip('/')}/_commits/*", directories=True)
    names = sorted(f.rsplit("/", 1)[-1] for f in found)
    return [d for d in names if is_date(d) and versions(spark, base, d)]


def versions(spark: SparkSession, base: str, date: str) -> list[int]:
    names = [f.rsplit("/", 1)[-1] for f in fs.glob(spark, f"{_folder(base, date)}/*.json", directories=False)]
    return sorted(int(n[:-5]) for n in names if n[:-5].isdigit())


def version(spark: SparkSession, base: str, date: str, number: int | None = None) -> Version | None:
    """The given version of a date, or its last one; None if it has none."""
    if number is None:
        known = versions(spark, base, date)
        if not known:
            return None
        number = known[-1]
    held = json.loads(fs.read_text(spark, f"{_folder(base, date)}/{number:08d}.json"))
    return Version(number, held["run"], {name: Stored(**t) for name, t in held["tables"].items()})


def read(
    spark: SparkSession,
    base: str,
    table: str,
    mode: str = "latest",
    date: str | None = None,
    number: int | None = None,
    between: tuple[str, object, object] | None = None,
) -> DataFrame:
    """A published table: of the newest date or the given one, of its last version or a given one.

    ``between`` is (column, lowest, highest): rows outside are left out, and directories whose value
    is made from that column are pruned with it.
    """
    if mode == "date":
        if not date or not is_date(date):
            raise ValueError(f"not a processing date (YYYY-MM-DD): {date}")
    elif mode == "latest":
        known = dates(spark, base)
        if not known:
            raise FileNotFoundError(f"no published date in {base}")
        date = known[-1]
    else:
        raise ValueError(f"unknown mode: {mode}")
    found = version(spark, base, date, number)
    if found is None or table not in found.tables:
        raise FileNotFoundError(f"{table} is not published for {date} in {base}")
    return _scan(spark, base, found.tables[table], between)


def _scan(spark: SparkSession, base: str, stored: Stored, between: tuple[str, object, object] | None = None) -> DataFrame:
    schema = T.StructType.fromJson(stored.schema)
    df = spark.read.schema(schema).parquet(f"{base.rstrip('/')}/{stored.path}")
    if between:
        column, low, high = between
        kind = schema[column].dataType.simpleString()
        ends = [F.lit(x).cast(kind) for x in (low, high)]
        df = df.where(F.col(column).between(*ends))
        for name, text in stored.partitions.items():
            made = df.select(F.expr(text).alias(name)).schema[name].dataType
            low_made, high_made = (_made_from(spark, text, column, kind, x, made) for x in (low, high))
            if low_made is not None and high_made is not None:
                df = df.where(F.col(name).between(low_made, high_made))
    return df.drop(*stored.partitions)


def _made_from(spark: SparkSession, text: str, column: str, kind: str, value: object, made: T.DataType):
    """A directory value as a literal, or None if it is made from other columns too."""
    one = spark.range(1).select(F.lit(value).cast(kind).alias(column))
    try:
        return F.lit(one.select(F.expr(text)).first()[0]).cast(made)
    except Exception as e:
        if "UNRESOLVED_COLUMN" in str(e):
            return None
        raise


class Run:
    """Tables that become visible together."""

    def __init__(self, spark: SparkSession, base: str, date: str):
        if not is_date(date):
            raise ValueError(f"not a processing date (YYYY-MM-DD): {date}")
        self.spark, self.base, self.date = spark, base.rstrip("/"), date
        self.name = uuid.uuid4().hex
        self.tables: dict[str, Stored] = {}
        self.results: list[tuple] = []

    def stage(
        self,
        name: str,
        df: DataFrame,
        gates: list[gt.Gate] | None = None,
        layout: Layout | None = None,
        reported: frozenset[str] = frozenset(),
        dealt: bool = False,
    ) -> DataFrame:
        """Write a table, check it, and return a scan of what was written.

        ``dealt`` says that the rows were dealt by ranges of the layout with their last shuffle.

        Row gates and the row count are taken during the write, after the last shuffle; key gates and
        the reconciliation read the written files. Gates named in ``reported`` may fail.
        """
        layout = layout or Layout()
        checks = gates or []
        by_name = [g for g in checks if g.names is not None]
        by_row = [g for g in checks if g.names is None and g.counted(df) is not None]
        by_key = [g for g in checks if g.names is None and g.counted(df) is None]
        if by_name:
            self._judge(gt.run(df, by_name, name), reported)
        path = f"_data/{self.date}/{self.name}/{name}"
        arranged, sent = counted(layout.arrange(df, dealt))
        watched = None
        if by_row:
            arranged, watched = gt.watch(arranged, by_row, name)
        out = layout.sort(arranged)
        with scratch.shuffles_dropped(self.spark):
            out.write.mode("overwrite").partitionBy(*layout.partitions).parquet(f"{self.base}/{path}")
        stored = Stored(path, sent.get["rows"], out.schema.jsonValue(), dict(layout.partitions), tuple(layout.order))
        found = _scan(self.spark, self.base, stored)
        reconcile(stored.rows, found, name)
        if watched:
            self._judge(watched(), reported)
        if by_key:
            self._judge(gt.run(found, by_key, name), reported)
        self.tables[name] = stored
        return found

    def _judge(self, result: DataFrame, reported: frozenset[str]) -> None:
        rows = [tuple(r) for r in result.collect()]  # one row for each gate
        self.results += rows
        gt.enforce(self.spark.createDataFrame([r for r in rows if r[0] not in reported], gt.RESULT_SCHEMA))

    def outcome(self) -> DataFrame:
        """The results of all gates so far."""
        return self.spark.createDataFrame(self.results, gt.RESULT_SCHEMA)

    def commit(self) -> int:
        """Make the staged tables visible, beside the others of the last version; returns the number."""
        folder = _folder(self.base, self.date)
        for _ in range(_TRIES):
            last = version(self.spark, self.base, self.date)
            held = (last.tables if last else {}) | self.tables
            number = last.number + 1 if last else 1
            text = json.dumps({"run": self.name, "tables": {n: asdict(t) for n, t in held.items()}})
            prepared = f"{folder}/_{self.name}-{number}"
            fs.write_text(self.spark, prepared, text)
            if fs.rename_if_new(self.spark, prepared, f"{folder}/{number:08d}.json"):
                return number
            fs.delete(self.spark, prepared)
        raise RuntimeError(f"{_TRIES} other commits came in between for {self.date} in {self.base}")


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Count the rows of ``df`` while it is written.

    Write the result directly: a shuffle after this point could repeat a task and its count.
    """
    observation = Observation()
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def reconcile(written: int, target: DataFrame, name: str) -> None:
    """Compare the rows sent with the rows found in the target."""
    found = target.count()
    if found != written:
        raise ReconciliationError(f"{name}: {written} rows sent, {found} found")


def expire(spark: SparkSession, base: str, date: str, keep: int = 1, grace_hours: float = 24.0) -> list[str]:
    """Delete all but the last ``keep`` versions of a date and the snapshots only they use.

    Snapshots younger than ``grace_hours`` stay, as their run may not have committed yet, and so a
    reader of an older version has that long to end. Commits go first: no version names missing files.
    Returns what was deleted.
    """
    if keep < 1:
        raise ValueError("keep at least one version")
    base = base.rstrip("/")
    known = versions(spark, base, date)
    kept = [version(spark, base, date, n) for n in known[-keep:]]
    used = {t.path for v in kept for t in v.tables.values()}
    gone = [f"{_folder(base, date)}/{n:08d}.json" for n in known[:-keep]]
    for path in fs.glob(spark, f"{base}/_data/{date}/*/*", directories=True):
        run, table = path.rsplit("/", 2)[-2:]
        if f"_data/{date}/{run}/{table}" not in used and fs.age_hours(spark, path) >= grace_hours:
            gone.append(path)
    for path in gone:
        fs.delete(spark, path)
    return gone
