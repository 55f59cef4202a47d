"""JDBC tables."""

from pyspark.sql import DataFrame, SparkSession


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    columns: list[str] | None = None,
    predicates: list[str] | None = None,
    bounds: tuple[str, int, int, int] | None = None,
    props: dict[str, str] | None = None,
) -> DataFrame:
    """Scan a table, in parallel when told how to split it.

    ``predicates`` gives one partition per condition; ``bounds`` is (column, lower, upper,
    partitions). The column list is pushed into the query by the engine's own pruning.
    """
    if predicates and bounds:
        raise ValueError("give predicates or bounds, not both")
    options: dict = {"properties": props or {}}
    if predicates:
        options["predicates"] = predicates
    if bounds:
        column, lower, upper, partitions = bounds
        options |= {
            "column": column,
            "lowerBound": lower,
            "upperBound": upper,
            "numPartitions": partitions,
        }
    df = spark.read.jdbc(url, table, **options)
    return df.select(*columns) if columns else df


def write_table(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "truncate",
    props: dict[str, str] | None = None,
    cascade: bool = False,
    connections: int | None = None,
) -> None:
    """Load a table: ``truncate`` empties it first and keeps its definition, ``append`` adds.

    ``connections`` bounds how many tasks write at once.
    """
    if mode not in ("truncate", "append"):
        raise ValueError(f"unknown mode: {mode}")
    writer = df.write.mode("append" if mode == "append" else "overwrite")
    if mode == "truncate":
        writer = writer.option("truncate", True)
        if cascade:
            writer = writer.option("cascadeTruncate", True)
    if connections:
        writer = writer.option("numPartitions", connections)
    writer.jdbc(url, table, properties=props or {})
