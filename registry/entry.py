"""What a registered query is."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


@dataclass(frozen=True)
class Entry:
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Double columns rounded, so that summation order does not show in comparisons."""
    return df.select(
        *(
            F.round(f.name, places).alias(f.name) if isinstance(f.dataType, T.DoubleType) else f.name
            for f in df.schema
        )
    )
