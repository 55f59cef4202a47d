"""Small corpora and plain versions of what the operators compute."""

import random

from pyspark.sql import SparkSession


def frame(spark: SparkSession, rows, schema):
    return spark.createDataFrame(rows, schema)


def words(rng: random.Random, n: int, size: int = 400) -> list[str]:
    return ["w%03d" % rng.randrange(size) for _ in range(n)]


def closure(nodes, links):
    """Smallest member of each node's component."""
    parent = {x: x for x in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {x: root(x) for x in nodes}
