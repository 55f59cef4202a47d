"""Connected components of a link table by alternating star contractions."""

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from tristrata.llm.rows import Shelf

FEW = 50_000  # links, some 800 kB, that are joined in one partition: no shuffle is worth its tasks for them
Laid = Callable[[DataFrame], DataFrame]


def _nearest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame, laid: Laid) -> DataFrame:
    """Every neighbour above a node is linked to the least of the node and its neighbours."""
    both = laid(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))))
    least = _nearest(both).select("u", F.least("u", "m").alias("m"))
    return (
        both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame, laid: Laid) -> DataFrame:
    """The lower neighbours of a node, and the node, are linked to the least of them."""
    least = _nearest(edges)
    moved = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return laid(moved.unionByName(least.select("u", F.col("m").alias("v")))).distinct()


def _flat(edges: DataFrame, laid: Laid) -> bool:
    """Whether every node has one lower neighbour at most, and none that has one has a higher one."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("below"), F.lit(0).alias("above")).unionByName(
        edges.select(F.col("v").alias("id"), F.lit(0).alias("below"), F.lit(1).alias("above"))
    )
    return laid(ends).groupBy("id").agg(F.sum("below").alias("n"), F.max("above").alias("m")).where("n + m > 1").count() == 0


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Columns ``id`` and ``component`` (its smallest id) of every id that a link names.

    A distributed union-find: each round joins every node with the least of its neighbourhood, so
    trees flatten into stars in a logarithmic number of rounds. It ends once all trees are stars. Only counts reach the driver. Links
    with a null end and links of an id with itself join nothing. An empty table has no components.
    Up to ``FEW`` links are held in one partition, and more are dealt out.
    """
    shelf = Shelf(links)
    edges = shelf.put(
        links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "links",
    )
    few = edges.count() <= FEW  # a round never adds a link

    def laid(df: DataFrame) -> DataFrame:
        return df.coalesce(1) if few else df

    while not _flat(laid(edges), laid):
        after = shelf.put(_small_star(_large_star(laid(edges), laid), laid), "links")
        shelf.drop(edges)
        edges = after
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )
