"""Mixing sources to target weights by nested hash thresholds.

A document's place in its source is a hash of its id and text. Sums of sizes by source and hash bucket show
in which bucket the budget of the source runs out; only that bucket is looked into again, with
narrower buckets, until the hash is used up. What lies below the threshold is taken. Nothing is
sorted, a larger budget takes a superset, and reruns agree.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from tristrata.llm.rows import Shelf, fresh, text_of

WEIGHTS = (5, 2, 1)
SHARE = 1.5  # of all sizes
MOST = 2.0  # times its own size that a source, or a document, is taken at most
WORDS = r"[^\x20\x09-\x0D]+"  # fixed value: what counts as a word
STEP = 12  # bits of the hash that a round looks at
ROUNDS = 3


def place(id_col: str, text_col: str) -> Column:
    """A number of 36 bits from a document's id and text, so that rows which share an id lie apart."""
    key = F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.md5(text_of(text_col)))
    return F.conv(F.substring(F.md5(key), 1, STEP * ROUNDS // 4), 16, 10).cast("long")


def sizes(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source") -> DataFrame:
    """Columns ``id``, ``source``, ``size`` (words of the whole text; null: 0) and ``place``."""
    return docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        F.regexp_count(text_of(text_col), F.lit(WORDS)).cast("long").alias("size"),
        place(id_col, text_col).alias("place"),
    )


def targets(measured: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST) -> DataFrame:
    """``source``, ``source_size`` and ``target`` of every source.

    Weights repeat over the sources in code point order, null last. Targets share ``share`` of all
    sizes by weight; what goes beyond ``most`` times a source's size is shared again among the
    others until none is above. That is one water level: sources are capped in order of cap by
    weight, and the level is that of the first one which the rest of the budget does not fill. The
    windows run over one row for each source.
    """
    totals = measured.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    named = totals.withColumn("_n", F.row_number().over(by_name)).withColumn(
        "_w", F.get(F.array(*(F.lit(float(w)) for w in weights)), (F.col("_n") - 1) % len(weights))
    ).withColumn("_cap", F.col("source_size") * F.lit(float(most)))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    order = Window.orderBy(F.col("_cap") / F.col("_w"), "_n")
    capped = order.rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0.0)
    level = named.withColumn("_at", F.row_number().over(order)).withColumn(
        "_level",
        (F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("_cap").over(capped), none))
        / (F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(capped), none)),
    )
    open_at = F.when(F.col("_level") * F.col("_w") <= F.col("_cap"), F.col("_at"))
    found = level.withColumn("_first", F.min(open_at).over(everything)).withColumn(
        "_rest", F.max(F.when(F.col("_at") == F.col("_first"), F.col("_level"))).over(everything)
    )
    return found.select(
        "source", "source_size",
        F.when(F.col("_at") >= F.col("_first"), F.col("_rest") * F.col("_w")).otherwise(F.col("_cap")).alias("target"),
    )


def thresholds(measured: DataFrame, goals: DataFrame) -> DataFrame:
    """``goals`` with ``passes`` (times every document is taken) and ``below`` (places taken once more).

    The document at the threshold is taken if that comes nearer to the target.
    """
    full = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(int(MOST)))).otherwise(0)
    state = goals.withColumn("passes", full.cast("long")).withColumn(
        "_rest", F.when(F.col("passes") >= int(MOST), 0.0).otherwise(F.col("target") - F.col("passes") * F.col("source_size"))
    ).withColumn("_bucket", F.lit(0).cast("long")).withColumn("_taken", F.lit(0).cast("long"))
    for r in range(ROUNDS):
        shift = STEP * (ROUNDS - 1 - r)
        inside = measured.select(
            F.col("source").alias("_s"), F.shiftright("place", shift + STEP).alias("_outer"),
            F.shiftright("place", shift).alias("_b"), "size",
        ).groupBy("_s", "_outer", "_b").agg(F.sum("size").alias("_n")) if r == 0 else (
            measured.join(
                state.select(F.col("source").alias("_s"), F.col("_bucket").alias("_outer")),
                F.col("source").eqNullSafe(F.col("_s")) & (F.shiftright("place", shift + STEP) == F.col("_outer")),
            ).groupBy("_s", F.shiftright("place", shift).alias("_b")).agg(F.sum("size").alias("_n"))
        )
        running = Window.partitionBy("_s").orderBy("_b")
        hist = inside.select("_s", "_b", "_n", (F.sum("_n").over(running)).alias("_sum"))
        joined = state.join(hist, F.col("source").eqNullSafe(F.col("_s")), "left").withColumn(
            "_over", F.col("_taken") + F.col("_sum") > F.col("_rest")
        )
        state = joined.groupBy("source", "source_size", "target", "passes", "_rest").agg(
            F.min(F.when(F.col("_over"), F.struct("_b", (F.col("_taken") + F.col("_sum") - F.col("_n")).alias("_before"), "_n"))).alias("_edge")
        ).select(
            "source", "source_size", "target", "passes", "_rest",
            F.coalesce("_edge._b", F.lit(1 << (STEP * (r + 1))).cast("long")).alias("_bucket"),
            F.coalesce("_edge._before", F.lit(0).cast("long")).alias("_taken"),
            F.col("_edge._n").alias("_edge_size"),
        )
    nearer = F.col("_taken") + F.col("_edge_size") - F.col("_rest") < F.col("_rest") - F.col("_taken")
    return state.select(
        "source", "source_size", "target", "passes",
        (F.col("_bucket") + F.coalesce(nearer, F.lit(False)).cast("long")).alias("below"),
    )


def plan(measured: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST) -> DataFrame:
    """One row for each source: its size, target, full passes and threshold."""
    shelf = Shelf(measured)
    goals = shelf.put(targets(measured, weights, share, most), "targets")
    return shelf.put(thresholds(measured, goals), "thresholds")


def mix(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source") -> DataFrame:
    """``id``, ``source``, ``size``, ``source_size``, ``target``, ``times`` and ``taken`` of every row.

    Texts are read once. Rows that repeat an id and a text share a place, and are taken together. An empty
    table gives no rows, a source without a word takes nothing.
    """
    measured = Shelf(docs).put(sizes(docs, id_col, text_col, source_col), "sizes")
    chosen = plan(measured).withColumnRenamed("source", "_s")
    times = F.col("passes") + (F.col("place") < F.col("below")).cast("long")
    times = F.when(F.col("passes") >= int(MOST), F.col("passes")).otherwise(times)
    return (
        measured.join(chosen, measured["source"].eqNullSafe(chosen["_s"]), "left")
        .withColumn("times", times)
        .select("id", "source", "size", "source_size", "target", "times", (F.col("size") * F.col("times")).alias("taken"))
    )


def apply_mix(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source") -> DataFrame:
    """The documents as the mix takes them: each row as many times as it is taken, all columns."""
    chosen = plan(Shelf(docs).put(sizes(docs, id_col, text_col, source_col), "sizes"))
    names = fresh(docs.columns, "mix_source", "mix_passes", "mix_below", "mix_copy")
    s, passes, below, copy = names
    chosen = chosen.select(F.col("source").alias(s), F.col("passes").alias(passes), F.col("below").alias(below))
    extra = F.when(F.col(passes) >= int(MOST), 0).otherwise((place(id_col, text_col) < F.col(below)).cast("long"))
    return (
        docs.join(chosen, docs[source_col].eqNullSafe(chosen[s]), "left")
        .withColumn(copy, F.explode(F.array_repeat(F.lit(1), (F.col(passes) + extra).cast("int"))))
        .drop(*names)
    )
