"""How filters interact: what each one removes in every order they can be applied.

What a filter does to a document depends only on which filters it fails, so documents are counted by
that set. The states of a run are the subsets of filters already applied, the edges add one filter.
Forward counting says how many orders reach a state, backward counting how many leave it, and an edge
lies on the product of both. An edge's removals, weighted by its orders, sum to the filter's Shapley
total; an order's steps are the edges on its path.
"""

from functools import reduce
from itertools import permutations
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from tristrata.llm.rows import Shelf, text_of

WORDS = r"[^\x20\x09-\x0D]+"  # fixed value: what counts as a word
MOST_FILTERS = 8  # 40,320 orders; the report has a row for each order and step


def text_failures(text: Column) -> dict[str, Column]:
    """Conditions A to D, true where a text fails."""
    words = F.regexp_extract_all(text, F.lit(WORDS), F.lit(0))
    n = F.size(words)
    return {
        "A": n < 50,
        "B": F.size(F.array_distinct(words)) * 100 < n * 65,
        "C": F.regexp_count(text, F.lit("[A-Z]")) * 100 > F.length(text) * 5,
        "D": text.rlike("[#$%&*|]"),
    }


def lattice(n: int) -> list[tuple[int, int, int, int]]:
    """Edges (state, filter, orders that reach the state, orders that leave from its far end).

    States are bit sets. The counts are sums along the edges, level by level in both directions.
    """
    if not 1 <= n <= MOST_FILTERS:
        raise ValueError(f"between 1 and {MOST_FILTERS} filters, not {n}")
    full = (1 << n) - 1
    forward, backward = [0] * (full + 1), [0] * (full + 1)
    forward[0] = backward[full] = 1
    for state in range(full + 1):  # a subset is a smaller number than its supersets
        for f in range(n):
            if not state >> f & 1:
                forward[state | 1 << f] += forward[state]
    for state in range(full, -1, -1):
        for f in range(n):
            if not state >> f & 1:
                backward[state] += backward[state | 1 << f]
    return [
        (state, f, forward[state], backward[state | 1 << f])
        for state in range(full + 1) for f in range(n) if not state >> f & 1
    ]


def failure_sets(
    docs: DataFrame, failures: dict[str, Column], repeats: str | None, id_col="doc_id", text_col="text", part_col="source",
) -> DataFrame:
    """One row for each kind of document: ``part``, ``id``, ``mask`` (bit i: fails filter i) and ``n``.

    ``failures`` gives conditions over the columns of ``docs``. ``repeats`` names one more filter, the
    last bit: the same text stands under a smaller id anywhere in the table. A null id is not smaller
    than any and has none below it. Texts are read once and leave the first pass as a digest. Each
    text's smallest id is found with partial sums; rows are then matched on text and id together, so
    no join key is as large as a group of copies.
    """
    mask = reduce(
        lambda a, b: a.bitwiseOR(b),
        [F.coalesce(c, F.lit(False)).cast("int") * (1 << i) for i, c in enumerate(failures.values())],
        F.lit(0),
    )
    facts = docs.select(
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.col(id_col).cast("long").alias("id"),
        mask.alias("mask"),
        *([F.unhex(F.sha2(text_of(text_col), 256)).alias("digest")] if repeats else []),
    )
    kinds = facts.groupBy(*facts.columns).agg(F.count(F.lit(1)).alias("n"))
    if not repeats:
        return kinds
    kinds = Shelf(docs).put(kinds, "failures")
    first = kinds.groupBy(F.col("digest").alias("_digest")).agg(F.min("id").alias("_first")).where("_first IS NOT NULL")
    same = (F.col("digest") == F.col("_digest")) & (F.col("id") == F.col("_first"))
    later = F.col("_first").isNull() & F.col("id").isNotNull()
    return kinds.join(first, same, "left").select(
        "part", "id", F.col("mask").bitwiseOR(later.cast("int") * (1 << len(failures))).alias("mask"), "n"
    )


def cells(kinds: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Documents by part and failure set: ``n``, and how many of them are labelled ``good`` and ``toxic``.

    ``labels`` has doc_id, quality and toxic. Several labels of one document count as one that holds if
    any of them does; a document without label, or with a null one, is neither.
    """
    if labels is None:
        marked = kinds.withColumns({"_good": F.lit(0), "_toxic": F.lit(0)})
    else:
        known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("_id")).agg(
            F.max((F.col("quality") == 1).cast("int")).alias("_good"), F.max((F.col("toxic") == 1).cast("int")).alias("_toxic")
        )
        ids = kinds.groupBy("id", "part", "mask").agg(F.sum("n").alias("n"))
        marked = ids.join(known, F.col("id") == F.col("_id"), "left")
    return marked.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.coalesce("_good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("_toxic", F.lit(0))).alias("toxic"),
    )


def edge_report(counted: DataFrame, names: list[str]) -> DataFrame:
    """One row for each part and edge: what is kept, removed, redundant and lost there, and its orders.

    Each failure set adds to every edge once; that is a fixed number of rows for each set.
    """
    edges = F.array(*(
        F.struct(
            F.lit(state).alias("state"), F.lit(f).alias("filter"), F.lit(1 << f).alias("bit"),
            F.lit(reach * leave).cast("long").alias("orders"),
        )
        for state, f, reach, leave in lattice(len(names))
    ))
    placed = counted.select("part", "mask", "n", "good", "toxic", F.explode(edges).alias("e")).select("*", "e.*")
    mask, bit = F.col("mask"), F.col("bit")
    alive, fails = mask.bitwiseAND(F.col("state")) == 0, mask.bitwiseAND(bit) != 0

    def total(where: Column, what: str) -> Column:
        return F.sum(F.when(where, F.col(what)).otherwise(0)).cast("long")

    return placed.groupBy("part", "state", "filter", "orders").agg(
        total(alive & ~fails, "n").alias("kept"), total(alive & fails, "n").alias("removed"),
        total(~alive & fails, "n").alias("redundant"), total(mask == bit, "n").alias("unique_fails"),
        total(alive & fails, "good").alias("good_lost"), total(alive & fails, "toxic").alias("toxic_lost"),
    )


def audit(counted: DataFrame, names: list[str]) -> DataFrame:
    """One row for each part, order of the filters and step of that order.

    Columns ``part``, ``filter_order``, ``step``, ``kept``, ``removed``, ``redundant``,
    ``unique_fails``, ``good_lost``, ``toxic_lost``, and ``shapley``: the step's filter's removals
    summed over all orders. ``names`` are the filters' letters, first bit first.
    """
    edges = Shelf(counted).put(edge_report(counted, names), "edges")
    shapley = edges.groupBy(F.col("part").alias("_part"), F.col("filter").alias("_filter")).agg(
        F.sum(F.col("removed") * F.col("orders")).cast("long").alias("shapley")
    )
    steps = []
    for order in permutations(range(len(names))):
        state = 0
        for step, f in enumerate(order, 1):
            steps.append(("".join(names[x] for x in order), step, state, f))
            state |= 1 << f
    paths = counted.sparkSession.createDataFrame(steps, "filter_order string, step int, _state int, _on int")
    valued = edges.join(
        shapley, (F.col("part") == F.col("_part")) & (F.col("filter") == F.col("_filter"))
    )
    # At most MOST_FILTERS * MOST_FILTERS! rows of fixed width.
    return valued.join(F.broadcast(paths), (F.col("state") == F.col("_state")) & (F.col("filter") == F.col("_on"))).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


def audit_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of filters A to E over whole texts, by source.

    A: under 50 words; B: less than 65 % of them different; C: over 5 % of the characters are ASCII
    capitals; D: holds one of ``#$%&*|``; E: the text of a smaller id. Null texts are empty, null
    sources the part of the empty string. Repeated rows count each and do not fail E through each
    other. An empty table gives no rows; other columns are not read.
    """
    failures = text_failures(text_of("text"))
    kinds = failure_sets(docs, failures, "E")
    return audit(Shelf(docs).put(cells(kinds, labels), "cells"), [*failures, "E"])
