"""Near-duplicate documents: BagMinHash signatures of word-shingle multisets.

A shingle that occurs w times has weight w. Weights are discretised into unit levels and the levels
into dyadic blocks [0,1), [1,2), [2,4), [4,8), ... Each (shingle, block) carries a Poisson process
whose rate is the width of the block; every point has a time, a level in the block and a register.
Points at levels below the weight count, and a register holds the time of its first point. The
first point of a register is shared by two documents with a probability equal to their weighted
Jaccard. A process stops once its time passes the latest register, and a heavy shingle needs one
process for each block, not for each occurrence.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tristrata.llm import linking
from tristrata.llm.rows import Shelf, band_hashes, code_points, mix, slices, text_of
from tristrata.llm.shingles import multisets, word_shingles

WORDS = 5
THRESHOLD = 0.8
BANDS = 24  # of four registers: a pair at 0.8 is missed by all of them once in 300,000
REGISTERS = 96


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def signatures(owner: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """First times of ``n`` texts by register; ``owner`` is the text of each weighted shingle."""
    times = np.full(n * REGISTERS, np.inf)
    parts = [(owner, mix(shingle, 10), np.zeros(len(owner), np.int64), np.ones(len(owner), np.int64), weight)]
    low = 1
    while len(weight) and low < weight.max():
        more = weight > low
        k = int(more.sum())
        block = np.full(k, low, np.int64)
        parts.append((owner[more], mix(shingle[more], 10 + low.bit_length()), block, block, weight[more]))
        low *= 2
    owner, seed, start, width, weight = (np.concatenate(x) for x in zip(*parts))
    time = np.zeros(len(owner))
    step = 0
    while len(owner):
        draw = mix(seed, 2 * step + 100)
        time = time - np.log1p(-_unit(draw)) / width
        spot = mix(draw, 1)
        level = start + ((spot >> np.uint64(32)).astype(np.int64) * width >> 32)
        register = (spot & np.uint64(0xFFFFFFFF)).astype(np.int64) * REGISTERS >> 32
        hit = level < weight
        np.minimum.at(times, owner[hit] * REGISTERS + register[hit], time[hit])
        left, back = np.unique(owner, return_inverse=True)
        latest = times.reshape(n, REGISTERS)[left].max(axis=1)
        on = time < latest[back]
        owner, seed, start, width, weight, time = (x[on] for x in (owner, seed, start, width, weight, time))
        step += 1
    return times.reshape(n, REGISTERS).view(np.uint64)


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, 1):
            ids = np.asarray(part.column(0))
            points, starts = code_points(part.column(1))
            hashes, owner = word_shingles(points, starts, WORDS)
            shingle, weight, owner = multisets(hashes, owner)
            full, who = np.unique(owner, return_inverse=True)
            if not len(full):
                continue
            found = band_hashes(signatures(who, shingle, weight, len(full)), BANDS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.ravel()), pa.array(np.repeat(ids[full], BANDS))], names=["bucket", "id"]
            )


def measure(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The multiset of shingles of each text: hashes, counts, and the text each is in."""
    points, starts = code_points(pa.array(texts, pa.large_string()))
    return multisets(*word_shingles(points, starts, WORDS))


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns id, ``text_key``, ``class_id`` and ``kept``: the near-duplicate class of every row.

    Two documents are linked if the multisets of their five-word shingles overlap by at least 0.8;
    a class is what links and equal texts connect. Its id is its smallest document id, and the rows
    of that document (id and text) are kept. Null texts count as empty; texts without a word are
    linked with equal texts only. Null ids belong to a class but name it only if all are null. Rows
    that repeat an id and a text are one document. A long text is signed whole; an empty table gives no
    rows. Other columns are not read.
    """
    keyed = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("text")).withColumn(
        "id", F.xxhash64("text")
    )
    texts = keyed.select("id", "text")
    shelf = Shelf(docs)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = texts.mapInArrow(_buckets, "bucket long, id long")
    found = shelf.put(linking.classes(buckets, texts, measure, THRESHOLD, parts), "classes")
    rows = (
        keyed.drop("text").join(found, "id", "left")
        .select("_id", F.col("id").alias("text_key"), F.coalesce("component", "id").alias("_class"))
    )
    # Null sorts first in a struct, so the flag puts it last.
    first = rows.groupBy("_class").agg(
        F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("text_key").alias("key"))).alias("_first")
    )
    return rows.join(first, "_class").select(
        F.col("_id").alias(id_col),
        "text_key",
        F.col("_first.id").alias("class_id"),
        (F.col("_id").eqNullSafe(F.col("_first.id")) & (F.col("text_key") == F.col("_first.key"))).alias("kept"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without near-duplicates: one row of each class, all columns."""
    from tristrata.llm.rows import fresh

    key, kid = fresh(docs.columns, "text_key", "kept_id")
    winners = near_classes(docs, id_col, text_col).where("kept").select(
        F.col(id_col).alias(kid), F.col("text_key").alias(key)
    ).distinct()
    keyed = docs.withColumn(key, F.xxhash64(text_of(text_col)))
    on = keyed[id_col].eqNullSafe(winners[kid]) & (keyed[key] == winners[key])
    return keyed.join(winners, on, "left_semi").dropDuplicates([id_col, key]).drop(key)
