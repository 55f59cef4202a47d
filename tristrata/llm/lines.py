"""Line deduplication: MinHash of character shingles, verified, one line of a component stays."""

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tristrata.llm import linking
from tristrata.llm.rows import Shelf, band_hashes, code_points, fresh, mix, slices, text_of
from tristrata.llm.shingles import FACTOR, HASH_BITS, rolling

CHARS = 5  # a changed inner character costs five shingles: lines of 49 characters or more still link
THRESHOLD = 0.8
BANDS = 20  # of six bins: a pair at 0.8 is missed by all of them twice in a thousand, and unlike lines seldom meet
BINS = 120
NONE = np.uint32(2**32 - 1)
LEFT = np.uint64(2**64 - 1)
TAIL = 128  # empty bins that are filled in one go
SIGNED_BYTES = 1 << 18  # text that is signed at a time; fewer cost more in calls than a cache saves


def _spread(x: np.ndarray) -> np.ndarray:
    """A 32-bit finaliser, in place."""
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        x ^= x >> np.uint32(shift)
        x *= np.uint32(factor)
    x ^= x >> np.uint32(16)
    return x


@cache
def _turns() -> np.ndarray:
    """The bins that an empty bin asks, by turn and bin."""
    return np.argsort(mix(np.arange(BINS * BINS), 77).reshape(BINS, BINS), axis=1).T.copy()


def signatures(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One-permutation MinHash of lines of a shingle or more: the least 32-bit hash in each bin.

    An empty bin borrows from another. The bins it asks, in turn, are the same for all lines, so
    equal sets agree and the chance that two lines agree in a bin stays their Jaccard similarity.
    """
    n = len(starts) - 1
    hashes = _spread(rolling(points, CHARS, np.uint32))
    for k in range(1, CHARS):  # runs that leave their line
        over = starts[1:] - k
        hashes[over[over < len(hashes)]] = NONE
    place = (hashes >> np.uint32(16)) * np.uint32(BINS) >> np.uint32(16)
    out = np.full(n * BINS, NONE)
    np.minimum.at(out, np.repeat(np.arange(n) * BINS, np.diff(starts))[: len(hashes)] + place, hashes)
    given, turns = out.copy(), _turns()
    empty = np.flatnonzero(out == NONE)
    bins = empty % BINS
    for t in range(BINS):
        if len(empty) <= TAIL:
            break
        lent = given[empty - bins + turns[t][bins]]
        usable = lent != NONE
        out[empty[usable]] = mix(lent[usable], t + 1).astype(np.uint32)
        empty, bins = empty[~usable], bins[~usable]
    if len(empty):  # the few that are left look at all their turns at once
        asked = given[(empty - bins)[:, None] + turns.T[bins]]
        t = np.argmax(asked != NONE, axis=1)
        lent = asked[np.arange(len(empty)), t]
        filled = mix(lent + t.astype(np.uint64) * FACTOR, 1).astype(np.uint32)  # the seeds of the turns above
        out[empty] = np.where(lent != NONE, filled, NONE)
    return out.reshape(n, BINS)


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for part in slices(batch, 1, SIGNED_BYTES):
            part = part.filter(pc.greater_equal(pc.utf8_length(part.column(1)), CHARS))
            ids, at = np.unique(np.asarray(part.column(0)), return_index=True)
            if not len(ids):
                continue
            signed = signatures(*code_points(part.column(1).take(pa.array(at))))
            yield band_hashes(signed.astype(np.uint64), BANDS).ravel(), np.repeat(ids, BANDS)


def _buckets(groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return linking.packed(_found(batches), groups)

    return run


def measure(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The set of shingles of each line: hashes, counts of one, and the line each is in."""
    points, starts = code_points(pa.array(lines, pa.large_string()))
    keys = mix(rolling(points, CHARS), 4)
    keys >>= np.uint64(64) - HASH_BITS
    keys |= np.repeat(np.arange(len(lines), dtype=np.uint64) << HASH_BITS, np.diff(starts))[: len(keys)]
    for k in range(1, CHARS):  # runs that leave their line
        over = starts[1:] - k
        keys[over[(over >= 0) & (over < len(keys))]] = LEFT
    keys.sort()
    keys = keys[: np.searchsorted(keys, LEFT)]
    keys = keys[np.append(True, keys[1:] != keys[:-1])[: len(keys)]]
    owner = (keys >> HASH_BITS).astype(np.int64)
    return keys & ((np.uint64(1) << HASH_BITS) - np.uint64(1)), np.ones(len(keys), np.int64), owner


def line_places(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns ``id``, ``text_key``, ``line_no`` (from 0), ``line_key`` and ``line`` without outer spaces.

    Lines end with a line feed. Blank lines are left out.
    """
    return (
        docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("_text"))
        .select("id", F.xxhash64("_text").alias("text_key"), F.posexplode(F.split("_text", "\n")).alias("line_no", "_line"))
        .withColumn("line", F.trim("_line"))
        .where("line != ''")
        .select("id", "text_key", "line_no", F.xxhash64("line").alias("line_key"), "line")
    )


def line_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``text_key``, ``line_no``, ``class`` and ``kept`` of every line that is not blank.

    Lines are linked if the sets of their five-character shingles have a Jaccard similarity of at
    least 0.8, or if they are equal; shorter lines only if equal. The class of a line is what links
    connect, and its first line (smallest id, null ids last, then line number) is kept.
    """
    shelf = Shelf(docs)
    places = line_places(docs, id_col, text_col)
    texts = places.select(F.col("line_key").alias("id"), F.col("line").alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = texts.mapInArrow(_buckets(parts * linking.GROUPS), "group int, entries binary")
    buckets = linking.meetings(rows, parts)
    found = shelf.put(linking.classes(buckets, texts, measure, THRESHOLD, parts), "classes")
    rows = shelf.put(
        places.drop("line").join(found.withColumnRenamed("id", "line_key"), "line_key", "left").select(
            "id", "text_key", "line_no", F.coalesce("component", "line_key").alias("class")
        ),
        "places",
    )
    place = F.struct(
        F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("line_no").alias("no"),
        F.col("text_key").alias("key"),
    )
    first = rows.groupBy("class").agg(F.min(place).alias("_first"))
    return rows.join(first, "class").select(
        "id", "text_key", "line_no", "class", (place == F.col("_first")).alias("kept")
    )


def drop_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    counts: tuple[str, str] = ("n_lines", "n_removed"),
) -> DataFrame:
    """The documents with repeated lines taken out, and two counts of lines (blank ones included).

    All other columns stay; a column named like a count is replaced. Null texts become empty. Rows
    that repeat an id and a text are one document and keep the same lines. A document may lose all
    its lines; its text is then empty.
    """
    key, gone, kid, kkey, parts = fresh(docs.columns + list(counts), "text_key", "gone", "gone_id", "gone_key", "parts")
    removed = (
        line_classes(docs, id_col, text_col).where("not kept").groupBy("id", "text_key")
        .agg(F.collect_set("line_no").alias(gone))
        .select(F.col("id").alias(kid), F.col("text_key").alias(kkey), gone)
    )
    keyed = docs.withColumn(text_col, text_of(text_col)).withColumn(key, F.xxhash64(text_col))
    on = keyed[id_col].eqNullSafe(removed[kid]) & (keyed[key] == removed[kkey])
    both = keyed.join(removed, on, "left").withColumn(parts, F.split(text_col, "\n"))
    left = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col(gone))
    kept = F.array_join(F.transform(left, lambda i: F.get(F.col(parts), i)), "\n")
    out = both.withColumns({
        counts[0]: F.size(parts),
        counts[1]: F.when(F.col(gone).isNull(), 0).otherwise(F.size(gone)),
        text_col: F.when(F.col(gone).isNull(), F.col(text_col)).otherwise(kept),
    })
    return out.drop(key, gone, kid, kkey, parts)
