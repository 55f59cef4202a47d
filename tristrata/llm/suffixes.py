"""Removal of long strings that occur more than once, by suffix sorting of shards.

1. Every string has an anchor: of its substrings of ``GRAM`` bytes the one with the least hash (the
   first of equals). Equal strings have the same anchor in the same place, so only strings whose
   anchor occurs twice can repeat. That is asked of all strings of half the wanted length: a longer
   one can only repeat if all its halves' anchors do. This leaves nothing out.
2. What remains is dealt to shards by the anchors of the strings of full length, so equal strings
   meet in one shard, and each string is dealt once.
   Long stretches that repeat themselves every few bytes are known to repeat; only their ends are dealt.
3. A shard's pieces are held in memory and suffix-sorted by induced sorting with a queue in files; neighbours in order that share
   the wanted length repeat each other.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tristrata.llm import induction
from tristrata.llm.rows import Shelf, fresh, mix, raw_bytes, slices, text_of

LENGTH = 400  # bytes
GRAM = 64  # bytes of an anchor at most, a power of two; a quarter of the length for short strings
SHARD_BYTES = 4 << 20  # pieces a task sorts at a time, unless one anchor alone has more
PLACE_BITS = 40  # bits of a hash that give way to the place when the least one is looked for
STRETCH_BYTES = 8 << 20  # a longer text is gone through in stretches of so many strings
PERIODS = 16  # bytes after which a stretch may repeat itself to be taken as a whole
BASE = 0x9E3779B97F4A7C15


def _gram(length: int) -> int:
    return min(GRAM, 1 << (max(1, length // 4).bit_length() - 1))


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes from each place on."""
    out, width = data.astype(np.uint64) + np.uint64(1), 1
    while width < gram:
        out = out[:-width] * np.uint64(pow(BASE, width, 2**64)) + out[width:]
        width *= 2
    return mix(out, 5)


def anchors(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of strings with equal anchors: hash, first and last start, and if there is more than one anchor.

    Neighbouring anchors with the same hash, as in a text that repeats itself, are one run.
    """
    hashes = _gram_hashes(data, gram)
    low = np.uint64(PLACE_BITS)
    least = hashes >> low << low | np.arange(len(hashes), dtype=np.uint64)
    width, window = 1, length - gram + 1
    while width * 2 <= window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < window:
        least = np.minimum(least[: -(window - width)], least[window - width :])
    place = (least & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    chosen = hashes[place]
    first = np.flatnonzero(np.append(True, chosen[1:] != chosen[:-1]))
    last = np.append(first[1:], len(place)) - 1
    return chosen[first].view(np.int64), first, last, place[first] != place[last]


def _in_stretches(data: np.ndarray, length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """The anchors of a text of any length, a stretch of strings at a time."""
    for lo in range(0, len(data) - length + 1, STRETCH_BYTES):
        anchor, first, last, more = anchors(data[lo : lo + STRETCH_BYTES + length - 1], length, gram)
        yield anchor, first + lo, last + lo, more


def periodic(data: np.ndarray, length: int) -> list[tuple[int, int, int]]:
    """(begin, end, period) of stretches of four lengths or more that repeat themselves; they do not overlap."""
    out: list[tuple[int, int, int]] = []
    least = 4 * length
    if len(data) < least:
        return out
    for period in range(1, PERIODS + 1):
        edge = np.diff(np.concatenate([[0], (data[period:] == data[:-period]).view(np.int8), [0]]))
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + period
        for lo, hi in zip(begin[end - begin >= least].tolist(), end[end - begin >= least].tolist()):
            if all(hi <= a or lo >= b for a, b, _ in out):
                out.append((lo, hi, period))
    return sorted(out)


def _find_anchors(length: int):
    half = length // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                keys, at = np.unique(np.asarray(part.column(0)), return_index=True)
                data, starts = raw_bytes(part.column(1).take(pa.array(at)))
                found = []
                for k, a, b in zip(keys.tolist(), starts[:-1].tolist(), starts[1:].tolist()):
                    if b - a >= length:
                        for anchor, first, last, more in _in_stretches(data[a:b], half, _gram(length)):
                            found.append((anchor, np.full(len(anchor), k), first, last, more))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(x)) for x in zip(*found)], names=["anchor", "key", "first", "last", "more"]
                    )

    return run


def _cut(length: int):
    """Pieces by anchor; a stretch that is known to repeat comes as one with no bytes, from first to before last."""
    half = length // 2

    def made(key: int, anchor, first, last, pieces: list[bytes]) -> pa.RecordBatch:
        keys = np.full(len(pieces), key)
        return pa.RecordBatch.from_arrays(
            [*(pa.array(x, pa.int64()) for x in (anchor, keys, first, last)), pa.array(pieces, pa.binary())],
            names=["anchor", "key", "first", "last", "piece"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data, _ = raw_bytes(batch.column(1).slice(i, 1))
                spots = sorted((s["first"], s["last"]) for s in batch.column(2)[i].as_py())
                first, last = np.array(spots, np.int64).T
                head = np.flatnonzero(np.append(True, first[1:] != last[:-1] + 1))
                stop = last[np.append(head[1:], len(first)) - 1]
                key = batch.column(0)[i].as_py()
                for lo, hi in zip(first[head].tolist(), (stop + half).tolist()):
                    whole = periodic(data[lo:hi], length)
                    if whole:
                        yield made(key, np.full(len(whole), key), *np.array([(a + lo, b + lo) for a, b, _ in whole]).T, [b""] * len(whole))
                    # Each end keeps a string of every phase, so whatever equals one inside meets it.
                    ends = [lo, *(x + lo for a, b, p in whole for x in (a + length + 2 * p, b - length - 2 * p)), hi]
                    for begin, end in zip(ends[::2], ends[1::2]):
                        body = data[begin:end]
                        for anchor, a, b, _ in _in_stretches(body, length, _gram(length)):
                            pieces = [body[x : y + length].tobytes() for x, y in zip(a.tolist(), b.tolist())]
                            yield made(key, anchor, a + begin, b + begin, pieces)

    return run


def _runs(pieces: list[tuple], length: int) -> pa.RecordBatch:
    """Runs of repeated starts of one shard's pieces (anchor, key, first, last, bytes)."""
    seen = {(key, first): (last, body) for _, key, first, last, body in pieces}
    size = sum(len(body) + 1 for _, body in seen.values()) + 1
    text, wanted = induction.room(size, np.uint16), induction.room(size, bool)
    wanted[:] = False
    at, offsets, origin = 0, [], []
    for (key, first), (last, body) in seen.items():
        text[at : at + len(body)] = np.frombuffer(body, np.uint8).astype(np.uint16) + 2
        text[at + len(body)] = 1
        wanted[at : at + last - first + 1] = True
        offsets.append(at)
        origin.append((key, first))
        at += len(body) + 1
    text[at] = 0
    starts = np.flatnonzero(induction.repeated_starts(text, wanted, length))
    offsets, (keys, firsts) = np.array(offsets, np.int64), np.array(origin, np.int64).T
    piece = np.searchsorted(offsets, starts, side="right") - 1
    head = np.flatnonzero(np.append(True, (starts[1:] != starts[:-1] + 1) | (piece[1:] != piece[:-1]))) if len(starts) else starts
    stop = np.append(head[1:], len(starts)) - 1 if len(starts) else starts
    own = piece[head]
    begin = firsts[own] + starts[head] - offsets[own]
    return pa.RecordBatch.from_arrays(
        [pa.array(keys[own]), pa.array(begin), pa.array(begin + starts[stop] - starts[head] + length)],
        names=["key", "begin", "end"],
    )


def _sort_shards(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for batch in batches:
            known = batch.filter(pc.equal(pc.binary_length(batch.column(4)), 0))
            if known.num_rows:
                yield pa.RecordBatch.from_arrays(known.columns[1:4], names=["key", "begin", "end"])
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if not row[4]:
                    continue
                if size >= SHARD_BYTES and row[0] != last:
                    yield _runs(held, length)
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
                last = row[0]
        if held:
            yield _runs(held, length)

    return run


def repeated_runs(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """``key``, ``begin`` and ``end``: byte ranges covered by strings that also start elsewhere.

    ``texts`` has (key, text); equal keys have equal texts, and several rows of a key count as one.
    Ranges of a key may overlap or touch.
    """
    shelf = Shelf(texts)
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = texts.mapInArrow(_find_anchors(length), "anchor long, key long, first long, last long, more boolean").repartition(parts, "anchor")
    spot = F.struct("key", "first")
    often = dealt.groupBy("anchor").agg(F.min(spot).alias("_a"), F.max(spot).alias("_b"), F.max("more").alias("_more")).where("_a != _b or _more").select("anchor")
    spots = shelf.put(
        dealt.join(often.hint("shuffle_hash"), "anchor", "left_semi").groupBy("key").agg(
            F.collect_set(F.struct("first", "last")).alias("spots")
        ),
        "spots",
    )
    pieces = texts.join(spots, "key").select("key", "text", "spots").mapInArrow(
        _cut(length), "anchor long, key long, first long, last long, piece binary"
    )
    return (
        pieces.repartition(parts * 2, "anchor").sortWithinPartitions("anchor")
        .mapInArrow(_sort_shards(length), "key long, begin long, end long")
    )


def _erase(length: int, schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs, copies = batch.column(batch.num_columns - 1).to_pylist(), batch.column(batch.num_columns - 2).to_pylist()
            texts = batch.column(batch.num_columns - 3)
            kept, removed, spans, sizes = [], [], [], []
            for i, (ranges, often) in enumerate(zip(runs, copies)):
                data = raw_bytes(texts.slice(i, 1))[0]
                edge = np.zeros(len(data) + 1, np.int32)
                if often and len(data) >= length:
                    ranges = [{"begin": 0, "end": len(data)}]
                if ranges:
                    np.add.at(edge, [r["begin"] for r in ranges], 1)
                    np.add.at(edge, [r["end"] for r in ranges], -1)
                gone = np.cumsum(edge[:-1]) > 0
                kept.append(data[~gone].tobytes())
                removed.append(int(gone.sum()))
                spans.append(int((gone & ~np.append(False, gone[:-1])).sum()))
                sizes.append(len(data))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-3], *(pa.array(x, pa.int64()) for x in (sizes, removed, spans)), pa.array(kept, pa.binary())],
                names=schema.names,
            )

    return run


def drop_repeats(
    docs: DataFrame, keep: list[str], text_col: str = "text", length: int = LENGTH,
    names: tuple[str, str, str, str] = ("n_bytes", "n_removed", "n_spans", "kept_bytes"),
) -> DataFrame:
    """The columns ``keep`` of every row with what is left of its text, as bytes, and counts.

    Each byte that is covered by a string of ``length`` bytes which also starts anywhere else, in
    the same text or another row, is removed. Strings are judged on the input and do not run from
    one text into another. Null texts count as empty; every row is a text of its own, also if it
    repeats an id. A cut may fall inside a character. A text may have any length, and no text is slow
    because it repeats itself. Other columns are not read.
    """
    from pyspark.sql import types as T

    shelf = Shelf(docs)
    key, text, many, runs, rkey, ckey = fresh(keep, "key", "text", "many", "runs", "run_key", "copy_key")
    keyed = docs.select(*keep, text_of(text_col).alias(text)).withColumn(key, F.xxhash64(text))
    plain = keyed.select(F.col(key).alias("key"), F.col(text).alias("text"))
    found = shelf.put(
        repeated_runs(plain, length).groupBy("key").agg(F.collect_set(F.struct("begin", "end")).alias("runs")), "runs"
    )
    copies = shelf.put(plain.groupBy("key").agg((F.count(F.lit(1)) > 1).alias("many")).where("many"), "copies")
    marks = found.join(copies, "key", "full").select(F.col("key").alias(rkey), F.col("many").alias(many), F.col("runs").alias(runs))
    both = keyed.join(marks, keyed[key] == marks[rkey], "left")
    schema = T.StructType(
        [docs.schema[c] for c in keep] + [T.StructField(n, T.LongType()) for n in names[:3]] + [T.StructField(names[3], T.BinaryType())]
    )
    return both.select(*keep, text, many, runs).mapInArrow(_erase(length, schema), schema)
