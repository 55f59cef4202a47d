"""Pieces the operators share: stored intermediates and flat views of Arrow text columns."""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tristrata.sources import fs, scratch

SLICE_BYTES = 1 << 20  # text a task holds as numpy arrays at a time; a longer text comes alone


class Shelf:
    """Intermediate tables of one operator call, written to the folder the cluster shares."""

    def __init__(self, df: DataFrame):
        self.spark = df.sparkSession
        self.paths: dict[int, str] = {}

    def put(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch.new_path(self.spark, label)
        with scratch.shuffles_dropped(self.spark):
            df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        return out

    def drop(self, df: DataFrame) -> None:
        """Delete a table that nothing reads any more."""
        fs.delete(self.spark, self.paths.pop(id(df)))


def text_of(column: str | Column) -> Column:
    """A text column with null read as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def fresh(taken: list[str], *names: str) -> list[str]:
    """Names like the given ones that clash with no column of ``taken``, in any letter case."""
    used = {t.lower() for t in taken}
    out = []
    for name in names:
        while name.lower() in used:
            name = "_" + name
        used.add(name.lower())
        out.append(name)
    return out


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row and where each starts (and the last ends)."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def code_points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts in a row and where each text starts (and the last ends)."""
    data, at = raw_bytes(column)
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    inside = np.flatnonzero(data.view(np.int8) < -64)  # bytes that begin no character
    return points, at - np.searchsorted(inside, at)


def slices(
    batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES, length: Callable = pc.binary_length
) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts (or lists) have at most ``limit`` bytes (items) together."""
    sizes = pc.fill_null(length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, size in enumerate(sizes.tolist()):
        if total and total + size > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < batch.num_rows:
        yield batch.slice(start)


def mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser: equal inputs give equal outputs, others look independent."""
    x = x.astype(np.uint64, copy=True)
    x += np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


def band_hashes(signatures: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit value for each row and band of a signature matrix, as signed integers."""
    n, width = signatures.shape
    parts = signatures.reshape(n, bands, width // bands)
    out = np.broadcast_to(np.arange(bands, dtype=np.uint64), (n, bands)).copy()
    for k in range(width // bands):
        out = mix(out ^ parts[:, :, k], k + 1)
    return out.view(np.int64)
