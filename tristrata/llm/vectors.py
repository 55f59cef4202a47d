"""Near-duplicate embeddings: exact links from int8 tile products with rigorous error bounds.

Each vector is scaled to length one and quantised to int8; the length of what quantisation lost is
kept. If u = a + e and v = b + f with quantised a, b, then u.v differs from a.b by at most
|a||f| + |e||b| + |e||f|. Vectors of a label are dealt to blocks of bounded size, and each pair of
blocks is a tile: one product of small integers, which is exact. Only pairs whose product plus bound
reaches the threshold are computed again in double precision. A tile returns counts and the
components of its links, never the pairs.
"""

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tristrata.llm.components import components
from tristrata.llm.rows import Shelf

THRESHOLD = 0.98
BLOCK = 2048
EXACT = 1024  # components whose int8 products a float32 adds up exactly (1024 * 127 * 127 < 2^24)
PAIRS = 1 << 15  # pairs computed again at a time


def quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Int8 vectors, their scales, and a bound for the length of what they lost."""
    unit = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
    scale = 127 / np.abs(unit).max(axis=1)
    small = np.rint(unit * scale[:, None]).astype(np.int8)
    lost = unit - small / scale[:, None]
    return small, scale, np.sqrt((lost * lost).sum(axis=1)) + 1e-12


def candidates(a: np.ndarray, b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of rows whose cosine may reach the threshold."""
    (qa, sa, ea), (qb, sb, eb) = quantised(a), quantised(b)
    product = np.zeros((len(a), len(b)), np.float64 if a.shape[1] > EXACT else np.float32)
    for lo in range(0, a.shape[1], EXACT):
        product += qa[:, lo : lo + EXACT].astype(np.float32) @ qb[:, lo : lo + EXACT].astype(np.float32).T
    bound = ea[:, None] + eb[None, :] + 3 * ea[:, None] * eb[None, :]
    return np.nonzero(product >= (threshold - bound - 1e-9) * (sa[:, None] * sb[None, :]))


def _cosines(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact double-precision cosines of the given pairs; scaled first, so squares stay finite."""
    a = a / np.abs(a).max(axis=1, keepdims=True)
    b = b / np.abs(b).max(axis=1, keepdims=True)
    la, lb = (np.sqrt((x * x).sum(axis=1)) for x in (a, b))
    out = np.empty(len(i))
    for lo in range(0, len(i), PAIRS):
        x, y = i[lo : lo + PAIRS], j[lo : lo + PAIRS]
        out[lo : lo + PAIRS] = np.einsum("ij,ij->i", a[x], b[y]) / (la[x] * lb[y])
    return out


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest index linked with each index, directly or through others."""
    root = np.arange(n)
    while True:
        before = root.copy()
        np.minimum.at(root, i, root[j])
        np.minimum.at(root, j, root[i])
        root = root[root]
        if (root == before).all():
            return root


def _tile(threshold: float) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("block", kind="stable")
        x = np.array(part["vector"].tolist(), np.float64)
        first = int((part["block"] == part["i"]).sum())
        whole = first == len(part)  # a block with itself
        i, j = candidates(x[:first], x if whole else x[first:], threshold)
        if whole:
            i, j = i[i < j], j[i < j]
        else:
            j = j + first
        near = _cosines(x, x, i, j) >= threshold
        i, j = i[near], j[near]
        copies = part["n"].to_numpy()
        links = np.zeros(len(part), np.int64)
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        root = _roots(len(part), i, j)
        some = np.flatnonzero(links)
        ids = part["id"].to_numpy()
        return pd.DataFrame({
            "id": ids[some], "key": part["key"].to_numpy()[some], "links": links[some], "root": ids[root[some]],
        })

    return run


def near_vectors(
    vectors: DataFrame, id_col="vec_id", vec_col="embedding", label_col="label",
    threshold: float = THRESHOLD, block: int = BLOCK,
) -> DataFrame:
    """``id``, ``n_links``, ``component_id`` and ``kept`` of every row.

    Vectors are linked if their labels are equal and not null, their lengths are equal and their
    cosine is at least ``threshold``. A vector that is null, empty, zero, or holds a null or a
    number that is not finite is linked with nothing. ``n_links`` counts rows; equal vectors of a
    label are compared once and counted as often as they occur. Rows that repeat an id are one node
    of the components. A row with a null id has no links and no component, and is not kept.
    """
    shelf = Shelf(vectors)
    vector = F.col(vec_col).cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.coalesce(
        F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False)
    )
    rows = vectors.select(
        F.col(id_col).alias("id"), F.when(good, F.col(label_col)).alias("label"), F.when(good, vector).alias("vector")
    ).withColumn("key", F.xxhash64("label", "vector"))
    groups = shelf.put(
        rows.where("vector is not null").groupBy("label", "key", "vector").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n")),
        "vectors",
    )
    sizes = groups.groupBy("label", F.size("vector").alias("dim")).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    tiles = (
        groups.withColumn("dim", F.size("vector")).join(sizes, ["label", "dim"])
        .withColumn("block", F.pmod(F.xxhash64("key", "id"), F.col("blocks")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("label", "dim", "id", "key", "vector", "n", "block", F.least("block", "_other").alias("i"), F.greatest("block", "_other").alias("j"))
    )
    found = shelf.put(
        tiles.groupBy("label", "dim", "i", "j").applyInPandas(_tile(threshold), "id long, key long, links long, root long"),
        "tiles",
    )
    joined = shelf.put(components(found, "id", "root"), "components")
    sums = found.groupBy("id", "key").agg(F.sum("links").alias("links"))
    info = groups.join(sums, ["id", "key"], "left").join(joined, "id", "left").select(
        "label", "key", "vector", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
    )
    return rows.join(info, ["label", "key", "vector"], "left").select(
        "id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.lit(False)).alias("kept"),
    )
