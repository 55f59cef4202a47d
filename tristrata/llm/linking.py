"""From band hashes to verified components, without all pairs of a group.

Ids that share a bucket form a star around the smallest id of the bucket, and each ray is verified
on the texts. What a star leaves apart can still be linked: in buckets whose members are in more than
one component, those outside the largest one are compared with each other and with its members in
square tiles of bounded size, where only links that join two components are returned. So no link
between candidates is lost, and no group meets in one task.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tristrata.llm.components import components
from tristrata.llm.rows import Shelf, mix, slices
from tristrata.llm.shingles import HASH_BITS

# Texts -> distinct hashes, their counts and the place of their text, ordered by text and hash.
Measure = Callable[[list[str]], tuple[np.ndarray, np.ndarray, np.ndarray]]
TILE = 256  # texts on each side of a tile
COLUMNS = 8192  # elements of a pack that are compared at a time
PACKED = 512  # entries of buckets in a row
HELD = 1 << 20  # entries, of 16 bytes, that a task packs or looks through at a time
GROUPS = 4  # of buckets for each partition, which are looked through one after the other
CHARS = 1 << 17  # characters that are measured at a time; a longer text comes alone
PARITIES = 512  # cells whose parities bound the difference of two texts
CROWD = 4  # pairs for each row of a tile from which on the tile is compared at once
PACK_CHARS = 1 << 18  # characters of a pack of tiles; a longer tile comes alone


def measured(measure: Measure, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``measure`` of all texts, some of them at a time."""
    found, start, total = [], 0, 0
    for i, text in enumerate([*texts, None]):
        if i > start and (text is None or total + len(text) > CHARS):
            hashes, counts, owner = measure(texts[start:i])
            found.append((hashes, counts, owner + start))
            start, total = i, 0
        total += len(text or "")
    return tuple(np.concatenate(x) for x in zip(*found))


def overlaps(measure: Measure, lefts: list[str], which: np.ndarray, rights: list[str]) -> np.ndarray:
    """Weighted Jaccard of each right text's multiset with that of the left text ``which`` names."""
    lh, lc, lo = measured(measure, lefts)
    rh, rc, ro = measured(measure, rights)
    held = lo.astype(np.uint64) << HASH_BITS | lh  # in order, as owners and hashes are
    asked = which[ro].astype(np.uint64) << HASH_BITS | rh
    at = np.minimum(np.searchsorted(held, asked), max(len(held) - 1, 0))
    shared = np.zeros(len(rights))
    if len(held):
        both = held[at] == asked
        shared = np.bincount(ro[both], np.minimum(lc[at[both]], rc[both]), len(rights))
    total = np.bincount(lo, lc, len(lefts))[which] + np.bincount(ro, rc, len(rights)) - shared
    return np.divide(shared, total, out=np.zeros(len(rights)), where=total > 0)


def _verified(measure: Measure, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for wide in slices(batch, 2, CHARS):
                for part in slices(wide, 3, CHARS):
                    _, first, which = np.unique(np.asarray(part.column(0)), return_index=True, return_inverse=True)
                    lefts = part.column(2).take(pa.array(first)).to_pylist()
                    good = overlaps(measure, lefts, which, part.column(3).to_pylist()) >= threshold
                    yield part.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def _shared(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """The size of the common part of each two of ``n`` sets.

    Common parts are a product of matrices of zeros and ones, taken over some columns at a time.
    Elements of one text only are left out.
    """
    by = np.argsort(hashes)  # which of equal elements comes first does not matter
    hashes = hashes[by]
    several = np.zeros(len(hashes), bool)  # elements of more than one text
    same = hashes[1:] == hashes[:-1]
    several[1:] |= same
    several[:-1] |= same
    owner, hashes = owner[by][several], hashes[several]
    column = np.zeros(len(hashes), np.int64)
    column[1:] = np.cumsum(hashes[1:] != hashes[:-1])
    out = np.zeros((n, n))
    width = int(column[-1]) + 1 if len(column) else 0
    for lo in range(0, width, COLUMNS):
        a, b = np.searchsorted(column, [lo, lo + COLUMNS])
        has = np.zeros((n, min(COLUMNS, width - lo)), np.float32)
        has[owner[a:b], column[a:b] - lo] = 1
        out += has @ has.T
    return out


def _elements(hashes: np.ndarray, counts: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Multisets as sorted values of owner and hash; the n-th occurrence of an element counts as one of its own."""
    if len(counts) and counts.max() > 1:
        at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        hashes, owner = mix(np.repeat(hashes, counts) ^ mix(at, 20), 21) >> (np.uint64(64) - HASH_BITS), np.repeat(owner, counts)
        return np.sort(owner.astype(np.uint64) << HASH_BITS | hashes)
    return owner.astype(np.uint64) << HASH_BITS | hashes


def _may_link(held: np.ndarray, size: np.ndarray, threshold: float) -> np.ndarray:
    """Which two texts can be linked, by a bound that no link exceeds.

    A text's elements fall into ``PARITIES`` cells. Where the numbers in a cell of two texts are one
    odd and one even, an element is in one of them only, and a link allows so many of those.
    """
    n = len(size)
    cell = (held >> HASH_BITS) * np.uint64(PARITIES) + held % np.uint64(PARITIES)
    odd = (np.bincount(cell.astype(np.int64), minlength=n * PARITIES) & 1).astype(np.float32).reshape(n, PARITIES)
    ones = odd.sum(1)
    apart = ones[:, None] + ones[None, :] - 2 * (odd @ odd.T)
    return (1 + threshold) * apart <= (1 - threshold) * (size[:, None] + size[None, :]) + 0.01


def _common(held: np.ndarray, edges: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The size of the common part of the texts of each pair, some pairs at a time."""
    n = edges[b + 1] - edges[b]
    out = np.zeros(len(a), np.int64)
    part = np.cumsum(n) // CHARS
    for lo, hi in zip(cuts := np.flatnonzero(np.append(True, part[1:] != part[:-1])[: len(part)]), [*cuts[1:], len(part)]):
        pair = np.repeat(np.arange(lo, hi), n[lo:hi])
        place = np.arange(len(pair)) - np.repeat(np.cumsum(n[lo:hi]) - n[lo:hi], n[lo:hi]) + edges[b[pair]]
        asked = held[place] & ((np.uint64(1) << HASH_BITS) - np.uint64(1)) | a[pair].astype(np.uint64) << HASH_BITS
        found = held[np.minimum(np.searchsorted(held, asked), len(held) - 1)] == asked
        out[lo:hi] = np.bincount(pair[found] - lo, minlength=hi - lo)
    return out


def _pack_links(measure: Measure, threshold: float, rows: list[tuple]) -> pa.RecordBatch:
    """Links inside the tiles of a pack, at most one for each pair of components in a tile.

    ``rows`` has (tile, in the tile's first block, id, component, text), tile by tile. Texts are
    measured together. Pairs that may be linked are compared one by one, and where a tile has many of
    them, all at once.
    """
    tile, first, ids, comp = (np.array([x[k] for x in rows]) for k in range(4))
    _, at, which = np.unique(ids, return_index=True, return_inverse=True)
    held = _elements(*measured(measure, [rows[i][4] for i in at]))
    edges = np.searchsorted(held, np.arange(len(at) + 1, dtype=np.uint64) << HASH_BITS)
    size = np.diff(edges)
    starts = np.flatnonzero(np.append(True, tile[1:] != tile[:-1]))
    rows_of = np.diff(np.append(starts, len(tile)))
    alone = np.repeat(np.logical_and.reduceat(first, starts), rows_of)
    # Two blocks: each is compared with itself in a tile of its own.
    asked = (tile[:, None] == tile[None, :]) & (comp[:, None] < comp[None, :]) & (alone[:, None] | (first[:, None] != first[None, :]))
    i, j = np.nonzero(asked)
    may = _may_link(held, size, threshold)[which[i], which[j]]
    i, j = i[may], j[may]
    place = np.repeat(np.arange(len(starts)), rows_of)
    crowded = np.bincount(place[i], minlength=len(starts)) > CROWD * rows_of
    shared = np.zeros(len(i))
    few = ~crowded[place[i]]
    pairs, back = np.unique(which[i[few]] * len(at) + which[j[few]], return_inverse=True)
    shared[few] = _common(held, edges, *np.divmod(pairs, len(at)))[back]
    for t in np.flatnonzero(crowded):
        lo, own = starts[t], which[starts[t] : starts[t] + rows_of[t]]
        elements = np.concatenate([held[edges[w] : edges[w + 1]] for w in own]) & ((np.uint64(1) << HASH_BITS) - np.uint64(1))
        here = place[i] == t
        shared[here] = _shared(elements, np.repeat(np.arange(len(own)), size[own]), len(own))[i[here] - lo, j[here] - lo]
    total = size[which[i]] + size[which[j]]
    near = (shared >= threshold * (total - shared)) & (shared > 0)
    i, j = i[near], j[near]
    _, one = np.unique(np.stack([place[i], comp[i], comp[j]]), axis=1, return_index=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[i[one]], pa.int64()), pa.array(ids[j[one]], pa.int64())], names=["a", "b"]
    )


def _tiles(measure: Measure, threshold: float):
    """Links of tiles whose rows (bucket, i, j, block, id, component, text) follow each other.

    Small tiles are packed: the texts of whole tiles are measured together once they have the rows of a block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, last, n, chars = [], None, 0, 0
        for batch in batches:
            for *tile, block, key, comp, text in zip(*(x.to_pylist() for x in batch.columns)):
                if tile != last:
                    if len(pack) >= TILE or chars > PACK_CHARS:
                        yield _pack_links(measure, threshold, pack)
                        pack, n, chars = [], 0, 0
                    last, n = tile, n + 1
                pack.append((n, block == tile[1], key, comp, text))
                chars += len(text)
        if pack:
            yield _pack_links(measure, threshold, pack)

    return run


def pack(bucket: np.ndarray, ids: np.ndarray, groups: int) -> pa.RecordBatch:
    """Entries (bucket, id) as rows of many of them: ``group``, which follows from the bucket, and ``entries``."""
    group = ((bucket.view(np.uint64) >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)).astype(np.int32)
    by = np.argsort(group, kind="stable")
    group, entries = group[by], np.stack([bucket[by], ids[by]], axis=1)
    cuts = np.flatnonzero(np.append(True, group[1:] != group[:-1])[: len(group)])
    cuts = [x for lo, hi in zip(cuts, [*cuts[1:], len(group)]) for x in range(lo, hi, PACKED)]
    return pa.RecordBatch.from_arrays(
        [pa.array(group[cuts]), pa.array([entries[a:b].tobytes() for a, b in zip(cuts, [*cuts[1:], len(group)])], pa.binary())],
        names=["group", "entries"],
    )


def packed(found: Iterator[tuple[np.ndarray, np.ndarray]], groups: int) -> Iterator[pa.RecordBatch]:
    """The rows of ``pack`` for arrays of buckets and ids, many entries at a time."""
    held, n = [], 0
    for some in found:
        held.append(some)
        n += len(some[0])
        if n >= HELD:
            yield pack(*map(np.concatenate, zip(*held)), groups)
            held, n = [], 0
    if n:
        yield pack(*map(np.concatenate, zip(*held)), groups)


def _met(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct entries of buckets that hold several ids, and one entry of every other bucket."""
    bucket, ids = entries[np.argsort(entries[:, 0])].T
    head = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[: len(bucket)])
    several = np.minimum.reduceat(ids, head) != np.maximum.reduceat(ids, head) if len(head) else head > 0
    inside = np.repeat(several, np.diff(np.append(head, len(bucket))))
    bucket_in, ids_in = bucket[inside], ids[inside]
    by = np.lexsort((ids_in, bucket_in))
    met = np.stack([bucket_in[by], ids_in[by]], axis=1)
    met = met[np.append(True, (met[1:] != met[:-1]).any(axis=1))[: len(met)]]
    return met, np.stack([bucket[head[~several]], ids[head[~several]]], axis=1)


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The entries of buckets that hold several ids; rows of a group follow each other.

    A group's entries are looked through ``HELD`` at a time (more if as many buckets are left with
    one id). Entries of a bucket that was seen with several ids pass at once, so a bucket of any size is
    never held.
    """

    def made(entries: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(entries[:, 0].copy()), pa.array(entries[:, 1].copy())], names=["bucket", "id"])

    none = np.zeros((0, 2), np.int64)
    last, known, lone, fresh, size = None, none[:, 0], none, [], 0

    def looked() -> np.ndarray:
        nonlocal known, lone, fresh, size
        entries = np.frombuffer(b"".join(fresh), np.int64).reshape(-1, 2)
        open_ = np.isin(entries[:, 0], known) if len(known) else np.zeros(len(entries), bool)
        met, lone = _met(np.concatenate([lone, entries[~open_]]))
        known = np.concatenate([known, np.unique(met[:, 0])])
        fresh, size = [], 0
        return np.concatenate([entries[open_], met])

    for batch in batches:
        for group, entries in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if size and (group != last or size >= 16 * max(HELD, len(lone))):
                yield made(looked())
            if group != last:
                last, known, lone = group, none[:, 0], none
            fresh.append(entries)
            size += len(entries)
    if size:
        yield made(looked())


def meetings(rows: DataFrame, parts: int) -> DataFrame:
    """Columns ``bucket`` and ``id``: the entries of buckets that hold more than one id.

    ``rows`` has the packed entries (group, entries). Most buckets hold one id; their entries never
    become rows.
    """
    return rows.repartition(parts, "group").sortWithinPartitions("group").mapInArrow(_meetings, "bucket long, id long")


def _fetch(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """One text for each wanted id."""
    return texts.join(ids.hint("shuffle_hash"), "id", "left_semi").groupBy("id").agg(F.first("text").alias("text"))


def classes(
    buckets: DataFrame, texts: DataFrame, measure: Measure, threshold: float, parts: int
) -> DataFrame:
    """Columns ``id`` and ``component`` of every id that is linked with another one.

    ``buckets`` has (bucket, id), repeats allowed, entries alone in their bucket (see ``meetings``) needless; ``texts`` has (id, text), where equal ids have
    equal texts. ``parts`` is the number of partitions buckets are dealt to. An id shows up once in
    a bucket at most after the first join, so of all entries a bucket can hold one in as many as
    there are bands.
    """
    shelf = Shelf(buckets)
    dealt = buckets.repartition(parts, "bucket")
    several = (
        dealt.groupBy("bucket").agg(F.min("id").alias("leader"), F.max("id").alias("_last"))
        .where("leader != _last").drop("_last")
    )
    # The entries need no sorting: the few shared buckets of a partition are looked up.
    stars = shelf.put(dealt.join(several.hint("shuffle_hash"), "bucket").distinct(), "stars")
    rays = shelf.put(
        stars.where("id != leader").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct(),
        "rays",
    )
    wanted = rays.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    found = shelf.put(_fetch(texts, wanted), "texts")
    pairs = (
        rays.join(found.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
        .join(found.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
        .select("a", "b", "ta", "tb")
    )
    links = shelf.put(pairs.mapInArrow(_verified(measure, threshold), "a long, b long"), "verified")
    shelf.drop(rays)
    first = shelf.put(components(links), "components")

    known = first.select("id", "component")
    placed = stars.join(known, "id", "left").select("bucket", "id", F.coalesce("component", "id").alias("component"))
    spread = placed.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("_m"), F.min("id").alias("_l"), F.bit_xor(F.xxhash64("id")).alias("_x"))
    open_buckets = spread.groupBy("bucket").agg(
        F.max(F.struct("_m", "component")).alias("_home"), F.sum("_m").alias("_n"), F.count(F.lit(1)).alias("_apart"),
        F.min("_l").alias("_least"), F.bit_xor("_x").alias("_members"),
    ).where("_apart > 1 and _n > 2")
    # Buckets of the same members, as near copies share in many bands, are compared once.
    open_buckets = open_buckets.groupBy("_n", "_least", "_members").agg(F.min(F.struct("bucket", "_home")).alias("_b")).select(
        F.col("_b.bucket").alias("bucket"), F.col("_b._home.component").alias("_home"),
        F.ceil((F.col("_n") - F.col("_b._home._m")) / F.lit(TILE)).cast("int").alias("_away"),
        F.ceil(F.col("_b._home._m") / F.lit(TILE)).cast("int").alias("_at"),
    )
    # The largest component of a bucket is not compared with itself: its members meet the blocks of
    # those away from it, which are numbered first, and those meet all blocks.
    at_home = F.col("component") == F.col("_home")
    blocks = F.when(at_home, F.col("_at")).otherwise(F.col("_away"))
    block = F.pmod(F.xxhash64("id"), blocks).cast("int") + F.when(at_home, F.col("_away")).otherwise(0)
    others = F.when(at_home, F.col("_away")).otherwise(F.col("_away") + F.col("_at"))
    apart = (
        placed.join(open_buckets, "bucket")
        .withColumn("block", block)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), others - 1)))
        .select(
            "bucket", "id", "component", "block",
            F.least("block", "_other").alias("i"), F.greatest("block", "_other").alias("j"),
        )
    )
    more = shelf.put(
        apart.join(found, "id").select("bucket", "i", "j", "block", "id", "component", "text")
        .repartition(parts, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
        .mapInArrow(_tiles(measure, threshold), "a long, b long"),
        "joined",
    )
    return components(links.unionByName(more))
