"""Language identification by rank-order n-gram profiles.

A profile is a language's most frequent n-grams (one to three characters, lower case, a word edge
counts as a character) in order of frequency. A text is compared with every profile by the
out-of-place distance: how far each of the text's own most frequent n-grams is from its place in
the profile, or the most possible if the profile lacks it.
"""

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tristrata.llm.rows import Shelf, code_points, fresh, slices, text_of

HELD_BYTES = 1 << 18  # text whose n-grams a task holds at a time; a longer text comes alone
PLACES = 400  # n-grams of a profile, and of a text that are compared with it
MAX_LANGUAGES = 1000  # bounds the profiles that every task receives
UNKNOWN = "und"
LOW = 0.01  # the quantile of the scores of a language's own texts that its limit is taken from
SLACK = 0.8  # share of that quantile a text has to reach
NONE = (1 << 21) - 1  # the digit of an n-gram shorter than three; above every code point


@cache
def _letters() -> np.ndarray:
    """Lower-case code point of every letter, 0 for all else."""
    out = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        if chr(c).isalpha():
            low = chr(c).lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


class Grams:
    """N-gram counts of the texts of a slice, as numbers over the slice's own alphabet."""

    def __init__(self, column: pa.Array):
        points, starts = code_points(column)
        self.n = n = len(starts) - 1
        owner = np.repeat(np.arange(n, dtype=np.int32), np.diff(starts))
        flat = np.zeros(len(points) + n + 1, np.uint32)
        flat[np.arange(len(points)) + owner + 1] = _letters()[points]
        texts = np.zeros(len(flat), np.int32)
        texts[np.arange(len(points)) + owner + 1] = owner
        texts[starts[1:] + np.arange(1, n + 1)] = np.arange(n)
        keep = flat != 0
        keep[1:] |= flat[:-1] != 0
        keep[0] = True
        flat, texts = flat[keep], texts[keep]
        present = np.zeros(0x110000, bool)
        present[flat] = True
        present[0] = True
        self.alphabet = np.flatnonzero(present)
        small = np.zeros(0x110000, np.int32)
        small[self.alphabet] = np.arange(len(self.alphabet))
        s = small[flat].astype(np.int64)
        self.base = a = len(self.alphabet)
        self.span = 3 * a**3
        one = s != 0
        two = np.zeros(len(s), bool)
        two[:-1] = one[:-1] | one[1:]
        three = np.zeros(len(s), bool)
        three[:-2] = one[1:-1]
        # A separator belongs to the text before it; a gram that starts there to the text after.
        after = texts.copy()
        after[:-1] = np.where(s[:-1] == 0, texts[1:], texts[:-1])
        pair = np.zeros(len(s), np.int64)
        pair[:-1] = s[:-1] * a + s[1:]
        triple = np.zeros(len(s), np.int64)
        triple[:-2] = pair[:-2] * a + s[2:]
        codes = [
            after[m] * np.int64(self.span) + k * a**3 + v[m]
            for k, (m, v) in enumerate(((one, s), (two, pair), (three, triple)))
        ]
        keys = np.concatenate(codes)
        if n * self.span < 2**32:
            keys = keys.astype(np.uint32)
        keys.sort()
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
        self.count = np.diff(np.append(first, len(keys)))
        keys = keys[first].astype(np.int64)
        self.owner, self.gram = keys // self.span, keys % self.span

    def world(self, gram: np.ndarray) -> np.ndarray:
        """The numbers of n-grams that are the same for every slice."""
        a = self.base
        length, value = gram // a**3, gram % a**3
        letter = self.alphabet.astype(np.int64)
        x, y, z = letter[value // a**2], letter[value // a % a], letter[value % a]
        x = np.where(length < 2, NONE, x)
        y = np.where(length < 1, NONE, y)
        return x << 42 | y << 21 | z

    def local(self, world: np.ndarray) -> np.ndarray:
        """The slice's numbers of n-grams; -1 where a character does not occur in the slice."""
        a = self.base
        digits = [world >> 42, world >> 21 & NONE, world & NONE]
        length = 2 - (digits[0] == NONE) - (digits[1] == NONE)
        out, known = length * 0, np.ones(len(world), bool)
        for d in digits:
            d = np.where(d == NONE, 0, d)
            at = np.minimum(np.searchsorted(self.alphabet, d), a - 1)
            known &= self.alphabet[at] == d
            out = out * a + at
        return np.where(known, length * a**3 + out, -1)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, 1, HELD_BYTES):
            grams = Grams(part.column(1))
            names, lang = np.unique(np.array(part.column(0).to_pylist(), object), return_inverse=True)
            keys = lang[grams.owner] * grams.span + grams.gram
            order = np.argsort(keys)
            keys, count = keys[order], grams.count[order]
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else keys
            if not len(first):
                continue
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names[keys[first] // grams.span], pa.string()),
                    pa.array(grams.world(keys[first] % grams.span)),
                    pa.array(np.add.reduceat(count, first)),
                ],
                names=["lang", "gram", "n"],
            )


def profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Columns ``lang``, ``gram`` and ``place`` (from 0): learned from all rows with a language.

    Ties in frequency are in order of the n-gram. Null texts teach nothing.
    """
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).mapInArrow(
        _counts, "lang string, gram long, n long"
    )
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return (
        counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= PLACES)  # in this form the engine cuts each task's n-grams before they are moved
        .select("lang", "gram", (F.col("place") - 1).alias("place"))
    )


def _distances(grams: Grams, world: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Out-of-place distance of each text (row) to each language, and how many n-grams counted."""
    start = np.searchsorted(grams.owner, np.arange(grams.n + 1))
    inside = np.arange(len(grams.owner)) - start[grams.owner]
    if len(grams.owner) and inside.max() < 1 << 21 and grams.n < 1 << 20:
        rare = (1 << 22) - 1 - np.minimum(grams.count, (1 << 22) - 1)
        keys = grams.owner << 43 | rare << 21 | inside
        keys.sort()
        order = start[grams.owner] + (keys & (1 << 21) - 1)
    else:
        order = np.lexsort((grams.gram, -grams.count, grams.owner))
    chosen = inside < PLACES
    place, owner, gram = inside[chosen], grams.owner[chosen], grams.gram[order[chosen]]
    near = grams.local(world)
    by = np.argsort(near)
    at = np.minimum(np.searchsorted(near[by], gram), len(by) - 1)
    row = np.where(near[by][at] == gram, by[at], len(world))
    used = np.bincount(owner, minlength=grams.n)
    out = np.empty((grams.n, table.shape[1]))
    for k in range(table.shape[1]):
        there = table[:, k][row]
        off = np.where(there < 0, PLACES, np.abs(there - place))
        out[:, k] = np.bincount(owner, weights=off, minlength=grams.n)
    return out, used


def identify(
    docs: DataFrame,
    learned: DataFrame,
    keep: list[str],
    text_col: str = "text",
    names: tuple[str, str] = ("lang_pred", "score"),
) -> DataFrame:
    """The columns ``keep`` of every row with the predicted language and a score from 0 to 1.

    The score is one minus the distance to the nearest profile over the largest possible one. Ties
    go to the first language in order of the names. Texts that are null or hold no letter are
    ``und`` with score 0, and so is everything if ``learned`` (from ``profiles``) is empty. Rows do not
    depend on one another, so repeated rows agree and an empty table gives none; a long text is judged
    whole, alone. Columns of ``keep`` may not have the made names.
    """
    if clash := {c.lower() for c in keep} & {n.lower() for n in names}:
        raise ValueError(f"columns to keep have names of the result: {sorted(clash)}")
    rows = learned.limit(PLACES * MAX_LANGUAGES + 1).collect()
    if len(rows) > PLACES * MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = sorted({r.lang for r in rows})
    world = np.unique(np.array([r.gram for r in rows], np.int64))
    table = np.full((len(world) + 1, len(languages)), -1, np.int64)
    for r in rows:
        table[np.searchsorted(world, r.gram), languages.index(r.lang)] = r.place
    known = np.array(languages + [UNKNOWN], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, batch.num_columns - 1, HELD_BYTES):
                best = np.full(part.num_rows, len(languages))
                score = np.zeros(part.num_rows)
                if languages:
                    off, used = _distances(Grams(part.column(part.num_columns - 1)), world, table)
                    some = used > 0
                    best[some] = off[some].argmin(axis=1)
                    score[some] = 1 - off[some].min(axis=1) / (used[some] * PLACES)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(known[best], pa.string()), pa.array(score)],
                    names=schema.names,
                )

    schema = T.StructType(
        [docs.schema[c] for c in keep]
        + [T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())]
    )
    hidden = fresh([*keep, *names], "_whole_text")[0]
    return docs.select(*keep, F.col(text_col).alias(hidden)).mapInArrow(run, schema)


def recognised(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows whose text is in a language that the rows with a language teach.

    A text's score depends on how much it says, so texts are banded by their number of letters
    (powers of two). The limit of a language in a band is a share of a low quantile of the scores of
    all its own texts there (labelled so and recognised so), and where it has none the least of its
    limits. Texts below their language's limit are rejected, and so are those without a letter.
    """
    shelf = Shelf(docs)
    pred, score, band, limit, least, lang, part = fresh(
        docs.columns, "lang_pred", "score", "band", "limit", "least", "limit_lang", "limit_band"
    )
    letters = F.length(F.regexp_replace(text_of(text_col), r"\P{L}+", ""))
    named = identify(docs, profiles(docs, text_col, lang_col), docs.columns, text_col, names=(pred, score))
    named = named.where(F.col(pred) != UNKNOWN).withColumn(band, F.floor(F.log2(F.greatest(letters, F.lit(1)))))
    named = shelf.put(named, "named")
    limits = (
        named.where(F.col(pred) == F.col(lang_col)).groupBy(F.col(pred).alias(lang), F.col(band).alias(part))
        .agg((F.percentile_approx(score, LOW, 10000) * SLACK).alias(limit))
    )
    lows = limits.groupBy(F.col(lang).alias(pred)).agg(F.min(limit).alias(least))
    # A language has a limit for each power of two of a text's length, so both tables are small.
    both = named.join(F.broadcast(lows), pred, "left").join(
        F.broadcast(limits), (F.col(pred) == F.col(lang)) & (F.col(band) == F.col(part)), "left"
    )
    held = F.coalesce(limit, least, F.lit(0.0))
    return both.where((F.col(score) > 0) & (F.col(score) >= held)).select(docs.columns)
