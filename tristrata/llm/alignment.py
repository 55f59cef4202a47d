"""Alignment of two tokenizers: which tokens of one end where tokens of the other do.

Texts are encoded by both. All that follows is done on Arrow arrays of a slice of texts: the id lists
are flattened with their parents, cumulative sums of token lengths that start anew with each text give
byte ends, a hash join on (text, end) finds the links, and a grouping counts id pairs for each text.
Spark merges these partial counts over the corpus and joins them to the texts' pairs again.
"""

import hashlib
import json
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from tristrata.llm.bpe import WORDS, _token_bytes
from tristrata.llm.rows import Shelf, fresh, slices

LONG_SPACE = re.compile(r"\s{1000}")  # beyond some 10,000 the fast encoder's pattern runs out of stack
MOST_PAIRS = 5_000_000  # possible id pairs up to which their counts are broadcast
COMMA, BAR, SEMICOLON = (pa.scalar(c, pa.large_string()) for c in ",|;")
PAIR = T.StructType([T.StructField("pair", T.LongType()), T.StructField("n", T.LongType())])


class Encoder:
    """Ids and their bytes for one tokenizer; special tokens' strings in texts are plain text."""

    lead = ""  # what encoding puts before a text

    def __init__(self, tokens: list[bytes]):
        self.tokens = pa.array(tokens, pa.large_binary())
        self.lengths = pc.binary_length(self.tokens).cast(pa.int64())
        self.names = pa.array([str(i) for i in range(len(tokens))], pa.large_string())

    def ids(self, text: str) -> np.ndarray:
        raise NotImplementedError


class ByteEncoder(Encoder):
    """A byte-level BPE file of the tokenizers library, over a space and the text.

    The vocabulary's merges run in tiktoken, which merges by rank as the library does (tests compare
    them on texts and on every code point); texts with very long runs of white space go to the
    library itself, with the same result.
    """

    lead = " "

    def __init__(self, source: bytes):
        import tiktoken
        from tokenizers import Tokenizer

        content = json.loads(source)
        tokens = _token_bytes(content)
        super().__init__(tokens)
        ranks = {tokens[i]: i for i in content["model"]["vocab"].values()}
        for t in content["added_tokens"]:
            ranks.pop(t["content"].encode(), None)
        self.fast = tiktoken.Encoding("bytes", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        self.whole = Tokenizer.from_str(source.decode())
        self.whole.encode_special_tokens = True
        self.whole.no_truncation()
        self.whole.no_padding()

    def ids(self, text: str) -> np.ndarray:
        if LONG_SPACE.search(text):
            return np.array(self.whole.encode(self.lead + text, add_special_tokens=False).ids, np.int64)
        return self.fast.encode_to_numpy(self.lead + text, disallowed_special=()).astype(np.int64)


class PieceEncoder(Encoder):
    """A sentencepiece model with byte fallback, which sets a space before the text itself."""

    def __init__(self, source: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=source)
        super().__init__([self._bytes(i) for i in range(self.model.get_piece_size())])

    def _bytes(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        if self.model.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text, add_bos=False, add_eos=False, num_threads=1), np.int64)


@cache
def _encoders(byte_source: bytes, piece_source: bytes) -> tuple[Encoder, Encoder]:
    return ByteEncoder(byte_source), PieceEncoder(piece_source)


def possible_pairs(a: Encoder, b: Encoder) -> int:
    """How many id pairs can ever be linked: tokens that end together hold one another as an ending."""
    sides = [t.tokens.to_pylist() for t in (a, b)]
    total = 0
    for own, other in (sides, sides[::-1]):
        number: dict[bytes, int] = {}
        for t in other:
            number[t] = number.get(t, 0) + 1
        total += sum(number.get(t[k:], 0) for t in own for k in range(len(t)))
    return total


def _lists(rows: list[np.ndarray]) -> pa.LargeListArray:
    at = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    return pa.LargeListArray.from_arrays(pa.array(at), pa.array(flat, pa.int64()))


def _ends(lists: pa.LargeListArray, encoder: Encoder) -> pa.Table:
    """One row for each token: its text's number, its id, and where its bytes end in the text."""
    ids, text = pc.list_flatten(lists), pc.list_parent_indices(lists)
    lengths = encoder.lengths.take(ids)
    running = pc.cumulative_sum(lengths)
    starts = lists.offsets.slice(0, len(lists)).to_numpy()
    before = np.concatenate([[0], running.to_numpy()])[starts]  # sum up to each text's first token
    ends = pc.subtract(running, pa.array(before, pa.int64()).take(text))
    return pa.table({"text": text.cast(pa.int64()), "id": ids, "end": ends})


def _faithful(lists: pa.LargeListArray, encoder: Encoder, expected: list[bytes]) -> np.ndarray:
    """For each text: that its tokens' bytes join to what is expected."""
    at = lists.offsets.to_numpy()
    tokens = encoder.tokens.take(pc.list_flatten(lists))
    places = np.frombuffer(tokens.buffers()[1], np.int64)[: len(tokens) + 1] if len(tokens) else np.zeros(1, np.int64)
    joined = memoryview(tokens.buffers()[2]).cast("B") if len(tokens) else memoryview(b"")
    return np.array([joined[places[at[i]] : places[at[i + 1]]] == e for i, e in enumerate(expected)], bool)


def _grouped(tokens: pa.Table, cuts: np.ndarray, names: pa.Array) -> pa.Array:
    """The decimal ids between one cut and the next, joined by commas, for each cut.

    ``cuts`` are ascending keys of text and byte end; the tokens are in the same order.
    """
    own = np.searchsorted(cuts, _key(tokens))
    at = np.searchsorted(own, np.arange(len(cuts) + 1))
    parts = pa.LargeListArray.from_arrays(pa.array(at, pa.int64()), names.take(tokens["id"].combine_chunks()))
    return pc.binary_join(parts, COMMA)


def _key(table: pa.Table) -> np.ndarray:
    return table["text"].to_numpy() << 40 | table["end"].to_numpy()


def _align_slice(texts: list[str], a: Encoder, b: Encoder) -> dict[str, pa.Array]:
    """The columns that describe the alignment of each text."""
    n = len(texts)
    expected = [(" " + t).encode() if t else b"" for t in texts]
    encoded = [[e.ids(t) if t else np.zeros(0, np.int64) for t in texts] for e in (a, b)]
    lists = [_lists(r) for r in encoded]
    good = _faithful(lists[0], a, expected) & _faithful(lists[1], b, expected)
    if not good.all():
        lists = [_lists([r if g else r[:0] for r, g in zip(rows, good)]) for rows in encoded]
    ends = [_ends(x, e) for x, e in zip(lists, (a, b))]
    links = (
        ends[0].rename_columns(["text", "a", "end"])
        .join(ends[1].rename_columns(["text", "b", "end"]), keys=["text", "end"], join_type="inner", use_threads=False)
    )
    cuts = np.unique(_key(links))
    sides = [_grouped(x, cuts, e.names) for x, e in zip(ends, (a, b))]
    group_text = pc.binary_join_element_wise(*sides, BAR)
    group_at = np.searchsorted(cuts >> 40, np.arange(n + 1))
    groups = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(group_at, pa.int64()), group_text), SEMICOLON)
    counted = links.group_by(["text", "a", "b"], use_threads=False).aggregate([([], "count_all")]).sort_by("text")
    pair = pa.StructArray.from_arrays(
        [
            pa.array(counted["a"].to_numpy() << 32 | counted["b"].to_numpy(), pa.int64()),
            counted["count_all"].combine_chunks().cast(pa.int64()),
        ],
        names=["pair", "n"],
    )
    pair_at = np.searchsorted(counted["text"].to_numpy(), np.arange(n + 1)).astype(np.int32)
    return {
        "n_a": pc.list_value_length(lists[0]).cast(pa.int64()),
        "n_b": pc.list_value_length(lists[1]).cast(pa.int64()),
        "n_groups": pa.array(np.diff(group_at), pa.int64()),
        "n_links": pa.array(np.bincount(links["text"].to_numpy(), minlength=n)[:n], pa.int64()),
        "groups": groups.cast(pa.string()) if groups.nbytes < 1 << 31 else groups,
        "pairs": pa.ListArray.from_arrays(pa.array(pair_at), pair),
    }


MADE = ("n_a", "n_b", "n_groups", "n_links", "groups", "groups_sha256", "pairs")


def align(
    docs: DataFrame, byte_path: str, piece_path: str, keep: list[str], text_col: str = "text", with_groups: bool = False
) -> DataFrame:
    """The columns ``keep`` with each whole text's alignment.

    ``n_a`` and ``n_b`` tokens, ``n_groups`` stretches between common ends, ``n_links`` pairs of tokens
    that end together, ``groups_sha256`` of ``a1,a2|b1;a3|b2`` (with ``with_groups`` the string itself
    as ``groups``), and ``pairs`` with the number of links for each pair of ids (A shifted by 32 bits,
    or B). Texts that are null, empty, or that a tokenizer alters have no tokens: zeros and ''. Rows that
    repeat and an empty table need nothing special; a long text is worked on whole, alone. Columns of
    ``keep`` may not have the made names. Both files are read on the driver only.
    """
    if clash := {c.lower() for c in keep} & set(MADE):
        raise ValueError(f"columns to keep have names of the result: {sorted(clash)}")
    share = docs.sparkSession.sparkContext.broadcast
    sources = []
    for path in (byte_path, piece_path):
        with open(path, "rb") as f:
            sources.append(share(f.read()))  # a vocabulary; its size is bounded
    made = [m for m in MADE if m != "groups" or with_groups]
    types = {"groups": T.StringType(), "groups_sha256": T.StringType(), "pairs": T.ArrayType(PAIR)}
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(m, types.get(m, T.LongType())) for m in made])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _encoders(*(s.value for s in sources))
        for batch in batches:
            for part in slices(batch, batch.num_columns - 1):
                texts = [t or "" for t in part.column(part.num_columns - 1).to_pylist()]
                found = _align_slice(texts, a, b)
                found["groups_sha256"] = pa.array(
                    [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in found["groups"].to_pylist()], pa.string()
                )
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *(found[m] for m in made)], names=schema.names)

    hidden = fresh(keep, "_whole_text")[0]
    return docs.select(*keep, F.col(text_col).alias(hidden)).mapInArrow(run, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """The alignment table: ``pair``, ``a_id``, ``b_id``, its links corpus-wide, and ``best``.

    A pair is best if no other has more links with the same B id.
    """
    merged = Shelf(aligned).put(
        aligned.select(F.inline("pairs")).groupBy("pair").agg(F.sum("n").alias("links")), "pair-counts"
    ).withColumns({"a_id": F.shiftright("pair", 32), "b_id": F.col("pair").bitwiseAND((1 << 32) - 1)})
    top = merged.groupBy(F.col("b_id").alias("_b")).agg(F.max("links").alias("_top"))
    return merged.join(top, F.col("b_id") == F.col("_b")).select(
        "pair", "a_id", "b_id", "links", (F.col("links") == F.col("_top")).alias("best")
    )


def scored(docs: DataFrame, byte_path: str, piece_path: str, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` with the alignment, ``n_best`` links of best pairs and ``count_sum`` over links.

    Aligned texts are written once. Their pairs meet the counts in a join that broadcasts the counts
    when the two vocabularies allow few enough pairs, however large the corpus; rows of a text are then
    added up where they are, so one row a text is shuffled.
    """
    shelf = Shelf(docs)
    row = fresh([*keep, *MADE], "_row")[0]
    aligned = shelf.put(
        align(docs, byte_path, piece_path, keep, text_col).withColumn(row, F.monotonically_increasing_id()), "aligned"
    )
    counts = shelf.put(pair_counts(aligned).select("pair", "links", "best"), "pair-values")
    with open(byte_path, "rb") as f, open(piece_path, "rb") as g:
        bound = possible_pairs(*_encoders(f.read(), g.read()))
    side = counts.withColumnRenamed("pair", "_pair")
    side = F.broadcast(side) if bound <= MOST_PAIRS else side
    sums = (
        aligned.select(F.col(row).alias("_of"), F.inline("pairs"))
        .join(side, F.col("pair") == F.col("_pair"))
        .groupBy("_of")
        .agg(F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("links")).alias("count_sum"))
    )
    joined = aligned.drop("pairs").join(sums, F.col(row) == F.col("_of"), "left")
    none = F.lit(0).cast("long")
    return joined.select(
        *keep, "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", none).alias("n_best"), F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256",
    )
