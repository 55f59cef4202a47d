"""Byte-level BPE: propose tokens greedily, verify all adjacent pairs at once, merge only what fails.

A sequence of tokens is the result of the merges exactly if each token is what its own bytes merge
to and no merge crosses a border between neighbours. Whether one crosses is seen from the two
tokens alone. The right spine of the left token (itself, its right part, the right part of that,
...) are the tokens that touch the border from the left while merging goes on, the left spine of
the right token those from the right. A token lives from its own merge to that of its parent. If two
tokens that touch the border at the same time have a merge that comes before either parent's, it is
taken and crosses the border. Of equal merges the leftmost comes first.
"""

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from tristrata.llm.rows import fresh, slices

LAST = 1 << 60  # rank of the parent that a whole token does not have
CACHE_WORDS = 60_000  # words of a generation that a worker remembers; it holds two
CACHED_LETTERS = 64  # a longer word is merged each time it comes
LATIN = 0x250  # texts below this code point are split by explicit character classes
SLICE_IDS = 1 << 18  # ids a worker decodes at a time; a longer list comes alone

# Fixed value: the words of the byte-level pre-tokenizer.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _latin_words() -> re.Pattern:
    """The same words for texts below LATIN, with the classes written out, which is twice as fast."""
    def of_class(name: str) -> str:
        return "".join(re.escape(chr(c)) for c in range(LATIN) if unicodedata.category(chr(c))[0] == name)

    letters, numbers, spaces = of_class("L"), of_class("N"), r"\t-\r \x85\xa0"
    return re.compile(
        rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^{spaces}{letters}{numbers}]+|[{spaces}]+(?![^{spaces}])|[{spaces}]+"
    )


def _byte_letters() -> dict[str, int]:
    """The printable characters by which vocabulary files write the 256 bytes.

    Bytes that print in Latin-1 stand for themselves, the others for code points from 256 on.
    """
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _token_bytes(content: dict) -> list[bytes]:
    """The bytes each id stands for."""
    letter = _byte_letters()
    vocab, added = content["model"]["vocab"], content["added_tokens"]
    out = [b""] * (max([*vocab.values(), *(t["id"] for t in added)]) + 1)
    for token, i in vocab.items():
        out[i] = bytes(letter[c] for c in token)
    for t in added:
        out[t["id"]] = t["content"].encode()
    return out


class Bpe:
    """A vocabulary with its merges, read from a tokenizer file's JSON text."""

    def __init__(self, source: str):
        content = json.loads(source)
        letter = _byte_letters()
        vocab = content["model"]["vocab"]
        self.added = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.bytes = _token_bytes(content)
        size = len(self.bytes)
        self.single = np.array([vocab[c] for c, _ in sorted(letter.items(), key=lambda x: x[1])])
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        self.rank = np.full(size, -1, np.int64)  # of the merge that makes a token; -1: a byte
        self.left, self.right = np.arange(size), np.arange(size)
        for rank, merge in enumerate(content["model"]["merges"]):
            x, y = merge if isinstance(merge, list) else merge.split(" ")
            a, b, made = vocab[x], vocab[y], vocab[x + y]
            self.merges[a, b] = (rank, made)
            if self.rank[made] < 0:
                self.rank[made], self.left[made], self.right[made] = rank, a, b
        pairs = np.array(sorted(self.merges), np.int64).reshape(-1, 2)
        self.pair_key = pairs[:, 0] << 32 | pairs[:, 1]
        self.pair_rank = np.array([self.merges[a, b][0] for a, b in pairs.tolist()], np.int64)
        self.by_bytes = {self.bytes[i]: i for i in vocab.values()}
        ids = np.array(sorted(vocab.values()))
        whole = np.ones(size, bool)
        made = ids[self.rank[ids] >= 0]
        # A token that its own bytes do not merge to is never proposed.
        order = made[np.argsort(self.rank[made])]
        whole[order] = self.compatible(self.left[order], self.right[order], self.rank[order])
        for i in order.tolist():
            whole[i] &= whole[self.left[i]] and whole[self.right[i]]
        self.by_bytes = {b: i for b, i in self.by_bytes.items() if whole[i]}
        self._build_trie()
        self.tokens = pa.array(self.bytes, pa.large_binary())
        ends = "|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True))
        self.special = regex.compile(f"({ends})") if ends else None
        self.words, self.latin = regex.compile(WORDS), _latin_words()
        self.wide = re.compile(f"[^\\x00-{chr(LATIN - 1)}]")

    def _build_trie(self) -> None:
        """Prefixes of the tokens as nodes: ``node_token`` (-1: only a prefix), and edges sorted by node and byte.

        The first two bytes are looked up directly in ``first`` and ``second``.
        """
        edges: dict[int, int] = {}
        token = [-1]
        for word, i in self.by_bytes.items():
            node = 0
            for byte in word:
                key = node << 8 | byte
                if key not in edges:
                    edges[key] = len(token)
                    token.append(-1)
                node = edges[key]
            token[node] = i
        self.node_token = np.array(token, np.int32)
        order = np.array(sorted(edges), np.int64)
        self.edge_key, self.edge_node = order, np.array([edges[k] for k in order.tolist()], np.int32)
        self.first = np.zeros(256, np.int32)
        self.second = np.full(1 << 16, -1, np.int32)
        for byte in range(256):
            node = self.first[byte] = edges.get(byte, 0)
            for after in range(256):
                self.second[byte << 8 | after] = edges.get(int(node) << 8 | after, -1) if node else -1

    def longest(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The longest token that starts at each byte and ends by its word's end: ids and lengths."""
        node = self.first[data]
        best, length = self.node_token[node], np.ones(len(data), np.int32)
        live = np.flatnonzero(np.arange(1, len(data) + 1) < ends)
        depth = 1
        while len(live):
            if depth == 1:
                child = self.second[data[live].astype(np.int32) << 8 | data[live + 1]]
                there = child >= 0
            else:
                key = node[live].astype(np.int64) << 8 | data[live + depth]
                at = np.minimum(np.searchsorted(self.edge_key, key), len(self.edge_key) - 1)
                there = self.edge_key[at] == key
                child = self.edge_node[at]
            live, child = live[there], child[there]
            depth += 1
            node[live] = child
            token = self.node_token[child]
            whole = token >= 0
            best[live[whole]], length[live[whole]] = token[whole], depth
            live = live[live + depth < ends[live]]
        return best, length

    def compatible(self, a: np.ndarray, b: np.ndarray, until: np.ndarray | None = None) -> np.ndarray:
        """For pairs of neighbours: that no merge (before rank ``until``) crosses their border."""
        a, b = a.copy(), b.copy()
        good = np.ones(len(a), bool)
        end_a = np.full(len(a), LAST) if until is None else until.copy()
        end_b = end_a.copy()
        if until is not None:  # both parts wait for the same merge, which is not a crossing
            end_b -= 1
        live = np.arange(len(a))
        while len(live):
            key = a[live] << 32 | b[live]
            at = np.minimum(np.searchsorted(self.pair_key, key), max(len(self.pair_key) - 1, 0))
            there = self.pair_key[at] == key if len(self.pair_key) else np.zeros(len(live), bool)
            rank = np.where(there, self.pair_rank[at] if len(self.pair_key) else LAST, LAST)
            crossed = there & (rank < end_a[live]) & (rank <= end_b[live])
            good[live[crossed]] = False
            ra, rb = self.rank[a[live]], self.rank[b[live]]
            go = ~crossed & ((ra >= 0) | (rb >= 0))
            left = go & (ra > rb)  # the younger of the two is taken apart
            right = go & ~left
            x = live[left]
            end_a[x], a[x] = ra[left], self.right[a[x]]
            x = live[right]
            end_b[x], b[x] = rb[right], self.left[b[x]]
            live = live[go]
        return good

    def propose(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The longest token at each place of each word, from left to right: all ids in order, and how many a word has."""
        sizes = np.array([len(w) for w in words], np.int64)
        stop = np.cumsum(sizes)
        data = np.frombuffer(b"".join(words), np.uint8)
        best, length = self.longest(data, np.repeat(stop, sizes))
        at, live = stop - sizes, np.flatnonzero(sizes)
        owners, found = [], []
        while len(live):
            here = at[live]
            owners.append(live)
            found.append(best[here])
            at[live] = here + length[here]
            live = live[at[live] < stop[live]]
            if len(live) * 64 < len(words) and len(owners) > 64:  # few long words are left
                for w in live.tolist():
                    places, place, end = [], int(at[w]), int(stop[w])
                    while place < end:
                        places.append(place)
                        place += int(length[place])
                    owners.append(np.full(len(places), w))
                    found.append(best[places])
                break
        if not owners:
            return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
        owner = np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        return np.concatenate(found)[order].astype(np.int64), np.bincount(owner, minlength=len(words))

    def merge(self, word: bytes) -> list[int]:
        """The merges themselves, lowest rank first, leftmost first."""
        token = self.single[np.frombuffer(word, np.uint8)].tolist()
        n = len(token)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        merges = self.merges
        queue = [
            (m[0], i, token[i], token[i + 1])
            for i in range(n - 1)
            if (m := merges.get((token[i], token[i + 1])))
        ]
        heapq.heapify(queue)
        while queue:
            _, i, x, y = heapq.heappop(queue)
            j = after[i]
            if token[i] != x or j >= n or token[j] != y:
                continue
            token[i], token[j] = merges[x, y][1], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if m := merges.get((token[i], token[after[i]])):
                    heapq.heappush(queue, (m[0], i, token[i], token[after[i]]))
            if before[i] >= 0 and (m := merges.get((token[before[i]], token[i]))):
                heapq.heappush(queue, (m[0], before[i], token[before[i]], token[i]))
        return [t for t in token if t >= 0]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word, four bytes each."""
        raw = [w.encode() for w in words]
        flat, sizes = self.propose(raw)
        owner = np.repeat(np.arange(len(words)), sizes)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        bad = owner[inner[~self.compatible(flat[inner], flat[inner + 1])]]
        ids, ends = flat.astype(np.int32).tobytes(), (4 * np.cumsum(sizes)).tolist()
        out = [ids[a:b] for a, b in zip([0, *ends[:-1]], ends)]
        for i in np.unique(bad).tolist():
            out[i] = np.array(self.merge(raw[i]), np.int32).tobytes()
        return out

    def pieces(self, text: str) -> list[str]:
        """The words of a text; an added token is one piece of its own."""
        words = self.words if self.wide.search(text) else self.latin
        if self.special is None or not self.special.search(text):
            return words.findall(text)
        out = []
        for i, part in enumerate(self.special.split(text)):
            out += [part] if i % 2 else words.findall(part)
        return out


class Memory:
    """Ids of words, in two generations: what is seen again moves to the young one, the old one is dropped when that is full."""

    def __init__(self, bpe: Bpe, limit: int | None = None):
        self.bpe, self.limit = bpe, limit or CACHE_WORDS
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.added = {t: np.int32(i).tobytes() for t, i in bpe.added.items()}

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, four bytes each."""
        split = [self.bpe.pieces(t) for t in texts]
        missing = set().union(*split) - self.young.keys()
        kept = missing & self.old.keys()
        self.young.update((w, self.old[w]) for w in kept)
        new = [w for w in missing - kept if w not in self.added]
        self.young.update(zip(new, self.bpe.encode_words(new)))
        self.young.update(self.added)
        known = self.young
        ids = [b"".join(map(known.__getitem__, words)) for words in split]
        for w in new:
            if len(w) > CACHED_LETTERS:
                del known[w]
        if len(known) > self.limit:
            self.old, self.young = known, {}
        return ids


@cache
def _loaded(source: str) -> Bpe:
    return Bpe(source)


@cache
def _memory(source: str) -> Memory:
    return Memory(_loaded(source))


@cache
def _decoder(source: str) -> pa.Array:
    return pa.array(_token_bytes(json.loads(source)), pa.large_binary())


def _id_lists(memory: Memory, column: pa.Array) -> pa.ListArray:
    """The ids of a column of texts."""
    ids = memory.encode([t or "" for t in column.to_pylist()])
    at = np.zeros(len(ids) + 1, np.int32)
    np.cumsum([len(x) // 4 for x in ids], out=at[1:])
    return pa.ListArray.from_arrays(pa.array(at), pa.array(np.frombuffer(b"".join(ids), np.int32)))


def _texts(tokens: pa.Array, lists: pa.Array) -> pa.Array:
    """The texts of lists of ids: their tokens' bytes in a row, cut where lists end."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    found = tokens.take(lists.flatten())
    if len(found) == 0:
        return pa.array([""] * len(lists), pa.string())
    places = np.frombuffer(found.buffers()[1], np.int64)[found.offset :][ends]
    data = found.buffers()[2]
    raw = memoryview(data).cast("B")[places[0] : places[-1]]
    if places[-1] - places[0] < 1 << 31:
        at = (places - places[0]).astype(np.int32)
        out = pa.StringArray.from_buffers(len(lists), pa.py_buffer(at), pa.py_buffer(raw))
        try:
            out.validate(full=True)
            return out
        except pa.ArrowInvalid:  # bytes that are not UTF-8
            pass
    texts = [bytes(raw[a - places[0] : b - places[0]]).decode("utf-8", "replace") for a, b in zip(places[:-1], places[1:])]
    return pa.array(texts, pa.string())


def read_vocabulary(df: DataFrame, path: str):
    """The tokenizer file's text, shared with all tasks (a vocabulary; its size is bounded)."""
    with open(path, encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(
    docs: DataFrame, path: str, keep: list[str], text_col: str = "text", name: str = "ids"
) -> DataFrame:
    """The columns ``keep`` with the token ids of each whole text; null texts count as empty.

    Strings of added tokens become those tokens. ``path`` is a byte-level BPE file of the
    tokenizers library; it is read on the driver only.
    """
    source = read_vocabulary(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _memory(source.value)
        for batch in batches:
            for part in slices(batch, batch.num_columns - 1):
                lists = _id_lists(memory, part.column(part.num_columns - 1))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], lists], names=schema.names)

    schema = T.StructType(
        [docs.schema[c] for c in keep] + [T.StructField(name, T.ArrayType(T.IntegerType()))]
    )
    return docs.select(*keep, F.col(text_col).alias(fresh(keep, "_whole_text")[0])).mapInArrow(run, schema)


def round_trip(
    docs: DataFrame, path: str, keep: list[str], text_col: str = "text", name: str = "ids", back: str = "decoded"
) -> DataFrame:
    """The columns ``keep`` with the ids of each whole text and the text they decode to, in one pass of the workers.

    The same as ``encode`` followed by ``decode``, whose notes hold here too: null texts count as empty,
    rows do not depend on one another, an empty table gives no rows, a long text is worked on alone, and
    columns of ``keep`` may not have the made names.
    """
    if clash := {c.lower() for c in keep} & {name.lower(), back.lower()}:
        raise ValueError(f"columns to keep have names of the result: {sorted(clash)}")
    source = read_vocabulary(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _memory(source.value)
        for batch in batches:
            for part in slices(batch, batch.num_columns - 1):
                lists = _id_lists(memory, part.column(part.num_columns - 1))
                texts = _texts(memory.bpe.tokens, lists)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], lists, texts], names=schema.names)

    schema = T.StructType([
        *(docs.schema[c] for c in keep), T.StructField(name, T.ArrayType(T.IntegerType())), T.StructField(back, T.StringType()),
    ])
    return docs.select(*keep, F.col(text_col).alias(fresh([*keep, name, back], "_whole_text")[0])).mapInArrow(run, schema)


def decode(
    encoded: DataFrame, path: str, keep: list[str], ids_col: str = "ids", name: str = "decoded"
) -> DataFrame:
    """The columns ``keep`` with the text of each list of ids; null lists give an empty text.

    Bytes that are not UTF-8 become replacement characters, ids out of the vocabulary an error.
    """
    source = read_vocabulary(encoded, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _decoder(source.value)
        for batch in batches:
            for part in slices(batch, batch.num_columns - 1, SLICE_IDS, pc.list_value_length):
                texts = _texts(tokens, part.column(part.num_columns - 1))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], texts], names=schema.names)

    schema = T.StructType(
        [encoded.schema[c] for c in keep] + [T.StructField(name, T.StringType())]
    )
    return encoded.select(*keep, F.col(ids_col).alias(fresh(keep, "_ids")[0])).mapInArrow(run, schema)
