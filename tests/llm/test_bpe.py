import hashlib
import random
from itertools import chain

import numpy as np
import pytest

from tristrata.llm import bpe, queries

tokenizers = pytest.importorskip("tokenizers")

NASTY = [
    None, "", " ", "  a", "\n\n x\t\t", "don't we'll I'VE", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext|", "日本語 テキスト",
    "🙂🙂🙂", "aaaaaaaaaaaaaaaaaaaaaaaaaaaa" * 50, "١٢٣ ½", "é ​\xa0x", "\x00\x01", "A" * 3000 + "b" * 3000, "http://x.y/z?a=1&b=2", "  \x1c",
    "x" * 30000, "﻿q\r\n\r\n",
]


def mixed(n):
    rng = random.Random(9)
    letters = "etaoinshrdlu  .,'ABC12éß\n"
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(300))) for _ in range(n)]


def expected(texts):
    lib = tokenizers.Tokenizer.from_file(queries.vocabulary())
    lib.no_truncation()
    lib.no_padding()
    ids = [lib.encode(t or "", add_special_tokens=False).ids for t in texts]
    return [(i, lib.decode(i, skip_special_tokens=False)) for i in ids]


def test_ids_and_texts_equal_the_library(spark, small):
    texts = NASTY + mixed(200) + [r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    given = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, ids int")
    encoded = bpe.encode(given, queries.vocabulary(), ["doc_id"])
    back = bpe.decode(encoded, queries.vocabulary(), ["doc_id", "ids"]).orderBy("doc_id").collect()
    assert [(list(r.ids), r.decoded) for r in back] == expected(texts)


def test_cut_up_ids_decode_like_the_library(spark):
    lib = tokenizers.Tokenizer.from_file(queries.vocabulary())
    lists = [lib.encode("日本語🙂é").ids[i : i + 2] for i in range(5)] + [[], None]
    given = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "doc_id long, ids array<int>")
    got = bpe.decode(given, queries.vocabulary(), ["doc_id"]).orderBy("doc_id").collect()
    assert [r.decoded for r in got] == [lib.decode(x or [], skip_special_tokens=False) for x in lists]


def test_pair_checks_agree_with_merging():
    with open(queries.vocabulary(), encoding="utf-8") as f:
        made = bpe.Bpe(f.read())
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdeinorst") for _ in range(rng.randrange(1, 14))).encode() for _ in range(4000)]
    assert [np.frombuffer(x, np.int32).tolist() for x in made.encode_words([w.decode() for w in words])] == [made.merge(w) for w in words]


def test_words_forgotten_and_seen_again_stay_right():
    made = bpe._loaded(open(queries.vocabulary(), encoding="utf-8").read())
    memory = bpe.Memory(made, limit=50)
    texts = mixed(120) + NASTY
    for text in texts + texts[::-1]:
        got = [np.frombuffer(x, np.int32).tolist() for x in memory.encode([text or ""])]
        assert got == [list(chain.from_iterable(tuple(made.merge(w.encode())) if w not in made.added else (made.added[w],) for w in made.pieces(text or "")))]
        assert all(len(w) <= bpe.CACHED_LETTERS for w in memory.young if w not in made.added)
    assert memory.old and len(memory.young) < 2000


def test_latin_texts_split_as_others():
    made = bpe._loaded(open(queries.vocabulary(), encoding="utf-8").read())
    rng = random.Random(4)
    signs = [chr(c) for c in range(bpe.LATIN)] + ["'s", " ", "  ", "'ll", "a", "1"]
    for _ in range(3000):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(40)))
        assert made.latin.findall(text) == made.words.findall(text)


def test_round_trip_is_encoding_and_decoding(spark):
    texts = NASTY + mixed(100)
    given = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts * 2)], "doc_id long, text string, _whole_text string")
    got = bpe.round_trip(given, queries.vocabulary(), ["doc_id", "_whole_text"]).orderBy("doc_id").collect()
    assert [(list(r.ids), r.decoded) for r in got] == expected(texts * 2)
    with pytest.raises(ValueError):
        bpe.round_trip(given.withColumnRenamed("_whole_text", "IDS"), queries.vocabulary(), ["IDS"])


def test_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    for made in (bpe.encode, bpe.round_trip):
        assert made(none, queries.vocabulary(), ["doc_id"]).collect() == []


def test_query(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    want = dict(zip(texts, expected(texts.values())))
    for r in queries.op6_bpe(spark, small).collect():
        ids, text = want[r.doc_id]
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
