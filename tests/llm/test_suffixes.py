import hashlib
import random

import numpy as np
import pytest

from tests.llm.helpers import words
from tristrata.llm import induction, queries, suffixes


def plain(docs, length):
    """(n_bytes, n_removed, n_spans, kept bytes) of each text, by counting all strings."""
    raw = [(t or "").encode() for _, t in docs]
    seen = {}
    for d, b in enumerate(raw):
        for i in range(len(b) - length + 1):
            seen[b[i : i + length]] = seen.get(b[i : i + length], 0) + 1
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return out


@pytest.mark.parametrize("run", [1, 3, 1 << 18])
def test_suffix_and_prefix_arrays(run, monkeypatch):
    monkeypatch.setattr(induction, "RUN", run)
    rng = np.random.default_rng(run)
    for _ in range(150):
        text = np.append(rng.integers(1, rng.integers(2, 5), rng.integers(0, 50)), 0).astype(np.uint16)
        for memory in (0, 1 << 20):
            order, common = induction.suffix_array(text, 1000, memory)
            want = sorted(range(len(text)), key=lambda i: tuple(text[i:]))
            assert list(order) == want
            for k in range(1, len(text)):
                a, b = text[want[k - 1] :], text[want[k] :]
                n = min(len(a), len(b))
                off = np.flatnonzero(a[:n] != b[:n])
                assert common[k] == (off[0] if len(off) else n)


def test_repeats_equal_a_plain_version(spark):
    rng = random.Random(11)
    passages = [" ".join(words(rng, rng.randrange(15, 60))) for _ in range(6)]
    docs = []
    for i in range(40):
        parts = [rng.choice([rng.choice(passages), " ".join(words(rng, rng.randrange(1, 40)))]) for _ in range(rng.randrange(1, 5))]
        docs.append((i, " é ".join(parts)))
    docs += [(40, None), (41, ""), (42, "ab" * 300), (43, "z" * 100), (44, "z" * 99), (45, docs[3][1]), (46, docs[3][1]), (3, docs[3][1])]
    docs += [(47, "y" * 101), (None, passages[0])]
    given = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, key long")
    got = suffixes.drop_repeats(given, ["doc_id", "key"], length=100).collect()
    found = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept_bytes)) for r in got)
    assert found == sorted((str(d[0]), *p) for d, p in zip(docs, plain(docs, 100)))


def test_small_shards_agree(spark, monkeypatch):
    rng = random.Random(12)
    passage = " ".join(words(rng, 30))
    docs = [(i, " ".join(words(rng, i)) + passage + " ".join(words(rng, 9))) for i in range(30)]
    monkeypatch.setattr(suffixes, "SHARD_BYTES", 1)
    got = suffixes.drop_repeats(spark.createDataFrame(docs, "doc_id long, text string"), ["doc_id"], length=100).collect()
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept_bytes)) for r in got) == sorted(plain(docs, 100))


def test_no_rows(spark):
    assert suffixes.drop_repeats(spark.createDataFrame([], "doc_id long, text string"), ["doc_id"]).collect() == []


def test_query_on_all_documents(spark, small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    rows = queries.op5_suffixes(spark, small).collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows}
    assert all(r.n_kept == r.n_bytes - r.n_removed for r in rows)
    assert got == {d[0]: (*p[:3], hashlib.sha256(p[3]).hexdigest()) for d, p in zip(docs, plain(docs, 400))}


def test_repeated_starts_of_odd_pieces():
    rng = random.Random(1)
    for _ in range(1500):
        text, wanted = [], []
        for _ in range(rng.randrange(1, 5)):
            n = rng.randrange(1, 14)
            most = rng.choice([3, 4, 5])
            text += [rng.randrange(2, most) if most > 3 else 2 for _ in range(n)] + [1]
            marked = rng.randrange(n + 1)
            wanted += [True] * marked + [False] * (n + 1 - marked)
        text, wanted, length = np.array([*text, 0], np.uint16), np.array([*wanted, False]), rng.randrange(2, 9)
        ends, seen = np.flatnonzero(text < 2), {}
        for s in np.flatnonzero(wanted).tolist():
            if ends[np.searchsorted(ends, s)] - s >= length:
                seen.setdefault(text[s : s + length].tobytes(), []).append(s)
        want = sorted(s for same in seen.values() if len(same) > 1 for s in same)
        assert np.flatnonzero(induction.repeated_starts(text, wanted, length)).tolist() == want


def test_stretches_that_repeat_themselves_equal_a_plain_version(spark):
    rng = random.Random(5)
    noise = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    docs = [
        (0, noise(50) + "x" * 3000 + noise(60)), (1, noise(9) + "x" * 100 + noise(9)), (2, "x" * 101), (3, noise(70) + "-=" * 900 + noise(5) + "-=" * 700),
        (4, noise(20) + "=-" * 55), (5, "&nbsp;" * 300), (6, noise(3) + "y" * 500 + "x" * 500 + noise(3)), (7, "é" * 1200), (8, noise(150) + "x" * 99),
        (9, ("abcdefghijklmnopqrstuvwxyz" * 40) + noise(30)), (10, noise(40) + "x" * 20000 + "y" * 900),
    ]
    got = suffixes.drop_repeats(spark.createDataFrame(docs, "doc_id long, text string"), ["doc_id"], length=100).collect()
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept_bytes)) for r in got}
    assert found == {d[0]: p for d, p in zip(docs, plain(docs, 100))}


def test_a_megabyte_of_one_byte_ends(spark):
    import time

    rng = np.random.default_rng(3)
    noise = ["".join(map(chr, rng.integers(97, 123, 1_000_000))) for _ in range(3)]
    passage = noise[0][5000:5900]
    docs = [(0, noise[0] + " " * 1_000_000 + noise[1]), (1, noise[2][:500_000] + passage + noise[2][500_000:]), (2, "ab" * 500_000)]
    given = spark.createDataFrame(docs, "doc_id long, text string")
    started = time.time()
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in suffixes.drop_repeats(given, ["doc_id"]).collect()}
    assert got == {0: (1_000_900, 2), 1: (900, 1), 2: (1_000_000, 1)}
    assert time.time() - started < 60


def test_long_texts_go_in_stretches(spark, monkeypatch):
    rng = random.Random(8)
    passage = " ".join(words(rng, 30))
    docs = [(i, " ".join(words(rng, 200 + i)) + passage + " ".join(words(rng, 90))) for i in range(6)]
    monkeypatch.setattr(suffixes, "STRETCH_BYTES", 130)
    got = suffixes.drop_repeats(spark.createDataFrame(docs, "doc_id long, text string"), ["doc_id"], length=100).collect()
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept_bytes)) for r in got) == sorted(plain(docs, 100))


def test_planted_passages_go_and_clean_documents_stay(spark):
    """Passages of 400 to 4,000 bytes, stated here and not taken from the module."""
    rng = random.Random(21)
    text = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    passages = {n: text(n) for n in (400, 401, 650, 1500, 4000)}
    docs, want = [], {}
    for n, passage in passages.items():
        for k in range(3):
            head, tail = text(300) + str(k), str(k) + text(500)
            want[len(docs)] = (n, head + tail)
            docs.append((len(docs), head + passage + tail))
    for _ in range(20):
        clean = text(2000)
        want[len(docs)] = (0, clean)
        docs.append((len(docs), clean))
    got = suffixes.drop_repeats(spark.createDataFrame(docs, "doc_id long, text string"), ["doc_id"]).collect()
    assert {r.doc_id: (r.n_removed, bytes(r.kept_bytes).decode()) for r in got} == want
