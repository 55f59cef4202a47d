from collections import Counter
import hashlib

import pytest

from tests.llm.test_bpe import NASTY, mixed
from tristrata.llm import alignment, queries

tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
PATHS = (queries.vocabulary(), queries.vocabulary(queries.PIECE_BPE))


def both():
    with open(PATHS[0], "rb") as f, open(PATHS[1], "rb") as g:
        return alignment._encoders(f.read(), g.read())


def plain(texts):
    """Groups and links of each text, token by token, with the libraries themselves."""
    lib = tokenizers.Tokenizer.from_file(PATHS[0])
    lib.encode_special_tokens = True
    piece = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    letter = {v: k for k, v in {c: b for c, b in alignment_letters().items()}.items()}
    back = {c: b for b, c in letter.items()}
    rows, links = [], []
    for text in texts:
        if not text:
            rows.append((0, 0, 0, ""))
            links.append([])
            continue
        a = [(i, bytes(back[c] for c in lib.id_to_token(i))) for i in lib.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in piece.encode(text):
            name = piece.id_to_piece(i)
            b.append((i, bytes([int(name[3:5], 16)]) if piece.is_byte(i) else name.replace("▁", " ").encode()))
        want = (" " + text).encode()
        if b"".join(t for _, t in a) != want or b"".join(t for _, t in b) != want:
            rows.append((0, 0, 0, ""))
            links.append([])
            continue
        ends = []
        for side in (a, b):
            at, found = 0, {}
            for i, t in side:
                at += len(t)
                found[at] = i
            ends.append(found)
        cuts = sorted(ends[0].keys() & ends[1].keys())
        groups, before = [], 0
        for cut in cuts:
            parts = [",".join(str(i) for e, i in side.items() if before < e <= cut) for side in ends]
            groups.append("|".join(parts))
            before = cut
        rows.append((len(a), len(b), len(cuts), hashlib.sha256(";".join(groups).encode()).hexdigest()))
        links.append([(ends[0][c], ends[1][c]) for c in cuts])
    counts = Counter(x for some in links for x in some)
    top = {}
    for (_, b), n in counts.items():
        top[b] = max(top.get(b, 0), n)
    return [
        (n_a, n_b, n_groups, len(some), sum(counts[x] == top[x[1]] for x in some), sum(counts[x] for x in some), digest)
        for (n_a, n_b, n_groups, digest), some in zip(rows, links)
    ]


def alignment_letters():
    from tristrata.llm.bpe import _byte_letters

    return _byte_letters()


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_equals_the_libraries_token_by_token(spark):
    texts = [t for t in NASTY if len(t or "") < 4000] + mixed(150) + ["▁x", "a▁", "<s>x</s> <unk>", "ab  cd", "aa" * 200, None, "x", "x"]
    given = spark.createDataFrame([(i, t, 0, "g") for i, t in enumerate(texts)], "doc_id long, text string, n_c int, source string")
    got = alignment.scored(given, *PATHS, ["doc_id", "source"]).orderBy("doc_id").collect()
    assert [tuple(r[c] for c in COLUMNS) for r in got] == plain(texts)
    assert {r.source for r in got} == {"g"}


def test_query_equals_the_libraries(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").orderBy("doc_id").collect()
    got = queries.op12_alignment(spark, small).orderBy("doc_id").collect()
    assert [r.doc_id for r in got] == [r.doc_id for r in docs]
    assert [tuple(r[c] for c in COLUMNS) for r in got] == plain([r.text for r in docs])


def test_long_texts_with_long_runs():
    a, b = both()
    lib = tokenizers.Tokenizer.from_file(PATHS[0])
    for text in (" " * 300_000, "x" + "\n" * 100_000 + "y", "^" * 100_000):
        assert a.ids(text).tolist() == lib.encode(" " + text, add_special_tokens=False).ids
        found = alignment._align_slice([text], a, b)
        assert found["n_links"][0].as_py() >= 1


def test_the_fast_encoder_merges_as_the_library():
    """No two neighbours that the library leaves apart join to a token, and code points are split alike."""
    from tristrata.llm.bpe import Bpe
    import numpy as np

    with open(PATHS[0], encoding="utf-8") as f:
        made = Bpe(f.read())
    known = made.by_bytes
    pairs = [(known[t[:k]], known[t[k:]]) for t in known for k in range(1, len(t)) if t[:k] in known and t[k:] in known]
    left, right = np.array(pairs).T
    assert not made.compatible(left, right).any()
    a, _ = both()
    texts = [f"a{c}b1{c}{c} {c} {c}2\n{c}  {c}." for c in map(chr, range(0, 0x3000)) if c.strip() or True]
    encoded = a.whole.encode_batch([" " + t for t in texts], add_special_tokens=False)
    assert all(a.ids(t).tolist() == e.ids for t, e in zip(texts, encoded))


def test_pair_table_groups_and_bound(spark):
    texts = ["one two", "one two three", None]
    given = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    aligned = alignment.align(given, *PATHS, ["doc_id"], with_groups=True)
    rows = {r.doc_id: r for r in aligned.collect()}
    assert rows[2].groups == "" and rows[0].groups.count(";") + 1 == rows[0].n_groups
    table = alignment.pair_counts(aligned).collect()
    a, b = both()
    assert sum(r.links for r in table) == sum(r.n_links for r in rows.values())
    assert all(a.tokens[r.a_id].as_py().endswith(b.tokens[r.b_id].as_py()) or b.tokens[r.b_id].as_py().endswith(a.tokens[r.a_id].as_py()) for r in table)
    assert len(table) <= alignment.possible_pairs(a, b) <= alignment.MOST_PAIRS


def test_no_rows_and_clashing_names(spark):
    none = spark.createDataFrame([], "doc_id long, text string, n_a int, _whole_text int")
    assert alignment.scored(none, *PATHS, ["doc_id", "_whole_text"]).collect() == []
    with pytest.raises(ValueError):
        alignment.align(none, *PATHS, ["n_a"])
