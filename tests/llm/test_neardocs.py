import random
from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import closure, words
from tristrata.llm import linking, neardocs, queries
from tristrata.llm.rows import mix


def shingles(text):
    tokens, word = [], ""
    for c in (text or "") + " ":
        if c.isalnum():
            low = c.lower()
            word += low if len(low) == 1 else c
        elif word:
            tokens.append(word)
            word = ""
    n = neardocs.WORDS
    if 0 < len(tokens) < n:
        return Counter([tuple(tokens)])
    return Counter(tuple(tokens[i : i + n]) for i in range(len(tokens) - n + 1))


def plain(docs):
    """Class id and kept flag of each (id, text), by all pairs of texts."""
    texts = sorted({t or "" for _, t in docs})
    sets = {t: shingles(t) for t in texts}
    links = []
    for i, a in enumerate(texts):
        for b in texts[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and min(x.total(), y.total()) >= 0.8 * max(x.total(), y.total()):
                shared = (x & y).total()
                if shared >= 0.8 * (x | y).total():
                    links.append((a, b))
    root = closure(texts, links)
    least = {}
    for key, t in docs:
        if key is not None:
            r = root[t or ""]
            least[r] = min(key, least.get(r, key))
    return sorted((str(k), str(least.get(root[t or ""])), k == least.get(root[t or ""])) for k, t in docs)


def near(df, name="doc_id"):
    return sorted((str(r[name]), str(r.class_id), r.kept) for r in df.collect())


def corpus():
    rng = random.Random(21)
    docs = []
    for _ in range(12):
        base = words(rng, rng.randrange(30, 200))
        for _ in range(rng.randrange(1, 9)):
            copy = base.copy()
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = "new%d" % rng.randrange(10**6)
            docs.append(" ".join(copy))
    docs += ["again " * 50, "again " * 60, "again " * 64, "AGAIN again, " * 30, None, "", "!!", "!!", "??", "one two", "One  two!", "one two three"]
    return list(enumerate(docs)) + [(None, docs[0]), (None, "nobody has an id here at all"), (2, docs[2])]


def test_classes_equal_all_pairs(spark):
    docs = corpus()
    given = spark.createDataFrame([(i, t, 5, "x") for i, t in docs], "doc_id long, text string, id int, bucket string")
    got, want = near(neardocs.near_classes(given)), plain(docs)
    # A class without any id keeps its rows; the plain version calls their id, none, the least one too.
    assert got == want


def test_far_variants_are_joined_through_others(spark):
    rng = random.Random(8)
    base = words(rng, 150, 10**6)
    docs = []
    for i in range(120):
        copy = base.copy()
        for place in (i % 150, (i * 5) % 150):
            copy[place] = f"v{i}x{place}"
        docs.append((i, " ".join(copy)))
    given = spark.createDataFrame(docs, "doc_id long, text string")
    assert near(neardocs.near_classes(given)) == plain(docs)


@pytest.mark.parametrize("tile", [1, 3, 40])
def test_tiles_of_any_size_lose_no_link(spark, monkeypatch, tile):
    """Buckets of several components over many blocks, the largest of which is not compared with itself."""
    monkeypatch.setattr(linking, "TILE", tile)
    rng = random.Random(tile)
    docs = []
    for _ in range(3):
        base = words(rng, 140, 10**6)
        for i in range(30):
            copy = base.copy()
            for place in rng.sample(range(140), rng.choice([0, 2, 2, 3])):
                copy[place] = f"v{i}x{place}"
            docs.append((len(docs), " ".join(copy)))
    rng.shuffle(docs)
    given = spark.createDataFrame(docs, "doc_id long, text string")
    assert near(neardocs.near_classes(given)) == plain(docs)


def test_signatures_estimate_the_weighted_overlap():
    rng = np.random.default_rng(1)
    n = 3000
    shared, own = mix(np.arange(40 * n), 50).reshape(n, 40), mix(np.arange(20 * n), 51).reshape(n, 20)
    wa, wb = rng.integers(1, 12, (n, 60)), rng.integers(1, 12, (n, 40))
    a = neardocs.signatures(np.repeat(np.arange(n), 60), np.concatenate([shared, own], 1).ravel(), wa.ravel(), n)
    b = neardocs.signatures(np.repeat(np.arange(n), 40), shared.ravel(), wb.ravel(), n)
    true = np.minimum(wa[:, :40], wb).sum(1) / (np.maximum(wa[:, :40], wb).sum(1) + wa[:, 40:].sum(1))
    error = (a == b).mean(1) - true
    spread = np.sqrt((true * (1 - true)).mean() / neardocs.REGISTERS)
    assert abs(error.mean()) < 4 * spread / np.sqrt(n)
    assert error.std() < 1.1 * spread


def test_one_of_each_class_stays(spark):
    docs = corpus()
    given = spark.createDataFrame([(i, t, {"a": 1}, i) for i, t in docs], "doc_id long, text string, text_key map<string,int>, n_chars long")
    left = neardocs.keep_one(given)
    assert left.columns == given.columns
    flags = plain(docs)
    want = {(k, t) for k, t in docs if (str(k), str(k), True) in flags and (k is not None or t != docs[0][1])}
    assert sorted((str(r.doc_id), r.text) for r in left.collect()) == sorted((str(k), t) for k, t in want)
    assert neardocs.keep_one(given.limit(0)).collect() == []


def test_query_on_all_documents(spark, small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert near(queries.op9_near_documents(spark, small)) == plain(docs)
