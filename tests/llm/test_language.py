from collections import Counter
import zlib

import pytest
from pyspark.sql import functions as F

from tristrata.llm import language, queries


def grams(text):
    """Letters in lower case, one edge sign between words; an edge alone is no n-gram."""
    out, flat = Counter(), ["\0"]
    for c in text or "":
        low = c.lower()
        c = (low if len(low) == 1 else c) if c.isalpha() else "\0"
        if c != "\0" or flat[-1] != "\0":
            flat.append(c)
    if flat[-1] != "\0":
        flat.append("\0")
    for i in range(len(flat)):
        if flat[i] != "\0":
            out[(flat[i],)] += 1
        if i + 1 < len(flat) and (flat[i], flat[i + 1]) != ("\0", "\0"):
            out[tuple(flat[i : i + 2])] += 1
        if i + 2 < len(flat) and flat[i + 1] != "\0":
            out[tuple(flat[i : i + 3])] += 1
    return out


def code(g):
    digits = [language.NONE] * (3 - len(g)) + [0 if c == "\0" else ord(c) for c in g]
    return digits[0] << 42 | digits[1] << 21 | digits[2]


def ordered(counts):
    # The same length first in each text's own order, then by characters.
    return sorted(counts, key=lambda g: (-counts[g], len(g), [0 if c == "\0" else ord(c) for c in g]))


def plain(rows, learn):
    totals = {}
    for text, lang in learn:
        if text is not None and lang is not None:
            totals.setdefault(lang, Counter()).update(grams(text))
    places = {
        lang: {code(g): i for i, g in enumerate(sorted(c, key=lambda g: (-c[g], code(g)))[: language.PLACES])}
        for lang, c in totals.items()
    }
    out = []
    for text in rows:
        own = ordered(grams(text))[: language.PLACES]
        if not own or not places:
            out.append(("und", 0.0))
            continue
        best = min(
            (sum(abs(p[code(g)] - i) if code(g) in p else language.PLACES for i, g in enumerate(own)), lang)
            for lang, p in sorted(places.items())
        )
        out.append((best[1], 1 - best[0] / (len(own) * language.PLACES)))
    return out


TEXTS = [
    "The cat and the dog. The end", "Der Hund und die Katze, das Ende", "", None, "12 34 !!", "é", "ΑΒΓ αβγ", "the",
    "The cat and the dog. The end", "日本語の文", "x" * 5000, "ab " * 3000,
]


def test_predictions_equal_a_plain_version(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    learn = [(r.text, r.lang) for r in docs.collect()]
    texts = TEXTS + [t for t, _ in learn[:30]]
    given = spark.createDataFrame([(i, t, "no") for i, t in enumerate(texts)], "doc_id long, text string, score string")
    got = language.identify(given, language.profiles(docs), ["doc_id"]).orderBy("doc_id").collect()
    want = plain(texts, learn)
    assert [r.lang_pred for r in got] == [w[0] for w in want]
    assert [r.score for r in got] == pytest.approx([w[1] for w in want])
    assert all(0 <= r.score <= 1 for r in got)


def test_the_query_equals_a_plain_version(spark, small):
    """Its own rows: what is held out, and what is predicted from the others alone."""
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    held = {d.doc_id: zlib.crc32(str(d.doc_id).encode()) % 3 == 1 for d in docs}
    want = plain([d.text for d in docs], [(d.text, d.lang) for d in docs if not held[d.doc_id]])
    got = {r.doc_id: r for r in queries.op1_language(spark, small).collect()}
    assert got.keys() == held.keys()
    for d, (lang, score) in zip(docs, want):
        r = got[d.doc_id]
        assert (r.held_out, r.lang_pred) == (held[d.doc_id], lang) and abs(r.score - score) < 1e-9


def test_nothing_learned_and_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    some = spark.createDataFrame([(1, "abc", None), (None, None, None)], none.schema)
    got = language.identify(some, language.profiles(some), ["doc_id"]).collect()
    assert {(r.doc_id, r.lang_pred, r.score) for r in got} == {(1, "und", 0.0), (None, "und", 0.0)}
    assert language.identify(none, language.profiles(none), ["doc_id"]).collect() == []


def test_clashing_names(spark):
    given = spark.createDataFrame([(1, "the cat", "x")], "doc_id long, text string, _whole_text string")
    learned = language.profiles(given.selectExpr("text", "'en' AS lang"))
    assert [tuple(r)[:2] for r in language.identify(given, learned, ["doc_id", "_whole_text"]).collect()] == [(1, "x")]
    with pytest.raises(ValueError):
        language.identify(given.withColumnRenamed("_whole_text", "Score"), learned, ["Score"])


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op1_language(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id")
    held = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert held > 0.98


FOREIGN = [
    "kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki ja omatunto",
    "bütün insanlar hür haysiyet ve haklar bakımından eşit doğarlar akıl ve vicdana sahiptirler",
    "0fa3c97b 77e1d04c b52a9e6f 3c88d1f0 9ab47e25 e60d13fc 5b7fa298 c41e0d36 8f92b7ae 1d6ce054 fa03b8c7 42d9e51b",
    "qxzvkj wqpfh zzkxv jqwrtp xkcdvb mnqzxw pkjhgf vbxzqk wrtqpz hjkxcv qzwvxk",
]


def test_foreign_and_gibberish_texts_are_rejected(spark):
    """Texts without a label in no learned language go; every labelled clean text stays."""
    clean = ["the house and the garden of the old man are on the hill by the river and it was good to be there"] * 5
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    extra = [(-1 - i, t * n, None) for n in (1, 8) for i, t in enumerate(FOREIGN, 10 * n)]
    kept = language.recognised(docs.unionByName(spark.createDataFrame(extra, docs.schema)))
    assert kept.columns == docs.columns
    assert kept.where("doc_id < 0").count() == 0
    lettered = docs.where(r"text rlike '\\p{L}'").count()
    assert kept.count() >= 0.995 * lettered
    one = spark.createDataFrame([(i, t, "en") for i, t in enumerate(clean)], docs.schema)
    assert language.recognised(one).count() == len(clean)
