import corpus_pipeline
import pytest

from tests.llm import test_bpe, test_language, test_lines, test_neardocs
from tristrata.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_run_equals_plain_versions_of_the_stages(spark, small):
    docs = [tuple(r) for r in spark.read.schema(SCHEMA).parquet(f"{small}/documents.parquet").collect()]
    named = test_language.plain([d[1] for d in docs], [d[1:3] for d in docs])
    docs = [d for d, (lang, score) in zip(docs, named) if lang != "und" and score > 0]
    left = test_lines.plain([d[:2] for d in docs])
    docs = [(d[0], left[d[0]][0], d[2], d[3], len(left[d[0]][0])) for d in docs]
    docs = [d for d in docs if d[1].strip(" \n")]
    kept = {k for k, _, stays in test_neardocs.plain([d[:2] for d in docs]) if stays}
    docs = [d for d in docs if str(d[0]) in kept]
    times = {r.id: r.times for r in mixing.mix(spark.createDataFrame(docs, SCHEMA)).collect()}
    ids = {d[0]: e for d, e in zip(docs, test_bpe.expected([d[1] for d in docs]))}
    want = sorted((d[0], d[3], ids[d[0]][0]) for d in docs for _ in range(times[d[0]]))
    got = corpus_pipeline.run(spark, small).collect()
    assert sorted((r.doc_id, r.source, list(r.ids)) for r in got) == want
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in got)


ROWS = [
    (1, "The cat sat on the mat and it was good", "en", "a", 0), (1, "The cat sat on the mat and it was good", "en", "a", 0),
    (2, None, None, None, None), (None, "Der Hund ist im Haus und schläft den ganzen Tag", "de", None, 1), (3, "", "en", "a", 0),
    (4, "\n \n", "en", "b", 3), (5, "the end " * 40000, "en", "b", 320000),
]
LETTERED = sorted(str(r[0]) for r in ROWS if any(c.isalpha() for c in r[1] or ""))


def ids(rows):
    return sorted(str(r.doc_id) for r in rows)


def check_language(rows):
    assert ids(rows) == LETTERED  # nothing without a letter stays, nothing else goes


def check_lines(rows):
    assert ids(rows) == LETTERED
    assert {r.text for r in rows} == {r[1] for r in ROWS if str(r[0]) in LETTERED}  # single lines, each kept
    assert all(r.n_chars == len(r.text) for r in rows)


def check_near(rows):
    texts = [r.text or "" for r in rows]
    assert set(texts) == {r[1] or "" for r in ROWS}
    kept = [t for t in texts if t]
    assert len(kept) == len(set(kept))


def check_mix(rows):
    held = {}
    for r in ROWS:
        held[r[:2]] = held.get(r[:2], 0) + 1
    for key in {(r.doc_id, r.text) for r in rows}:
        assert sum((r.doc_id, r.text) == key for r in rows) <= 2 * held[key]


def check_encode(rows):
    want = {(str(r[0]), tuple(e[0])) for r, e in zip(ROWS, test_bpe.expected([r[1] for r in ROWS]))}
    assert len(rows) == len(ROWS) and {(str(r.doc_id), tuple(r.ids)) for r in rows} == want
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in rows)


CHECKS = dict(zip((n for n, _ in corpus_pipeline.STAGES), (check_language, check_lines, check_near, check_mix, check_encode)))


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_odd_rows(spark, small, name, stage):
    docs = spark.createDataFrame([(*r, "x", 7) for r in ROWS], SCHEMA + ", lang_pred string, size int")
    got = stage(spark, docs, small)
    if name != "encode":
        assert got.columns == docs.columns
    CHECKS[name](got.collect())
    assert stage(spark, docs.limit(0), small).collect() == []


def test_clean_documents_pass_the_filter(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    kept = corpus_pipeline.identify_language(spark, docs, small)
    lettered = docs.where("text rlike '\\\\p{L}'")
    assert kept.count() == lettered.count()
