import random

import numpy as np
import pyarrow as pa

from tests.llm.helpers import closure, words
from tristrata.llm import lines, linking, queries
from tristrata.llm.rows import code_points, mix
from tristrata.llm.shingles import rolling


def shingles(line):
    return {line[i : i + lines.CHARS] for i in range(len(line) - lines.CHARS + 1)}


def plain(docs):
    """Kept text, lines and removed lines of each (id, text); links by all pairs."""
    place = {}
    for key, text in docs:
        for n, line in enumerate((text or "").split("\n")):
            if line.strip(" "):
                place.setdefault(line.strip(" "), []).append((key is None, key or 0, n))
    names = sorted(place)
    sets = {x: shingles(x) for x in names}
    links = [
        (a, b) for i, a in enumerate(names) for b in names[i + 1 :]
        if sets[a] and sets[b] and len(sets[a] & sets[b]) >= lines.THRESHOLD * len(sets[a] | sets[b])
    ]
    root = closure(names, links)
    first = {}
    for x in names:
        first[root[x]] = min(first.get(root[x], (True, 10**9, 0)), min(place[x]))
    out = {}
    for key, text in docs:
        parts = (text or "").split("\n")
        kept = [
            p for n, p in enumerate(parts)
            if not p.strip(" ") or first[root[p.strip(" ")]] == (key is None, key or 0, n)
        ]
        out[key] = ("\n".join(kept), len(parts), len(parts) - len(kept))
    return out


def test_lines_equal_a_plain_version(spark):
    rng = random.Random(5)
    base = [" ".join(words(rng, 12)) for _ in range(40)]
    docs = []
    for i in range(60):
        body = []
        for _ in range(rng.randrange(1, 8)):
            line = rng.choice(base)
            if rng.random() < 0.5:
                line = line[:-1] + rng.choice("abcdef")
            body.append(rng.choice([line, line, "  " + line, "", "short", " ".join(words(rng, 9))]))
        docs.append((i, "\n".join(body)))
    docs += [(60, None), (61, ""), (62, "\n\n"), (None, base[0] + "\n" + "only here, in the row without id")]
    given = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, line string, class int")
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in lines.drop_lines(given).collect()}
    assert got == plain(docs)


def test_many_variants_of_one_line(spark):
    """Variants that are far from the star's centre are still joined through each other."""
    base = list("the quick brown fox jumps over the lazy dog while nobody at all is looking at it today")
    docs = []
    for i in range(60):
        text = base.copy()
        text[(i * 7) % 80] = "#"
        text[(i * 3 + 40) % 80] = "%"
        docs.append((i, "".join(text)))
    given = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in lines.drop_lines(given).collect()}
    assert got == plain(docs)


NEAR = [
    ("a ship left the harbour at dawn this cold winter morning", "a ship left the harbour at down this cold winter morning"),
    ("please read the whole page and all notes before you sign it twice", "please read the whole page and all notes before you sing it twice"),
    (
        "our shop is open on weekdays from nine to five in summer and in spring time",
        "our shop is open on weekdays from nine to six in summer and in spring time",
    ),
    (
        "the committee agreed that the old bridge over the river should be repaired before the winter begins",
        "the committee decided that the old bridge over the river should be repaired before the winter begins",
    ),
    (
        "visitors are asked to leave coats and large bags in the lockers at the entrance and to keep the ticket until they leave this old house by the gate",
        "visitors are asked to leave coats and small bags in the lockers at the entrance and to keep the ticket until they leave this old house by the gate",
    ),
]
FAR = ["a cat sat on a mat in the sun", "a dog lay on a rug in the sun", "weather: 11 C, wind 4, rain 0", "the road was closed for most of the night"]


def test_planted_near_lines_of_common_lengths(spark):
    """One line of each near pair stays and no other line goes; the lines are literal, so no constant is believed."""
    lone = [(2 * len(NEAR) + i, x) for i, x in enumerate(FAR)]
    docs = [(2 * i + k, pair[k]) for i, pair in enumerate(NEAR) for k in (0, 1)] + lone
    got = {r.doc_id: r.text for r in lines.drop_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {k: "" if k < 2 * len(NEAR) and k % 2 else text for k, text in docs}


def test_repeated_rows_other_columns_and_no_rows(spark):
    given = spark.createDataFrame([(1, "a line\nb", 7), (1, "a line\nb", 7), (2, "b", 8)], "doc_id long, text string, n_lines long")
    got = sorted(tuple(r) for r in lines.drop_lines(given, counts=("lines", "gone")).select("doc_id", "text", "n_lines", "gone").collect())
    assert got == [(1, "a line\nb", 7, 0), (1, "a line\nb", 7, 0), (2, "", 8, 1)]
    assert lines.drop_lines(given.limit(0)).collect() == []


def test_query_on_all_documents(spark, small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in queries.op3_lines(spark, small).collect()}
    assert got == plain(docs)


def test_signatures_fill_empty_bins_as_a_plain_version():
    """A bin without a hash takes that of the first bin it asks which has one, whatever is left for the end."""
    rng = random.Random(8)
    texts = ["".join(rng.choice("abcdefgh é漢") for _ in range(n)) for n in [5, 6, 7, 40, 200, 900] * 20]
    points, starts = code_points(pa.array(texts, pa.large_string()))
    signed = lines.signatures(points, starts)
    turns = np.argsort(mix(np.arange(lines.BINS**2), 77).reshape(lines.BINS, lines.BINS), axis=1)
    for k in range(0, len(texts), 7):
        own = lines._spread(rolling(points[starts[k] : starts[k + 1]], lines.CHARS, np.uint32))
        held = {}
        for h in own.tolist():
            b = (h >> 16) * lines.BINS >> 16
            held[b] = min(h, held.get(b, h))
        for b in range(lines.BINS):
            asked = next((t, held[c]) for t, c in enumerate(turns[b].tolist()) if c in held)
            plain = held.get(b, int(mix(np.array([asked[1]]), asked[0] + 1)[0]) % 2**32)
            assert signed[k, b] == plain


def test_lines_are_measured_in_parts_that_stay_in_a_cache(monkeypatch):
    """Eight bytes for each character, some arrays at a time; the parts give what the whole gives."""
    rng = random.Random(9)
    texts = [" ".join(words(rng, 40)) for _ in range(2_000)]
    parts = []

    def measure(some):
        parts.append(sum(map(len, some)))
        return lines.measure(some)

    got = linking.measured(measure, texts)
    assert sum(parts) == sum(map(len, texts)) > 300_000 and max(parts) <= 1 << 17
    assert all((a == b).all() for a, b in zip(got, lines.measure(texts)))


def test_entries_alone_in_their_bucket_never_become_rows(spark, monkeypatch):
    """Entries travel many to a row; those of buckets with one id stay behind, whatever a task holds at a time."""
    rng = np.random.default_rng(4)
    bucket = rng.integers(-(2**63), 2**63 - 1, 6_000)[rng.integers(0, 6_000, 9_000)]
    bucket[:700] = bucket[0]  # one that is common
    ids = rng.integers(-500, 500, 9_000)
    bucket, ids = np.append(bucket, bucket[:3_000]), np.append(ids, ids[:3_000])
    held = {}
    for b, i in zip(bucket.tolist(), ids.tolist()):
        held.setdefault(b, set()).add(i)
    want = {(b, i) for b, some in held.items() if len(some) > 1 for i in some}
    for size in (10, 1_000, 1 << 20):
        monkeypatch.setattr(linking, "HELD", size)
        monkeypatch.setattr(linking, "PACKED", 64)
        batches = list(linking.packed(iter([(bucket[:5_000], ids[:5_000]), (bucket[5_000:], ids[5_000:])]), 8))
        rows = sorted(r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        assert len(rows) < 1_700 if size == 10 else len(rows) < 250
        given = [pa.RecordBatch.from_arrays([pa.array([g for g, _ in rows[k : k + 7]], pa.int32()), pa.array([e for _, e in rows[k : k + 7]])], names=["group", "entries"]) for k in range(0, len(rows), 7)]
        assert {x for b in linking._meetings(iter(given)) for x in zip(*(c.to_pylist() for c in b.columns))} == want
        found = linking.meetings(spark.createDataFrame(rows, "group int, entries binary"), 3)
        assert {tuple(r) for r in found.collect()} == want
    assert not list(linking.packed(iter([]), 8)) and not list(linking._meetings(iter([])))


def test_documents_spread_their_lines_in_packed_rows(spark):
    """A line has twenty entries; before, each of them was a row of the exchange."""
    rng = random.Random(14)
    texts = pa.RecordBatch.from_arrays(
        [pa.array(range(3_000), pa.int64()), pa.array([" ".join(words(rng, 12)) for _ in range(3_000)])], names=["id", "text"]
    )
    rows = [r for b in lines._buckets(8)(iter([texts])) for r in b.to_pylist()]
    assert sum(len(r["entries"]) for r in rows) == 16 * 20 * 3_000 and len(rows) < 3_000


def test_a_pack_of_tiles_gives_the_links_of_all_pairs(monkeypatch):
    """Small tiles, two blocks and crowded tiles; a bound never hides a link."""
    rng = random.Random(15)
    base = [" ".join(words(rng, 14)) for _ in range(12)]
    rows = []
    for t in range(60):
        two, own = rng.random() < 0.3, {}
        for _ in range(rng.choice([3, 5, 40])):
            text = list(rng.choice(base[:3]))
            for _ in range(rng.randrange(4)):
                text[rng.randrange(len(text))] = rng.choice("xyz")
            own["".join(text)] = (not two or rng.random() < 0.5, rng.randrange(4))
        rows += [(t, f, hash(x), c, x) for x, (f, c) in own.items()]
    want = {}
    for t, f, a, c, x in rows:
        for u, g, b, d, y in rows:
            alone = all(r[1] for r in rows if r[0] == t)
            if t == u and c < d and (alone or f != g) and len(shingles(x) & shingles(y)) >= 0.8 * len(shingles(x) | shingles(y)):
                want.setdefault((t, c, d), set()).add((a, b))
    for crowd in (0, 4, 10**6):
        monkeypatch.setattr(linking, "CROWD", crowd)
        got = linking._pack_links(lines.measure, 0.8, rows)
        pairs = list(zip(*(c.to_pylist() for c in got.columns)))
        assert len(pairs) == len(want) > 20 and all(any(p in some for some in want.values()) for p in pairs)


def test_measure_equals_sets_of_shingles():
    rng = random.Random(16)
    texts = ["".join(rng.choice("ab é漢") for _ in range(n)) for n in [0, 1, 4, 5, 6, 3, 30, 200, 2, 9]] + ["", "abcd", "z"]
    hashes, counts, owner = lines.measure(texts)
    assert (counts == 1).all() and (np.diff(owner) >= 0).all()
    assert np.bincount(owner, minlength=len(texts)).tolist() == [len(shingles(x)) for x in texts]
    assert len(set(hashes.tolist())) == len(set().union(*map(shingles, texts)))
    assert all(len(x) == 0 for x in lines.measure(["", "abc"]))
