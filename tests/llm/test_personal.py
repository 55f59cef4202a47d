import hashlib
import random
import re
import time

import pytest

from tristrata.llm import personal, queries

BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def plain(text):
    """Base spans by the patterns as they are stated."""
    out = []
    for rank, (kind, pattern) in enumerate(BASE):
        for m in re.finditer(pattern, text or ""):
            found = m.group()
            digits = [int(c) for c in found if c in "0123456789"]
            if kind == "ip":
                good = all(len(p) < 4000 and int(p) <= 255 for p in found.split("."))
            elif kind == "card":
                doubled = [d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(reversed(digits))]
                good = 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0
            else:
                good = kind == "email" or 9 <= len(digits) <= 15
            if good:
                out.append((m.start(), rank, kind, m.end()))
    return [f"{kind}:{start}:{end}" for start, _, kind, end in sorted(out)]


TEXTS = [
    None, "", "a@b.c", "a@b", "a@b.c@d.e", "@b.c@d.e", "x@y.z.", "é@b.cö a.b+c@d-e.f_g@h.i", "a@@b.c", "a@b..c", "1.2.3.4.5.6.7.8", "256.1.1.1 001.02.0003.4",
    "1.2.3.4@5.6", "4111 1111 1111 1111", "4111111111111112", "4111-1111-1111-1111-", "4111  111111111111", "1" * 40, "0 0 0 0 0 0 0 0 0 0 0 0", "+1 (743) 555-3824",
    "+1(", "+12", "+1 2", "++49 30 1234567890", "+1 23456789 1234567890", "+1 555 0100 000 +2 555 0100 000", "0" * 12, "a\n1.1.1.1\n+1 555 010 0000", "١٢٣٤.١.١.١",
    "9" * 5000 + ".1.1.1", "😀 a@b.cd 😀 1.1.1.1", "a%b@c.d-", "-@-.-", "1-2-3@4.5", "+4111111111111111",
]


def fuzzed(n):
    rng = random.Random(3)
    signs = ["1", "4", "0", "25", ".", ".", "@", "+", " ", "-", "(", ")", "a", "b.c", "é", "\n", "4111111111111111", "_", "%", "1.2.3.4"]
    return ["".join(rng.choice(signs) for _ in range(rng.randrange(60))) for _ in range(n)]


def rows_of(spark, texts, **more):
    given = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, kind string, start int")
    return personal.find(given, ["doc_id", "kind"], **more)


def test_base_spans_equal_the_stated_patterns(spark):
    texts = TEXTS + fuzzed(3000)
    for r in personal.digest(rows_of(spark, texts), ["doc_id", "kind"]).collect():
        want = plain(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), texts[r.doc_id]
        assert set(want) <= set(r.spans.split(",")) | {""}
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w.startswith(k) for w in want) for k, _ in BASE]
        assert r.kind == "x" and r.n_added == len([s for s in r.spans.split(",") if s]) - len(want)


def added(text):
    return [(s.kind, text[s.start : s.end]) for _, s, base in personal.spans(text, [0]) if not base]


def test_added_kinds_and_their_checks():
    cases = {
        "pay to DE89 3704 0044 0532 0130 00 AND more": [("iban", "DE89 3704 0044 0532 0130 00")],
        "GB82WEST12345698765432.": [("iban", "GB82WEST12345698765432")], "GB83WEST12345698765432": [], "GB82WEST123456987654321": [],
        "jane.doe [at] example [dot] org": [("email", "jane.doe [at] example [dot] org")], "look (at) this": [],
        "mail jörg@müller.de": [("email", "jörg@müller.de")], "no@domain": [],
        "4111111111111111 4111111111111112": [("card", "4111111111111111")], "4111.1111.1111.1111": [("card", "4111.1111.1111.1111")],
        "7536784127813050 1234": [], "server fe80::1ff:fe23:4567:890a": [("ip", "fe80::1ff:fe23:4567:890a")], "at 12:30:45": [], "a::b": [],
        "call (030) 123-4567 now": [("phone", "(030) 123-4567")], "page 030 123-4567 now": [], "born 1999-12-31": [("birth_date", "1999-12-31")],
        "dated 1999-12-31": [], "born 1999-13-31": [], "SSN 123-45-6789": [("national_id", "123-45-6789")], "part 123-45-6789": [], "SSN 666-45-6789": [],
    }
    for text, want in cases.items():
        assert added(text) == want, text


def test_words_nearby_adjust_the_score_within_one_text():
    score = lambda text, starts=(0,): {(i, s.kind): s.score for i, s, _ in personal.spans(text, list(starts))}
    alone, server, version = (score(w + " 10.0.0.1")[0, "ip"] for w in ("the", "server", "version"))
    assert version < alone < server
    assert score("version\n10.0.0.1", (0, 8))[1, "ip"] == alone
    assert score("version " + "x " * 40 + "10.0.0.1")[0, "ip"] == alone


def test_masked_text(spark):
    got = rows_of(spark, ["a a@b.cd, 1.2.3.4!", None, "clean"], masked="safe").orderBy("doc_id").collect()
    assert [r.safe for r in got] == ["a [EMAIL], [IP]!", "", "clean"]


def test_long_runs_end(spark):
    started = time.process_time()
    for text in ("1" * 300_000, "a" * 300_000, "1." * 150_000, "@" * 300_000, "1-" * 150_000, "+1" + " " * 300_000, "é@ü." * 70_000, "[at]" * 70_000, "A1" * 150_000):
        personal.spans(text, [0])
    assert time.process_time() - started < 20


def test_no_rows_and_clashing_names(spark):
    none = spark.createDataFrame([], "doc_id long, text string, found int, _whole_text int")
    assert personal.find(none, ["doc_id", "_whole_text"]).collect() == []
    with pytest.raises(ValueError):
        personal.find(none, ["found"])


def test_query(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = queries.op13_personal(spark, small).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r.base_sha256 == hashlib.sha256(",".join(plain(texts[r.doc_id])).encode()).hexdigest()
