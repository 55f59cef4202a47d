from itertools import permutations
import re

import duckdb
import pytest

from tests.test_registry import rows as compared
from tristrata.llm import audit, queries

DOCS = "doc_id long, text string, source string, part string, mask int, n int"
LABELS = "doc_id long, quality int, toxic int"


def failing(docs):
    """The letters each row fails, straight from their definitions."""
    out = []
    for key, text, *_ in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = ""
        if len(words) < 50:
            fails += "A"
        if 100 * len(set(words)) < 65 * len(words):
            fails += "B"
        if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text):
            fails += "C"
        if re.search("[#$%&*|]", text):
            fails += "D"
        if key is not None and any(k is not None and k < key and (t or "") == text for k, t, *_ in docs):
            fails += "E"
        out.append(fails)
    return out


def simulated(docs, labels):
    """Every order applied to the rows one by one."""
    fails = failing(docs)
    good = {k for k, q, _ in labels if q == 1 and k is not None}
    toxic = {k for k, _, t in labels if t == 1 and k is not None}
    out = {}
    for part in {d[2] or "" for d in docs}:
        mine = [(d[0], f) for d, f in zip(docs, fails) if (d[2] or "") == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, letter in enumerate(order, 1):
                gone = [x for x in left if letter in x[1]]
                left = [x for x in left if letter not in x[1]]
                total[letter] += len(gone)
                failed = sum(letter in f for _, f in mine)
                out[part, order, step] = [
                    len(left), len(gone), failed - len(gone), sum(f == letter for _, f in mine),
                    sum(k in good for k, _ in gone), sum(k in toxic for k, _ in gone),
                ]
        for order in map("".join, permutations("ABCDE")):
            for step, letter in enumerate(order, 1):
                out[part, order, step].append(total[letter])
    return out


def given():
    varied = " ".join("word%d" % i for i in range(60))
    texts = [
        None, "", "x", varied, varied, varied + " #", "A" * 40, "a b " * 60, varied + " a" * 200, varied.upper(), "\xa0a\x85 b",
        "w " * 20000, "line\none\x0btwo\x1fthree", "$", "É" * 50, varied.replace(" ", "\t"),
    ]
    docs = [(i, t, ["s", "t", None, ""][i % 4], "x", 9, 9) for i, t in enumerate(texts)]
    docs += [(3, varied, "s", "x", 0, 0), (3, varied, "s", "x", 0, 0), (None, varied, "t", "x", 0, 0), (None, None, None, None, None, None)]
    docs += [(100 + i, varied, "s", "x", 0, 0) for i in range(40)]
    labels = [(i, i % 2, (i + 1) % 3) for i in range(0, 140, 2)] + [(1, None, 1), (1, 1, None), (None, 1, 1), (2, 0, 0)]
    return docs, labels


def test_equals_applying_every_order(spark):
    docs, labels = given()
    got = audit.audit_texts(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    want = simulated(docs, labels)
    assert len(got) == len(want) == 600 * 3
    for r in got:
        have = [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley]
        assert have == want[r.part, r.filter_order, r.step], r


def test_lattice_counts_are_orders():
    for n in (1, 3, 5):
        edges = audit.lattice(n)
        orders = list(permutations(range(n)))
        for state, f, reach, leave in edges:
            through = sum({*o[: bin(state).count("1")]} == {i for i in range(n) if state >> i & 1} and o[bin(state).count("1")] == f for o in orders)
            assert reach * leave == through
    with pytest.raises(ValueError):
        audit.lattice(0)


def test_no_rows_and_other_filters(spark):
    none = audit.audit_texts(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS))
    assert none.collect() == []
    docs = spark.createDataFrame([(1, "a", "s"), (2, "b", "s"), (3, "ab", "s")], "doc_id long, text string, source string")
    kinds = audit.failure_sets(docs, {"has_a": docs.text.contains("a"), "has_b": docs.text.contains("b")}, None)
    got = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.shapley) for r in audit.audit(audit.cells(kinds), ["a", "b"]).collect()}
    assert got == {("ab", 1): (1, 2, 0, 3), ("ab", 2): (0, 1, 1, 3), ("ba", 1): (1, 2, 0, 3), ("ba", 2): (0, 1, 1, 3)}


def test_query_equals_sql(spark, small):
    db = duckdb.connect()
    for t in ("documents", "labels"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    df = queries.op11_audit(spark, small)
    cursor = db.execute(queries.OP11_SQL)
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert compared(df.columns, [tuple(r) for r in df.collect()]) == compared(columns, cursor.fetchall())
