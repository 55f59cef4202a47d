import re

import duckdb
import pytest

from tests.test_registry import rows as compared
from tristrata.llm import mixing, queries

SCHEMA = "doc_id long, text string, source string, size int"


def water(sizes):
    """Targets by sharing again and again what goes beyond twice a source's size."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    budget, fixed = 1.5 * sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in fixed]
        level = (budget - sum(fixed.values())) / sum(weight[s] for s in rest) if rest else 0
        above = [s for s in rest if weight[s] * level > 2 * sizes[s]]
        if not above:
            return fixed | {s: weight[s] * level for s in rest}
        fixed |= {s: 2.0 * sizes[s] for s in above}


def test_targets_and_what_is_taken(spark):
    docs = [
        (i, " ".join(["w"] * (1 + i * 7919 % 23)) + " \x0b\t", ["b", "a", "é", "Z", None, "c"][min(i % 11, 5)], 0) for i in range(3000)
    ]
    docs += [(None, "x y", "a", 0), (4000, None, "a", 0), (4001, "", "only empty", 0), (4002, "\xa0a b\x85c", "c", 0)]
    got = mixing.mix(spark.createDataFrame(docs, SCHEMA)).collect()
    sizes, taken, target = {}, {}, {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.size * r.times
    for key, text, *_ in docs:
        assert any(r.id == key and r.size == len(re.findall(r"[^\x20\x09-\x0D]+", text or "")) for r in got)
    assert target == pytest.approx(water(sizes))
    assert all(r.source_size == sizes[r.source] for r in got)
    assert all(abs(taken[s] - target[s]) <= 12 for s in sizes)  # half a document


def test_a_larger_budget_takes_a_superset_and_reruns_agree(spark):
    docs = spark.createDataFrame([(i, "a b c d", "s%d" % (i % 4), 0) for i in range(400)], SCHEMA)
    measured = mixing.sizes(docs)

    def chosen(share):
        plan = mixing.plan(measured, share=share)
        rows = measured.join(plan.withColumnRenamed("source", "s"), mixing.F.col("source") == mixing.F.col("s"))
        return {(r.id, r.passes + (r.place < r.below and r.passes < 2)) for r in rows.collect()}

    small, again, large = chosen(0.4), chosen(0.4), chosen(0.5)
    assert small == again
    more = dict(large)
    assert all(more[i] >= n for i, n in small)


def test_applied_copies_equal_the_plan(spark):
    docs = spark.createDataFrame([(i, "a b " * (i % 5), ["x", "y", None][i % 3], i) for i in range(300)], SCHEMA)
    times = {r.id: r.times for r in mixing.mix(docs).collect()}
    count = {}
    for r in mixing.apply_mix(docs).collect():
        count[r.doc_id] = count.get(r.doc_id, 0) + 1
        assert r.size == r.doc_id
    assert count == {i: n for i, n in times.items() if n}
    assert mixing.apply_mix(docs).columns == docs.columns


def test_no_rows_and_no_words(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert mixing.mix(none).collect() == [] and mixing.apply_mix(none).collect() == []
    blank = mixing.mix(spark.createDataFrame([(1, " ", None, 0)], SCHEMA)).collect()
    assert [(r.size, r.target, r.taken) for r in blank] == [(0, 0.0, 0)]


def test_query_equals_sql(spark, small):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    df = queries.op8_mixing(spark, small)
    cursor = db.execute(queries.OP8_SQL)
    columns = [c[0] for c in cursor.description]
    assert compared(df.columns, [tuple(r) for r in df.collect()]) == compared(columns, cursor.fetchall())


def test_targets_are_met_where_ids_repeat_or_are_null(spark):
    """A third of a source's words stands under null ids, another third under one id."""
    docs = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, "w%d " % i * (1 + i % 9), "ab"[i % 2], 0) for i in range(6000)]
    got = mixing.mix(spark.createDataFrame(docs, SCHEMA)).collect()
    for source in "ab":
        mine = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 10
