import random

import pytest

from tests.llm.helpers import closure
from tristrata.llm import components as module
from tristrata.llm.components import components
from tristrata.llm.rows import Shelf


def test_components_equal_a_plain_union_find(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    links += [(1000 + i, 1001 + i) for i in range(100)]  # a long chain
    links += [(2000, 2001 + i) for i in range(100)]  # a hub
    links += [(None, 4), (5, None), (6, 6)]
    found = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    real = [(a, b) for a, b in links if a is not None and b is not None and a != b]
    assert found == closure({x for e in real for x in e}, real)


def test_no_links_no_components(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("few", [0, 50_000])
def test_few_links_are_not_shuffled(spark, monkeypatch, few):
    rounds, put = [], Shelf.put

    def seen(self, df, label):
        rounds.append(df._jdf.queryExecution().executedPlan().toString())
        return put(self, df, label)

    monkeypatch.setattr(module, "FEW", few, raising=False)
    monkeypatch.setattr(Shelf, "put", seen)
    rng = random.Random(12)
    links = [(i, i + 1) for i in range(60)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(70)]
    found = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    real = [(a, b) for a, b in links if a != b]
    assert found == closure({x for e in real for x in e}, real)
    assert len(rounds) > 1 and all(("hashpartitioning" in r) == (few == 0) for r in rounds[1:])
