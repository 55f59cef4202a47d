"""Every gate reports exact violation counts on tampered rows."""

import pytest

from tests.helpers import plan_of, rows
from tristrata.operators import gates as gt
from tristrata.plans import contracts as ct


@pytest.fixture
def df(spark):
    return spark.createDataFrame(
        [
            (1, "A", "B", 5.0, 1, 2),
            (2, "A", "A", 0.0, 2, 2),
            (2, None, "B", -1.0, 3, 2),
            (3, "LONG", "B", None, None, 2),
            (3, "LONG", "B", None, None, 2),
        ],
        "k int, a string, b string, x double, lo int, hi int",
    )


def counts(df, *gates):
    return {r.gate: r.violations for r in gt.run(df, list(gates), "t").collect()}


def test_row_gates(df):
    found = counts(
        df,
        gt.not_null(["a", "x"]),
        *gt.not_null_each(["a", "x"]),
        gt.ordered("lo", "hi"),
        gt.ordered("lo", "hi", strict=False),
        gt.columns_differ("a", "b"),
        gt.positive("x"),
        gt.positive("absent"),
        gt.max_length("a", 3),
    )
    assert found["not_null(a,x)"] == 3
    assert found["not_null(a)"] == 1 and found["not_null(x)"] == 2
    assert found["columns_differ(a,b)"] == 1
    assert found["positive(x)"] == 2 and found["positive(absent)"] == 0
    assert found["max_length(a,3)"] == 2


def test_ordered_ignores_nulls_and_counts_equality_when_strict(df):
    assert counts(df, gt.ordered("lo", "hi")) == {"ordered(lo,hi)": 2}
    assert counts(df, gt.ordered("lo", "hi", strict=False)) == {"ordered(lo,hi)": 1}


def test_key_gates(df):
    assert counts(df, gt.unique(["k"])) == {"unique(k)": 2}
    assert rows(gt.violations(df, gt.unique(["k"])), "k") == [(2, 2), (3, 2)]
    assert counts(df, gt.no_full_duplicates()) == {"no_full_duplicates": 1}
    assert counts(df, gt.no_full_duplicates(["b"])) == {"no_full_duplicates": 1}


def test_schema_and_size_gates(df):
    needed = gt.required_columns(["K", "a", "zz"])
    assert counts(df, needed, gt.not_empty()) == {"required_columns": 1, "not_empty": 0}
    assert rows(gt.violations(df, needed)) == [("zz",)]
    assert rows(gt.violations(df, gt.required_columns(["k"]))) == []
    none = df.where("k > 9")
    assert counts(none, gt.not_empty(), gt.positive("x")) == {"not_empty": 1, "positive(x)": 0}
    assert rows(gt.violations(none, gt.not_empty())) == [(0,)]


def test_foreign_keys_with_and_without_nulls(spark):
    fact = spark.createDataFrame([(1,), (2,), (None,), (9,), (9,)], "k int")
    dim = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    assert rows(gt.violations(fact, gt.fk_exists("k", dim, "id"))) == [(9, 2)]
    with_null = gt.fk_exists("k", dim, "id", ignore_nulls=False)
    assert rows(gt.violations(fact, with_null), "key") == [(None, 1), (9, 2)]


def test_delay_sums(spark):
    pairs = [(20.0, 20.0), (25.0, 20.0), (26.0, 20.0), (20.0, 0.0), (-3.0, 10.0), (None, 10.0)]
    df = spark.createDataFrame(
        [(t, s, None) for t, s in pairs], "total double, p double, q double"
    )
    gate = gt.sum_consistency("total", ["p", "q"])
    assert rows(gt.violations(df, gate).select("total", "p")) == [(26.0, 20.0)]


def test_exact_sums_judge_only_known_operands(spark):
    df = spark.createDataFrame(
        [(3.0, 1.0, 2.0), (4.0, 1.0, 2.0), (3.0, 1.0, None)], "t double, p double, q double"
    )
    exact = gt.sum_consistency("t", ["p", "q"], tol=0.0, only_positive=False)
    assert counts(df, exact) == {"sum_consistency(t)": 1}


def test_castable(spark):
    df = spark.createDataFrame([("5",), ("70000",), ("x",), ("",), (None,)], "c string")
    assert counts(df, gt.castable("c", "smallint")) == {"castable(c,smallint)": 2}


def test_row_gates_share_one_scan(spark, small):
    df = spark.read.parquet(f"{small}/lineitem.parquet")
    gates = [gt.not_empty(), gt.positive("l_quantity"), gt.ordered("l_partkey", "l_suppkey")]
    assert plan_of(gt.run(df, gates, "lineitem")).count("FileScan") == 1


def test_enforce(df):
    gt.enforce(gt.run(df, [gt.not_empty()], "t"))
    with pytest.raises(gt.QualityError, match="positive.x. has 2"):
        gt.enforce(gt.run(df, [gt.positive("x"), gt.unique(["k"])], "t"))


def test_watch_counts_during_the_write(df, tmp_path):
    watched, result = gt.watch(df, [gt.not_empty(), gt.positive("x"), gt.unique(["k"])], "t")
    watched.write.parquet(str(tmp_path / "out"))
    found = {r.gate: (r.violations, r.passed) for r in result().collect()}
    assert found == {"not_empty": (0, True), "positive(x)": (2, False)}


def test_gates_from_a_contract(spark):
    dim = spark.createDataFrame([(1,)], "id bigint")
    table = ct.Table(
        "t",
        {"id": "bigint", "code": "string", "ref": "bigint"},
        pk=("id",),
        not_null=("code",),
        unique=("code",),
        max_len={"code": 2},
        fks={"ref": ("dim", "id")},
    )
    df = spark.createDataFrame(
        [(1, "a", 1), (1, "a", 2), (None, "abc", 1)], "id bigint, code string, ref bigint"
    )
    assert counts(df, *ct.gates_of(table, {"dim": dim})) == {
        "not_empty": 0,
        "required_columns": 0,
        "not_null(id)": 1,
        "not_null(code)": 0,
        "unique(id)": 1,
        "unique(code)": 1,
        "max_length(code,2)": 1,
        "fk_exists(ref)": 1,
    }


def formatted(df) -> str:
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def test_key_gates_share_one_scan_and_one_join(spark, small):
    lineitem, orders, part, supplier = (
        spark.read.parquet(f"{small}/{t}.parquet") for t in ("lineitem", "orders", "part", "supplier")
    )
    gates = [
        gt.unique(["l_orderkey", "l_linenumber"]),
        gt.unique(["l_partkey"]),
        gt.fk_exists("l_orderkey", orders, "o_orderkey"),
        gt.fk_exists("l_partkey", part, "p_partkey", ignore_nulls=False),
        gt.fk_exists("l_suppkey", supplier.where("s_suppkey > 3"), "s_suppkey"),
    ]
    result = gt.run(lineitem, gates, "lineitem")
    plan = formatted(result)
    assert plan.count("lineitem.parquet]") == 1
    assert plan.count("Join (") // 2 == 1 or plan.count("Join LeftOuter") + plan.count("SortMergeJoin(") <= 1
    apart = {g.name: gt.violations(lineitem, g).count() for g in gates}
    assert {r.gate: r.violations for r in result.collect()} == apart


def test_shared_keys_of_many_types(spark):
    df = spark.createDataFrame(
        [(0.0, b"a", ["x", None], None, 1), (-0.0, b"a", ["x", None], "NULL", 1), (1.5, b"b", ["x", "null"], "", 2), (None, None, None, None, None)],
        "f double, b binary, a array<string>, s string, k int",
    )
    gates = [gt.unique([c]) for c in ("f", "b", "a", "s")] + [gt.unique(["s", "k"])]
    apart = {g.name: gt.violations(df, g).count() for g in gates}
    assert counts(df, *gates) == apart == {"unique(f)": 1, "unique(b)": 1, "unique(a)": 1, "unique(s)": 1, "unique(s,k)": 0}


def test_foreign_keys_of_another_type_and_repeated_dimension_keys(spark):
    fact = spark.createDataFrame([(1,), (2,), (None,), (9,), (9,)], "k int")
    dim = spark.createDataFrame([("1",), ("2",), ("2",), (None,), ("x",)], "id string")
    assert counts(fact, gt.fk_exists("k", dim, "id")) == {"fk_exists(k)": 1}
    assert counts(fact, gt.fk_exists("k", dim, "id", ignore_nulls=False)) == {"fk_exists(k)": 2}
    wide = spark.createDataFrame([(1,), (2**40,)], "id bigint")
    assert counts(fact, gt.fk_exists("k", wide, "id")) == {"fk_exists(k)": 2}


def test_a_probe_stops_at_the_first_row(spark, small):
    lineitem = spark.read.parquet(f"{small}/lineitem.parquet")
    alone = gt.run(lineitem, [gt.not_empty()], "t")
    assert "Limit 1" in formatted(alone) or "LocalLimit" in formatted(alone)
    assert "ReadSchema: struct<>" in formatted(alone)
    shared = formatted(gt.run(lineitem, [gt.not_empty(), gt.positive("l_discount")], "t"))
    assert "Limit" not in shared and shared.count("lineitem.parquet]") == 1


def test_distinct_rows_are_never_moved_whole(spark, small):
    lineitem = spark.read.parquet(f"{small}/lineitem.parquet")
    plan = formatted(gt.run(lineitem, [gt.no_full_duplicates()], "t"))
    moved = [line for line in plan.splitlines() if "hashpartitioning" in line]
    assert not any("l_comment" in line or "l_quantity" in line for line in moved)
    assert counts(lineitem, gt.no_full_duplicates()) == {"no_full_duplicates": 0}


def test_rows_with_one_hash_are_compared_by_value(spark, monkeypatch):
    """With a hash that tells nothing apart the answers stay the same."""
    from pyspark.sql import functions as F
    from tristrata.operators import profile as pf

    df = spark.createDataFrame(
        [(1, None, "a"), (1, "a", None), (2, "b", "b"), (2, "b", "b"), (3, "c", "c"), (3, "c", "d"), (4, "e", "e")], "k int, x string, y string"
    )
    wide = df.withColumns({"z": F.lit(1), "w": F.lit(2)})

    def answers():
        return (
            counts(df, gt.no_full_duplicates()), rows(gt.violations(df, gt.no_full_duplicates())),
            rows(pf.duplicate_count(wide)), rows(pf.duplicate_members(wide, wide.columns)),
            rows(pf.key_collisions(df, ["k"]), "k"), rows(pf.all_collisions_identical(df, ["k"])),
        )

    plain = answers()
    assert plain[0] == {"no_full_duplicates": 1} and plain[2] == [(1,)] and len(plain[3]) == 2
    assert plain[4] == [(1, 2, False), (2, 2, True), (3, 2, False)] and plain[5] == [(False,)]
    monkeypatch.setattr(gt, "row_hash", lambda df, cols: F.lit(7).cast("long") + F.size(F.array(*(F.lit(1) for _ in cols))))
    assert answers() == plain


def test_full_duplicates_are_sought_among_rows_that_agree_on_some_columns(spark):
    """A repeated key is no full duplicate; only the key is hashed."""
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (2, "c"), (None, "d"), (None, "d")], "k int, x string")
    gate = gt.no_full_duplicates(by=["k"])
    assert counts(df, gate) == counts(df, gt.no_full_duplicates()) == {"no_full_duplicates": 2}
    assert rows(gt.violations(df, gate), "k") == [(None, "d", 2), (2, "c", 2)]
    assert counts(df.where("k = 1"), gate) == {"no_full_duplicates": 0}


def test_keys_are_tagged_within_compiled_code(spark):
    """NULL keys are dropped after the rows are dealt out, not by a function over each row's array."""
    df = spark.sql("SELECT * FROM VALUES (1, 'a'), (1, NULL), (2, 'b') AS t(k, f)")
    known = spark.sql("SELECT 'a' AS f")
    counted = gt.key_counts(df, [gt.unique(["k"]), gt.fk_exists("f", known, "f"), gt.fk_exists("f", known, "f", ignore_nulls=False)])
    assert "lambdafunction" not in plan_of(counted)
    assert [r.violations for r in counted.collect()] == [1, 1, 2]
