import duckdb
import numpy as np

from tests.llm.helpers import closure
from tests.test_registry import rows as compared
from tristrata.llm import queries, vectors


def plain(rows, threshold=0.98):
    good = [
        (i, np.array(v, float), label) for i, v, label in rows
        if i is not None and label is not None and v and None not in v and np.isfinite(v).all() and np.any(v)
    ]
    links, count = [], {i: 0 for i, _, _ in good}
    for x, (i, a, la) in enumerate(good):
        for j, b, lb in good[x + 1 :]:
            if la == lb and len(a) == len(b):
                a1, b1 = a / np.abs(a).max(), b / np.abs(b).max()
                if a1 @ b1 / np.sqrt((a1 @ a1) * (b1 @ b1)) >= threshold:
                    links.append((i, j))
                    count[i] += 1
                    count[j] += 1
    root = closure([i for i, _, _ in rows if i is not None], links)
    return {i: (count.get(i, 0), root.get(i), i is not None and root[i] == i) for i, _, _ in rows}


def given():
    rng = np.random.default_rng(4)
    rows, centres = [], rng.normal(size=(6, 16))
    for i in range(240):
        v = centres[rng.integers(6)] + rng.normal(size=16) * rng.choice([0.0, 0.12, 0.2, 1.0])
        rows.append((i, [float(np.float32(x)) for x in v * rng.choice([1, 1, 1e-3, 50])], int(rng.integers(3))))
    v = rows[0][1]
    rows += [
        (300, v, None), (301, None, 1), (302, [], 1), (303, [0.0] * 16, 1), (304, [None] + v[1:], 1),
        (305, [float("nan")] + v[1:], 1), (306, [float("inf")] + v[1:], 1), (307, v[:8], rows[0][2]), (308, [1e30] * 16, 1),
        (309, [1e30] * 16, 1), (310, [1e-38] * 16, 1), (None, v, rows[0][2]), (311, [-0.0] * 15 + [1.0], 2), (312, [0.0] * 15 + [1.0], 2),
    ]
    return rows


def test_links_equal_all_pairs(spark):
    rows = given()
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, component_id string")
    for block in (2048, 13):
        got = {r.id: (r.n_links, r.component_id, r.kept) for r in vectors.near_vectors(df, block=block).collect()}
        assert got == plain(rows)


def test_bound_holds():
    rng = np.random.default_rng(8)
    for dim in (3, 64, 1500):
        a = rng.normal(size=(40, dim)) * rng.choice([1e-3, 1, 30], size=(40, 1))
        b = np.concatenate([a + rng.normal(size=a.shape) * 0.1, rng.normal(size=(10, dim))])
        cosine = (a / np.linalg.norm(a, axis=1)[:, None]) @ (b / np.linalg.norm(b, axis=1)[:, None]).T
        for threshold in (0.5, 0.9, 0.98):
            near = set(zip(*(x.tolist() for x in vectors.candidates(a, b, threshold))))
            assert set(zip(*(x.tolist() for x in np.nonzero(cosine >= threshold)))) <= near


def test_no_rows(spark):
    assert vectors.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect() == []


def test_query_equals_sql(spark, small):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{small}/embeddings.parquet'")
    df = queries.op4_vectors(spark, small)
    cursor = db.execute(queries.OP4_SQL)
    columns = [c[0] for c in cursor.description]
    assert compared(df.columns, [tuple(r) for r in df.collect()]) == compared(columns, cursor.fetchall())
