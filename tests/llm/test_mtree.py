"""Top inner products against brute force."""

import duckdb
import numpy as np

from plexus.llm import mtree
from plexus.llm.registry import OP7_SQL, op7_mtree_top_k
from tests.conftest import SF_SMALL


def brute(rows, asked, k):
    out = []
    for i in asked:
        q = rows[i]
        best = sorted((-int(q @ v), j) for j, v in rows.items() if j != i)[:k]
        out += [(i, r, j, -s) for r, (s, j) in enumerate(best, 1)]
    return sorted(out)


def test_trees_of_random_clustered_and_equal_vectors(spark):
    rng = np.random.default_rng(5)
    centers = rng.normal(0, 60, (6, 8))
    points = np.vstack([centers[rng.integers(0, 6, 700)] + rng.normal(0, 9, (700, 8)), rng.normal(0, 90, (300, 8)), np.full((400, 8), 30)])
    rows = {int(i): v.astype(int) for i, v in enumerate(points)}
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in rows.items()], "vec_id long, v array<long>")
    asked = [i for i in rows if i % 50 == 0]
    for size in (300, 5000):
        got = mtree.top_k(frame, frame.filter("vec_id % 50 = 0"), 5, tree_size=size, block=10).collect()
        assert sorted(map(tuple, got)) == brute(rows, asked, 5)


def test_search_skips_work():
    rng = np.random.default_rng(6)
    x = np.rint(np.repeat(rng.normal(0, 100, (40, 4)), 50, 0) + rng.normal(0, 2, (2000, 4)))
    most = (x * x).sum(1).max()
    lifted = np.hstack([x, np.sqrt(most - (x * x).sum(1))[:, None]])
    pages = {r[1]: (r[2], np.frombuffer(r[3], np.int64), np.frombuffer(r[4]).reshape(-1, 5), np.frombuffer(r[5]), np.frombuffer(r[6]))
             for r in mtree.build(0, np.arange(2000), lifted)}
    opened = []

    class Counted(dict):
        def __getitem__(self, k):
            opened.append(k)
            return dict.__getitem__(self, k)

    got = mtree.search(Counted(pages), np.append(x[3], 0.0)[None], np.array([3]), 5, most)
    assert [(s, i) for _, i, s in got] == [(-s, i) for s, i in sorted((-int(x[3] @ v), i) for i, v in enumerate(x) if i != 3)[:5]]
    assert len(opened) < 0.7 * len(pages)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (50, [-0.01, 2.0]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (4, [inf, 0.0]), (5, [1.0, 0.5]),
            (100, [nan, 0.0]), (None, [1.0, 1.0]), (6, [1.0, 0.5]), (7, [])]
    table = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, score int")
    v = mtree.integer_vectors(table)
    got = sorted(map(tuple, mtree.top_k(v, v.filter("vec_id % 50 = 0")).collect()))
    ints = {0: np.array([256, 128]), 50: np.array([-3, 512]), 5: np.array([256, 128]), 6: np.array([256, 128])}
    assert got == brute(ints, [0, 50], 5)
    assert mtree.top_k(v.limit(0), v.limit(0)).collect() == []


def test_registered_query(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF_SMALL}/embeddings.parquet'")
    assert sorted(map(tuple, op7_mtree_top_k(spark, SF_SMALL).collect())) == sorted(con.execute(OP7_SQL).fetchall())
