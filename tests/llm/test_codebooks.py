"""Product codes against plain Lloyd's rounds."""

import hashlib

import duckdb
import numpy as np
import pytest

from plexus.llm import codebooks as C
from plexus.llm.registry import op13_product_codes, op13_sql
from tests.conftest import SF_SMALL


def plain(rows, parts=4, entries=256, rounds=4):
    """rows: (vec_id, vector, label); every part against every entry."""
    rows = [(i, np.floor(1024 * np.array(v, float)).astype(int), label) for i, v, label in rows
            if v and all(x is not None and np.isfinite(x) for x in v)]
    x = np.array([v for _, v, _ in rows]).reshape(len(rows), parts, -1)
    first = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0], rows[k][1].tolist()))[:entries]
    books = x[first].swapaxes(0, 1).copy()

    def nearest():
        far = ((x[:, :, None, :] - books[None]) ** 2).sum(3)
        return far.argmin(2), far.min(2)

    for _ in range(rounds):
        own, _ = nearest()
        for k in range(parts):
            for e in set(own[:, k].tolist()):
                members = x[own[:, k] == e, k]
                books[k, e] = members.sum(0) // len(members)
    own, far = nearest()
    error, total = far.sum(1), {}
    for (_, _, label), e in zip(rows, error, strict=True):
        total[label] = total.get(label, 0) + int(e)
    digest = hashlib.sha256(",".join(str(c) for c in books.ravel()).encode()).hexdigest()
    return sorted(((i, "".join(f"{c:02x}" for c in own[k]), int(error[k]), total[label], digest) for k, (i, _, label) in enumerate(rows)),
                  key=lambda r: (r[0] is None, r))


def got(frame, **more):
    return sorted(map(tuple, C.compressed(frame, **more).collect()), key=lambda r: (r[0] is None, r))


def clusters(rng, n, width, centers):
    at = rng.uniform(-0.5, 0.5, (centers, width))
    return at[rng.integers(0, centers, n)] + rng.normal(0, 0.02, (n, width))


def test_clustered_equal_and_spread_vectors(spark):
    rng = np.random.default_rng(3)
    x = np.vstack([clusters(rng, 500, 8, 9), np.repeat(rng.uniform(-1, 1, (1, 8)), 400, 0), rng.uniform(-1, 1, (200, 8))])[rng.permutation(1100)]
    rows = [(int(i), v.tolist(), int(i) % 3 or None) for i, v in enumerate(x)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert got(frame, block=150) == plain(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(5, [0.1, 0.2, -0.3, 0.0], "a"), (5, [0.1, 0.2, -0.3, 0.0], "a"), (5, [0.0, 0.2, -0.3, 0.0], None), (None, [1.0, 1.0, 1.0, 1.0], None),
            (1, None, "a"), (2, [None, 1.0, 1.0, 1.0], "a"), (3, [nan, 1.0, 1.0, 1.0], "a"), (4, [1.0, -inf, 1.0, 1.0], "b"), (6, [], "b"),
            (7, [-0.0001, 0.0, 0.5, 0.5], "b")]
    frame = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "vec_id long, embedding array<float>, label string, row int, code string, error int")
    single = [(i, v and [None if c is None else float(np.float32(c)) for c in v], label) for i, v, label in rows]
    assert got(frame) == plain(single) and len(got(frame)) == 5
    assert got(frame.limit(0)) == []
    few = [(i, [i / 7, -i / 5, i / 3, 0.5], None) for i in range(6)]
    assert got(spark.createDataFrame(few, "vec_id long, embedding array<double>, label int"), entries=2, rounds=3) == plain(few, entries=2, rounds=3)


def test_vectors_that_cannot_be_cut(spark):
    for vectors in ([[1.0] * 4, [1.0] * 8], [[1.0] * 6], [[1.0, 1e9, 0.0, 0.0]]):
        frame = spark.createDataFrame([(k, v, 0) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>, label int")
        with pytest.raises(ValueError, match="components"):
            C.compressed(frame)


def test_trees_meet_exactly_and_spare_comparisons():
    rng = np.random.default_rng(4)
    for width in (1, 3, 16):
        for x in (np.rint(1000 * clusters(rng, 3000, width, 12)).astype(int), rng.integers(-2, 2, (1500, width))):
            book = x[rng.integers(0, len(x), 200)]
            order, *arrays = C.split_tree(x, C.LEAF)
            tree = dict(zip(("lo", "hi", "sums", "first", "last", "left", "right"), arrays, strict=True)) | {"points": x[order]}
            compared = []
            whole, places, chosen = C.assign(C.Entries(book), book, tree, compared)
            own = np.full(len(x), -1)
            for node, entry in whole:
                own[tree["first"][node]:tree["last"][node]] = entry
                assert (tree["sums"][node] == x[order][tree["first"][node]:tree["last"][node]].sum(0)).all()
            own[places] = chosen
            assert (own == ((x[order][:, None] - book[None]) ** 2).sum(2).argmin(1)).all()
            if width < 16 or len(x) == 3000:  # 16 unrelated components spare next to nothing
                assert sum(compared) < 0.4 * len(x) * len(book)


def test_many_labels_are_joined(spark, monkeypatch):
    monkeypatch.setattr(C, "LABELS", 1)
    rows = [(k, [k / 9, 0.1, 0.2, k / 50], k % 4 or None) for k in range(40)]
    assert got(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")) == plain(rows)


def test_registered_query(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF_SMALL}/embeddings.parquet'")
    want = sorted(con.execute(op13_sql()).fetchall())
    assert sorted(map(tuple, op13_product_codes(spark, SF_SMALL).collect())) == want
    assert want == plain([(r[0], r[1], r[2]) for r in con.execute("SELECT vec_id, embedding, label FROM embeddings").fetchall()])
