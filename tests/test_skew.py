"""Hot-key shapes: one node or key holding a large share of the rows.
Results must stay exact (checked against brute force); the salted and
pair-free paths are the ones exercised."""

import pytest

from plexus.operators import graph as G
from plexus.operators import social as S


@pytest.fixture(scope="module")
def star(spark):
    # hub 0 is friends with everyone; a ring among the others adds triangles
    n = 60
    pairs = [(0, i) for i in range(1, n)] + [(i, i % (n - 1) + 1) for i in range(1, n)]
    rows = sorted({(a, b) for a, b in pairs} | {(b, a) for a, b in pairs})
    return spark.createDataFrame(rows, "followerID bigint, followedID bigint"), rows


def test_mutual_friends_on_star(star):
    f, rows = star
    adj = {}
    for a, b in rows:
        adj.setdefault(a, set()).add(b)
    got = {(r.a, r.b): r.n_mutual for r in G.mutual_friends(f).collect()}
    want = {(a, b): len(adj[a] & adj[b]) for a, b in rows if a < b}
    assert got == want


def test_common_neighbours_never_lists_hub_pairs(star):
    f, rows = star
    pairs = f.where("followerID < followedID").selectExpr("followerID AS a", "followedID AS b")
    out = G.common_neighbours(pairs, f)
    # exact: one row per (pair, common friend), nothing more
    adj = {}
    for a, b in rows:
        adj.setdefault(a, set()).add(b)
    assert out.count() == sum(len(adj[a] & adj[b]) for a, b in rows if a < b)


def test_rank_with_hub_source_salted(spark):
    # node 0 holds most out-edges; salting splits it over many buckets
    edges = [(0, i) for i in range(1, 200)] + [(i, (i * 7) % 199 + 1) for i in range(1, 200)]
    e = spark.createDataFrame(sorted(set(edges)), "src bigint, dst bigint")
    plain = {r.node: round(r.rank, 9) for r in G.social_rank(e, max_iters=4, delta=None).collect()}
    salted = {r.node: round(r.rank, 9) for r in
              G.social_rank(e, max_iters=4, delta=None, fanout_chunk=8).collect()}
    assert plain == salted


def test_last_writer_wins_on_hot_key(spark):
    # one key takes 300 of 301 operations
    ops = [(i, "put" if i % 3 else "delete", 1, 1) for i in range(1, 301)] + [(400, "put", 2, 2)]
    log = spark.createDataFrame(ops, "seq long, op string, postID long, userID long")
    out = sorted(tuple(r) for r in S.apply_changes(log, ["postID", "userID"], "seq").collect())
    assert out == [(2, 2)]  # the last operation on (1, 1) is seq 300, a delete
